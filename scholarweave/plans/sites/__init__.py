"""Per-site extraction jobs (E1-E16): pages in, entity DataFrames out."""
