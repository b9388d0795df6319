"""Counts gathered while a job runs (F5, F10, H0): what a crawl could not parse, class or key.

The counts are observed metrics of the tables that a run writes anyway, so they cost no pass of
their own.  A watched table must be written (or computed) before ``totals`` is read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Named counts of one run; the same name may be counted on several tables."""

    def __init__(self) -> None:
        self._observed: list[Observation] = []

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """``df``, counting the rows where each condition is true once it is computed; NULL counts as false."""
        return self.watch_sums(df, **{name: F.when(cond, 1).otherwise(0) for name, cond in counts.items()})

    def watch_sums(self, df: DataFrame, **values: Column) -> DataFrame:
        """``df``, adding up each value once it is computed; an empty table and NULLs add nothing."""
        seen = Observation()
        self._observed.append(seen)
        return df.observe(seen, *[F.coalesce(F.sum(v), F.lit(0)).alias(name) for name, v in values.items()])

    def totals(self) -> dict[str, int]:
        """The counts of all watched tables, by name."""
        out: Counter[str] = Counter()
        for seen in self._observed:
            out.update({name: int(n) for name, n in seen.get.items()})
        return dict(out)
