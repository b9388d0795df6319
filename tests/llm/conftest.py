import pytest

ROWS = [
    (0, "The quick brown fox jumps over the lazy dog near the river bank today.\nA second line of words here.", "en", "s0"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.\nA second line of words here.", "en", "s0"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.\nA second line of words here.", "en", "s0"),
    (2, None, None, None),
    (3, "", "en", "s1"),
    (None, "Text of a row without an id, mail a.b@mail.example.com now.", "en", None),
    (4, " \t\n ", "en", "s1"),
    (5, "été über ñandú 日本語 🎉 <|endoftext|> x\r\n\n  y", "fr", "s1"),
    (6, " ".join(f"w{i % 997}x" for i in range(20_000)), "en", "s0"),
    (7, "Mail jo@host.example.org, call +1 (523) 555-1055, ip 10.0.0.1, card 4111 1111 1111 1111.", "en", "s2"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and columns that clash with outputs."""
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(ROWS, schema)
    return df.selectExpr("*", "length(text) n_chars", "1 n_words", "'x' component_id", "2 kept", "3 sig", "'k' key",
                         "4 line", "'z' n_dropped", "5 ids", "6 score", "7 shard", "8 spans", "'b' part")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
