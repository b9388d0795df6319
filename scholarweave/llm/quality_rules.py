"""Operator 8 [native]: quality statistics, fixed rules and robust multivariate outliers.

Statistics and rules are column expressions within a row.  The verdict on the rest fits, for every
(lang, source), location and scatter by minimum covariance determinant: from a median start,
concentration steps re-estimate mean and covariance on the ALPHA share of rows with the smallest
Mahalanobis distance.  All of it is partial aggregation (sums, approximate quantiles) over a narrow
table, so a source with a third of all rows is combined map-side; group values come back to the rows
by a broadcast of checked size, or by salted keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm.registry import query
from scholarweave.session import cut_lineage, table

#: Fixed values of the base statistics and rules.
SPACES = " \t\n\x0b\f\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

ALPHA = 0.75                        # share of a group that concentration steps keep
CONSISTENCY = 1.487                 # ALPHA / P(chi2_6 <= chi2_4 quantile of ALPHA): normal consistency for 4 dimensions
STEPS = 3
CUTOFF = 28.47                      # chi-square quantile, 4 degrees of freedom, tail 1e-5
MIN_GROUP = 100                     # smaller sources of a language are fitted together
FLOOR = (0.05, 0.5, 0.2, 0.2)      # least standard deviation of each dimension
DIMS = len(FLOOR)
BROADCAST_GROUPS = 100_000          # tables of at most so many groups (15 numbers and two keys each) are broadcast
SALTS = 64                          # parts of a group where there are more


def statistics(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    n_lines counts lines with a word.  A null text counts as an empty one: all statistics are 0.
    """
    has_word = lambda line: F.btrim(line, F.lit(SPACES)) != ""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                    F.col("source").cast("string").alias("source"), text.alias("text"))
    trimmed = F.btrim("text", F.lit(SPACES))
    d = d.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>"))
                     .otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+", -1)))
    d = d.withColumn("lines", F.filter(F.split("text", "\n", -1), has_word))
    d = d.select(
        "doc_id", "lang", "source", "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    # one hash a window; texts whose hashes are all different have no repeat and go no further
    d = d.withColumn("win", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), (F.col("n_words") - (WINDOW - 1)).cast("int")),
        lambda i: F.xxhash64(F.slice("words", i, WINDOW)))))
    repeats = F.size(F.array_distinct("win")) < F.size("win")
    d = d.drop("words").withColumn("sorted", F.when(repeats, F.sort_array(F.transform(
        "win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, at: F.coalesce(F.get("sorted", at)["h"] == x["h"], F.lit(False))
    at = F.sort_array(F.transform(F.filter("sorted", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
    d = d.withColumn("at", at)
    covered = F.aggregate(
        "at", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"])
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("win", "sorted", "at")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _vector() -> list[Column]:
    """Length-free transforms: log mean word length, log symbol rate, angles of the repeat shares."""
    share = lambda n, of: F.asin(F.sqrt(F.col(n) / F.greatest(F.col(of), F.lit(1))))
    return [F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)) + 1),
            F.log1p(1000 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
            share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]


def _with_group(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of ``rows`` to the written table ``groups`` (one row per key) that no large group heats up.

    Up to BROADCAST_GROUPS groups are broadcast; beyond that each group is spread over SALTS tasks.
    """
    if groups.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), keys, "left")
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in keys]), F.lit(SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(salted, [*keys, "_salt"], "left").drop("_salt")


def _cholesky(fit: DataFrame) -> DataFrame:
    """Adds the lower Cholesky factor l{i}{j} of the covariance columns c{i}{j}."""
    for i in range(DIMS):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}")
            fit = fit.withColumn(f"l{i}{j}", value)
    return fit.select("lang_g", "source_g", *[f"m{i}" for i in range(DIMS)],
                      *[f"l{i}{j}" for i in range(DIMS) for j in range(i + 1)])


def _with_distance(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance to the row's group (groups are null-safe keys)."""
    d = _with_group(rows, fit, ["lang_g", "source_g"])
    for i in range(DIMS):
        y = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            y = y - F.col(f"l{i}{j}") * F.col(f"y{j}")
        d = d.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, DIMS)), F.col("y0") * F.col("y0"))
    return d.withColumn("d2", d2).select(*rows.columns, "d2")


def _moments(rows: DataFrame, factor: float) -> DataFrame:
    """Mean and covariance (times ``factor``, floored on the diagonal) of each group."""
    pairs = [(i, j) for i in range(DIMS) for j in range(i + 1)]
    agg = rows.groupBy("lang_g", "source_g").agg(
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(DIMS)],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"v{i}{j}") for i, j in pairs])
    cov = [(F.col(f"v{i}{j}") * factor + (FLOOR[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in pairs]
    return _cholesky(agg.select("lang_g", "source_g", *[f"m{i}" for i in range(DIMS)], *cov))


def fit_groups(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant location and scatter (mean, Cholesky factor) of each group of ``rows``.

    ``rows`` has lang_g, source_g, x0..x3 and, to tell copies apart, doc_id.  The start is the coordinate-wise median with the
    floors as scale; each concentration step keeps the nearest ALPHA of a group.
    """
    start = rows.groupBy("lang_g", "source_g").agg(
        *[F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"m{i}") for i in range(DIMS)])
    start = start.select("*", *[F.lit(FLOOR[i] ** 2 if i == j else 0.0).alias(f"c{i}{j}")
                                for i in range(DIMS) for j in range(i + 1)])
    fit = cut_lineage(_cholesky(start), "mcd")
    for _ in range(STEPS):
        near = _with_distance(rows, fit)
        limit = cut_lineage(near.groupBy("lang_g", "source_g").agg(
            F.percentile_approx("d2", ALPHA, 1000).alias("limit")), "limits")
        kept = _with_group(near, limit, ["lang_g", "source_g"]).where("d2 <= limit")
        fit = cut_lineage(_moments(kept, CONSISTENCY), "mcd")
    return fit


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per input row: the statistics, base_failed, outlier_d2 and kept.

    kept is false for rows that fail the base rules and for rows whose squared Mahalanobis distance
    exceeds CUTOFF.  Null texts are empty and fail; a null lang or source is a group of its own;
    sources with fewer than MIN_GROUP passing rows in a language are fitted together.  Repeated rows
    count each; extra columns are ignored; an empty table gives no rows.
    """
    stats = statistics(docs)
    stats = cut_lineage(stats.select("*", base_failed().alias("base_failed"),
                                     *[x.alias(f"x{i}") for i, x in enumerate(_vector())],
                                     F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("lang_g"),
                                     F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source_0")), "stats")
    sizes = cut_lineage(stats.where(~F.col("base_failed")).groupBy("lang_g", "source_0")
                        .agg(F.count("*").alias("n")), "sizes")
    rows = _with_group(stats, sizes, ["lang_g", "source_0"]).withColumn(
        "source_g", F.when(F.col("n") >= MIN_GROUP, F.col("source_0")).otherwise(F.lit("*")))
    passing = rows.where(~F.col("base_failed")).select("doc_id", "lang_g", "source_g", *[f"x{i}" for i in range(DIMS)])
    fit = fit_groups(passing)
    judged = _with_distance(rows, fit)
    d2 = F.when(~F.col("base_failed"), F.col("d2"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", d2.alias("outlier_d2")) \
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("outlier_d2"), F.lit(0.0)) <= CUTOFF))


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rules and the outlier verdict for every row of ``documents``."""
    return quality_rules(table(spark, sf_dir, "documents"))
