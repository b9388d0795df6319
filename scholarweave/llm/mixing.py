"""Operator 12 [native]: mixing sources to target weights from packed, fixed-length blocks.

The documents of a source are packed end to end into blocks of ``BLOCK_WORDS`` words.  The mix is
output shards of ``SHARD_SLOTS`` slots; a shard's slots per source are multinomial draws from the
sources' shares (each slot draws a ticket by hash).  What the draws give a source beyond its target is
moved, slot by slot, to sources that fell short, so every source gets its target to the word.  The k-th
slot of a source maps through a pseudorandom permutation of its block numbers, another one each time
the source begins anew, and blocks join by number.  All randomness is hashes of counters: reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarweave.llm.registry import query
from scholarweave.session import cut_lineage, table

BLOCK_WORDS = 256
SHARD_SLOTS = 65536
ROUNDS = 32             # of the block permutation
BUCKETS = 4096          # of a source's documents, packed one after the other
SPAN = 1024             # shards whose running counts one task adds up

# Fixed values of the mixing contract.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
_SPACE = " \t\n\x0b\x0c\r"
_WORD_AND_SPACE = r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"


@dataclass
class Mix:
    """sources: one row each; slots: one row a slot; packed: one row for every piece of a document in a block."""
    sources: DataFrame
    slots: DataFrame
    packed: DataFrame


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (long); null: 0."""
    return F.coalesce(F.length(F.regexp_replace(F.btrim(text, F.lit(_SPACE)), _WORD_AND_SPACE, "w")),
                      F.lit(0)).cast("long")


def permuted(x: Column, n: Column, *key: Column, inverse: bool = False) -> Column:
    """The place of x in a pseudorandom permutation of 0 .. n - 1 named by ``key``: swap-or-not rounds.

    A round pairs x with (c - x) mod n and swaps the two if a hash bit of the larger says so; that is
    its own inverse for any n, so the rounds run backwards undo the permutation.
    """
    rounds = list(range(ROUNDS))[::-1] if inverse else list(range(ROUNDS))

    def step(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - at, n)
        swap = F.xxhash64(*key, r, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)
    return F.aggregate(F.array(*[F.lit(r) for r in rounds]), x, step)


def running(df: DataFrame, by: list[str], bucket: str, order: list[str], sums: dict[str, str]) -> DataFrame:
    """``df`` with, for each column of ``sums``, its sum over earlier rows of the group ``by`` under the new name.

    Rows go by ``bucket``, then ``order``: a task adds up one bucket of one group, and the buckets' totals.
    """
    totals = df.groupBy(*by, bucket).agg(*[F.sum(c).alias(f"_{n}") for c, n in sums.items()])
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select(*by, bucket, *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}")
                                         for n in sums.values()])
    inside = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for c, n in sums.items()})
    return rows.join(start, [*by, bucket]).withColumns(
        {n: F.col(n) + F.col(f"_{n}") for n in sums.values()}).drop(*[f"_{n}" for n in sums.values()])


def source_targets(sizes: DataFrame) -> DataFrame:
    """sid, source, source_size, weight and target (double) of every source of ``sizes`` (source, source_size).

    Sources by code point, null last, take the weights in turn.  Filled in the order of what they hold
    for their weight, a source is full if its share of what is left exceeds ``MOST_REPEATS`` times its
    size; all sources after the first that is not full share the rest by weight.  One row a source.
    """
    ranked = sizes.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    ranked = ranked.withColumns({
        "weight": F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.col("sid") % len(WEIGHTS)).cast("long"),
        "most": F.col("source_size") * MOST_REPEATS})
    fill = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    past = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(past), F.lit(0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(past), F.lit(0))
    full = F.col("most").cast("double") * F.col("weights") < F.col("weight").cast("double") * F.col("left")
    shared = ranked.withColumns({"left": left, "weights": weights}).withColumn("full", full)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(every), F.lit(0))
    open_weights = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(
        (F.col("weight") * rest).cast("double") / open_weights)
    return shared.select("sid", "source", "source_size", "weight", target.alias("target"))


def _slot_plan(sources: DataFrame) -> DataFrame:
    """Adds blocks, last (words of the last block), slots, over (words of the last slot beyond the target) and first."""
    size, words = F.col("source_size"), F.floor(F.col("target") + 0.5).cast("long")
    some = size > 0
    blocks = F.when(some, F.ceil(size / BLOCK_WORDS).cast("long")).otherwise(0)
    planned = sources.withColumns({"words": words, "blocks": blocks}).withColumns({
        "last": size - (F.col("blocks") - 1) * BLOCK_WORDS,
        "epochs": F.when(some, F.expr("words div source_size")).otherwise(0),
        "rest": F.when(some, F.col("words") % size).otherwise(0)})
    short = F.when(some, permuted(F.col("blocks") - 1, F.col("blocks"), F.col("sid"), F.col("epochs"), inverse=True))
    planned = planned.withColumn("short_at", short).withColumn("n", F.ceil(F.col("rest") / BLOCK_WORDS).cast("long"))
    # the first n blocks of the permutation hold n * BLOCK_WORDS words, less if the short last block is among them
    lost = F.when(F.col("short_at") < F.col("n"), BLOCK_WORDS - F.col("last")).otherwise(0)
    planned = planned.withColumn("n", F.col("n") + (F.col("n") * BLOCK_WORDS - lost < F.col("rest")).cast("long"))
    planned = planned.withColumns({
        "over": F.col("n") * BLOCK_WORDS - lost - F.col("rest"),
        "slots": F.col("epochs") * F.col("blocks") + F.col("n")})
    first = F.coalesce(F.sum("slots").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return planned.select("sid", "source", "source_size", "target", "blocks", "last", "slots", "over",
                          first.alias("first"))


def draw_counts(sources: DataFrame, shard_slots: int) -> DataFrame:
    """(shard, sid, n): slots of a shard that source sid gets; over all shards, ``slots`` of each source."""
    spark = sources.sparkSession
    total, n_sources = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    # the source of a ticket: the tickets' range is cut into cells, each with the few sources that reach into it
    width = max(1, total // (n_sources + SPAN))
    cells = sources.where("slots > 0").select(
        "sid", "first", "slots", F.explode(F.expr(f"sequence(first div {width}, (first + slots - 1) div {width})"))
        .alias("cell"))
    tickets = spark.range(total).select(F.expr(f"id div {shard_slots}").alias("shard"),
                                        F.pmod(F.xxhash64(F.lit("ticket"), "id"), F.lit(total)).alias("ticket"))
    drawn = tickets.withColumn("cell", F.expr(f"ticket div {width}")).join(cells, "cell").where(
        "ticket >= first and ticket < first + slots").groupBy("shard", "sid").agg(F.count("*").alias("drawn"))
    drawn = cut_lineage(drawn.withColumn("h", F.xxhash64("shard", "sid")).withColumn("part", F.pmod("h", F.lit(SPAN))),
                        "mix-drawn")

    # shards in an order of each source's own keep its draws up to its slots; later draws are free again
    kept = running(drawn, ["sid"], "part", ["h", "shard"], {"drawn": "past"}).join(
        sources.select("sid", "slots"), "sid").withColumn(
        "n", F.greatest(F.least("drawn", F.col("slots") - F.col("past")), F.lit(0)))
    kept = cut_lineage(kept.select("shard", "sid", "n", (F.col("drawn") - F.col("n")).alias("free")), "mix-kept")
    free = kept.groupBy("shard").agg(F.sum("free").alias("free")).where("free > 0").withColumn(
        "part", F.expr(f"shard div {SPAN}"))
    n_free = kept.agg(F.coalesce(F.sum("free"), F.lit(0))).first()[0]
    unit = F.explode(F.expr("sequence(past, past + free - 1)")).alias("j")
    places = running(free, [], "part", ["shard"], {"free": "past"}).select("shard", unit).withColumn(
        "j", permuted(F.col("j"), F.lit(max(1, n_free)), F.lit("free")))
    short = sources.join(kept.groupBy("sid").agg(F.sum("n").alias("got")), "sid", "left").select(
        "sid", (F.col("slots") - F.coalesce("got", F.lit(0))).alias("free")).where("free > 0")
    past = F.coalesce(F.sum("free").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = short.withColumn("past", past).select("sid", unit)
    moved = places.join(wanted, "j").groupBy("shard", "sid").agg(F.count("*").alias("n"))
    return cut_lineage(kept.select("shard", "sid", "n").unionByName(moved).groupBy("shard", "sid")
                       .agg(F.sum("n").alias("n")).where("n > 0"), "mix-counts")


def _slots(sources: DataFrame, counts: DataFrame) -> DataFrame:
    """shard, slot, sid, block, take: the block of every slot and how many of its words it takes."""
    of_source = running(counts.withColumn("part", F.expr(f"shard div {SPAN}")), ["sid"], "part", ["shard"],
                        {"n": "k"}).drop("part")
    of_shard = Window.partitionBy("shard")
    placed = of_source.withColumns({
        "at": F.coalesce(F.sum("n").over(of_shard.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "in_shard": F.sum("n").over(of_shard)})
    # a row becomes up to a shard's slots: deal the few rows over all tasks, by a number so that they stay dealt
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = placed.repartition(tasks, "shard", "sid").withColumn("i", F.explode(F.expr("sequence(0L, n - 1)"))).join(sources, "sid")
    each = each.withColumn("k", F.col("k") + F.col("i"))
    block = permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.col("sid"), F.expr("k div blocks"))
    each = each.withColumn("block", block)
    whole = F.when(F.col("block") == F.col("blocks") - 1, F.col("last")).otherwise(BLOCK_WORDS)
    take = whole - F.when(F.col("k") == F.col("slots") - 1, F.col("over")).otherwise(0)
    slot = permuted(F.col("at") + F.col("i"), F.col("in_shard"), F.lit("slot"), F.col("shard"))
    return each.select("shard", slot.alias("slot"), "sid", "block", take.alias("take"))


def _with_sid(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the number of their source; a null source has one too."""
    return rows.join(sources.select("sid", F.col("source").alias("_name")), F.col("source").eqNullSafe(F.col("_name")))


def _packed(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """sid, row (of the source), doc_id, size, h and, for every block it reaches into, block, lo, hi, skip.

    The document's words from ``skip`` on are words lo to hi of the block.
    """
    keyed = _with_sid(docs, sources).select(
        "sid", "doc_id", "size", "h", "copies", (F.col("size") * F.col("copies")).alias("words"),
        F.pmod("h", F.lit(BUCKETS)).alias("part"))
    at = running(keyed, ["sid"], "part", ["h", "doc_id", "size"], {"words": "from", "copies": "row"})
    at = at.withColumn("i", F.explode(F.expr("sequence(0L, copies - 1)"))).withColumns({
        "from": F.col("from") + F.col("i") * F.col("size"), "row": F.col("row") + F.col("i")})
    reach = F.expr(f"sequence(from div {BLOCK_WORDS}, (from + greatest(size, 1L) - 1) div {BLOCK_WORDS})")
    start = F.col("block") * BLOCK_WORDS
    lo = F.greatest(F.col("from"), start)
    return at.withColumn("block", F.explode(reach)).select(
        "sid", "row", "doc_id", "size", "h", "block", (lo - start).alias("lo"),
        (F.least(F.col("from") + F.col("size"), start + BLOCK_WORDS) - start).alias("hi"),
        (lo - F.col("from")).alias("skip"))


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, h (hash of id and text) and text of every document."""
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    return documents.select(doc_id.alias("doc_id"), F.col("source").cast("string").alias("source"),
                            word_count(text).alias("size"), F.xxhash64(doc_id, text).alias("h"), text.alias("text"))


def mix(documents: DataFrame, shard_slots: int = SHARD_SLOTS) -> Mix:
    """The mix of ``documents`` (doc_id, text, source); see ``taken_words`` and ``mixed_blocks``.

    Equal rows are counted before they are dealt, so a row repeated any number of times is no hot key;
    their words follow each other.  A null text has no words, null sources are one source, a null doc_id
    is kept.  Other columns are ignored; an empty table gives no rows.
    """
    docs = cut_lineage(sized(documents).groupBy("source", "doc_id", "size", "h").agg(
        F.count("*").alias("copies")), "mix-docs")
    sizes = docs.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    sources = cut_lineage(_slot_plan(source_targets(sizes)), "mix-sources")
    slots = cut_lineage(_slots(sources, draw_counts(sources, shard_slots)), "mix-slots")
    return Mix(sources, slots, _packed(docs, sources))


def taken_words(m: Mix) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document: words the mix takes, repeats counted."""
    whole = F.when(F.col("block") == F.col("blocks") - 1, F.col("last")).otherwise(BLOCK_WORDS)
    drawn = m.slots.join(m.sources.select("sid", "blocks", "last"), "sid").withColumn(
        "cut", F.col("take") < whole).groupBy("sid", "block").agg(
        F.count_if(~F.col("cut")).alias("times"), F.coalesce(F.max(F.when(F.col("cut"), F.col("take"))), F.lit(0))
        .alias("cut"))
    taken = F.coalesce(F.col("times") * (F.col("hi") - F.col("lo")) + F.greatest(
        F.least("hi", "cut") - F.col("lo"), F.lit(0)), F.lit(0))
    rows = m.packed.join(drawn, ["sid", "block"], "left").groupBy("sid", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.sum(taken).alias("taken"))
    return rows.join(m.sources.select("sid", "source_size", "target"), "sid").select(
        "doc_id", "size", "source_size", "target", "taken")


def mixed_blocks(documents: DataFrame, m: Mix) -> DataFrame:
    """shard, slot, source, doc_ids and text of every slot of the mix; a slot holds at most ``BLOCK_WORDS`` words."""
    words = F.split(F.btrim("text", F.lit(_SPACE)), r"[\x20\x09-\x0D]+")
    texts = _with_sid(sized(documents).dropDuplicates(["doc_id", "source", "h"]), m.sources).select(
        "sid", F.col("doc_id").alias("id"), F.col("h").alias("hash"), words.alias("words"))
    held = m.packed.where("hi > lo").join(texts.withColumnRenamed("sid", "s"), (F.col("sid") == F.col("s")) & (
        F.col("h") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id"))).select(
        "sid", "block", "lo", "doc_id", F.slice("words", (F.col("skip") + 1).cast("int"),
                                                (F.col("hi") - F.col("lo")).cast("int")).alias("words"))
    pieces = m.slots.join(held, ["sid", "block"]).where("lo < take").groupBy("shard", "slot", "sid", "take").agg(
        F.sort_array(F.collect_list(F.struct("lo", "doc_id", "words"))).alias("p"))
    text = F.slice(F.flatten(F.transform("p", lambda x: x["words"])), F.lit(1), F.col("take").cast("int"))
    return pieces.join(m.sources.select("sid", "source"), "sid").select(
        "shard", "slot", "source", F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
        F.array_join(text, " ").alias("text"))


@query("op12_mixing")
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every row of ``documents``."""
    return taken_words(mix(table(spark, sf_dir, "documents")))
