"""Feed files read by byte ranges: the same documents as a whole parse, whatever the cut."""

import io
import json
import random

import pytest
from pyspark.sql import functions as F

from scholarweave.operators.features import explode_feed
from scholarweave.plans.sites import knowcenter
from scholarweave.sources.feed_ranges import LIST_DEPTH, range_documents, range_summary, read_feed

TEXTS = ["", "a", '"', "\\", '\\"', "}]", '{"features":', "[{[", 'x\\\\"{', "ü漢\n", "\\" * 9, '"},{"']


def _feed(rng, n):
    def document():
        features = [{"@id": rng.choice(["title_DE", "year", "x" + rng.choice(TEXTS)]),
                     "values": rng.choice([rng.choice(TEXTS), {"value": rng.choice(TEXTS)}, {"value": [rng.choice(TEXTS)]}])}
                    for _ in range(rng.randrange(4))]
        return rng.choice([{}, {"features": {"feature": features}}, {"n": [[{}], 1], "features": {"feature": features}}])
    return {"a": rng.choice(TEXTS), "DataSet": {"documents": {"document": [document() for _ in range(n)]}}, "z": rng.choice(TEXTS)}


def _whole(raw: bytes, step: int) -> list[bytes]:
    """The documents of all ranges in order, with states summed up as the job does."""
    file, inside, depth, out = io.BytesIO(raw), 0, 0, []
    for lo in range(0, len(raw), step):
        hi = min(lo + step, len(raw))
        sums = range_summary(file, lo, hi)
        delta, opens, _ = sums[inside]
        docs = list(range_documents(file, lo, hi, len(raw), inside, depth))
        assert len(docs) == dict(opens).get(LIST_DEPTH - depth, 0)
        out += docs
        inside, depth = (inside + sums[0][2]) % 2, depth + delta
    assert (inside, depth) == (0, 0)
    return out


@pytest.mark.parametrize("seed", range(30))
def test_any_cut_gives_the_documents_of_the_whole_parse(seed):
    rng = random.Random(seed)
    feed = _feed(rng, rng.randrange(12))
    raw = json.dumps(feed, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])).encode()
    for step in (1, 2, 3, 7, rng.randrange(1, len(raw) + 1), len(raw)):
        assert [json.loads(d) for d in _whole(raw, step)] == feed["DataSet"]["documents"]["document"]


def test_read_feed_equals_the_exploded_texts(spark, tmp_path):
    rng = random.Random(7)
    feeds = {f"{k}.json": json.dumps(_feed(rng, n)) for k, n in enumerate((0, 1, 40, 200))}
    for name, text in {**feeds, "empty.json": "", "_SUCCESS": "x"}.items():
        (tmp_path / name).write_text(text)
    plain = spark.createDataFrame([(f"{tmp_path}/{n}", t) for n, t in feeds.items()], "url string, doc string")
    expected = sorted(map(str, explode_feed(plain).select("url", F.col("doc_pos").cast("long"), "features").collect()))
    for path in (str(tmp_path), f"file:{tmp_path}"):
        got = read_feed(spark, path, range_bytes=501).select("url", "doc_pos", "features")
        assert sorted(map(str, got.collect())) == expected and len(expected) > 200
    one = read_feed(spark, f"{tmp_path}/2.json", range_bytes=501)
    assert one.count() == 40
    # the site job takes either form
    cols = ["doc_pos", "title", "year", "unknown_features"]
    by_file = knowcenter.crawl(read_feed(spark, str(tmp_path), 501))["Publication"].select(*cols)
    by_text = knowcenter.crawl(plain.withColumnRenamed("doc", "body"))["Publication"].select(*cols)
    assert sorted(map(str, by_file.collect())) == sorted(map(str, by_text.collect()))


def test_folder_without_feeds(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    assert read_feed(spark, str(tmp_path)).count() == 0


def test_one_feed_is_read_by_several_tasks(spark, tmp_path):
    n = 100_000
    doc = '{"features":{"feature":[{"@id":"title_DE","values":{"value":"T%d"}}]}}'
    (tmp_path / "feed.json").write_text('{"DataSet":{"documents":{"document":[%s]}}}' % ",".join(doc % k for k in range(n)))
    rows = read_feed(spark, str(tmp_path), range_bytes=1 << 20).withColumn("task", F.spark_partition_id())
    got = rows.agg(F.count("*"), F.countDistinct("doc_pos"), F.min("doc_pos"), F.max("doc_pos"),
                   F.countDistinct("task")).first()
    assert tuple(got)[:4] == (n, n, 0, n - 1) and got[4] >= 4
    assert rows.where("features[0]['values'] != concat('{\"value\":\"T', doc_pos, '\"}')").count() == 0


def test_many_short_feeds_share_tasks(spark, tmp_path):
    doc = '{"features":{"feature":[{"@id":"title_DE","values":{"value":"T%d"}}]}}'
    for k in range(150):
        (tmp_path / f"{k}.json").write_text('{"DataSet":{"documents":{"document":[%s]}}}' % ",".join(doc % j for j in range(k % 4)))
    rows = read_feed(spark, str(tmp_path), range_bytes=64)
    assert rows.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert rows.count() == sum(k % 4 for k in range(150))
