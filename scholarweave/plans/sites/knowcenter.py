"""KnowCenter: publications from the JSON feature-list feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarweave.operators.counters import Counters
from scholarweave.operators.features import explode_feed, feed_publications

FEED_URL = ("http://oldknowsite.know-center.tugraz.at/wp-content/visualisation-output/"
            "publications/publications.json")


def crawl(feeds: DataFrame, counters: Counters | None = None, body_col: str = "body") -> dict[str, DataFrame]:
    """``feeds(url, body)``, each body a whole feed, or the documents that ``read_feed`` cut from feed files."""
    if "features" in feeds.columns:
        docs = feeds
    else:
        docs = explode_feed(feeds.select("url", F.col(body_col).alias("doc")), "doc")
    pubs = feed_publications(docs, "features", keep=["doc_pos"])
    if counters is not None:
        pubs = counters.watch_sums(pubs, unknown_features=F.col("unknown_features"))
    return {"Publication": pubs}
