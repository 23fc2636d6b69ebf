import datetime as dt

from pyspark.sql import functions as F

from feedlens.operators.dedup import merge_by_key
from feedlens.schema import ARTICLES
from feedlens.streaming.ingest import start_unique_articles


def _rows(feed, entries):
    t = dt.datetime(2024, 1, 5, 12, 0, 0)
    return [(feed, e, title, url, t, content) for e, (title, url, content) in enumerate(entries)]


def test_streaming_merge_matches_batch(spark, tmpdir_path):
    land = f"{tmpdir_path}/landing"
    polls = [
        _rows(1, [("A", "https://x.com/a", "one"), ("B", None, "two"), (None, None, "three")]),
        _rows(2, [("A again", "https://x.com/a/?q=1", "one"), ("B", None, "other"), ("C", "https://y.com/c", "c")]),
    ]
    for i, rows in enumerate(polls):
        spark.createDataFrame(rows, ARTICLES).write.mode("append").parquet(land)
        if i == 0:
            q = start_unique_articles(spark, land, f"{tmpdir_path}/ckpt", query_name="ua_test")
            q.processAllAvailable()
    q.processAllAvailable()
    got = {r.article_key: (r.occurrences, r.title) for r in spark.table("ua_test").collect()}
    q.stop()
    batch = merge_by_key(spark.read.schema(ARTICLES).parquet(land))
    exp = {r.article_key: (r.occurrences, r.title) for r in batch.collect()}
    assert got == exp
    assert got["url:https://x.com/a"] == (2, "A")
