"""Incremental ingest with Structured Streaming.

Polled feed entries land as Parquet files (``articles`` schema) in a landing
folder.  The stream keeps the unique-article table (E1) up to date: a
streaming aggregation by article key with the first arrival's fields and the
running occurrence count.  State is one row per article key (use the RocksDB
state store provider on a cluster); the checkpoint location must be on the
shared file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import merge_by_key
from ..schema import ARTICLES


def read_landed_entries(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None
                        ) -> DataFrame:
    r = spark.readStream.schema(ARTICLES)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(landing_dir)


def unique_articles_stream(entries: DataFrame) -> DataFrame:
    """E1 as a streaming aggregation (update / complete output modes); the state of
    a key is its first arrival's row and the count."""
    return merge_by_key(entries)


def start_unique_articles(spark: SparkSession, landing_dir: str, checkpoint_location: str,
                          sink=None, query_name: str = "unique_articles",
                          trigger_seconds: int | None = None) -> StreamingQuery:
    """Start the stream.  ``sink(batch_df, batch_id)`` receives the updated
    keys of every micro-batch (``foreachBatch``, idempotent by batch id).  Without a
    sink, an in-memory table named ``query_name`` is kept in the driver: local
    sessions only."""
    if sink is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("a sink is needed on a cluster: the in-memory table lies in the driver")
    stream = unique_articles_stream(read_landed_entries(spark, landing_dir))
    w = stream.writeStream.option("checkpointLocation", checkpoint_location).queryName(query_name)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    if sink is None:
        return w.outputMode("complete").format("memory").start()
    return w.outputMode("update").foreachBatch(sink).start()


def start_article_store(entries: DataFrame, store, checkpoint_location: str, query_name: str = "article_store",
                        available_now: bool = False) -> StreamingQuery:
    """Keep an ``ArticleStore`` up to date from a stream of entries (A2 as a stream or landed
    tables).  A batch is known by its id, so a restarted stream does not count it twice."""
    w = entries.writeStream.option("checkpointLocation", checkpoint_location).queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.outputMode("append").foreachBatch(store.sink).start()
