"""Adapters from the driver's test tables to the ``articles`` schema.

The test data has no feeds, so two deterministic mappings stand in for landed
feed files (documented in FIXTURES.md §3).  Every input row is used; the
re-polled copies only add rows.  Both are single-scan plans: the
documents/pages scan and the events scan meet in one equi-join on a unique key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_content
from ..schema import ARTICLE_COLUMNS


def _event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("published_date"))


def documents_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> articles.  Poll 0 is every document with its title and URL.
    Later polls add rows: poll 1 re-reads a tenth of the documents with a tracking query on
    the URL (a feed read twice), poll 2 another tenth with neither title nor URL,
    poll 3 a tenth with the title but no URL."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    ev = _event_times(spark, sf_dir)
    base = docs.join(ev, docs.doc_id * 5 == ev.event_id, "left")
    tenth = F.col("doc_id") % 10
    also = F.when(tenth == 0, 1).when(tenth == 3, 2).when(tenth == 6, 3)
    poll = F.explode(F.when(also.isNotNull(), F.array(F.lit(0), also)).otherwise(F.array(F.lit(0))))
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("doc_id").cast("string"))
    rows = base.select(
        F.expr("cast(substr(source, 4) as int)").alias("feed_no0"),
        F.col("doc_id").alias("entry_no"),
        F.trim(F.substring_index(F.col("text"), "\n", 1)).alias("title0"),
        url.alias("url0"),
        "published_date",
        clean_content("text").alias("content"),
        poll.alias("poll"))
    return rows.select(
        (F.col("feed_no0") + F.col("poll") * 100).cast("int").alias("feed_no"),
        "entry_no", F.when(F.col("poll") != 2, F.col("title0")).alias("title"),
        F.when(F.col("poll") == 1, F.concat(F.col("url0"), F.lit("/?utm_source=rss")))
         .when(F.col("poll") == 0, F.col("url0")).alias("url"),
        "published_date", "content").select(*ARTICLE_COLUMNS)


def pages_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages -> articles: title from <title>, content = cleaned HTML."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    ev = _event_times(spark, sf_dir)
    base = pages.join(ev, pages.page_id * 20 == ev.event_id, "left")
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return base.select(
        (F.col("page_id") % 13).cast("int").alias("feed_no"),
        F.col("page_id").alias("entry_no"),
        F.when(title != "", title).alias("title"),
        "url", "published_date",
        clean_content("html").alias("content")).select(*ARTICLE_COLUMNS)
