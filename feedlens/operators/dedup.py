"""Merging repeated entries (E1) and ingest counters.

Duplicate *flagging* (ordered greedy rules, J1-J3) is in ``flagging.py``; it is
a separate operator because the output rows are decided by the article key
alone, never by the flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import article_key
from ..schema import ARTICLE_COLUMNS, ORDER_COLUMNS


def with_article_key(df: DataFrame) -> DataFrame:
    return df.withColumn("article_key", article_key())


def arrival_order() -> Column:
    """Arrival order (feed_no, entry_no), nulls first; rows that repeat an arrival
    (files without a feed number do) go by a hash of the row."""
    return F.struct(*ORDER_COLUMNS, F.xxhash64(*ARTICLE_COLUMNS).alias("row"))


def merge_by_key(df: DataFrame) -> DataFrame:
    """One row per article key with the fields of its first arrival and the
    number of rows seen.

    One scan and one shuffle: the first row is an aggregate, partial before the
    shuffle, so a key holding a third of the input ships one row per map task.
    Rows that repeat an arrival count as occurrences; which of them is
    first is decided by their hash, so reruns agree."""
    keyed = df if "article_key" in df.columns else with_article_key(df)
    merged = keyed.groupBy("article_key").agg(F.min_by(F.struct(*ARTICLE_COLUMNS), arrival_order()).alias("first"),
                                              F.count(F.lit(1)).alias("occurrences"))
    return merged.select("article_key", "first.*", "occurrences")


def occurrence_histogram(unique: DataFrame) -> DataFrame:
    """Occurrences -> number of articles."""
    return (unique.groupBy("occurrences")
            .agg(F.count(F.lit(1)).alias("articles"))
            .orderBy("occurrences"))
