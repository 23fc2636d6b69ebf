"""Orderings and the global article numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def newest_first() -> list[Column]:
    """G1: published desc (undated last), ties in arrival order."""
    return [F.col("published_date").desc_nulls_last(), F.col("feed_no").asc(), F.col("entry_no").asc()]


def by_impact() -> list[Column]:
    """Score desc, stable over the newest-first numbering."""
    return [F.col("impact_score").desc(), F.col("number").asc()]


def number_articles(df: DataFrame, order: list[Column] | None = None,
                    partitions: int | None = None) -> DataFrame:
    """``number`` = 1..n over the whole table in newest-first order.

    No single-partition window: the table is range-partitioned on the (unique)
    order key and sorted within partitions; each row gets (partition, local
    index) from ``monotonically_increasing_id``.  That table is checkpointed so
    the ids are stable, the per-partition counts (one row per partition, a
    bound fixed by ``partitions``) are turned into offsets and broadcast, and
    number = offset + local index + 1.
    """
    order = order or newest_first()
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_rid", F.monotonically_increasing_id()))
    ranged = checkpoint(ranged)
    pid = F.shiftright("_rid", _LOCAL_BITS)
    counts = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = ranged.join(F.broadcast(offsets), pid == F.col("_pid"))
    local = F.col("_rid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return out.withColumn("number", (F.col("_off") + local + 1).cast("long")).drop("_rid", "_pid", "_off")


def number_in_range(unique: DataFrame, start, end) -> DataFrame:
    """F1 restricted to a date range (C1), without numbering the whole table.

    In newest-first order every article published after the range precedes
    every article inside it, and undated articles come last.  So the articles
    after the range are one count, and only those inside are sorted, by key
    and order columns alone.  The filter is above the merge (the date is that
    of a key's first arrival), so ``unique`` is computed once into a table that
    holds of the newer articles nothing but the date.
    """
    from .filters import day_bounds

    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in day_bounds(start, end))
    date = F.col("published_date")
    slim = unique.where(date >= lo).select(*[
        c if c == "published_date" else F.when(date < hi, F.col(c)).alias(c) for c in unique.columns])
    recent = checkpoint(slim, "range")
    newer = recent.where(date >= hi).agg(F.count(F.lit(1)).alias("_newer"))
    inside = recent.where(date < hi)
    keys = number_articles(inside.select("article_key", "published_date", "feed_no", "entry_no"))
    numbers = keys.crossJoin(newer).select("article_key", (F.col("_newer") + F.col("number")).alias("number"))  # one-row side
    return inside.join(numbers, "article_key").select(*unique.columns, "number")
