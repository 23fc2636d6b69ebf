"""Sharding by global byte-size prefix sums.

Documents are range-partitioned by doc_id.  Per-partition totals (one row per
partition) are summed up into offsets; a document's prefix sum is its
partition's offset plus the running sum inside the partition.  Cutting the
prefix sums at equal byte targets gives contiguous shards in doc_id order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.session import checkpoint

SHARDS = 16


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot,
    grown_shard, start_byte.

    size is the UTF-8 length plus 1 (null text: 1).  The law is ``bytes``: a
    document goes to the shard in whose equal byte range its middle lies, so a
    shard is off its target by less than the longest document at either end.
    Order is doc_id (null first), then size and checksum; rows equal in all
    three are interchangeable.  Hence repeated ids and ties are in order, and a
    rerun gives the same result.  slot counts from 0 within each shard.  An
    empty table gives an empty result; other columns are not read.  Only
    (doc_id, size, checksum) is shuffled, never a text.
    """
    text = F.coalesce("text", F.lit(""))
    small = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "size", "text_crc32", "row"]
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = checkpoint(small.repartitionByRange(int(parts), *order).withColumn("part", F.spark_partition_id()), "ranged")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = ranged.groupBy("part").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    offsets = totals.select("part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                            F.sum("s").over(Window.partitionBy()).alias("all"))
    inside = Window.partitionBy("part").orderBy(*order)
    placed = (ranged.withColumn("end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("at", F.row_number().over(inside) - 1)
              .join(F.broadcast(offsets), "part")  # as many rows as partitions
              .withColumn("start_byte", F.col("s0") + F.col("end") - F.col("size"))
              .withColumn("at", F.col("n0") + F.col("at"))
              .withColumn("shard", F.least(F.lit(shards - 1), F.expr(
                  f"(2 * start_byte + size) * {int(shards)} div (2 * all)")).cast("int")))
    placed = checkpoint(placed.select("doc_id", "size", "text_crc32", "shard", "start_byte", "at"), "placed")
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "start_byte")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs`` as one folder per shard, rows in shard order.

    Rows are matched by doc_id, which has to be unique here.
    """
    place = shard_documents(docs, shards).select(F.col("doc_id").alias("__id"), F.col("shard").alias("__shard"),
                                                 F.col("slot").alias("__slot"))
    (docs.join(place, docs["doc_id"].eqNullSafe(place["__id"])).repartitionByRange("__shard", "__slot")
     .sortWithinPartitions("__shard", "__slot").drop("__id", "__slot")
     .write.partitionBy("__shard").parquet(path))
