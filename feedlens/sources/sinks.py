"""Sinks (A5-A7): Parquet stages and text documents.

Stage outputs are Parquet, partitioned by publication day where rows are
articles; C1 derives the days of a date range, so that a later date filter prunes
whole partitions.  Writes are plain DataFrameWriter jobs (atomic per job through the output committer), so a lost
executor only re-runs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.days import summarize_days
from ..operators.dedup import occurrence_histogram


def write_articles(unique: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5: unique articles partitioned by day, and their occurrence statistics
    (E2) and day summary (both from the written table) next to them.  Rows are dealt by day and a
    hash before the write, so a day is a few files and a busy day not one task."""
    spark = unique.sparkSession
    day = F.to_date("published_date")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (unique.withColumn("published_day", day)
           .repartition(parts, "published_day", F.pmod(F.xxhash64("article_key"), F.lit(4)))
           .write.mode(mode).partitionBy("published_day").parquet(f"{path}/articles"))
    occurrence_histogram(spark.read.parquet(f"{path}/articles")).coalesce(1).write.mode(mode).parquet(
        f"{path}/occurrence_statistics")
    summarize_days(spark.read.parquet(f"{path}/articles")).coalesce(parts).write.mode(mode).parquet(f"{path}/day_summary")


def stage_path(root: str, run_id: str, stage: str) -> str:
    return f"{root.rstrip('/')}/run_id={run_id}/stage={stage}"


def write_stage(df: DataFrame, root: str, run_id: str, stage: str, name: str,
                mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """``<root>/run_id=<id>/stage=<raw|processed|final>/<name>``."""
    path = f"{stage_path(root, run_id, stage)}/{name}"
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_documents(df: DataFrame, path: str, col: str, mode: str = "overwrite",
                    partition_by: list[str] | None = None) -> None:
    """One text document per row (e.g. one script per period)."""
    w = df.select(*(partition_by or []), F.col(col).alias("value")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)
