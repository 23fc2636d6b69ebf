"""Line deduplication against levelled sorted runs of line hashes (native).

``LineRuns`` keeps the first holder of every line key in immutable runs, tables
bucketed and sorted by hash.  A new batch (documents after all earlier ones)
aggregates its own lines to (hash, smallest doc_id), anti-joins the runs by
merge join and adds what is new as a run of level 0.  When a level has
``FANOUT`` runs they are compacted into one run of the next level, so a batch
meets at most FANOUT - 1 runs a level.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm.common import WHITE, sha256_hex, text_of
from feedlens.session import checkpoint, discard, table_path

MIN_CHARS = 10
FANOUT = 3
BATCHES = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def hash_pair(key: Column) -> Column:
    """128 bits of two separately seeded 64-bit hashes, or null for short keys."""
    return F.when(F.length(key) >= MIN_CHARS, F.struct(F.xxhash64(F.lit(1), key).alias("h1"),
                                                       F.xxhash64(F.lit(2), key).alias("h2")))


def long_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2) of every line with a long enough key."""
    line = docs.select("doc_id", F.explode(F.split(text_of(), "\n", -1)).alias("line"))
    return (line.select("doc_id", hash_pair(line_key(F.col("line"))).alias("h"))
            .where("h IS NOT NULL").select("doc_id", "h.h1", "h.h2"))


class LineRuns:
    """The run set; its tables lie in the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.levels = spark, fanout, []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, df: DataFrame) -> tuple[str, str]:
        name, path = f"line_run_{uuid.uuid4().hex}", table_path(self.spark, "line-run")
        (df.repartition(self.buckets, "h1").write.bucketBy(self.buckets, "h1").sortBy("h1", "h2")
         .option("path", path).saveAsTable(name))
        return name, path

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def add_batch(self, lines: DataFrame) -> None:
        """Lines (doc_id, h1, h2) of documents that come after all earlier batches."""
        firsts = lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"))
        for run in self.runs():
            firsts = firsts.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self._add(0, firsts)

    def _add(self, level: int, df: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(df))
        if len(self.levels[level]) >= self.fanout:
            old, merged = self.levels[level], reduce(DataFrame.unionAll, [self.spark.table(n) for n, _ in self.levels[level]])
            self.levels[level] = []
            self._add(level + 1, merged)
            self._drop(old)

    def _drop(self, tables) -> None:
        for name, path in tables:
            self.spark.sql(f"DROP TABLE {name}")
            gone = self.spark.read.schema("h1 long").parquet(path)
            gone._feedlens_path = path
            discard(gone)

    def owners(self) -> DataFrame:
        """(h1, h2, owner): the smallest doc_id that holds each key."""
        return reduce(DataFrame.unionAll, self.runs())


def dropped_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, gone): the hash pairs whose lines a document loses."""
    spark = docs.sparkSession
    lines = checkpoint(long_lines(docs), "lines")
    cuts = lines.select(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)]).alias("c")).first()["c"]
    edges = [None, *sorted(set(cuts or [])), None]
    state = LineRuns(spark)
    for low, high in zip(edges, edges[1:]):
        part = lines
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        state.add_batch(part)
    return (lines.join(state.owners(), ["h1", "h2"])
            .where(F.col("doc_id").isNull() & F.col("owner").isNotNull() | (F.col("doc_id") > F.col("owner")))
            .groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("gone")))


def _kept(gone: Column) -> Column:
    """Lines of the text column that stay."""
    def stays(line: Column) -> Column:
        return ~F.coalesce(F.array_contains(gone, hash_pair(line_key(line))), F.lit(False))
    return F.filter(F.split(F.col("__text"), "\n", -1), stays)


def dedup_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``text`` reduced to its kept lines, plus __n_lines and __n_dropped.

    Lines are split at ``\\n``; a null or empty text is one empty line and stays
    as it is.  A key of at least 10 code points found under two or more
    doc_ids keeps its lines only under the smallest; all lines of that document
    stay, repeats too.  Rows that share a doc_id count as one document.  A null
    doc_id comes after all numbers; among null ids alone nothing is dropped.
    An empty table gives an empty result; other columns pass through.
    """
    gone = dropped_lines(docs, batches).select(F.col("doc_id").alias("__id"), F.col("gone").alias("__gone"))
    lines = F.size(F.split("__text", "\n", -1))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["__id"]), "left").withColumn("__text", text_of())
    kept = joined.withColumn("__lines", F.when(F.col("__gone").isNull(), F.split("__text", "\n", -1))
                             .otherwise(_kept(F.col("__gone"))))
    return (kept.withColumn("__n_lines", lines.cast("long"))
            .withColumn("__n_dropped", (lines - F.size("__lines")).cast("long"))
            .withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join("__lines", "\n")))
            .drop("__id", "__gone", "__text", "__lines"))


def line_report(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 per document."""
    out = dedup_lines(docs.select("doc_id", "text"), batches)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      sha256_hex(text_of()).alias("kept_sha256"))
