"""Exact deduplication by a tree-merge of digest runs (native).

Texts are equal when their whitespace-normalised forms are identical.  Every
leaf holds one run of digests (digest, verifier, smallest id, count).
In each binomial round run ``r`` meets run ``r XOR 2^round``: the pair is
shuffled and aggregated by digest (not merged in sort order), keeping the
smallest identifier and the summed count.  A
run is spread over the shuffle partitions by (run, digest), so the last round
does not meet in one task, and a group of copies is one row per run and task
before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import WHITE_RUN, let, sha256_hex, text_of
from feedlens.session import checkpoint, discard

#: Leaf runs; a power of two, log2 of it is the number of rounds.
LEAVES = 8


def normalised(col: str = "text") -> Column:
    return F.regexp_replace(text_of(col), WHITE_RUN, " ")


def digest_of(text: Column) -> tuple[Column, Column]:
    """SHA-256 of a normalised text, and its length with a second hash, by
    which equal digests are verified."""
    return (F.unhex(sha256_hex(text)).alias("digest"),
            F.struct(F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("hash")).alias("verifier"))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, verifier) of every row."""
    return docs.select("doc_id", normalised().alias("t")).select("doc_id", *digest_of(F.col("t")))


def merge_runs(runs: DataFrame, rounds: int) -> DataFrame:
    """One binomial round after the other; each level is a written table of
    runs, so a lost executor costs one round at most."""
    for level in range(rounds):
        merged = (runs.withColumn("run", F.shiftright("run", 1))
                  .groupBy("run", "digest", "verifier")
                  .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
                  .sortWithinPartitions("run", "digest"))
        done = checkpoint(merged, f"digest-runs-{level}")
        discard(runs)
        runs = done
    return runs


def merged_digests(rows: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """(digest, verifier, keep_id, group_size) of all rows (doc_id, digest, verifier)."""
    rounds = max(0, (leaves - 1).bit_length())
    first = (rows.withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(1 << rounds)).cast("int"))
             .groupBy("run", "digest", "verifier")
             .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
             .sortWithinPartitions("run", "digest"))
    return merge_runs(checkpoint(first, "digest-leaves"), rounds).drop("run")


def exact_groups(docs: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    keep_id is the smallest doc_id among the rows with an equal normalised
    text, group_size their number.  Null text counts as empty.  A null doc_id
    never wins against a number; in a group of null ids alone keep_id is null.
    ``kept`` holds for the row whose doc_id is keep_id (null-safe), so repeated
    rows of that id are all kept.  An empty table gives an empty result.
    Columns other than doc_id and text are not read.
    """
    rows = checkpoint(digests(docs), "digests")
    return (rows.join(merged_digests(rows, leaves), ["digest", "verifier"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def drop_exact_copies(docs: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """``docs`` without the rows whose text an earlier doc_id holds; columns unchanged."""
    runs = merged_digests(checkpoint(digests(docs), "digests"), leaves).select(
        F.struct("digest", "verifier").alias("__of"), F.col("keep_id").alias("__keep"))
    marked = docs.withColumn("__of", let(normalised(), lambda t: F.struct(*digest_of(t))))
    return marked.join(runs, "__of").where(F.col("doc_id").eqNullSafe(F.col("__keep"))).select(*[f"`{c}`" for c in docs.columns])
