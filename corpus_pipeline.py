"""The corpus pipeline: documents in, token ids of a clean mixed corpus out.

Every stage works on all that its predecessor kept, is written as Parquet and
read again.  ``STAGES`` lists (name, function) in order; each function takes
(spark, docs, sf_dir).  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm.byte_bpe import encode, public_vocabulary
from feedlens.llm.common import table
from feedlens.llm.line_dedup import dedup_lines
from feedlens.llm.mixing import mix
from feedlens.llm.ngram_join import keep_one
from feedlens.llm.quality_crf import keep_good
from feedlens.session import checkpoint

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the line CRF rejects go (fitted on the labels outside the held-out fold)."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; n_chars follows the text."""
    kept = dedup_lines(docs).drop("__n_lines", "__n_dropped")
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                               .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: five words a shingle, similarity 0.8 or more."""
    return keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix of sources takes it."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digest of the text that the ids decode to."""
    import public_tokenizers

    ranks = public_vocabulary(VOCABULARY)
    return encode(docs, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The classifier, the sampling and the tokenizer are beyond SQL;
#: tests/llm/test_pipeline.py holds every stage of a run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = checkpoint(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name.lower()))
    return docs
