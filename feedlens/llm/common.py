"""What several of these operators share: the word rule, input tables, and
numpy helpers over the words of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that one step of a Python worker handles at once.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def sha256_hex(col: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(col.cast("binary"), 256)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the
    body uses it."""
    return F.transform(F.array(value), body)[0]


def small_batches(spark: SparkSession, limit: int = 16 << 20) -> None:
    """Bound the bytes of the Arrow batches that Python stages are handed from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, per_line: int = 0) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` text bytes (or one
    longer text): a worker's memory follows the longest text, not the batch.
    ``per_line`` counts every line as so many bytes more, for work that follows lines."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if per_line:
            size = size + per_line * (1 + pc.fill_null(pc.count_substring(batch.column(text), "\n"), 0).to_numpy(zero_copy_only=False))
        end = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            base = end[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(end, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def fresh(texts: pa.Array) -> pa.Array:
    """The texts as large strings with null as empty, in buffers of their own:
    Arrow's string kernels mistake a slice's offsets."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    return texts.take(pa.array(np.arange(len(texts))))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_lists(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: (offsets, flat words); text
    ``i`` has the words ``flat[offsets[i]:offsets[i + 1]]``."""
    lists = pc.ascii_split_whitespace(fresh(texts))
    flat = lists.flatten()
    real = pc.not_equal(flat, "")
    count = np.diff(lists.offsets.to_numpy())
    if not pc.all(real).as_py() and len(flat):
        owner = np.repeat(np.arange(len(count)), count)[real.to_numpy(zero_copy_only=False)]
        count = np.bincount(owner, minlength=len(count))
        flat = flat.filter(real)
    return np.concatenate([[0], np.cumsum(count)]).astype(np.int64), flat


def word_hashes(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; equal words alone are hashed once."""
    coded = flat.dictionary_encode()
    words = coded.dictionary.to_numpy(zero_copy_only=False)
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(words.astype(object), categorize=False)[coded.indices.to_numpy()]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive words that start at each position (the
    last ``k - 1`` positions are left out)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n] + np.uint64(j))
    return out
