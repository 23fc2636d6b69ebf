"""Token-id files: Parquet with one list of ids per document.

Files follow doc_id.  Ids are dictionary encoded, with delta packing as the
fallback (format version 2), in bounded row groups and short pages with page
indexes, so a reader of doc_id, n_tokens or a doc_id range skips the ids of
everything else.  Columns: part, at (ids before the document in its part),
doc_id, n_tokens, ids.
"""

from __future__ import annotations

import itertools
import os
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.llm.common import slices, small_batches, word_lists

END_ID = 1
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(128 << 10),
    "parquet.page.row.count.limit": "500",
}
#: Words whose ids a worker remembers: seen again since they were new, and new.
OLD_WORDS, NEW_WORDS = 250_000, 200_000
#: Marks that form a token run of their own after an ASCII letter or digit.
TAIL = string.punctuation.replace("'", "")
#: Words of small Latin letters; a tokenizer that gives these the ids that its model does is asked for its model alone.
PROBES = ["a", "it", "hello", "running", "zzzzqx", "ªº", "ción", "größe", "élève", "łódź", "internationalisation"]
#: Text bytes that a worker is handed and handles at once.
SLICE = 2 << 20
_WORKER: dict = {}


def _tokenizer(spec, added: bool):
    """The worker's word cache with its tokenizer; built once per process."""
    key = zlib.crc32(spec.value), added
    if _WORKER.get("key") != key:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; each thread would keep memory of its own
        tok = Tokenizer.from_str(spec.value.decode())
        tok.encode_special_tokens = not added
        _WORKER.update(key=key, cache=WordCache(tok, [t.content for t in tok.get_added_tokens_decoder().values()] if added else []))
    return _WORKER["cache"]


def _byte_level() -> dict[int, str]:
    """The characters that byte-level tokenizers write bytes as."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_LEVEL = _byte_level()
#: Whether a byte is an ASCII letter or digit.
_ALNUM = np.isin(np.arange(256), np.frombuffer((string.ascii_letters + string.digits).encode(), np.uint8))


def plain(word: str) -> bool:
    """Whether the word is of small Latin letters, each one code point: one token run that no normalizer changes."""
    return word.isalpha() and max(word) < "\u0250" and word == word.lower()


class WordCache:
    """Ids of words (as int32 bytes) by the tokenizers library.  A word that
    comes back while it is remembered as new becomes old; the new ones are
    forgotten when they are too many, so rare words do not push out frequent ones."""

    def __init__(self, tok, added: list[str] = ()):
        """``added``: strings that are one token wherever they stand."""
        self.tok, self.old, self.new = tok, {}, {}
        self.added = [a.lower() for a in added]
        #: A word without these (uncased) characters holds none of them.
        self.lead = "".join(itertools.takewhile(lambda c: c in string.punctuation, os.path.commonprefix(self.added)))

        self.model = tok.model.tokenize
        names = [t.content for t in tok.get_added_tokens_decoder().values()]
        self.direct = all(map(plain, PROBES)) and not any(map(str.isalpha, names)) and all(
            self._by_model(w) == self._by_tokenizer([w])[0] for w in PROBES)

    def _by_model(self, word: str) -> bytes:
        """Ids of a plain word by the tokenizer's model alone, without the normalizer and the splitting."""
        text = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LEVEL)
        return array("i", [t.id for t in self.model(text)]).tobytes()

    def _by_tokenizer(self, words: list[str]) -> list[bytes]:
        return [array("i", e.ids).tobytes() for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]

    def split(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The part of each word that is remembered, and its tail.  A tail of marks is a token
        run of its own, and A-Z of a pure ASCII word are lower-cased by the
        tokenizer anyway, so words are remembered without both.  Words with an
        added token's string, in any case, go to the tokenizer as they are."""
        base = pc.ascii_rtrim(words, characters=TAIL)
        size, full = (pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (base, words))
        cut = (size > 0) & (size < full)
        _, at, data = base.buffers()
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        last = np.frombuffer(at, np.int64)[base.offset + 1:base.offset + 1 + len(base)] - 1
        cut[cut] = _ALNUM[data[last[cut]]]
        whole = np.zeros(len(words), bool)
        if self.added:
            for k in np.flatnonzero(pc.match_substring(words, self.lead).to_numpy(zero_copy_only=False)):
                low = words[k].as_py().lower()
                whole[k] = any(a in low for a in self.added)
        cut &= ~whole
        base = pc.if_else(pa.array(cut), base, words)
        lower = pc.and_(pc.string_is_ascii(base), pa.array(~whole))
        tails = words.filter(pa.array(cut))
        tail = np.full(len(words), "", object)
        tail[cut] = [w[n:] for w, n in zip(tails.to_pylist(), pc.utf8_length(base).to_numpy(zero_copy_only=False)[cut].tolist())]
        return pc.if_else(lower, pc.ascii_lower(base), base), pa.array(tail, pa.large_string())

    def look_up(self, parts: list[str]) -> list[bytes]:
        """Ids of each of the distinct ``parts``."""
        out = list(map(self.old.get, parts))
        miss = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            part = parts[k]
            ids = out[k] = self.new.get(part)
            if ids is None:
                miss.append(k)
            elif len(self.old) < OLD_WORDS:
                self.old[part] = self.new.pop(part)
        for start in range(0, len(miss), 10_000):
            some = [parts[k] for k in miss[start:start + 10_000]]
            other = [w for w in some if not (self.direct and plain(w))]
            found = dict(zip(other, self._by_tokenizer(other)))
            found |= {w: self._by_model(w) for w in some if w not in found}
            for k, w in zip(miss[start:start + 10_000], some):
                out[k] = found[w]
            if len(self.new) + len(found) > NEW_WORDS:
                self.new.clear()
            self.new.update(found)
        return out

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each of the distinct ``words``."""
        length, ids = self.encode_array(pa.array(words, pa.large_string()))
        return [ids[end - n:end].tobytes() for n, end in zip(length, np.cumsum(length))]

    def encode_array(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each of the distinct ``words``, all their ids in order)."""
        n = len(words)
        base, tail = self.split(words.cast(pa.large_string()))
        coded = pa.concat_arrays([base, tail]).dictionary_encode()
        at = coded.indices.to_numpy()
        parts = self.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        length = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        codes = np.stack([at[:n], at[n:]], axis=1).ravel()  # a word's base, then its tail
        return length[at[:n]] + length[at[n:]], _gathered(np.frombuffer(b"".join(parts), np.int32), length, codes)[1]


def _gathered(pool: np.ndarray, length: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of the entries ``codes`` of a pool whose entries have those lengths."""
    first = np.cumsum(length) - length
    n = length[codes]
    upto = np.concatenate([[0], np.cumsum(n)])
    return upto, pool[np.repeat(first[codes] - upto[:-1], n) + np.arange(upto[-1])]


def encode_texts(texts: pa.Array, cache: WordCache, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of the texts, ``end_id`` after each.

    The tokenizer drops white space, and no token reaches over it, so a text's
    ids are those of its words in order; each distinct word is encoded once.
    """
    offsets, flat = word_lists(texts)
    coded = flat.dictionary_encode()
    length, pool = cache.encode_array(coded.dictionary)
    upto, ids = _gathered(pool, length, coded.indices.to_numpy())
    ends = upto[offsets[1:]]
    out = np.insert(ids, ends, end_id) if len(ends) else ids
    return np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]), out


def _encoder(spec, end_id: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _tokenizer(spec, added)
        before = 0
        for b in slices(batches, "text", SLICE):
            offsets, ids = encode_texts(b.column("text"), cache, end_id)
            pa.default_memory_pool().release_unused()  # else the pool keeps several slices' words, in each worker
            yield pa.RecordBatch.from_arrays(
                [pa.array(before + offsets[:-1]), b.column("doc_id"), pa.array(np.diff(offsets)),
                 pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))],
                ["at", "doc_id", "n_tokens", "ids"])
            before += int(offsets[-1])
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_json: bytes, end_id: int = END_ID, added: bool = False) -> None:
    """Encode ``text`` and write the files in ascending doc_id order.

    Null text is empty (the end id alone); a null doc_id comes first; rows of
    one doc_id are ordered by a hash of the text.  An empty table writes files
    without rows.  The text is shuffled once, the ids never.  With ``added``
    the strings of added tokens (<|endoftext|>) become their ids, as by the
    library's encode(text, add_special_tokens=False); else they are ordinary text.
    """
    small_batches(docs.sparkSession, SLICE)
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # the vocabulary file, about 2 MB
    order = [F.col("doc_id"), F.xxhash64("text")]
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(_encoder(spec, end_id, added), "at long, doc_id long, n_tokens long, ids array<int>")
     .withColumn("part", F.spark_partition_id())
     .write.options(**WRITE_OPTIONS).parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids."""
    files = spark.read.schema("part int, at long, doc_id long, n_tokens long, ids array<int>").parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # reads two small columns
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return files.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids")


def _checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("ids")
        offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        crc = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"),
                                          pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_report(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files."""
    small_batches(spark, SLICE)
    return read_token_files(spark, path).mapInArrow(_checksum, "doc_id long, start long, n_tokens long, ids_crc32 long")
