"""Byte-level BPE by ranked merges over the distinct words of a slice.

A slice is a run of documents of about ``SLICE`` text bytes.  Its distinct words
(matches of the pattern) are merged side by side: one pass takes the leftmost pair of
the lowest rank in every word that has one (``merge_words``), with the ranks
of all pairs of tokens in one hash table.  Words longer than ``SIDE_BYTES`` take the same
merges one at a time over a heap.  Decoding concatenates the pieces' bytes.
Every document's ids come from its own text alone, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import fresh, slices, small_batches, text_of

#: Words that are merged side by side.
WORDS = 200_000
#: Bytes of a word that is merged beside others; the passes follow the longest word, longer ones take ``merge_long``.
SIDE_BYTES = 64
#: Text bytes of a slice.
SLICE = 3 << 20
#: The rank of a pair that is no token.
NO_RANK = 1 << 40
_WORKER: dict = {}


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file's content."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Merges:
    """What the merges need of the ranks: the ids of single bytes, the rank of every pair of tokens that
    are a token together (open addressing), and the bytes of each token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = np.array([ranks.get(bytes([k]), -1) for k in range(256)], np.int64)
        found = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                x, y = ranks.get(token[:k]), ranks.get(token[k:])
                if x is not None and y is not None:
                    found[x << 32 | y] = rank
        keys, values = np.array(list(found), np.uint64), np.array(list(found.values()), np.int64)
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, ~np.uint64(0)), np.full(1 << bits, NO_RANK)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):  # every free place takes one of its keys, the others go on to the next place
            free = left[self.keys[at[left]] == ~np.uint64(0)]
            self.keys[at[free]] = keys[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = at[left] + 1 & self.mask
        self.values[at] = values
        size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        self.ends = np.concatenate([[0], np.cumsum(size)])
        self.pieces = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that the tokens ``x`` and ``y`` are together."""
        keys = (x << 32 | y).astype(np.uint64)
        at = self._place(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], NO_RANK)
        left = np.flatnonzero((held != keys) & (held != ~np.uint64(0)))
        while len(left):
            at[left] = at[left] + 1 & self.mask
            held = self.keys[at[left]]
            hit = held == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (held != ~np.uint64(0))]
        return out


def merge_words(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ends, ids) of words of 1 to ``SIDE_BYTES`` bytes: in each pass the leftmost pair of the lowest rank of
    every word; a word that has none is done."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    token = merges.bytes[np.frombuffer(b"".join(words), np.uint8)]
    word = np.arange(len(words))
    rank = np.full(len(token), NO_RANK)
    rank[:-1] = merges.rank(token[:-1], token[1:])
    rank[np.cumsum(size) - 1] = NO_RANK
    done = []
    while len(word):
        start = np.cumsum(size) - size
        best = np.minimum.reduceat(rank * SIDE_BYTES + np.arange(len(token)) - np.repeat(start, size), start)
        live = best < NO_RANK * SIDE_BYTES
        if not live.all():
            ends = np.repeat(~live, size)
            done.append((word[~live], size[~live], token[ends]))
            token, rank, word, size, best = token[~ends], rank[~ends], word[live], size[live], best[live]
            start = np.cumsum(size) - size
        at = start + best % SIDE_BYTES
        token[at] = best // SIDE_BYTES
        stays = np.ones(len(token), bool)
        stays[at + 1] = False
        token, rank = token[stays], rank[stays]
        size = size - 1
        at = at - np.arange(len(at))
        end = np.cumsum(size)
        rank[at] = NO_RANK
        pair = at[at + 1 < end]
        rank[pair] = merges.rank(token[pair], token[pair + 1])
        pair = at[at > end - size] - 1
        rank[pair] = merges.rank(token[pair], token[pair + 1])
    if not done:
        return np.zeros(1, np.int64), np.zeros(0, np.int32)
    order = np.empty(len(words), np.int64)
    order[np.concatenate([d[0] for d in done])] = np.arange(len(words))
    ends = np.concatenate([[0], np.cumsum(np.concatenate([d[1] for d in done]))])
    return gather(np.concatenate([d[2] for d in done]).astype(np.int32), ends, order)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges over a linked list with a heap, for words too long for ``fold``."""
    parts = [word[i:i + 1] for i in range(len(word))]
    after, ahead = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if not parts[i] or (j := after[i]) >= len(parts) or ranks.get(parts[i] + parts[j]) != r:
            continue
        parts[i] += parts[j]
        parts[j] = b""
        after[i] = after[j]
        if after[j] < len(parts):
            ahead[after[j]] = i
        for left, right in ((ahead[i], i), (i, after[i])):
            if left >= 0 and right < len(parts) and (q := ranks.get(parts[left] + parts[right])) is not None:
                heapq.heappush(heap, (q, left))
    return [ranks[p] for p in parts if p]


def chunked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(ends, codes, chunks): text ``i`` is the concatenation of
    ``chunks[codes[ends[i]:ends[i + 1]]]``, distinct strings cut before single
    spaces between two characters that are not white space.  No match of the
    pattern reaches over such a cut: a space only ever starts one there.  A
    text with any other space is one chunk."""
    lists = pc.split_pattern(fresh(texts), " ")
    ends = lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]
    coded = lists.flatten().dictionary_encode()
    parts, code = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    opens = np.array([not p or p[0].isspace() for p in parts], bool)
    closes = np.array([not p or p[-1].isspace() for p in parts], bool)
    head = np.zeros(len(code), bool)
    head[ends[:-1]] = True
    bad = np.zeros(len(code), bool)
    bad[1:] = ~head[1:] & (opens[code[1:]] | closes[code[:-1]])
    whole = np.add.reduceat(bad, ends[:-1]) > 0 if len(code) else np.zeros(0, bool)
    used, code = np.unique(code * 2 + head, return_inverse=True)
    chunks = [parts[c >> 1] if c & 1 else " " + parts[c >> 1] for c in used.tolist()]
    if not whole.any():
        return ends, code, chunks
    runs = [code[s:e] for s, e in zip(ends[:-1], ends[1:])]
    for k in np.flatnonzero(whole):
        runs[k] = np.array([len(chunks)])
        chunks.append(texts[int(k)].as_py())
    return np.concatenate([[0], np.cumsum([len(r) for r in runs])]), np.concatenate(runs), chunks


def _merges(spec) -> Merges:
    """The process's ranks, read once from the broadcast."""
    if _WORKER.get("id") != spec.value["id"]:
        _WORKER.update(id=spec.value["id"], merges=Merges(read_ranks(spec.value["ranks"])))
    return _WORKER["merges"]


def gather(pool: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, values) of the runs ``pool[ends[c]:ends[c + 1]]`` of all ``codes`` in order."""
    n = np.diff(ends)[codes]
    upto = np.concatenate([[0], np.cumsum(n)])
    return upto, pool[np.repeat(ends[:-1][codes] - upto[:-1], n) + np.arange(upto[-1])]


def word_tokens(words: list[str], merges: Merges, most: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(ends, ids) of the words: a token that is the whole word, else what its merges leave."""
    coded = [w.encode() for w in words]
    short, other, other_ends, where = [], array("i"), [0], np.zeros(len(coded), np.int64)
    for k, w in enumerate(coded):
        rank = merges.ranks.get(w)
        if rank is None and 0 < len(w) <= SIDE_BYTES:
            where[k] = len(short)
            short.append(w)
            continue
        if rank is None:
            other.extend(merge_long(w, merges.ranks))
        else:
            other.append(rank)
        where[k] = -len(other_ends)
        other_ends.append(len(other))
    parts = [(np.array(other_ends, np.int64), np.frombuffer(other, np.int32) if len(other) else np.zeros(0, np.int32))]
    parts += [merge_words(short[s:s + most], merges) for s in range(0, len(short), most)]
    size = np.concatenate([np.diff(ends) for ends, _ in parts])
    where[where < 0] = -1 - where[where < 0] - (len(other_ends) - 1)
    return gather(np.concatenate([ids for _, ids in parts]), np.concatenate([[0], np.cumsum(size)]), where + len(other_ends) - 1)


def joined(merges: Merges, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of the pieces of each run of ids."""
    upto, data = gather(merges.pieces, merges.ends, ids.astype(np.int64))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(upto[ends].astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _encode(spec, pattern: str, most: int, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, find = _merges(spec), regex.compile(pattern).findall
        for b in slices(batches, "text", SLICE):
            ends, codes, chunks = chunked(b.column("text"))
            index: dict[str, int] = {}
            of, upto = array("i"), [0]
            for chunk in chunks:
                for word in find(chunk):
                    of.append(index.setdefault(word, len(index)))
                upto.append(len(of))
            word_ends, ids = word_tokens(list(index), merges, most)
            part_ends, words = gather(np.frombuffer(of, np.int32) if len(of) else np.zeros(0, np.int32), np.array(upto), codes)
            total, ids = gather(ids, word_ends, words)
            ends = total[part_ends[ends]]
            out = [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))]
            if decoded:
                out.append(joined(merges, ids, ends))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "ids", "decoded"][:len(out)])
    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, flat values) of a list column, from 0."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy(zero_copy_only=False)


def _spec(df: DataFrame, ranks_file: bytes):
    return df.sparkSession.sparkContext.broadcast({"id": hashlib.sha256(ranks_file).hexdigest(), "ranks": ranks_file})  # about 1 MB


def encode(docs: DataFrame, ranks_file: bytes, pattern: str, most: int = WORDS, decoded: bool = False) -> DataFrame:
    """One row per input row: doc_id, ids (array of int), and with ``decoded``
    the bytes that the ids decode to.

    Each match of ``pattern`` is encoded separately.  Null and empty texts have
    no ids; repeated rows are encoded each for itself; a null doc_id stays
    null; an empty table gives an empty result; other columns are not read.
    Texts are never shuffled; ``most`` words are merged side by side.
    """
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        _encode(_spec(docs, ranks_file), pattern, most, decoded), "doc_id long, ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, ranks_file: bytes) -> DataFrame:
    """doc_id, ids, decoded (binary): the pieces' bytes in order."""
    spec = _spec(encoded, ranks_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(spec)
        for b in batches:
            ends, ids = _lists(b.column("ids"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), joined(merges, ids, ends)], ["doc_id", "ids", "decoded"])
    return encoded.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def bpe_report(docs: DataFrame, ranks_file: bytes, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256."""
    return encode(docs, ranks_file, pattern, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def public_vocabulary(name: str) -> bytes:
    """Content of a file of the installed public tokenizers."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()
