"""Removal of repeated passages with FM-indexes over shards.

A window is ``WINDOW`` consecutive words.  Equal windows have the same anchor,
the smallest hash of the ``GRAM``-word sequences inside, so windows are dealt to
shards by anchor and equal ones meet in one shard, wherever their documents
are.  A document's neighbouring windows with one anchor travel as one stretch;
stretches whose anchor occurs in a single document cannot repeat and stay at
home, equal stretches travel once with their smallest doc_id.

A shard concatenates its stretches, sorts the suffixes and keeps the
Burrows-Wheeler transform as a wavelet matrix of packed bits.  The stretches'
windows are streamed against it: backward search extends every match word by
word to the left, up to the window's length (matching statistics capped there,
abandoned when a match is unique).  What reaches the threshold has a suffix
interval, whose smallest doc_id says whether an earlier document holds the
window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import fresh, mix64, sha256_hex, slices, text_of
from feedlens.llm.ngram_join import HOT_LANES, SKETCH_BITS, excess
from feedlens.session import checkpoint, discard

WINDOW, GRAM = 13, 5
SHARD_WORDS = 400_000
#: An anchor with more distinct stretches is dealt out window by window.
WIDE_ANCHOR = 5_000
HOT_ROWS = 1_000
NO_ID = (1 << 63) - 1


#: Text bytes that a step handles at once, and words of stretches in a batch.
SLICE, BATCH_WORDS = 2 << 20, 4 << 20
#: Longest word that is hashed eight bytes at a time.
SHORT_WORD = 64
_PLACE = np.uint64(0x9E3779B97F4A7C15)
#: The first k of eight bytes.
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _white(data: np.ndarray) -> np.ndarray:
    return (data == 32) | (data - np.uint8(9) < 5)


class Words:
    """The words of an array of texts, as places in their bytes: text ``i`` has the words
    ``offsets[i]`` to ``offsets[i + 1]``, a word the bytes ``first`` to ``last`` of ``data``."""

    def __init__(self, texts: pa.Array):
        texts = fresh(texts)
        _, ends, data = texts.buffers()
        at = np.frombuffer(ends, np.int64)[:len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        self.data = np.frombuffer(data, np.uint8)[:at[-1]] if at[-1] else np.zeros(0, np.uint8)
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = ~_white(self.data)
        change = inside[1:] != inside[:-1]
        first, last = change & inside[1:], change & inside[:-1]
        meet = at[inside[at] & inside[at + 1]]  # a text ends in a word and the next one begins with one
        first[meet] = last[meet] = True
        self.first, self.last = np.flatnonzero(first), np.flatnonzero(last)
        self.offsets = np.searchsorted(self.first, at)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.offsets))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        length = self.last - self.first
        # eight bytes from each place on
        eight = np.ndarray(len(self.data) + 1, "<u8", np.concatenate([self.data, np.zeros(8, np.uint8)]), strides=(1,))
        h = mix64(length.astype(np.uint64) * _PLACE)
        long = np.flatnonzero(length > SHORT_WORD)
        if len(long):
            h[long] ^= pd.util.hash_array(np.array([self.data[i:j].tobytes() for i, j in zip(self.first[long], self.last[long])], object), categorize=False)
        rows, k = np.flatnonzero(length <= SHORT_WORD) if len(long) else slice(None), 0
        while True:
            part = eight[self.first[rows] + k] & _BYTES[np.minimum(length[rows] - k, 8)]
            h[rows] = mix64(h[rows] * _PLACE + part)
            k += 8
            rows = np.flatnonzero((length > k) & (length <= SHORT_WORD))
            if not len(rows):
                return h

    def joined(self, keep: np.ndarray) -> pa.Array:
        """Each text's words that are kept, joined by one space."""
        kept = np.flatnonzero(keep)
        first, last, owner = self.first[kept], self.last[kept].copy(), self.owner[kept]
        last[:-1] += owner[1:] == owner[:-1]  # with the white space behind it
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[first] += 1
        edge[last] -= 1
        out = self.data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
        out[_white(out)] = 32
        size = np.bincount(owner, weights=last - first, minlength=len(self.offsets) - 1).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(out)])


def _grams(mixed: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` consecutive words that start at each position, of mixed hashes of words."""
    n = max(0, len(mixed) - k + 1)
    out = mixed[:n].copy()
    for j in range(1, k):
        out *= _PLACE
        out += mixed[j:j + n]
    return mix64(out)


class Stretches:
    """The stretches of an array of texts: for each, its text, its first window
    (as a word position), its windows, its anchor and a hash of its words."""

    def __init__(self, texts: pa.Array):
        self.spans = Words(texts)
        self.offsets, owner = self.spans.offsets, self.spans.owner
        self.words = self.spans.hashes()
        self.mixed = mix64(self.words)
        n = len(self.words) - WINDOW + 1
        grams, best = _grams(self.mixed, GRAM), np.zeros(0, np.int64)
        smallest = grams[:0]
        if n > 0:
            smallest, width = grams, 1  # of the GRAM-word sequences of each window
            while 2 * width <= WINDOW - GRAM + 1:
                smallest = np.minimum(smallest[:-width], smallest[width:])
                width *= 2
            rest = WINDOW - GRAM + 1 - width
            smallest = np.minimum(smallest[:-rest], smallest[rest:]) if rest else smallest
            best = np.flatnonzero(owner[:n] == owner[WINDOW - 1:])  # windows inside one text
        # the leftmost smallest one of a window is that of the next unless it stands at the window's start or a smaller one comes in
        value = smallest[best]
        new = np.ones(len(best), bool)
        new[1:] = (value[1:] != value[:-1]) | (grams[best[:-1]] == value[:-1]) | (best[1:] != best[:-1] + 1)
        at = np.flatnonzero(new)
        self.start = best[at]
        self.windows = np.diff(np.append(at, len(best)))
        self.text = owner[self.start]
        self.anchor = value[at]

    @property
    def content(self) -> np.ndarray:
        """The hash of each stretch's words."""
        length = self.windows + WINDOW - 1
        # prefix sums of words times an odd power of their place, freed of the start by its inverse
        power = np.cumprod(np.full(len(self.words), _PLACE), dtype=np.uint64)
        inverse = np.cumprod(np.full(len(self.words), pow(int(_PLACE), -1, 1 << 64), np.uint64), dtype=np.uint64)
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.mixed * power, dtype=np.uint64)])
        return mix64((run[self.start + length] - run[self.start]) * inverse[self.start] + length.astype(np.uint64))

    def __len__(self) -> int:
        return len(self.start)


def _in_text(content: np.ndarray, text: np.ndarray) -> np.ndarray:
    """One number for a stretch's content and its text."""
    return mix64(content + mix64(text.astype(np.uint64) + np.uint64(1)))


def _runs(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, k): k of 0 to size[i] - 1 for every i."""
    i = np.repeat(np.arange(len(size)), size)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size)


def _listed(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row of each item, the items) of a column of lists; null has none."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(size)), size), lists.flatten()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(1 << SKETCH_BITS, np.int64)
    for b in slices(batches, "text", SLICE):
        s = Stretches(b.column("text"))
        seen += np.bincount((s.anchor >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(seen))
    used = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(seen[used])], ["bucket", "cnt"])


def _anchors(frequency):
    """(lane, hot, anchor, key, alike, content) of each text, equal stretches of a text once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(frequency.value, np.float32)
        for b in slices(batches, "text", SLICE):
            s = Stretches(b.column("text"))
            content = s.content
            number = _in_text(content, s.text)
            order = np.argsort(number)
            same = np.zeros(len(order), bool)
            same[1:] = number[order[1:]] == number[order[:-1]]
            rows = order[~same]
            anchor, key = s.anchor[rows], b.column("key").to_numpy()[s.text[rows]]
            hot = table[(anchor >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] >= HOT_ROWS
            lane = np.where(hot, mix64(anchor + mix64(key.astype(np.uint64)) % np.uint64(HOT_LANES) + np.uint64(1)), anchor)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lane.view(np.int64)), pa.array(hot), pa.array(anchor.view(np.int64)), pa.array(key),
                 b.column("alike").take(pa.array(s.text[rows])), pa.array(content[rows].view(np.int64))],
                ["lane", "hot", "anchor", "key", "alike", "content"])
    return run


class FmIndex:
    """FM-index over sequences of 64-bit words, each followed by a separator."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        alphabet, code = np.unique(words, return_inverse=True)
        n = len(words) + len(lengths)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        self.place = np.arange(len(words)) + owner  # of every word in the sequence with separators
        self.symbols = np.zeros(n, np.int64)        # 0 is the separator
        self.symbols[self.place] = code + 1
        self.owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        order = self._suffixes(n, len(lengths))
        self.order = order
        self.n = n
        self.before = np.concatenate([[0], np.cumsum(np.bincount(self.symbols, minlength=len(alphabet) + 1))])
        self._wavelet(self.symbols[order - 1], int(len(alphabet)).bit_length())
        self.base = self._map(np.arange(len(alphabet) + 1), np.zeros(len(alphabet) + 1, np.int64))

    def _suffixes(self, n: int, separators: int) -> np.ndarray:
        """Suffix array by prefix doubling; separators differ, in order of place."""
        rank = self.symbols + separators
        rank[self.symbols == 0] = np.arange(separators)
        step = 1
        while True:
            second = np.zeros(n, np.int64)
            second[:-step or None] = rank[step:] + 1
            key = rank * (n + separators + 2) + second
            order = np.argsort(key)  # of equal ones in any order, as none are left in the end
            key = key[order]
            new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                return order
            step *= 2

    def _wavelet(self, symbols: np.ndarray, levels: int) -> None:
        """Wavelet matrix: per level packed bits, ones before each 64, and the zeros."""
        self.levels = []
        for level in range(max(1, levels) - 1, -1, -1):
            bit = (symbols >> level & 1).astype(np.uint8)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)])[:-1]
            self.levels.append((level, packed, ones, len(bit) - int(bit.sum())))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def _map(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, packed, ones, zeros in self.levels:
            word = i >> 6
            one = ones[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
            i = np.where(symbol >> level & 1, zeros + one, i - one)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the first i places of the transform."""
        return self._map(symbol, i) - self.base[symbol]

    def search(self, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of ``length`` words from each word position
        ``start`` of the indexed sequences: (rows of ``start`` that occur
        more than once in full, their suffix intervals [low, high))."""
        rows = np.arange(len(start))
        at = self.place[start]
        for j in range(length - 1, -1, -1):
            c = self.symbols[at + j]
            if j == length - 1:
                low, high = self.before[c], self.before[c + 1]
            else:
                low = self.before[c] + self.rank(c, low)
                high = self.before[c] + self.rank(c, high)
            open_ = high - low > 1  # one: its own place alone
            rows, at, low, high = rows[open_], at[open_], low[open_], high[open_]
        return rows, low, high


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Smallest of values[low:high] for each range, by doubling."""
    out = np.empty(len(low), values.dtype)
    span = high - low
    table, width = values, 1
    while len(low):
        fit = (span >= width) & (span < 2 * width)
        out[fit] = np.minimum(table[low[fit]], table[high[fit] - width])
        if not (span >= 2 * width).any():
            return out
        table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


def _search_shard(group: pa.Table) -> pa.Table:
    """(content, first_window, earliest): per stretch the smallest doc_id that
    holds each of its windows, for stretches with a window of an earlier document."""
    lengths = pc.binary_length(group.column("words")).to_numpy() // 8
    words = np.frombuffer(b"".join(group.column("words").to_pylist()), np.uint64)
    keys = group.column("key").to_numpy()
    index = FmIndex(words, lengths)
    windows = lengths - WINDOW + 1
    first = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(windows)), windows)
    begin = np.cumsum(windows) - windows
    start = np.repeat(first - begin, windows) + np.arange(int(windows.sum()))
    earliest = keys[of]
    rows, low, high = index.search(start, WINDOW)
    earliest[rows] = _range_min(keys[index.owner[index.order]], low, high)
    last = group.column("last").to_numpy()
    useful = np.flatnonzero(np.minimum.reduceat(earliest, begin) < last) if len(begin) else begin
    i, j = _runs(windows[useful])
    ends = np.concatenate([[0], np.cumsum(windows[useful])]).astype(np.int32)
    return pa.table({
        "content": group.column("content").take(pa.array(useful)), "first_window": group.column("first_window").take(pa.array(useful)),
        "earliest": pa.ListArray.from_arrays(pa.array(ends), pa.array(earliest[begin[useful][i] + j]))})


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked stretches of each text with their words: one row, or one per
    window where the anchor is wide."""
    names = ["route", "content", "first_window", "key", "last", "words"]
    for b in slices(batches, "text", SLICE):
        s = Stretches(b.column("text"))
        if not len(s):
            continue
        text, asked = _listed(b.column("asked"))
        content = asked.field("content").to_numpy()
        number = _in_text(s.content, s.text)
        order = np.argsort(number)
        number = number[order]
        wanted = _in_text(content.view(np.uint64), text)
        place = np.minimum(np.searchsorted(number, wanted), len(number) - 1)
        a = np.flatnonzero(number[place] == wanted)  # rows of one doc_id are asked for one another's stretches too
        k, wide = order[place[a]], asked.field("wide").to_numpy(zero_copy_only=False)[a]
        of, w = _runs(np.where(wide, s.windows[k], 1))
        k, wide, a = k[of], wide[of], a[of]
        start, length = s.start[k] + w, np.where(wide, WINDOW, s.windows[k] + WINDOW - 1)
        route = s.anchor[k]
        if wide.any():
            route[wide] = _grams(s.mixed, WINDOW)[start[wide]]
        key, last = b.column("key").to_numpy()[text[a]], asked.field("last").to_numpy()[a]
        upto = np.cumsum(length)
        here = 0
        while here < len(a):
            stop = max(here + 1, int(np.searchsorted(upto, upto[here] - length[here] + BATCH_WORDS, side="right")))
            some = slice(here, stop)
            i, j = _runs(length[some])
            ends = np.concatenate([[0], 8 * np.cumsum(length[some])]).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), stop - here, [None, pa.py_buffer(ends), pa.py_buffer(s.words[start[some][i] + j])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(route[some].view(np.int64)), pa.array(content[a[some]]), pa.array(w[some].astype(np.int32)), pa.array(key[some]),
                 pa.array(last[some]), words], names)
            here = stop


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Take the repeated windows' words out of each text."""
    for b in slices(batches, "text", SLICE):
        s = Stretches(b.column("text"))
        hit = np.zeros(len(s.words) + 1, bool)  # words that a repeated window starts at
        text, hits = _listed(b.column("hits"))
        if len(hits) and len(s):
            number = _in_text(s.content, s.text)
            order = np.argsort(number)
            number = number[order]
            wanted = _in_text(hits.field("content").to_numpy().view(np.uint64), text)
            low = np.searchsorted(number, wanted)
            row, mask = _listed(hits.field("mask"))
            mask = np.flatnonzero(mask.to_numpy(zero_copy_only=False))
            row = row[mask]  # the hit of each repeated window
            begin = np.searchsorted(row, np.arange(len(hits)))
            window = mask - (np.cumsum(size := pc.list_value_length(hits.field("mask")).to_numpy()) - size)[row] + hits.field("first_window").to_numpy()[row]
            of, k = _runs(np.searchsorted(number, wanted, side="right") - low)  # every stretch that a hit names
            stretch = order[low[of] + k]
            i, j = _runs(np.diff(np.append(begin, len(row)))[of])
            hit[s.start[stretch[i]] + window[begin[of[i]] + j]] = True
        covered = np.cumsum(hit[:-1])
        covered[WINDOW:] -= covered[:-WINDOW].copy()
        keep = covered == 0
        n = np.diff(s.offsets)
        kept = np.bincount(s.spans.owner[keep], minlength=len(n))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(n - kept), s.spans.joined(keep)],
                                         ["doc_id", "n_words", "n_removed", "text"])


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def _alike(doc_id: Column) -> Column:
    """0 for a row with a doc_id; without one a hash of the text, so that only
    rows of one text, which hold the same stretches, are collected together."""
    return F.when(doc_id.isNull(), F.xxhash64(text_of())).otherwise(F.lit(0).cast("long"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(key, alike, content, first_window, mask): the windows of each document's
    stretches that start in a document with a smaller key."""
    spark = docs.sparkSession
    counts = (docs.select("text").mapInArrow(_sketch, "bucket int, cnt long").groupBy("bucket")
              .agg(F.sum("cnt").alias("cnt")).toArrow())  # at most 2^SKETCH_BITS rows
    sketch = np.zeros(1 << SKETCH_BITS)
    sketch[counts.column("bucket").to_numpy()] = counts.column("cnt").to_numpy()
    frequency = spark.sparkContext.broadcast(excess(sketch).astype(np.float32).tobytes())  # 1 MB
    keyed = docs.select(_key(F.col("doc_id")).alias("key"), _alike(F.col("doc_id")).alias("alike"), "text")
    rows = keyed.mapInArrow(_anchors(frequency), "lane long, hot boolean, anchor long, key long, alike long, content long")
    meet = Window.partitionBy("lane")
    shared = checkpoint(rows.withColumn("low", F.min("key").over(meet)).withColumn("high", F.max("key").over(meet))
                        .where("hot OR low < high").select("anchor", "key", "alike", "content"), "shared")
    stretches = shared.groupBy("anchor", "content").agg(F.min(F.struct("key", "alike")).alias("of"), F.max("key").alias("last"))
    stretches = checkpoint(stretches.select("anchor", "content", "of.key", "of.alike", "last"), "stretches")
    wide = stretches.groupBy("anchor").count().where(F.col("count") > WIDE_ANCHOR).select("anchor", F.lit(True).alias("wide"))
    asked = (stretches.join(wide, "anchor", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
             .groupBy("key", "alike").agg(F.collect_list(F.struct("content", "last", "wide")).alias("asked")))
    words = checkpoint(keyed.join(asked, ["key", "alike"]).select("key", "text", "asked").mapInArrow(
        _words, "route long, content long, first_window int, key long, last long, words binary"), "stretch-words")
    total = words.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = int(total // (8 * SHARD_WORDS)) + 1
    found = checkpoint(words.withColumn("shard", F.pmod("route", F.lit(shards))).groupBy("shard").applyInArrow(
        _search_shard, "content long, first_window int, earliest array<long>"), "windows")
    discard(words, stretches)
    hits = shared.join(found, "content").withColumn("mask", F.transform("earliest", lambda e: e < F.col("key"))).where(
        F.array_contains("mask", True)).select("key", "alike", "content", "first_window", "mask")
    return checkpoint(hits.distinct(), "hits")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, text (the kept words
    joined by one space).

    A word goes when a window that covers it also starts in a document with a
    smaller doc_id, judged on the input.  Texts with fewer than WINDOW words,
    null and empty ones keep all their words.  A null doc_id counts as larger
    than any number; rows that share a doc_id never remove one another's
    words.  An empty table gives an empty result; other columns are not read.
    """
    hits = repeated_windows(docs).groupBy("key", "alike").agg(F.collect_list(F.struct("content", "first_window", "mask")).alias("hits"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _key(F.col("doc_id")).alias("key"),
                       _alike(F.col("doc_id")).alias("alike"))
    return rows.join(hits, ["key", "alike"], "left").select("doc_id", "text", "hits").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, text string")


def repeat_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", sha256_hex(F.col("text")).alias("kept_sha256"))
