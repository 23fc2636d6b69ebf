"""Title similarity join, ``ratio(a, b) >= threshold`` as difflib computes it.

The reference compares every new title with every title seen so far.  Here the
comparison is over *distinct* strings, and only pairs that lossless filters leave are
verified with the exact stdlib ratio.

``similar_pairs`` compares blocks.  A block holds strings of one length class, by a hash
of their ids, and is one row of a table that is written once.  The table's product with itself meets every two
blocks of near classes in a task that reads them where they are: no row is a pair, disk holds each string a few times however
many blocks its own meets, and memory is a few blocks.  In the task all pairs are tested
by the multisets of their characters (M is at most what they share), as a product of 0/1
matrices; what is left by length and by the multisets of character pairs, both as histograms of classes, which share
no less; then long strings by runs of ``GRAM`` characters, in classes that grow with the strings; then by the longest common subsequence, which no sum of ordered blocks
exceeds.  The few pairs left are rows, dealt anew so that a cluster of near copies is not one
task's work, and verified both ways by difflib's rule (``Matcher``).  The first product is quadratic in the
strings of a length, as the job is when no key is selective.

The state between polls (``state.duplicates``) holds blocks too.

Why the filter loses nothing.  ratio = 2M/S with S = |a| + |b| and M the
characters in difflib's matching blocks (non-overlapping, in order, never
adjacent in both strings).  So:

* length:  2 min(|a|,|b|) / S >= ratio, hence min/max >= t / (2 - t);
* q-grams: with B blocks, B - 1 <= unmatched characters = S - 2M, and a block
  of length L holds L - q + 1 aligned q-grams, so the q-gram multisets of a
  and b share at least  (2q - 1) M - (q - 1)(S + 1)  grams, with
  M >= ceil(t S / 2);
* popular characters: in a b of 200 characters or more difflib looks only for characters
  that make up 1 % of it at most.  Each block has one of them, but for one at the very start,
  so B is bounded by their number (``most_blocks``), and the strings share at least
  M - (q - 1) B runs of q characters.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint, discard

DEFAULT_THRESHOLD = 0.85

# Classes of the character histograms: characters modulo this many.
HISTOGRAM = 64
# Classes of the histograms of two characters.
PAIR_HISTOGRAM = 256
# Characters of the runs that long strings are compared by.
GRAM = 4

# Strings and characters of a block, and the length classes that the length ratio of a pair may span.
BLOCK, BLOCK_CHARS, STEPS = 2000, 1_000_000, 4
# Blocks of each of the two parts of the table that a task of the product reads, about.
MET = 8
# Bytes of rows of two blocks that a worker is handed at once.
_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"
# Pairs of a block that are tested at once, and a number of matching blocks that says nothing.
PAIRS, NO_BOUND = 1 << 21, 1 << 40
# From so many pairs on, the subsequences of a block's pairs are taken side by side, if the bit sets have at most so many bytes.
ALIGNED, BITS = 500, 32 << 20
_EPS = 1e-9


def min_matches(s: Column, threshold: float) -> Column:
    return F.ceil(s * F.lit(threshold / 2.0) - F.lit(_EPS))


def overlap_bound(s: Column, threshold: float, q: int) -> Column:
    m = min_matches(s, threshold)
    return m * (2 * q - 1) - (s + 1) * (q - 1)


def lowest_bound(s: Column, threshold: float, q: int) -> Column:
    """The lower envelope of ``overlap_bound``: at most it, and never falling as s grows."""
    slope = (2 * q - 1) * threshold / 2.0 - (q - 1)
    return F.ceil(s * F.lit(slope) - F.lit(q - 1 + _EPS))


def ratio_at_least(a: str, b: str, threshold: float) -> bool:
    """The reference's test on normalized strings: equal, or ratio >= t."""
    if a == b:
        return True
    sm = SequenceMatcher(None, a, b)
    if sm.real_quick_ratio() < threshold or sm.quick_ratio() < threshold:
        return False  # both are upper bounds of ratio()
    return sm.ratio() >= threshold


def common_subsequence(a: str, where_b: dict[str, int], size_b: int, need: int = 0) -> int:
    """Length of the longest common subsequence, bit-parallel over b, given as the
    bit set of the places of each character; once ``need`` is out of reach, anything below it."""
    full = (1 << size_b) - 1
    row = full
    left = len(a)
    for ch in a:
        hit = row & where_b.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
        left -= 1
        if not left & 31 and need:
            # a matching of ``need`` leaves at most size_b - need of b unmatched, so what is read
            # of a meets b no further than that ahead; what is not read adds ``left`` at most
            ahead = min(len(a) - left + size_b - need, size_b)
            if ahead - (row & (1 << ahead) - 1 if ahead > 0 else 0).bit_count() + left < need:
                return -1
    return size_b - row.bit_count()


class Matcher:
    """difflib's matching against one ``b``, as ``SequenceMatcher(None, a, b)`` does it, but visiting only
    the places of ``a`` whose character is looked for at all, and left once the threshold is decided."""

    def __init__(self, b: str):
        self.b, self.places = b, {}
        for j, ch in enumerate(b):
            self.places.setdefault(ch, []).append(j)
        if len(b) >= 200:  # popular characters only extend a match
            most = len(b) // 100 + 1
            self.places = {ch: at for ch, at in self.places.items() if len(at) <= most}

    def _longest(self, a: str, starts: list[int], alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
        b, places = self.b, self.places
        besti, bestj, size = alo, blo, 0
        runs, last = {}, -2
        for i in starts[bisect_left(starts, alo):bisect_left(starts, ahi)]:
            before, runs = runs if last == i - 1 else {}, {}
            last = i
            for j in places[a[i]]:
                if j < blo:
                    continue
                if j >= bhi:
                    break
                k = runs[j] = before.get(j - 1, 0) + 1
                if k > size:
                    besti, bestj, size = i - k + 1, j - k + 1, k
        while besti > alo and bestj > blo and a[besti - 1] == b[bestj - 1]:
            besti, bestj, size = besti - 1, bestj - 1, size + 1
        while besti + size < ahi and bestj + size < bhi and a[besti + size] == b[bestj + size]:
            size += 1
        return besti, bestj, size

    def reaches(self, a: str, threshold: float) -> bool:
        """Whether ``SequenceMatcher(None, a, b).ratio() >= threshold``."""
        total = len(a) + len(self.b)
        if not total:
            return 1.0 >= threshold
        starts = [i for i, ch in enumerate(a) if ch in self.places]
        windows, found, room = [(0, len(a), 0, len(self.b))], 0, min(len(a), len(self.b))
        # ``room``: the most that the windows left can add
        while windows and 2.0 * found / total < threshold <= 2.0 * (found + room) / total:
            alo, ahi, blo, bhi = windows.pop()
            room -= min(ahi - alo, bhi - blo)
            i, j, size = self._longest(a, starts, alo, ahi, blo, bhi)
            if size:
                found += size
                for w in ((alo, i, blo, j), (i + size, ahi, j + size, bhi)):
                    if w[0] < w[1] and w[2] < w[3]:
                        windows.append(w)
                        room += min(w[1] - w[0], w[3] - w[2])
        return 2.0 * found / total >= threshold


def verify_pairs(a_values, b_values, threshold: float) -> list[tuple[bool, bool]]:
    """``ratio_at_least`` both ways, (a, b) and (b, a), for a batch of pairs: by the
    longest common subsequence, which no matching exceeds either way, and only then by
    difflib, which is not symmetric.  Pairs are visited grouped by ``b``."""
    n = len(a_values)
    out = [(False, False)] * n
    current, where, matcher = None, {}, None
    for i in sorted(range(n), key=lambda k: b_values[k]):
        x, y = a_values[i], b_values[i]
        if x == y:
            out[i] = (True, True)
            continue
        total = len(x) + len(y)
        if total == 0 or 2.0 * min(len(x), len(y)) / total < threshold:
            continue
        if y != current:
            current, where, matcher = y, {}, None
            for k, ch in enumerate(y):
                where[ch] = where.get(ch, 0) | 1 << k
        if 2.0 * common_subsequence(x, where, len(y), math.ceil(threshold * total / 2.0 - 1e-9)) / total >= threshold:
            matcher = matcher or Matcher(y)
            out[i] = (matcher.reaches(x, threshold), Matcher(x).reaches(y, threshold))
    return out


def parts(df: DataFrame) -> int:
    """Partition count for the CPU-heavy steps.  They blow small inputs up
    (a string into hundreds of grams, grams into pairs), so AQE's coalescing
    by input bytes would squeeze them into a task or two; an explicit count is
    left alone."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism * 2)


def similar_pairs(new_side: DataFrame, seen_side: DataFrame,
                  threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """All (a, b) with a from ``new_side.a`` and b from ``seen_side.b`` (both
    already normalized, NULL meaning "no title") such that a == b or
    ratio(a, b) >= threshold.  Inputs may hold repeats; work is on distinct
    strings."""
    a = new_side.select(F.col("a").alias("s")).where(F.col("s").isNotNull()).distinct() \
        .withColumn("in_a", F.lit(True))
    b = seen_side.select(F.col("b").alias("s")).where(F.col("s").isNotNull()).distinct() \
        .withColumn("in_b", F.lit(True))
    u = a.join(b, "s", "full").select("s", F.coalesce("in_a", F.lit(False)).alias("in_a"),
                                      F.coalesce("in_b", F.lit(False)).alias("in_b"))
    # stable ids for the distinct strings: checkpointed, so every branch below
    # sees the same numbering even after a lost executor
    u = checkpoint(u.withColumn("n", F.length("s")).withColumn("sid", F.monotonically_increasing_id()))

    # exact equality (includes the empty string)
    same = u.where(F.col("in_a") & F.col("in_b")).select(F.col("s").alias("a"), F.col("s").alias("b"))
    return same.unionByName(_compared(u.where("n > 0"), threshold))


def length_classes(threshold: float) -> tuple[float, int]:
    """(width of a class in log(length), how many classes apart a pair that reaches the threshold can be)."""
    reach = math.log((2.0 - threshold) / threshold)
    return max(reach / STEPS, 1e-3), math.ceil(reach / max(reach / STEPS, 1e-3)) + 1


def length_class(n: Column, threshold: float) -> Column:
    """The class of a length; the empty string has one of its own."""
    return F.when(n > 0, F.floor(F.log(n) / F.lit(length_classes(threshold)[0]))).otherwise(-1).cast("int")


def block_count(n: Column, strings: int) -> Column:
    """Blocks of at most about so many strings and ``BLOCK_CHARS`` characters that strings of lengths ``n`` fill."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / strings), F.ceil(F.sum(n) / BLOCK_CHARS)).cast("int")


def blocks_of(strings: DataFrame, threshold: float, size: int) -> DataFrame:
    """(lc, k, texts): the distinct strings (s) in blocks of one length class, a row a block."""
    classed = strings.select("s", length_class(F.length("s"), threshold).alias("lc"))
    sizes = classed.groupBy("lc").agg(block_count(F.length("s"), size).alias("blocks"))  # one row a length class
    return (classed.join(F.broadcast(sizes), "lc").select("lc", F.pmod(F.xxhash64("s"), F.col("blocks")).cast("int").alias("k"), "s")
            .groupBy("lc", "k").agg(F.collect_list("s").alias("texts")))


def similar_to_block(threshold: float):
    """Of rows of two blocks (a, b), as lists of strings, the strings of the first that are similar to one of the second."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                new = pd.DataFrame({"s": a.as_py(), "in_a": True, "in_b": False})
                seen = pd.DataFrame({"s": b.as_py(), "in_a": False, "in_b": True})
                yield pa.RecordBatch.from_arrays([pa.array(similar_in_blocks(new, seen, threshold)["a"].unique(), pa.string())], ["a"])
    return run


def _compared(u: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the different strings of ``u`` (sid, s, n, in_a, in_b) that are similar: blocks of strings of one
    length class and side, every two blocks of near classes compared, but for two of one and the same side only."""
    apart = length_classes(threshold)[1]
    u = u.withColumn("lc", length_class(F.col("n"), threshold)) \
        .withColumn("side", F.col("in_a").cast("int") + 2 * F.col("in_b").cast("int"))
    # one row a length class and side, as many as the logarithm of the longest string has
    named = checkpoint(u.groupBy("lc", "side").agg(block_count(F.col("n"), BLOCK).alias("blocks")).coalesce(1), "classes")
    own = F.struct("lc", "side", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int").alias("k"))
    blocks = checkpoint(u.join(F.broadcast(named), ["lc", "side"]).select(own.alias("own"), "s")
                        .groupBy("own").agg(F.collect_list("s").alias("texts")), "blocks")
    count = named.agg(F.sum("blocks")).first()[0] or 0
    tasks = max(parts(u), min(count * count // 2, 4 * parts(u)))
    # each side is shuffled once, and a part of it read by as many tasks as the other side has parts
    dealt = max(1, min(count, max(math.ceil(count / MET), math.ceil(math.sqrt(2 * tasks)))))
    x = blocks.select(F.col("own").alias("x"), F.col("texts").alias("x_texts")).repartition(dealt, "x")
    y = blocks.select(F.col("own").alias("y"), F.col("texts").alias("y_texts")).repartition(dealt, "y")
    met = x.join(y.hint("shuffle_replicate_nl"), (F.col("y") >= F.col("x")) & (F.col("y.lc") <= F.col("x.lc") + apart)
                 & ((F.col("x.side") == 3) | (F.col("x.side") != F.col("y.side"))))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for likely in batches:
            yield verified(likely, threshold)
    spark = u.sparkSession
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, BATCH_BYTES)
    try:
        likely = checkpoint(met.mapInArrow(likely_of_blocks(threshold), "x string, y string, xy boolean, yx boolean"), "likely")
    finally:
        spark.conf.set(_BATCH, before)
    discard(named, blocks)
    return likely.repartition(tasks, "x", "y").mapInPandas(verify, "a string, b string")


def likely_of_blocks(threshold: float):
    """Of rows of two blocks (x, x_texts, y, y_texts), the pairs of their strings that may be similar."""
    def block(row: pa.RecordBatch, name: str) -> Block:
        side = row.column(name)[0].as_py()["side"]
        return Block(pd.DataFrame({"s": row.column(f"{name}_texts")[0].as_py(), "in_a": bool(side & 1), "in_b": side > 1}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = x = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                if row.column("x")[0] != own:  # rows of one block follow one another
                    own, x = row.column("x")[0], block(row, "x")
                y = x if row.column("y")[0] == own else block(row, "y")
                yield pa.RecordBatch.from_pandas(_likely(x, y, threshold), pa.schema(
                    [("x", pa.string()), ("y", pa.string()), ("xy", pa.bool_()), ("yx", pa.bool_())]), preserve_index=False)
    return run


class Block:
    """Strings of a block, with what the bounds need of each."""

    def __init__(self, rows: pd.DataFrame):
        self.s = rows["s"].tolist()
        self.a, self.b = rows["in_a"].to_numpy(bool), rows["in_b"].to_numpy(bool)
        self.n = np.array([len(x) for x in self.s], np.int64)
        self.code = np.frombuffer("".join(self.s).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.n)])
        self.owner = np.repeat(np.arange(len(self.s)), self.n)
        self.chars = self.counted(self.owner, self.code, HISTOGRAM)
        inside = self.owner[1:] == self.owner[:-1]
        self.pairs = self.counted(self.owner[1:][inside], (self.code[:-1] * 31 + self.code[1:])[inside], PAIR_HISTOGRAM)
        self.most_blocks = np.full(len(self.s), NO_BOUND)
        for k in np.flatnonzero(self.n >= 200):
            self.most_blocks[k] = most_blocks(self.code[self.start[k]:self.start[k + 1]])
        self._grams = None

    def grams(self, classes: int) -> np.ndarray:
        """The histograms of the runs of ``GRAM`` characters in so many classes (a power of two)."""
        if self._grams is None or self._grams.shape[1] != classes:
            at = np.arange(max(0, len(self.code) - GRAM + 1))
            at = at[self.owner[at] == self.owner[at + GRAM - 1]]
            number = np.zeros(len(at), np.uint64)
            for k in range(GRAM):
                number = number * np.uint64(0x9E3779B97F4A7C15) + self.code[at + k].astype(np.uint64)
                number ^= number >> np.uint64(29)
            self._grams = self.counted(self.owner[at], (number % np.uint64(classes)).astype(np.int64), classes)
        return self._grams

    def counted(self, owner: np.ndarray, number: np.ndarray, classes: int) -> np.ndarray:
        out = np.bincount(owner * classes + number % classes, minlength=len(self.s) * classes).reshape(len(self.s), classes)
        return out.astype(np.uint8 if out.max(initial=0) < 256 else np.int32)


def most_blocks(code: np.ndarray) -> int:
    """Most matching blocks that difflib finds with a ``b`` of these 200 characters or more.  It looks for
    characters of b that are not popular (more than 1 % of it); a block grows from at least one of those, each
    at a place of b of its own, but for one that may stand at the very start of both strings."""
    _, n = np.unique(code, return_counts=True)
    return int(n[n <= len(code) // 100 + 1].sum()) + 1


def _levels(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """0/1 rows whose dot product is the sum of the smaller counts of two histograms: a column for each class and
    each count that both sides reach."""
    most = np.minimum(x.max(axis=0), y.max(axis=0)).astype(np.int64)
    kind = np.repeat(np.arange(len(most)), most)
    level = np.arange(len(kind)) - np.repeat(np.cumsum(most) - most, most) + 1
    return (x[:, kind] >= level).astype(np.float32), (y[:, kind] >= level).astype(np.float32)


class Subsequences:
    """Lengths of longest common subsequences of a string of ``x`` and one of ``y``, bit-parallel over the
    latter, many pairs a character of the former at a time."""

    def __init__(self, x: Block, y: Block):
        alphabet, code = np.unique(np.concatenate([x.code, y.code]), return_inverse=True)
        self.x, self.y, self.size = x, y, len(alphabet) + 1
        self.words = (int(y.n.max()) + 63) // 64
        if not self.fits:
            return
        # the character that is nowhere fills the shorter strings up
        self.text = np.full((int(x.n.max()), len(x.s)), len(alphabet), np.int64)
        self.text[np.arange(len(x.code)) - x.start[x.owner], x.owner] = code[:len(x.code)]
        at = np.arange(len(y.code)) - y.start[y.owner]
        self.where = np.zeros((self.words, len(y.s) * self.size), np.uint64)
        np.bitwise_or.at(self.where, (at // 64, y.owner * self.size + code[len(x.code):]), np.uint64(1) << (at % 64).astype(np.uint64))

    @property
    def fits(self) -> bool:
        """Whether the bit sets of the places of all characters are small."""
        return len(self.y.s) * self.size * self.words * 8 <= BITS

    def lengths(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of the pairs (x[i], y[j])."""
        rows = np.full((self.words, len(i)), ~np.uint64(0))
        mine = j * self.size
        for t in range(int(self.x.n[i].max(initial=0))):
            place = mine + self.text[t][i]
            carry = None
            for w in range(self.words):
                row = rows[w]
                hit = row & self.where[w][place]
                total = row + hit
                over = total < hit
                if carry is not None:
                    total += carry
                    over |= total < carry
                rows[w] = total | (row ^ hit)
                carry = over.astype(np.uint64)
        n = self.y.n[j]
        left = np.zeros(len(i), np.int64)
        for w in range(self.words):
            bits = np.clip(n - 64 * w, 0, 64).astype(np.uint64)
            mask = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << (bits % np.uint64(64))) - np.uint64(1))
            left += np.bitwise_count(rows[w] & mask)
        return n - left


def _candidates(x: Block, y: Block, within: bool, threshold: float):
    """(i, j) of the pairs that the histograms leave, some at a time."""
    half = threshold / 2.0
    levels_x, levels_y = _levels(x.chars, y.chars)
    # what is shared less what a match needs, in one product; rounded, so with room to spare
    right = np.concatenate([levels_y, np.ones((len(y.s), 1), np.float32), (-half * y.n[:, None]).astype(np.float32)], axis=1).T
    left = np.concatenate([levels_x, (-half * x.n[:, None]).astype(np.float32), np.ones((len(x.s), 1), np.float32)], axis=1)
    room = np.float32(-0.05 - 1e-5 * (x.n.max() + y.n.max()))
    step = max(1, PAIRS // max(1, len(y.s)))
    for first in range(0, len(x.s), step):
        i, j = np.nonzero(left[first:first + step] @ right >= room)
        i += first
        ok = x.a[i] & y.b[j] | x.b[i] & y.a[j]
        if within:
            ok &= j > i
        i, j = i[ok], j[ok]
        for s in range(0, len(i), PAIRS // PAIR_HISTOGRAM):
            p, q = i[s:s + PAIRS // PAIR_HISTOGRAM], j[s:s + PAIRS // PAIR_HISTOGRAM]
            total = x.n[p] + y.n[q]
            need = np.ceil(total * half - _EPS)
            shared = np.minimum(x.pairs[p], y.pairs[q]).sum(axis=1, dtype=np.int32)
            most = np.minimum(total - 2 * need + 1, np.maximum(x.most_blocks[p], y.most_blocks[q]))
            ok = (np.minimum(x.n[p], y.n[q]) >= need) & (shared >= need - most)
            yield _sharing_grams(x, y, p[ok], q[ok], (need - (GRAM - 1) * most)[ok])


def _sharing_grams(x: Block, y: Block, p: np.ndarray, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (p, q) those that share ``least`` runs of characters or may do so."""
    ok = least <= 0
    open_ = np.flatnonzero(~ok)
    if len(open_):
        classes = 1 << (2 * max(int(x.n.max()), int(y.n.max())) - 1).bit_length()
        mine, theirs = x.grams(classes), y.grams(classes)
        step = max(1, PAIRS // classes)
        for s in range(0, len(open_), step):
            some = open_[s:s + step]
            ok[some] = np.minimum(mine[p[some]], theirs[q[some]]).sum(axis=1, dtype=np.int32) >= least[some]
    return p[ok], q[ok]


def likely_in_blocks(left: pd.DataFrame, right: pd.DataFrame | None, threshold: float) -> pd.DataFrame:
    """(x, y, xy, yx): the pairs of a string of ``left`` and one of ``right`` (s, in_a, in_b) that may be similar, and
    which of (x, y) and (y, x) are asked for; without ``right``, of every two different strings of ``left``.  By the
    bounds of the histograms, then by the longest common subsequences."""
    if not len(left) or right is not None and not len(right):
        return pd.DataFrame({"x": pd.Series(dtype=object), "y": pd.Series(dtype=object),
                             "xy": pd.Series(dtype=bool), "yx": pd.Series(dtype=bool)})
    x = Block(left)
    return _likely(x, x if right is None else Block(right), threshold)


def _likely(x: Block, y: Block, threshold: float) -> pd.DataFrame:
    """``likely_in_blocks`` of two blocks, or of one with itself."""
    pairs = np.concatenate([np.zeros((2, 0), np.int64), *map(np.stack, _candidates(x, y, x is y, threshold))], axis=1)
    common = Subsequences(x, y) if pairs.shape[1] >= ALIGNED else None
    if common and common.fits:
        some = range(0, pairs.shape[1], PAIRS // 64)
        long = np.concatenate([common.lengths(*pairs[:, s:s + PAIRS // 64]) for s in some])
        pairs = pairs[:, long >= np.ceil((x.n[pairs[0]] + y.n[pairs[1]]) * (threshold / 2.0) - _EPS)]
    i, j = pairs
    return pd.DataFrame({"x": pd.Series([x.s[p] for p in i], dtype=object), "y": pd.Series([y.s[q] for q in j], dtype=object),
                         "xy": x.a[i] & y.b[j], "yx": y.a[j] & x.b[i]})


def verified(likely: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(a, b) of the pairs of ``likely_in_blocks`` that are similar, in the directions asked for."""
    a, b = [], []
    x, y = likely["x"].tolist(), likely["y"].tolist()
    for p, q, xy, yx, (forth, back) in zip(x, y, likely["xy"], likely["yx"], verify_pairs(x, y, threshold)):
        if forth and xy:
            a.append(p)
            b.append(q)
        if back and yx:
            a.append(q)
            b.append(p)
    return pd.DataFrame({"a": pd.Series(a, dtype=object), "b": pd.Series(b, dtype=object)})


def similar_in_blocks(left: pd.DataFrame, right: pd.DataFrame | None, threshold: float) -> pd.DataFrame:
    """(a, b) of the similar pairs of a string of ``left`` and one of ``right``; without ``right``, of every two
    different strings of ``left``."""
    return verified(likely_in_blocks(left, right, threshold), threshold)
