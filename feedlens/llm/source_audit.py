"""Source divergence audit by a recount over minimal perfect hashes.

The first pass over the texts finds, exactly, the terms that enough documents
of a language hold.  They are dealt to shards of about ``SHARD_TERMS`` terms by
their hash, and each shard gets a minimal perfect hash with its keys stored in
slot order.  The second pass looks every term of every text up there, verifies
it against the stored key and adds to one dense array of counts per (lang,
source).  Shards are broadcast in rounds of at most ``ROUND_BYTES``: a larger
vocabulary takes more passes, never a larger broadcast.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import fresh, mix64, slices
from feedlens.session import checkpoint, discard

MIN_DOCS = 30
SMOOTH = 5
TOP_TERMS = 50
#: Terms of one shard; a shard's task holds this many counts per source.
SHARD_TERMS = 2048
#: Stored keys and hash bits that one round broadcasts.
ROUND_BYTES = 64 << 20
#: Dense counts that a task of the second pass holds before it hands them on.
DENSE_BYTES = 96 << 20
TEXT_BYTES = 4 << 20
LEVELS = 24  # of a perfect hash; keys that still collide are listed

_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(index of the text, term) of every match of
    ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased: runs of ASCII
    letters and bytes of characters beyond ASCII."""
    texts = fresh(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[:len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if at[-1] == at[0]:
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    data = np.frombuffer(texts.buffers()[2].to_pybytes().translate(_FOLD), np.uint8)[:at[-1]]
    solid = data != 32
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    first[heads] = solid[heads]
    begin = np.flatnonzero(first)
    offsets = np.append(np.cumsum(solid)[begin] - 1, solid.sum()).astype(np.int64)
    flat = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid].tobytes())])
    return np.searchsorted(at, begin, side="right") - 1, flat


def term_hashes(terms: pa.Array) -> np.ndarray:
    if not len(terms):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(terms.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _codes(column: pa.Array) -> tuple[np.ndarray, list]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


# ---------------------------------------------------------------------------- first pass

def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", TEXT_BYTES):
        owner, flat = terms_of(part.column("text"))
        if not len(flat):
            continue
        coded = flat.dictionary_encode()
        size = len(coded.dictionary)
        once = np.unique(owner * size + coded.indices.to_numpy())
        code, langs = _codes(part.column("lang"))
        found, docs = np.unique(code[once // size] * size + once % size, return_counts=True)
        yield pa.record_batch({"lang": pa.array(langs, pa.string()).take(pa.array(found // size)),
                               "term": coded.dictionary.take(pa.array(found % size)).cast(pa.string()),
                               "docs": pa.array(docs, pa.int64())})


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term) of the terms in at least ``min_docs`` rows of the language."""
    found = docs.mapInArrow(_document_counts, "lang string, term string, docs long")
    return found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term")


# ---------------------------------------------------------------------------- perfect hashes

def _place(hashes: np.ndarray, level: np.ndarray | int, size: np.ndarray | int) -> np.ndarray:
    return (mix64(hashes ^ (np.uint64(0x9E3779B97F4A7C15) * np.asarray(level + 1, np.uint64))) % np.asarray(size, np.uint64)).astype(np.int64)


def perfect_hash(hashes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(sizes of the levels, their bits, keys in slot order).  A key's bit lies in
    the first level where no other remaining key falls on its place; its slot
    is the rank of that bit.  Keys of equal hash come last, without a bit."""
    left = np.arange(len(hashes))
    sizes, bits, order = [], [], []
    for level in range(LEVELS):
        if not len(left):
            break
        size = 2 * len(left) + 1
        place = _place(hashes[left], level, size)
        alone = np.bincount(place, minlength=size) == 1
        mine = alone[place]
        order.append(left[mine][np.argsort(place[mine])])
        sizes.append(size)
        bits.append(alone)
        left = left[~mine]
    return sizes, np.concatenate([*bits, np.zeros(0, bool)]), np.concatenate([*order, left]).astype(np.int64)


def _build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    terms = table.column("term").combine_chunks()
    sizes, bits, order = perfect_hash(term_hashes(terms))
    return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "shard": pa.array([key[1].as_py()], pa.int64()),
                     "shards": pa.array([table.column("shards")[0].as_py()], pa.int64()),
                     "terms": pa.array([terms.take(pa.array(order)).to_pylist()], pa.list_(pa.string())),
                     "sizes": pa.array([sizes], pa.list_(pa.int64())),
                     "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def term_shards(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One row per shard: lang, shard, shards (of the language), terms in slot
    order, sizes and bits of the perfect hash."""
    @F.pandas_udf("long")
    def hashed(term: pd.Series) -> pd.Series:
        return pd.Series(term_hashes(pa.array(term, pa.string())).view(np.int64))

    count = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / shard_terms).cast("long").alias("shards"))
    dealt = kept.join(count, "lang").withColumn("shard", F.pmod(hashed("term"), F.col("shards")))
    return dealt.groupBy("lang", "shard").applyInArrow(
        _build, "lang string, shard long, shards long, terms array<string>, sizes array<long>, bits binary")


class TermIndex:
    """The shards of one language that a round holds, looked up all at once."""

    def __init__(self, rows: list[dict]):
        self.shards = rows[0]["shards"]
        self.row = {r["shard"]: k for k, r in enumerate(rows)}
        self.numbers = np.array([r["shard"] for r in rows])
        self.at = np.full(self.shards, -1, np.int64)
        self.at[self.numbers] = np.arange(len(rows))
        depth = max(len(r["sizes"]) for r in rows)
        self.size = np.zeros((len(rows), depth), np.int64)
        for k, r in enumerate(rows):
            self.size[k, :len(r["sizes"])] = r["sizes"]
        bits = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=int(self.size[k].sum())).astype(bool) for k, r in enumerate(rows)]
        self.bits = np.concatenate([*bits, np.zeros(1, bool)])
        starts = np.concatenate([[0], np.cumsum(self.size.sum(axis=1))])[:-1]
        self.base = starts[:, None] + np.cumsum(self.size, axis=1) - self.size
        self.start = np.concatenate([[0], np.cumsum([len(r["terms"]) for r in rows])])  # slots before each shard
        slot = [self.start[k] + np.cumsum(b) - 1 for k, b in enumerate(bits)]
        self.slot = np.concatenate([*slot, np.zeros(1, np.int64)]).astype(np.int64)
        self.terms = pa.array([t for r in rows for t in r["terms"]], pa.large_string())
        self.listed = {t: int(self.start[k]) + int(b.sum()) + j for k, (r, b) in enumerate(zip(rows, bits))
                       for j, t in enumerate(r["terms"][int(b.sum()):])}

    def __len__(self) -> int:
        return len(self.terms)

    def slots(self, terms: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The slot of each term, -1 where it is not held (its key differs)."""
        out = np.full(len(terms), -1, np.int64)
        # the shard is that of Spark's pmod over the signed hash
        shard = self.at[np.mod(hashes.view(np.int64), self.shards)]
        left = np.flatnonzero(shard >= 0)
        for level in range(self.size.shape[1]):
            k = shard[left]
            left, k = left[self.size[k, level] > 0], k[self.size[k, level] > 0]
            place = self.base[k, level] + _place(hashes[left], level, self.size[k, level])
            hit = self.bits[place]
            out[left[hit]] = self.slot[place[hit]]
            left = left[~hit]
        found = np.flatnonzero(out >= 0)
        same = pc.equal(terms.take(pa.array(found)), self.terms.take(pa.array(out[found]))).to_numpy(zero_copy_only=False).astype(bool)
        out[found[~same]] = -1
        if self.listed:
            for i in np.flatnonzero(out < 0):
                out[i] = self.listed.get(terms[int(i)].as_py(), -1)
        return out


# ---------------------------------------------------------------------------- second pass

_OPEN: dict = {}


class _Round:
    """A broadcast and a name to know it by in a worker."""

    def __init__(self, data):
        self.data, self.id = data, uuid.uuid4().hex


def _indexes(packed) -> dict[str, TermIndex]:
    """The round's indexes, unpacked once in a worker (the last round's are let go)."""
    if packed.id not in _OPEN:
        _OPEN.clear()
        by_lang: dict[str, list] = {}
        for r in pa.ipc.open_stream(io.BytesIO(packed.data.value)).read_all().to_pylist():
            by_lang.setdefault(r["lang"], []).append(r)
        _OPEN[packed.id] = {lang: TermIndex(rows) for lang, rows in by_lang.items()}
    return _OPEN[packed.id]


def _counter(packed, dense_bytes: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _indexes(packed)
        dense: dict[tuple, np.ndarray] = {}
        held = 0
        for part in slices(batches, "text", TEXT_BYTES):
            owner, flat = terms_of(part.column("text"))
            if not len(flat):
                continue
            coded = flat.dictionary_encode()
            ids, terms = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            hashes = term_hashes(terms)
            lang, langs = _codes(part.column("lang"))
            source, sources = _codes(part.column("source"))
            group = lang * len(sources) + source
            order = np.argsort(group[owner], kind="stable")
            groups, begin = np.unique(group[owner][order], return_index=True)
            looked: dict[str, np.ndarray] = {}
            for g, lo, hi in zip(groups, begin, np.append(begin[1:], len(order))):
                name = langs[g // len(sources)]
                if name not in index:
                    continue
                if name not in looked:
                    mine = np.unique(ids[lang[owner] == g // len(sources)])
                    looked[name] = np.full(len(terms), -1, np.int64)
                    looked[name][mine] = index[name].slots(terms.take(pa.array(mine)), hashes[mine])
                key = (name, sources[g % len(sources)])
                if key not in dense:
                    if held + 8 * len(index[name]) > dense_bytes and dense:
                        yield from _nonzero(dense, index)
                        dense, held = {}, 0
                    dense[key] = np.zeros(len(index[name]), np.int64)
                    held += 8 * len(index[name])
                slot = looked[name][ids[order[lo:hi]]]
                used, times = np.unique(slot[slot >= 0], return_counts=True)
                dense[key][used] += times
        yield from _nonzero(dense, index)
    return count


def _nonzero(dense: dict, index: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), counts in dense.items():
        at = np.flatnonzero(counts)
        shard = np.searchsorted(index[lang].start, at, side="right") - 1
        if len(at):
            yield pa.record_batch({"lang": pa.array([lang] * len(at), pa.string()), "source": pa.array([source] * len(at), pa.string()),
                                   "shard": pa.array(index[lang].numbers[shard], pa.int64()),
                                   "slot": pa.array(at - index[lang].start[shard], pa.int64()), "n": pa.array(counts[at], pa.int64())})


def _rounds(shards: DataFrame, limit: int) -> list[list[tuple]]:
    """Shards (lang, shard) dealt to rounds of at most ``limit`` bytes (one number per shard is collected)."""
    size = F.octet_length("bits") + F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 16)
    rounds, used = [], limit + 1
    for r in shards.select("lang", "shard", size.alias("bytes")).orderBy("lang", "shard").collect():
        if used + r["bytes"] > limit:
            rounds.append([])
            used = 0
        rounds[-1].append((r["lang"], r["shard"]))
        used += r["bytes"]
    return rounds


def term_counts(docs: DataFrame, shards: DataFrame, round_bytes: int = ROUND_BYTES, dense_bytes: int = DENSE_BYTES) -> DataFrame:
    """(lang, source, shard, slot, n): occurrences of the kept terms, one pass
    over the texts for each round of shards.  The driver holds one round's shards at a time."""
    spark = docs.sparkSession
    parts = []
    for members in _rounds(shards, round_bytes):
        first, last = members[0], members[-1]
        at = F.struct("lang", "shard")
        edge = lambda m: F.struct(F.lit(m[0]).alias("lang"), F.lit(m[1]).cast("long").alias("shard"))
        held = shards.where((at >= edge(first)) & (at <= edge(last))).toArrow()
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, held.schema) as out:
            out.write_table(held)
        data = spark.sparkContext.broadcast(sink.getvalue())
        found = docs.mapInArrow(_counter(_Round(data), dense_bytes), "lang string, source string, shard long, slot long, n long")
        parts.append(checkpoint(found.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")), "term-counts"))
        data.unpersist()
    if not parts:
        return spark.createDataFrame([], "lang string, source string, shard long, slot long, n long")
    return reduce(DataFrame.unionAll, parts)


# ---------------------------------------------------------------------------- divergence

def scaled(count: np.ndarray, total: np.ndarray, smooth: int = SMOOTH) -> np.ndarray:
    """1 + floor(10^9 * (count + smooth) / total), exact: the division goes in
    three steps of 1,000, so 64 bits hold totals up to 9 * 10^15."""
    rest, out = count + smooth, np.zeros(np.broadcast(count, total).shape, np.int64)
    for _ in range(3):
        out = out * 1000 + rest * 1000 // total
        rest = rest * 1000 % total
    return out + 1


def _compare(smooth: int, top: int):
    def compare(key: tuple[pa.Scalar, ...], cells: pa.Table, shard: pa.Table) -> pa.Table:
        """Pair sums and best terms of one shard over all sources of its language."""
        lang = key[0].as_py()
        terms = np.array(shard.column("terms")[0].as_py(), object)
        sources = cells.column("source").to_pylist()
        count = np.zeros((len(sources), len(terms)), np.int64)
        for k, cell in enumerate(cells.column("cells").to_pylist()):
            if cell:
                count[k, [c["slot"] for c in cell]] = [c["n"] for c in cell]
        sums = cells.column("total").to_numpy()
        v = cells.column("v").to_numpy()
        p = scaled(count, (sums + smooth * v)[:, None], smooth)
        q = scaled(count.sum(axis=0), np.int64(sums.sum() + smooth * v[0]), smooth)
        alphabetical = np.empty(len(terms), np.int64)
        alphabetical[sorted(range(len(terms)), key=lambda i: terms[i])] = np.arange(len(terms))
        source, part, item, value = [], [], [], []
        for k, name in enumerate(sources):
            far = np.abs(p - p[k]).sum(axis=1)
            others = [j for j in range(len(sources)) if j != k]
            over = np.flatnonzero((count[k] > 0) & (p[k] > q))
            best = over[np.lexsort((alphabetical[over], -(p[k] - q)[over]))][:top]
            source += [name] * (len(others) + len(best))
            part += ["pair"] * len(others) + ["term"] * len(best)
            item += [sources[j] for j in others] + terms[best].tolist()
            value += far[others].tolist() + (p[k] - q)[best].tolist()
        return pa.table({"lang": pa.array([lang] * len(source), pa.string()), "source": pa.array(source, pa.string()),
                         "part": pa.array(part, pa.string()), "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})
    return compare


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, smooth: int = SMOOTH, top: int = TOP_TERMS,
                  shard_terms: int = SHARD_TERMS, round_bytes: int = ROUND_BYTES, dense_bytes: int = DENSE_BYTES) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank.

    Terms are maximal runs of ASCII letters (A-Z lower-cased) and characters
    beyond ASCII.  A language keeps the terms in at least ``min_docs`` of its
    rows; every row counts as a document, whatever its doc_id, which is not read.  Null text, lang and
    source are ''.  ``pair``: the sum over kept terms of the difference of
    scaled smoothed frequencies to each other source of the language (0
    without kept terms).  ``term``: the ``top`` kept terms that the group uses
    more than its language.  Ties go by the item's UTF-8 bytes.  A group
    without terms takes part with counts of 0; an empty table gives no rows;
    other columns are not read.  ``pair`` has a row for every two sources of a
    language, as its definition asks; the work per shard of terms is sources
    squared times ``shard_terms``.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = checkpoint(kept_terms(rows, min_docs), "kept-terms")
    shards = checkpoint(term_shards(kept, shard_terms), "term-shards")
    counts = checkpoint(term_counts(rows, shards, round_bytes, dense_bytes), "term-counts")
    groups = checkpoint(rows.select("lang", "source").distinct(), "groups")
    size = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = (groups.join(size, "lang", "left").join(total, ["lang", "source"], "left").na.fill(0, ["v", "total"]))
    cell = counts.groupBy("lang", "source", "shard").agg(F.collect_list(F.struct("slot", "n")).alias("cells"))  # a shard's slots at most
    grid = (known.where("v > 0").join(shards.select("lang", "shard"), "lang").join(cell, ["lang", "source", "shard"], "left"))
    keys = shards.select(F.col("lang").alias("l"), F.col("shard").alias("s"), "terms")
    found = grid.groupBy("lang", "shard").cogroup(keys.groupBy("l", "s")).applyInArrow(
        _compare(smooth, top), "lang string, source string, part string, item string, value long")
    found = checkpoint(found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")), "divergence")
    bare = known.where("v = 0").select("lang", "source")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item").asc())
    ranked = found.unionAll(none).withColumn("rank", F.row_number().over(order).cast("int"))
    out = checkpoint(ranked.where((F.col("part") == "pair") | (F.col("rank") <= top)), "audit")
    discard(kept, shards, counts, groups, found)
    return out
