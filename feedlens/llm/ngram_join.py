"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is its set of distinct word n-grams.  Tokens are in one global
order, estimated frequency first.  With a sets's size s and the least overlap
a = ceil(t s) that any partner needs, its prefix of s - a + l tokens shares at
least l tokens with the prefix of every partner of the same l; two documents
with different l still share the smaller one.  Every document takes the l that
is cheapest by the estimated frequencies of its prefix tokens: l more tokens to
index against the candidates, at most (sum of frequencies) / l, that it lets
through.  A pair is verified when it shares the smaller l of the two.

Per token, pairs are tested inside a task (size, position, and the distance of
folded parity bitmaps, all of them exact upper bounds on the overlap) and only
survivors leave it, to be tested once by the long bitmaps; token groups above ``BLOCK`` members are dealt out as
pairs of blocks.  Identical sets are one node.  Two rounds keep large groups of
near copies linear: first a node's nearest few survivors are verified, then
all survivors that the links found do not already connect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import fresh, gram_hashes, mix64, slices, word_hashes, word_lists
from feedlens.llm.components import components
from feedlens.session import checkpoint, discard

WORDS, PERCENT = 5, 80
SKETCH_BITS = 18
#: Least bits of a set's parity bitmap (about four a token, a power of two),
#: and of the folded one that travels with postings: of sets above WIDE tokens
#: BITMAP bits, of others FOLDED.
BITMAP, FOLDED, WIDE = 2048, 512, 1024
MOST_MATCHES = 8
#: Weights of the cost estimate: an indexed token, a comparison within a token
#: group, a verified candidate.
COST = (1.0, 0.02, 1.0)
NEAREST = 3
BLOCK = 1024
#: Most texts whose ids (20 MB) are broadcast to fetch their sets; more are fetched by a shuffle join.
FETCHED = 1_000_000
HOT_LANES = 16


def sets_of(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(size of each text's set, hashes of the sets one after the other, each ascending)."""
    texts = pc.ascii_lower(fresh(texts))
    offsets, flat = word_lists(texts)
    words = word_hashes(flat)
    count = np.diff(offsets)
    owner = np.repeat(np.arange(len(count)), count)
    grams = gram_hashes(words, n)
    owners = owner[:len(grams)]
    inside = owner[n - 1:] == owners if len(grams) else np.zeros(0, bool)
    hashed, owners = [grams[inside]], [owners[inside]]
    for k in range(1, n):  # texts of fewer words: the whole sequence
        short = np.flatnonzero(count == k)
        if len(short):
            h = np.zeros(len(short), np.uint64)
            for j in range(k):
                h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[offsets[short] + j] + np.uint64(j + 1000 * k))
            hashed.append(h)
            owners.append(short)
    h, o = np.concatenate(hashed), np.concatenate(owners)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[new], o[new]
    return np.bincount(o, minlength=len(count)), h


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    end = np.cumsum(size)
    return run[end] - run[end - size]


def signatures(size: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix64(_sums(mix64(h ^ np.uint64(0xA5A5A5A5)), size) + size.astype(np.uint64)).view(np.int64)


def bitmaps(size: np.ndarray, h: np.ndarray) -> Iterator[bytes]:
    """Parity bitmap per set: equal tokens cancel, so the distance of two
    bitmaps is at most the number of tokens that one set has and the other lacks."""
    end = np.cumsum(size)
    for start in range(0, len(size), 1024):
        part = size[start:start + 1024]
        low, high = end[start] - size[start], end[start + len(part) - 1]
        mixed = mix64(h[low:high] ^ np.uint64(0x5BD1E995))
        bit = (mixed & np.uint64(BITMAP - 1)).astype(np.int64)
        odd = np.bincount(np.repeat(np.arange(len(part)), part) * BITMAP + bit, minlength=len(part) * BITMAP) & 1
        upto = end[start:start + len(part)] - low
        for k, row in enumerate(np.packbits(odd.astype(np.uint8).reshape(len(part), BITMAP), axis=1)):
            if 4 * part[k] > BITMAP:
                width = 1 << int(4 * part[k] - 1).bit_length()
                own = (mixed[upto[k] - part[k]:upto[k]] & np.uint64(width - 1)).astype(np.int64)
                row = np.packbits((np.bincount(own, minlength=width) & 1).astype(np.uint8))
            yield row.tobytes()


def fold(bitmap: np.ndarray, bits: int) -> np.ndarray:
    """A parity bitmap (as 64-bit words) of fewer bits: its parts, each bit by parity."""
    return np.bitwise_xor.reduce(bitmap.reshape(-1, bits // 64))


def folded(bitmap: bytes, n: int) -> bytes:
    """The bitmap that a set of ``n`` tokens sends with its postings."""
    return fold(np.frombuffer(bitmap, np.uint64), BITMAP if n > WIDE else FOLDED).tobytes()


def _profile(n: int):
    """Rows of documents (doc_id, sig, n, bitmap, folded) and, at a task's end, of the
    frequency sketch (bucket, cnt)."""
    names = ["kind", "doc_id", "sig", "n", "bitmap", "folded", "bucket", "cnt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in slices(batches, "text"):
            size, h = sets_of(b.column("text"), n)
            sketch += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
            rows, long_maps = b.num_rows, list(bitmaps(size, h))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(rows, np.int32)), b.column("doc_id"), pa.array(signatures(size, h)), pa.array(size.astype(np.int32)),
                 pa.array(long_maps, pa.binary()), pa.array(map(folded, long_maps, size.tolist()), pa.binary()),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int64())], names)
        used = np.flatnonzero(sketch)
        rows = len(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(rows, np.int32)), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int32()),
             pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary()), pa.array(used.astype(np.int32)), pa.array(sketch[used])], names)
    return run


def excess(counts: np.ndarray) -> np.ndarray:
    """Estimated document frequency of a bucket's hottest token: what the
    bucket holds above the usual level, when that is beyond its noise; else 0."""
    usual = float(np.median(counts))
    over = counts - usual
    return np.where(over > 8 * np.sqrt(usual + 1), over, 0.0)


def _postings(n: int, percent: int, frequency):
    """Prefix tokens (lane, hot, token, sig, n, pos, ell) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(frequency.value, np.float32)
        for b in slices(batches, "text"):
            size, h = sets_of(b.column("text"), n)
            sig = signatures(size, h)
            owner = np.repeat(np.arange(len(size)), size)
            est = table[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            step = np.where(est > 0, np.ceil(2 * np.log2(est + 1)), 0).astype(np.int64)
            order = np.lexsort((mix64(h), step, owner))
            h, est = h[order], est[order]
            first = np.cumsum(size) - size
            base = size - -(-size * percent // 100) + 1  # prefix for one match
            run_est = np.concatenate([[0.0], np.cumsum(est, dtype=np.float64)])
            best, ell = None, np.ones(len(size), np.int64)
            for k in range(1, MOST_MATCHES + 1):
                length = np.minimum(base + k - 1, size)
                seen = run_est[first + length] - run_est[first]
                cost = COST[0] * length + COST[1] * seen + COST[2] * seen / k
                cost = np.where(base + k - 1 > size, np.inf, cost)
                better = np.zeros(len(size), bool) if best is None else cost < best
                ell[better] = k
                best = cost if best is None else np.minimum(best, cost)
            length = np.where(size > 0, np.minimum(base + ell - 1, size), 0)
            pos = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            at = np.repeat(first, length) + pos
            token, s = h[at], np.repeat(sig, length)
            hot = est[at] >= BLOCK
            lane = np.where(hot, mix64(token + (s.view(np.uint64) % np.uint64(HOT_LANES)) + np.uint64(1)), token)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lane.view(np.int64)), pa.array(hot), pa.array(token.view(np.int64)), pa.array(s),
                 pa.array(np.repeat(size, length).astype(np.int32)), pa.array(pos.astype(np.int32)),
                 pa.array(np.repeat(ell, length).astype(np.int32))], ["lane", "hot", "token", "sig", "n", "pos", "ell"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings sorted by (token, sig): without repeats, and without
    tokens of a single set unless they are dealt over lanes."""
    carry, before = None, None  # the last row, whose successor is not known yet, and the token ahead of it
    for b in batches:
        if carry is not None:
            b = pa.Table.from_batches([carry, b]).combine_chunks().to_batches()[0]
        token, sig = b.column("token").to_numpy(), b.column("sig").to_numpy()
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (sig[1:] != sig[:-1])
        b = b.filter(pa.array(new))
        token = b.column("token").to_numpy()
        keep = b.column("hot").to_numpy(zero_copy_only=False).copy()
        same = token[1:] == token[:-1]
        keep[1:] |= same
        keep[:-1] |= same
        if before is not None:
            keep[0] |= token[0] == before
        before = token[-2] if len(token) > 1 else before
        carry = b.slice(b.num_rows - 1)
        yield b.slice(0, b.num_rows - 1).filter(pa.array(keep[:-1])).drop_columns(["lane", "hot"])
    if carry is not None and (carry.column("hot")[0].as_py() or carry.column("token")[0].as_py() == before):
        yield carry.drop_columns(["lane", "hot"])


def _survivors(percent: int, nearest: int | None):
    """Pairs (a, b, need) of each token group that no upper bound rules out.

    Rows come sorted by (token, low, high); a group has at most about two
    blocks.  With ``nearest`` only the closest few of each member.
    """
    def admitted(g: dict, i, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the pairs (i, j) may reach the threshold, their bitmap distances)."""
        s, t = g["n"][i], g["n"][j]
        least = -(-percent * (s + t) // (100 + percent))  # overlap that a pair needs
        bound = np.minimum(g["pos"][i], g["pos"][j]) + np.minimum(s - g["pos"][i], t - g["pos"][j])
        rows = np.flatnonzero((g["label"][i] != g["label"][j]) & (bound >= least)
                              & (100 * np.minimum(s, t) >= percent * np.maximum(s, t)))
        i = np.broadcast_to(i, len(j))[rows]
        far = np.bitwise_count(g["bitmap"][j[rows]] ^ g["bitmap"][i]).sum(axis=1, dtype=np.int64)
        x, y = g["wide_at"][i], g["wide_at"][j[rows]]
        both = np.flatnonzero((x >= 0) & (y >= 0))
        far[both] = np.bitwise_count(g["wide"][x[both]] ^ g["wide"][y[both]]).sum(axis=1, dtype=np.int64)
        ok = ((s + t)[rows] - far) // 2 >= least[rows]
        return rows[ok], far[ok]

    def pairs(g: dict) -> Iterator[tuple]:
        for i in range(len(g["sig"])):
            one_block = g["low"][i] == g["high"][i]
            if not one_block and g["block"][i] != g["low"][i]:
                continue
            j = np.arange(i + 1, len(g["sig"])) if one_block else np.flatnonzero(g["block"] != g["block"][i])
            rows, far = admitted(g, i, j)
            if len(rows):
                yield i, j[rows], far

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            g = {c: t.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "n", "pos", "ell", "label", "low", "high", "block")}
            g["n"], g["pos"] = g["n"].astype(np.int64), g["pos"].astype(np.int64)
            maps = t.column("folded")
            far_reaching = pc.binary_length(maps).to_numpy() * 8 == BITMAP
            wide, narrow = (np.frombuffer(b"".join(maps.filter(pa.array(rows)).to_pylist()), np.uint64).reshape(-1, bits // 64)
                            for rows, bits in ((far_reaching, BITMAP), (~far_reaching, FOLDED)))
            g["bitmap"] = np.empty((len(g["sig"]), FOLDED // 64), np.uint64)
            g["bitmap"][~far_reaching] = narrow
            g["bitmap"][far_reaching] = np.bitwise_xor.reduce(wide.reshape(len(wide), -1, FOLDED // 64), axis=1) if len(wide) else 0
            g["wide_at"] = np.where(far_reaching, np.cumsum(far_reaching) - 1, -1)
            start = np.flatnonzero(np.concatenate([[True], np.diff(t.column("group").to_numpy()) != 0]))
            end = np.append(start[1:], len(g["sig"]))
            out = []
            i = start[end - start == 2]  # most groups: all at once
            every = {**g, "wide": wide}
            j = i + 1
            here = (g["low"][i] == g["high"][i]) | (g["block"][i] != g["block"][j])
            i, j = i[here], j[here]
            rows, _ = admitted(every, i, j)
            i, j = i[rows], j[rows]
            if len(i):
                out.append((np.minimum(g["sig"][i], g["sig"][j]), np.maximum(g["sig"][i], g["sig"][j]),
                            np.minimum(g["ell"][i], g["ell"][j])))
            for a, b in zip(start[end - start > 2], end[end - start > 2]):
                one = {**{k: v[a:b] for k, v in g.items()}, "wide": wide}
                found = [(np.full(len(j), i), j, far) for i, j, far in pairs(one)]
                if not found:
                    continue
                i, j, far = (np.concatenate(x) for x in zip(*found))
                if nearest is not None:
                    ends, peer, d = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([far, far])
                    order = np.lexsort((one["sig"][peer], d, ends))
                    ends, row = ends[order], np.concatenate([np.arange(len(i))] * 2)[order]
                    first = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
                    rank = np.arange(len(ends)) - np.repeat(first, np.diff(np.append(first, len(ends))))
                    some = np.unique(row[rank < nearest])
                    i, j = i[some], j[some]
                out.append((np.minimum(one["sig"][i], one["sig"][j]), np.maximum(one["sig"][i], one["sig"][j]),
                            np.minimum(one["ell"][i], one["ell"][j])))
            if out:
                a, b, need = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(need)], ["a", "b", "need"])
    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Cut a sorted stream so that no group (token, low, high) is torn apart;
    adds the column ``group``."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            part = b.slice(at, 4096)
            key = [part.column(c).to_numpy() for c in ("token", "low", "high")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            last = [held[-1].column(c)[-1].as_py() for c in ("token", "low", "high")] if held else None
            if last is not None and last != [k[0] for k in key]:
                yield _numbered(held)
                held = []
            if len(change):
                yield _numbered([*held, part.slice(0, int(change[-1]))])
                held = [part.slice(int(change[-1]))]
            else:
                held.append(part)
    if held:
        yield _numbered(held)


def _numbered(parts: list[pa.RecordBatch]) -> pa.Table:
    t = pa.Table.from_batches(parts).combine_chunks()
    key = [t.column(c).to_numpy() for c in ("token", "low", "high")]
    group = np.concatenate([[0], np.cumsum(np.any([k[1:] != k[:-1] for k in key], axis=0))])
    return t.append_column("group", pa.array(group))


def _near(percent: int):
    """Of pairs with both sizes and long bitmaps those that may reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = b.column("s").to_numpy().astype(np.int64) + b.column("t").to_numpy()
            far = np.empty(b.num_rows, np.int64)
            for k, (x, y) in enumerate(zip(b.column("x"), b.column("y"))):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                bits = 64 * min(len(x), len(y))
                far[k] = np.bitwise_count(fold(x, bits) ^ fold(y, bits)).sum(dtype=np.int64)
            yield b.filter(pa.array((both - far) // 2 >= -(-percent * both // (100 + percent)))).select(["a", "b"])
    return run


def _sets(n: int):
    """(sig, tokens) of the texts whose set is the one that was asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            size, h = sets_of(b.column("text"), n)
            sig, end = signatures(size, h), np.cumsum(size)
            asked = b.column("sig").to_numpy()
            rows = np.flatnonzero(sig == asked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig[rows]), pa.array([h[end[k] - size[k]:end[k]].tobytes() for k in rows], pa.binary())], ["sig", "tokens"])
    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for k, (x, y) in enumerate(zip(b.column("x"), b.column("y"))):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok[k] = 100 * both >= percent * (len(x) + len(y) - both)
            yield b.filter(pa.array(ok)).select(["a", "b"])
    return run


def similar_links(docs: DataFrame, nodes: DataFrame, shared: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges (u, v) between nodes whose components are those of all links."""
    many = shared.groupBy("token").count().where(F.col("count") > BLOCK)
    wide = (shared.join(many, "token", "left").withColumn("blocks", F.ceil(F.coalesce("count", F.lit(1)) / BLOCK).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("token", "sig", "n", "pos", "ell", "block", F.least("block", "other").alias("low"),
                    F.greatest("block", "other").alias("high")))
    links, labels = None, None
    for nearest in (NEAREST, None):
        if labels is None:
            rows = wide.join(nodes.select("sig", "folded"), "sig").withColumn("label", F.col("sig"))
        else:
            of = nodes.select("sig", "folded").join(labels, nodes["sig"] == labels["node"], "left").select(
                "sig", "folded", F.coalesce("component", "sig").alias("label"))
            mixed = shared.join(of.select("sig", "label"), "sig").groupBy("token").agg(
                F.min("label").alias("m"), F.max("label").alias("x")).where("m <> x").select("token")
            rows = wide.join(mixed, "token", "left_semi").join(of, "sig")
        found = (rows.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")
                 .mapInArrow(_survivors(percent, nearest), "a long, b long, need int"))
        met = found.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("need").alias("need")).where("shared >= need")
        maps = [nodes.select(F.col("sig").alias(k), F.col("n").alias(size), F.col("bitmap").alias(m)) for k, size, m in ("asx", "bty")]
        pairs = checkpoint(met.select("a", "b").join(maps[0], "a").join(maps[1], "b").mapInArrow(_near(percent), "a long, b long"), "pairs")
        needed = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
        asked = checkpoint(nodes.join(needed, "sig", "left_semi").select("sig", F.col("rep").alias("doc_id")), "asked")
        by_id = F.broadcast(asked) if asked.count() <= FETCHED else asked
        sets = checkpoint(docs.select("doc_id", "text").join(by_id, "doc_id")
                          .mapInArrow(_sets(n), "sig long, tokens binary").dropDuplicates(["sig"]), "sets")
        x = sets.select(F.col("sig").alias("a"), F.col("tokens").alias("x"))
        y = sets.select(F.col("sig").alias("b"), F.col("tokens").alias("y"))
        good = checkpoint(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verified(percent), "a long, b long")
                          .select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
        discard(pairs, asked, sets)
        links = good if links is None else links.unionAll(good)
        labels = components(links)
    return labels


def similar_classes(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; the set
    holds the distinct ``n``-word shingles, of a text with fewer words the whole
    sequence as one.  Documents link when 100 * intersection >= percent * union;
    component_id is the smallest doc_id reachable by links.  Null, empty and
    blank texts have an empty set and stand alone, as do rows with a null
    doc_id (component_id null).  Repeated rows and equal texts share a set and a
    component.  An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = checkpoint(docs.mapInArrow(
        _profile(n), "kind int, doc_id long, sig long, n int, bitmap binary, folded binary, bucket int, cnt long"), "profile")
    rows = profile.where("kind = 0").select("doc_id", "sig", "n", "bitmap", "folded")
    counts = profile.where("kind = 1").groupBy("bucket").agg(F.sum("cnt").alias("cnt")).toArrow()  # 2^SKETCH_BITS rows at most
    sketch = np.zeros(1 << SKETCH_BITS)
    sketch[counts.column("bucket").to_numpy()] = counts.column("cnt").to_numpy()
    frequency = spark.sparkContext.broadcast(excess(sketch).astype(np.float32).tobytes())  # 1 MB

    named = rows.where("n > 0 AND doc_id IS NOT NULL")
    nodes = checkpoint(named.groupBy("sig", "n", "bitmap", "folded").agg(F.min("doc_id").alias("rep")), "nodes")
    shared = checkpoint(docs.where("doc_id IS NOT NULL").mapInArrow(
        _postings(n, percent, frequency), "lane long, hot boolean, token long, sig long, n int, pos int, ell int")
        .repartition("lane").sortWithinPartitions("token", "sig")
        .mapInArrow(_shared, "token long, sig long, n int, pos int, ell int"), "shared")
    labels = checkpoint(similar_links(docs, nodes, shared, n, percent), "labels")
    discard(shared)
    label = nodes.join(labels, nodes["sig"] == labels["node"], "left").select("sig", "rep", F.coalesce("component", "sig").alias("label"))
    smallest = label.groupBy("label").agg(F.min("rep").alias("component_id"))
    named_class = label.join(smallest, "label").select(F.col("sig").alias("node_sig"), "component_id")
    of = rows.withColumn("key", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("sig")))
    return of.join(named_class, of["key"] == named_class["node_sig"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each class, the smallest doc_id; columns
    unchanged.  All rows of that doc_id stay, and rows with a null doc_id."""
    gone = similar_classes(docs, n, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
