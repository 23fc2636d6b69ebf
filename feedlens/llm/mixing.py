"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size gives every document of it the same number of
expected copies; the whole part is taken for certain, the fraction is an
inclusion probability.  The flight phase of the cube method moves the
probabilities of three documents at a time along the null space of two
constraints (their number, their words) until one of them is 0 or 1, which
keeps the source's expected documents and words exact.  It runs in blocks of
a source; the two documents or fewer that a block leaves fly on with those of
other blocks, level by level, so a source that holds a third of all rows is
many small tasks.  A source lands in the level where it has one block: what is
left is settled first without the word constraint, then by one draw, and the
words are corrected by exchanges.  What a flight leaves are the longest
documents, so each block also sends decided ones along, and a landing always
has about a block of documents (or the whole source) to exchange.  A document too
long for these is made up for by exchanges in all blocks of its source.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import WORD, text_of
from feedlens.session import checkpoint

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BLOCK = 4096
SEED = 20


def source_targets(units: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """One row per source: source, source_size, n_docs, target.

    Targets share the total of all sizes by weight; none is above ``most``
    times its source's size.  That is ``least(cap, level * weight)`` with the one
    level at which the targets sum up to the total: in the order of cap over
    weight, the level after k capped sources is what they leave over, per
    remaining weight, and the first level within its source's cap holds.
    """
    per = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = per.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                      (F.col("k") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "k")
    whole = Window.partitionBy()
    level = ranked.withColumns({
        "capped": F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "left": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "all": F.sum("source_size").over(whole),
    }).withColumn("level", (F.col("all") - F.col("capped")) / F.col("left"))
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    level = level.withColumn("level", F.first(fits, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return level.select("source", "source_size", "n_docs",
                        F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def fly(p: list[float], x: list[float], draws: np.ndarray) -> list[float]:
    """Flight phase over probabilities ``p`` with sizes ``x``; at most two
    entries of the result are neither 0 nor 1."""
    p = list(p)
    pool: list[int] = []
    upcoming = iter(range(len(p)))
    step = 0
    while True:
        while len(pool) < 3:
            k = next(upcoming, None)
            if k is None:
                return p
            if 0.0 < p[k] < 1.0:
                pool.append(k)
        a, b, c = pool
        u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1.0 - p[k]) / d if d > 0 else p[k] / -d for k, d in zip(pool, u) if d)
        down = min(p[k] / d if d > 0 else (1.0 - p[k]) / -d for k, d in zip(pool, u) if d)
        move = up if draws[step] * (up + down) < down else -down
        step += 1
        for k, d in zip(pool, u):
            q = p[k] + move * d
            p[k] = 0.0 if q < 1e-9 else 1.0 if q > 1.0 - 1e-9 else q
        pool = [k for k in pool if 0.0 < p[k] < 1.0]


def exchange(taken: np.ndarray, size: np.ndarray, goal: float, free: np.ndarray, alone: bool) -> np.ndarray:
    """``taken`` (0 or 1) after the best exchanges of a taken and a left document
    of ``free``, one at a time while that brings the words nearer to ``goal``;
    with ``alone`` a document may also come or go by itself."""
    taken = taken.copy()
    nobody = [-1] if alone else []
    while abs(over := float(size @ taken) - goal) > 0.5:
        ins, outs = (np.concatenate([np.flatnonzero(free & (taken == v)), nobody]).astype(int) for v in (1.0, 0.0))
        if not len(ins) or not len(outs):
            break
        get = np.where(outs < 0, 0.0, size[outs])
        order = np.argsort(get, kind="stable")
        outs, get = outs[order], get[order]
        give = np.where(ins < 0, 0.0, size[ins])
        at = np.searchsorted(get, give - over)  # the place of the best partner
        at = np.stack([np.clip(at - 1, 0, len(get) - 1), np.clip(at, 0, len(get) - 1)])
        off = np.abs(over - give + get[at])
        side, i = np.unravel_index(np.argmin(off), off.shape)
        if off[side, i] >= abs(over) - 1e-6:
            break
        for k, v in ((ins[i], 0.0), (outs[at[side, i]], 1.0)):
            if k >= 0:
                taken[k] = v
    return taken


def land(start: list[float], p: list[float], x: list[float], free: np.ndarray, draws: np.ndarray,
         whole: bool = True) -> list[float]:
    """Landing phase for the block whose probabilities were ``start`` before
    and ``p`` after the flight: the last two keep their sum, a last one is
    drawn, and then documents of ``free`` change places.

    The drawn ones stay as drawn and the others make up for them: at first by
    exchanges that keep the number of documents, then also by single ones.
    If the words stay off by over a hundredth of a mean document and the block
    is the ``whole`` source, the drawn ones may fall otherwise, and the nearest
    of all results counts; else it is left to all blocks (``make_up``).
    """
    p = list(p)
    drawn = [k for k, q in enumerate(p) if 0.0 < q < 1.0]
    step = 0
    while len(open_ := [k for k, q in enumerate(p) if 0.0 < q < 1.0]) > 1:
        a, b = open_[:2]
        up, down = min(1.0 - p[a], p[b]), min(p[a], 1.0 - p[b])
        move = up if draws[step] * (up + down) < down else -down
        step += 1
        for k, q in ((a, p[a] + move), (b, p[b] - move)):
            p[k] = 0.0 if q < 1e-9 else 1.0 if q > 1.0 - 1e-9 else q
    for k in open_:
        p[k] = float(draws[step] < p[k])
    taken, size = np.array(p), np.array(x)
    others = free.copy()
    others[drawn] = False
    if not others.any():
        return taken.tolist()
    goal = float(size @ np.array(start))
    near = max(0.5, float(size[free].mean()) / 100)
    as_drawn = tuple(taken[drawn])
    best = None
    for state in sorted(itertools.product((0.0, 1.0), repeat=len(drawn)), key=lambda s: sum(map(float.__ne__, s, as_drawn))):
        trial = taken.copy()
        trial[drawn] = state
        for alone in (False, True):
            trial = exchange(trial, size, goal, others, alone)
            off = abs(float(size @ trial) - goal)
            if best is None or off < best[0] - 1e-6:
                best = off, trial
            if off <= near:
                return trial.tolist()
        if not whole:
            return taken.tolist()
    return best[1].tolist()


def _carried(p: list[float], free: np.ndarray, n: int, rng) -> np.ndarray:
    """Marks the open documents and about ``n`` decided ones of ``free``, taken
    and left ones alike, that fly on."""
    q = np.array(p)
    marks = (q > 0.0) & (q < 1.0)
    left, took = (rng.permutation(np.flatnonzero(free & (q == v))) for v in (0.0, 1.0))
    k = min(len(left), max(n // 2, n - len(took)))
    marks[left[:k]] = True
    marks[took[:max(0, n - k)]] = True
    return marks


def _flight(seed: int, level: int, size: int, fan: int):
    def run(key, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["doc_id", "size"], na_position="first", kind="stable")
        rng = np.random.default_rng(zlib.crc32(repr((seed, level, *map(str, key))).encode()))
        draws = rng.random(len(block) + 3)
        start, x = block["p"].tolist(), block["size"].astype(float).tolist()
        free = block["flies"].to_numpy(bool)  # whole copies are certain
        p = fly(start, x, draws)
        blocks = int(block["blocks"].iloc[0])
        if blocks == 1:
            p = land(start, p, x, free, rng.random(4), whole=level == 0)
            return block.assign(p=p, flies=False)
        return block.assign(p=p, flies=_carried(p, free, max(0, size // min(blocks, fan) - 2), rng))
    return run


def _share(key, block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["doc_id", "size"], na_position="first", kind="stable")
    size, taken = block["size"].to_numpy(float), block["p"].to_numpy(float)
    over, room = float(block["over"].iloc[0]), float(block["room"].iloc[0])
    free = block["free"].to_numpy(bool)
    can = float(size[free & (taken == float(over > 0))].sum())
    if can:
        goal = float(size @ taken) - round(over * min(1.0, can / room))
        for alone in (False, True):
            taken = exchange(taken, size, goal, free, alone)
    return block.assign(p=taken).drop(columns=["over", "room", "free"])


def make_up(done: DataFrame) -> DataFrame:
    """``done`` with the words by which sources of several blocks are off
    made up for: every block exchanges documents for its share of them.  Longer
    documents than that are not touched."""
    words = F.col("size") * (F.col("whole") + F.col("p"))
    off = done.groupBy("source").agg((F.sum(words) - F.max("target")).alias("over"), F.avg("size").alias("mean"),
                                     F.max("home").alias("last"))
    off = checkpoint(off.where((F.col("last") > 0) & (F.abs("over") > F.greatest(F.lit(0.5), F.col("mean") / 100)))
                     .select(F.col("source").alias("t_source"), "over"), "mix-off")  # one row per source at most
    if off.isEmpty():
        return done
    same = F.col("source").eqNullSafe(F.col("t_source"))
    fraction = F.col("target") / F.col("source_size") - F.col("whole")
    rows = done.join(off, same).drop("t_source").withColumn("free", (fraction >= 1e-9) & (F.col("size") <= F.abs("over")))
    room = rows.where(F.col("free") & (F.col("p") == (F.col("over") > 0).cast("double"))).groupBy("source").agg(
        F.sum("size").alias("room")).withColumnRenamed("source", "t_source")
    moved = rows.join(room, same).drop("t_source").groupBy("source", "home").applyInPandas(_share, done.schema)
    return done.join(room, same, "left_anti").unionAll(checkpoint(moved, "mix-made-up"))


def copies(units: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """Units (row, doc_id, source, size) with source_size, target and copies.

    Blocks are dealt by a hash of (doc_id, size), never by physical partition,
    and the draws by source and block, so reruns agree.  A source's number of
    blocks follows from its own rows; ``flies`` marks the documents that still
    may change.
    """
    units = checkpoint(units, "mix-units")
    targets = checkpoint(source_targets(units, weights, most), "mix-targets")  # one row per source
    biggest = targets.agg(F.max("n_docs")).first()[0] or 0
    t = targets.withColumnRenamed("source", "t_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + F.lit(1e-9))
    flying = (units.join(t, units["source"].eqNullSafe(t["t_source"])).drop("t_source")
              .withColumn("whole", whole).withColumn("p", F.greatest(F.lit(0.0), ratio - whole))
              .withColumn("p", F.when(F.col("p") < 1e-9, 0.0).otherwise(F.col("p")))
              .withColumn("blocks", F.ceil(F.col("n_docs") / F.lit(block)))
              .withColumn("home", F.pmod(F.xxhash64("doc_id", "size"), "blocks")).withColumn("block", F.col("home"))
              .withColumn("flies", F.col("p") > 0)
              .select("row", "doc_id", "source", "size", "source_size", "target", "whole", "p", "home", "blocks", "block", "flies"))
    fan = max(2, block // 16)  # at most two are left of each block, and as many decided ones go along as fill the next
    done = None
    blocks, level = max(1, -(-biggest // block)), 0
    while True:
        flown = checkpoint(flying.groupBy("source", "block").applyInPandas(
            _flight(seed, level, block, fan), flying.schema), f"mix-flight-{level}")
        decided = flown.where("NOT flies")
        done = decided if done is None else done.unionAll(decided)
        if blocks == 1:
            break
        flying = (flown.where("flies").withColumn("block", F.expr(f"block div {fan}"))
                  .withColumn("blocks", F.expr(f"(blocks + {fan - 1}) div {fan}")))
        blocks, level = -(-blocks // fan), level + 1
    if level:
        done = make_up(done)
    return done.select("row", "doc_id", "source", "size", "source_size", "target",
                       (F.col("whole") + F.col("p")).cast("long").alias("copies"))


def units_of(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """(row, doc_id, source, size) per document; size is its number of words."""
    return docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"), "doc_id", "source",
                       F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"))


def mix_report(docs: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken.

    Null text has size 0 and takes 0 words.  A null source is a source of its
    own, last in order.  Repeated rows are mixed each for itself.  A source
    without words has target 0.  An empty table gives an empty result.
    """
    return copies(units_of(docs), weights, most).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; columns unchanged.
    ``docs`` has to be a table read from files: rows are matched by their place
    in it."""
    docs = docs.withColumn("__row", F.monotonically_increasing_id())
    n = copies(units_of(docs, F.col("__row")), weights, most).select(F.col("row").alias("__row"), F.col("copies").alias("__n"))
    return (docs.join(n.where("__n > 0"), "__row")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).drop("__row", "__n", "__copy"))
