"""Cheapest repair of a conversation's turns, ties settled by prefix-doubling path ranking.

A repair keeps, re-roles, deletes or inserts rows so that the role initials
read ``(s?(ua)+)?``.  That language has four states, so a stretch of rows is a
4 x 4 table of least costs.  Rows in order are cut into blocks of 2 ** BLOCK_BITS;
a block's task takes the cost DP over its own rows, stretches that reach
a block's edge hand on their table, and the tables of one conversation are folded
into the costs that remain after each stretch.  With these every block knows its
optimal arcs and ranks them by the audits of 1, 2, 4, ... letters; the pointers
doubled on the way give the least path from each of the four states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.session import checkpoint, discard

#: Rows (2 ** BLOCK_BITS) that one task solves at once.
BLOCK_BITS = 16
DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5
WHITE_OR_NOTHING = r"^[\x20\x09-\x0D]*\z"
UNFINISHED = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"

# States by the initials so far: nothing, s, ...u, ...a.  NEXT: the state after
# a user or assistant row, whichever comes there.  END: inserts that are missing.
NEXT = np.array([2, 2, 3, 2])
END = np.array([0, 2, 1, 0])
ROLE = ("user", "user", "assistant", "user")
S, U, A, OTHER = range(4)
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)  # by rank of the letter; 0: past the end
FAR = np.int64(1) << 50


# ---------------------------------------------------------------------------- rows

def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies after the damage that CRC-32 of
    ``conv_id:turn`` deals (null: one space)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    return rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"))


def _hashed(rows: DataFrame) -> DataFrame:
    """With 128 bits that stand for the text, and order rows of one turn and role."""
    return rows.withColumn("h1", F.xxhash64(F.lit(1), "text")).withColumn("h2", F.xxhash64(F.lit(2), "text"))


ORDER = ["turn", "role", "h1", "h2"]


def items(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal rows of one turn as one item: conv_id, ORDER, copies, blank, cut,
    and ``fresh`` (no such role and text in an earlier turn); and the table it reads."""
    one = _hashed(rows).groupBy("conv_id", *ORDER).agg(
        F.sum("copies").alias("copies"), F.max(F.col("text").rlike(WHITE_OR_NOTHING)).alias("blank"),
        F.max(F.col("text").rlike(UNFINISHED)).alias("cut"))
    one = checkpoint(one, "conversation-items")
    at = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    first = one.groupBy("conv_id", "role", "h1", "h2").agg(F.min(at).alias("first")).alias("f")
    x = one.alias("x")
    same = F.col("x.conv_id").eqNullSafe(F.col("f.conv_id"))
    for c in ("role", "h1", "h2"):
        same &= F.col(f"x.{c}") == F.col(f"f.{c}")
    return x.join(first, same).select("x.*", (at == F.col("f.first")).alias("fresh")), one


def in_order(found: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """conv_id, rid (global order), block, initial, fault (0 none, 1 blank or
    duplicate, 2 truncated), extra (further equal copies, duplicates all)."""
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    fault = F.when(F.col("blank") | ~F.col("fresh"), 1).when(F.col("cut"), 2).otherwise(0)
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = found.repartitionByRange(n, "conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    numbered = ranged.select("conv_id", F.monotonically_increasing_id().alias("rid"), code.alias("initial"), fault.alias("fault"),
                             (F.col("copies") - 1).alias("extra"))
    return checkpoint(numbered.withColumn("block", F.shiftright("rid", bits)), "conversation-order")


# ---------------------------------------------------------------------------- cost DP of a block

class Stretches:
    """The rows of one block in order, cut at changes of conversation."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("rid")
        get = lambda c: table.column(c).to_numpy().astype(np.int64)
        self.initial, self.fault, self.extra, self.rid = get("initial"), get("fault"), get("extra"), get("rid")
        conv = table.column("conv_id").combine_chunks()
        code = conv.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        n = len(code)
        self.start = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if n else np.zeros(0, np.int64)
        self.size = np.diff(np.append(self.start, n))
        self.conv = conv.take(pa.array(self.start))
        self.owner = np.repeat(np.arange(len(self.start)), self.size)
        self.edge = np.zeros(len(self.start), bool)
        self.edge[[0, -1]] = True
        # arcs of each row from each state: where a kept row leads, -1 if it may not stay
        keep = np.full((4, 4), -1)
        keep[S, 0], keep[U, [0, 1, 3]], keep[A, 2] = 1, 2, 3
        self.keep = np.where((self.fault == 1)[:, None], -1, keep[self.initial])
        self.cut = np.where(self.fault == 2, CUT, 0)
        legal = np.zeros((4, 4), bool)
        legal[[S, U, A], [U, A, U]] = True
        inside = np.zeros(n, np.int64)
        if n > 1:
            inside[1:] = (self.owner[1:] == self.owner[:-1]) & ~legal[self.initial[:-1], self.initial[1:]]
        self.illegal = np.bincount(self.owner, weights=inside + self.extra, minlength=len(self.start)).astype(np.int64)

    def costs(self, after: np.ndarray) -> np.ndarray:
        """Least cost to go before every row: [row, state, ...], given that after each
        stretch [stretch, state, ...].  All stretches step back together."""
        out = np.empty((len(self.initial), *after.shape[1:]), np.int64)
        order = np.argsort(-self.size, kind="stable")
        live = np.searchsorted(-self.size[order], -np.arange(self.size.max(initial=0)), side="left")
        last = self.start + self.size - 1
        wide = (slice(None),) + (None,) * (after.ndim - 2)
        for step, count in enumerate(live):
            s = order[:count]
            row = last[s] - step
            ahead = after[s] if step == 0 else out[row + 1]
            own = np.empty_like(ahead)
            must = (self.fault[row] == 1)[wide]
            for q in range(4):
                best = ahead[:, q] + DELETE
                rerole = ahead[:, NEXT[q]] + (REROLE + self.cut[row])[wide]
                best = np.where(must, best, np.minimum(best, rerole))
                to = self.keep[row, q]
                stay = ahead[np.arange(len(row)), np.maximum(to, 0)] + self.cut[row][wide]
                own[:, q] = np.where((to >= 0)[wide], np.minimum(best, stay), best)
            own += (DELETE * self.extra[row]).reshape((-1,) + (1,) * (after.ndim - 1))
            two = np.minimum(own[:, 2], own[:, 3] + INSERT)
            own[:, 3] = np.minimum(own[:, 3], own[:, 2] + INSERT)
            own[:, 2] = two
            own[:, 0] = np.minimum(own[:, 0], two + INSERT)
            own[:, 1] = np.minimum(own[:, 1], two + INSERT)
            out[row] = np.minimum(own, FAR)
        return out

    # ------------------------------------------------------------------------ ranking

    def arcs(self, cost: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
        """(tail, letter, head) of the optimal arcs.  Node 4 * position + state; each
        stretch has one position more than rows, where it ends."""
        shift = self.owner  # stretches before a row, each with its end position
        at = (np.arange(len(self.initial)) + shift) * 4
        end = (self.start + self.size + np.arange(len(self.start))) * 4
        lastrow = np.append(self.owner[1:] != self.owner[:-1], True) if len(self.owner) else np.zeros(0, bool)
        ahead = np.empty_like(cost)
        ahead[:-1] = cost[1:]
        ahead[lastrow] = after
        self.entry, self.end, self.positions = at[self.start], end, len(self.initial) + len(self.start)
        fixed = DELETE * self.extra
        free = self.fault != 1
        found = []
        for q in range(4):
            to = self.keep[:, q]
            ways = ((1, ahead[:, q] + DELETE + fixed, np.ones(len(at), bool), at + 4 + q),
                    (2, cost[:, NEXT[q]] + INSERT, np.ones(len(at), bool), at + NEXT[q]),
                    (3, ahead[np.arange(len(at)), np.maximum(to, 0)] + self.cut + fixed, to >= 0, at + 4 + to),
                    (4, ahead[:, NEXT[q]] + REROLE + self.cut + fixed, free, at + 4 + NEXT[q]))
            for letter, price, allowed, head in ways:
                row = np.flatnonzero(allowed & (price == cost[:, q]))
                found.append(np.stack([at[row] + q, np.full(len(row), letter), head[row], row]))
        return tuple(np.concatenate(found, axis=1)) if found else tuple(np.zeros((4, 0), np.int64))

    def audits(self, cost: np.ndarray, after: np.ndarray, stretch: np.ndarray, state: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """For each (stretch, state to enter it by): the ASCII-least audit of the
        cheapest edits up to the stretch's end, and the state there."""
        tail, letter, head, row = self.arcs(cost, after)
        none = len(tail)  # the arc past the end
        letter, head = np.append(letter, 0), np.append(head, -1)
        rank = letter.copy()

        def least(rank: np.ndarray) -> np.ndarray:
            order = np.lexsort((rank[:none], tail))
            first = np.append(True, tail[order][1:] != tail[order][:-1]) if none else np.zeros(0, bool)
            best = np.full(4 * self.positions + 1, none)
            best[tail[order][first]] = order[first]
            return best

        # a node's arcs have different letters, so audits of one letter name the successor
        pointer = least(rank)[head]
        pointer[none] = none
        length = (letter > 0).astype(np.int64)
        doubled, size = [pointer], 1
        while (pointer != none).any():
            size *= 2
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
            length = length + length[pointer]
            pointer = pointer[pointer]
            doubled.append(pointer)
        begin = least(rank)[self.entry[stretch] + state]
        text: list[bytes] = [b""] * len(begin)
        final = self.entry[stretch] + state
        steps = np.ceil(np.log2(np.maximum(length[begin], 1))).astype(np.int64)
        for depth in np.unique(steps):
            mine = np.flatnonzero(steps == depth)
            path = begin[mine][:, None]
            for k in range(depth - 1, -1, -1):  # between any two arcs of the path, 2 ** (k + 1) apart, the one midway
                path = np.stack([path, doubled[k][path]], axis=2).reshape(len(mine), -1)
            for i, p in zip(mine, path):
                p = p[p != none]
                if not len(p):
                    continue
                more = np.where(letter[p] == 2, 0, self.extra[row[p]])  # copies go with their item
                out = np.full(len(p) + int(more.sum()), LETTERS[1], np.uint8)
                out[np.arange(len(p)) + np.cumsum(more) - more] = LETTERS[letter[p]]
                text[i], final[i] = out.tobytes(), head[p[-1]]
        return text, final % 4


_EDGE = ("conv_id {conv}, block long, rid long, first long, last long, inside long, costs array<long>")


def _edges(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The least costs through the stretches at a block's edges, state to state."""
    s = Stretches(table)
    unit = np.full((len(s.start), 4, 4), FAR)
    unit[:, np.arange(4), np.arange(4)] = 0
    through = s.costs(unit)[s.start]
    e = np.flatnonzero(s.edge)
    return pa.table({"conv_id": s.conv.take(pa.array(e)), "block": pa.array([key[0].as_py()] * len(e), pa.int64()), "rid": pa.array(s.rid[s.start[e]]),
                     "first": pa.array(s.initial[s.start[e]]), "last": pa.array(s.initial[(s.start + s.size - 1)[e]]), "inside": pa.array(s.illegal[e]),
                     "costs": pa.array([c.ravel().tolist() for c in through[e]], pa.list_(pa.int64()))})


def _costs_after(stretches: pd.DataFrame) -> pd.DataFrame:
    """For every stretch of one conversation the cost to go after it, per state, and the whole cost."""
    stretches = stretches.sort_values("rid")
    after, go = [], INSERT * END
    for c in reversed(stretches["costs"].tolist()):
        after.append(go.tolist())
        go = (np.asarray(c).reshape(4, 4) + go).min(axis=1)
    return pd.DataFrame({"block": stretches["block"], "rid": stretches["rid"], "after": after[::-1], "whole": int(go[0])})


def _solve(key: tuple[pa.Scalar, ...], table: pa.Table, known: pa.Table) -> pa.Table:
    """One row per stretch: audits and exits by the state to enter by (a whole
    conversation is entered with nothing), cost and counts."""
    s = Stretches(table)
    after = np.tile(INSERT * END, (len(s.start), 1))
    whole = np.zeros(len(s.start), np.int64)
    place = {r: k for k, r in enumerate(s.rid[s.start].tolist())}
    for r in known.to_pylist():
        after[place[r["rid"]]] = r["after"]
        whole[place[r["rid"]]] = r["whole"]
    cost = s.costs(after)
    whole = np.where(s.edge, whole, cost[s.start, 0] if len(s.start) else 0)
    stretch = np.concatenate([np.arange(len(s.start)), *[np.flatnonzero(s.edge)] * 3])
    state = np.repeat(np.arange(4), [len(s.start), *[int(s.edge.sum())] * 3])
    text, leave = s.audits(cost, after, stretch, state)
    audits, exits = [[] for _ in s.start], [[] for _ in s.start]
    for k, t, x in zip(stretch, text, leave):
        audits[k].append(t.decode())
        exits[k].append(int(x))
    for k in np.flatnonzero(~s.edge):
        audits[k][0] += "I" * END[exits[k][0]]
    return pa.table({"conv_id": s.conv, "rid": pa.array(s.rid[s.start]), "edge": pa.array(s.edge), "audits": pa.array(audits, pa.list_(pa.string())),
                     "exits": pa.array(exits, pa.list_(pa.int64())), "cost": pa.array(whole), "first": pa.array(s.initial[s.start]),
                     "last": pa.array(s.initial[s.start + s.size - 1]), "illegal": pa.array(s.illegal)})


def _chain(stretches: pd.DataFrame) -> pd.DataFrame:
    """One conversation's stretches in order: audits joined along the states they leave by."""
    stretches = stretches.sort_values("rid")
    state, text, illegal, before = 0, [], int(stretches["illegal"].sum()), None
    legal = {(S, U), (U, A), (A, U)}
    for audits, exits, first, last in zip(stretches["audits"], stretches["exits"], stretches["first"], stretches["last"]):
        text.append(audits[state])
        state = int(exits[state])
        illegal += before is not None and (before, first) not in legal
        before = last
    return pd.DataFrame({"conv_id": stretches["conv_id"].iloc[:1], "audit": ["".join(text) + "I" * int(END[state])],
                         "cost": [int(stretches["cost"].iloc[0])], "illegal": [illegal]})


def audits(ordered: DataFrame) -> DataFrame:
    """conv_id, audit, cost, illegal of every conversation with rows."""
    conv = ordered.schema["conv_id"].dataType.simpleString()
    edges = checkpoint(ordered.groupBy("block").applyInArrow(_edges, _EDGE.format(conv=conv)), "conversation-edges")
    known = edges.groupBy("conv_id").applyInPandas(_costs_after, "block long, rid long, after array<long>, whole long")
    solved = checkpoint(ordered.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _solve, f"conv_id {conv}, rid long, edge boolean, audits array<string>, exits array<long>, cost long, first long, last long, illegal long"),
        "conversation-stretches")
    joined = solved.where("edge").groupBy("conv_id").applyInPandas(_chain, f"conv_id {conv}, audit string, cost long, illegal long")
    whole = solved.where("NOT edge").select("conv_id", F.col("audits")[0].alias("audit"), "cost", "illegal")
    out = checkpoint(whole.unionAll(joined), "conversation-audits")
    discard(edges, solved)
    return out


# ---------------------------------------------------------------------------- repaired text

def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, its audit first: conv_id, audit, digest of the repaired
    rows.  One pass; of a conversation only its audit and the running digest are held."""
    audit, at, state, digest, any_row = None, 0, 0, None, False
    keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    def put(role: str, text: str) -> None:
        nonlocal any_row
        digest.update((("\n" if any_row else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        any_row = True

    def inserts() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            put(ROLE[state], "")
            state, at = int(NEXT[state]), at + 1

    def finish(conv) -> tuple:
        inserts()
        return conv, audit, digest.hexdigest()

    conv, started = None, False
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "copies")]
        for conv_id, found, role, text, copies in zip(*columns):
            if found is not None:
                if started:
                    out.append(finish(conv))
                conv, audit, at, state, digest, any_row, started = conv_id, found, 0, 0, hashlib.sha256(), False, True
                continue
            for _ in range(copies):
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    put(role, text)
                    state = keep[role[:1], state]
                elif edit == "R":
                    put(ROLE[state], text)
                    state = int(NEXT[state])
        if out:
            yield _digests(out, batch.schema.field("conv_id").type)
        kind = batch.schema.field("conv_id").type
    if started:
        yield _digests([finish(conv)], kind)


def _digests(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    conv, audit, sha = zip(*rows)
    return pa.record_batch({"conv_id": pa.array(conv, kind), "audit": pa.array(audit, pa.string()), "repaired_sha256": pa.array(sha, pa.string())})


def repair(conversations: DataFrame, damaged: bool = True, bits: int = BLOCK_BITS) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.

    ``conversations`` has conv_id, turn, role, text; ``damaged=False`` repairs
    the rows as they are.  Null role and text are one space; a null conv_id is
    a conversation of its own.  Rows go by turn, null first; rows of one turn
    by role and a hash of the text, equal ones next to each other.  A role
    whose initial is not s, u or a (an empty or null one too) can't be kept.  A
    conversation whose rows are all dropped has zeros, an empty audit and the
    digest of the empty string.  An empty table gives no rows; other columns
    are not read.

    A conversation's rows are solved in blocks, copies counted and not
    repeated; what meets in one task per conversation are a 4 x 4 table per
    block and, since a digest is sequential, its rows as a stream for
    ``repaired_sha256``, of which only the audit (a letter per row, which the result
    holds anyway) is kept.
    """
    rows = damage(conversations) if damaged else conversations.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(1).cast("long").alias("copies"))
    conv = conversations.schema["conv_id"].dataType.simpleString()
    found, stored = items(rows)
    ordered = in_order(found, bits)
    answers = audits(ordered)
    none = lambda kind: F.lit(None).cast(kind)
    texts = _hashed(rows)
    heads = answers.select("conv_id", F.lit(0).alias("part"), none(conversations.schema["turn"].dataType).alias("turn"), none("string").alias("role"),
                           none("long").alias("h1"), none("long").alias("h2"), none("string").alias("text"), none("long").alias("copies"), "audit")
    stream = heads.unionAll(texts.select("conv_id", F.lit(1).alias("part"), *ORDER, "text", "copies", none("string").alias("audit")))
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = stream.repartition(n, "conv_id").sortWithinPartitions("conv_id", "part", *ORDER)
    digests = stream.select("conv_id", "audit", "role", "text", "copies").mapInArrow(
        _repaired, f"conv_id {conv}, audit string, repaired_sha256 string")
    bad = F.col("copies") - F.when(F.col("fresh"), F.lit(1)).otherwise(F.lit(0))  # copies that come after the first
    plain = ~F.col("blank")
    counts = found.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(F.lit(0))).alias("blank"),
        F.sum(F.when(plain, bad).otherwise(F.lit(0))).alias("duplicate"),
        F.sum(F.when(plain & F.col("fresh") & F.col("cut"), F.lit(1)).otherwise(F.lit(0))).alias("truncated"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = [*numbers, "audit", "repaired_sha256"]
    parts = conversations.select("conv_id").distinct()
    for part in (counts, answers.select("conv_id", "cost", "illegal"), digests):
        parts = parts.unionByName(part, allowMissingColumns=True)
    merged = parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in names])
    out = checkpoint(merged.select("conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
                                   F.coalesce("audit", F.lit("")).alias("audit"),
                                   F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")), "conversations")
    discard(ordered, answers, stored)
    return out
