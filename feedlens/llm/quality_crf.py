"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  A line's potential comes from its own features and
those of the lines before and after it, transitions tie neighbours.  Training
maximises the likelihood of the line labels (each line of a labelled document
has the document's label) on a bounded sample of labelled documents; scoring
takes forward-backward marginals of every line of every whole text, weighted
by line length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from feedlens.llm.common import fresh, mix64, slices, small_batches, text_of, word_hashes, word_lists

#: Bounds of the training sample: documents of each label (those with the
#: smallest hash of doc_id) and the longest text taken for training.
TRAIN_DOCS = 1500
TRAIN_CHARS = 200_000
FOLDS, HELD_OUT = 5, 0
#: Text bytes, with those of its lines, that are scored at once.
SLICE = 2 << 20
#: What a line counts in the cutting of slices, besides its own bytes.
LINE_BYTES = 64
THRESHOLD = 0.3

_SYMBOLS, _MARKS, _ENDS = b"#*$%&|<>@^~_+=\\{}[]", b"!?", b".!?\"')"
_OWN = 12


def _classes() -> np.ndarray:
    """Byte to (symbol, mark, upper, lower, digit, beyond ASCII, white) as 0/1 rows."""
    t = np.zeros((7, 256), np.uint8)
    t[0, list(_SYMBOLS)] = 1
    t[1, list(_MARKS)] = 1
    t[2, 65:91] = 1
    t[3, 97:123] = 1
    t[4, 48:58] = 1
    t[5, 128:] = 1
    t[6, [9, 10, 11, 12, 13, 32]] = 1
    return t


_CLASS = _classes()


def _repeats(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each owner 0..max: entries whose value the owner has already had."""
    order = np.lexsort((value, owner))
    o, v = owner[order], value[order]
    same = np.zeros(len(o), bool)
    same[1:] = (o[1:] == o[:-1]) & (v[1:] == v[:-1])
    return order[same]


def own_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lines per text, features of each line alone, UTF-8 bytes of each line, its text).

    A null or empty text is one empty line.  Work and memory follow the bytes
    and the lines of the array.
    """
    texts = fresh(texts)
    lists = pc.split_pattern(texts, "\n")
    count = np.diff(lists.offsets.to_numpy())
    lines = pa.concat_arrays([lists.flatten()]) if len(texts) else pa.array([], pa.large_string())
    n = len(lines)
    if not n:
        return count, np.zeros((0, _OWN), np.float32), np.zeros(0), np.zeros(0, np.int64)
    size = pc.binary_length(lines).to_numpy().astype(np.int64)
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)
    at = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + n + 1]
    sums = np.empty((7, n))
    run = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
    for k in range(7):
        np.cumsum(_CLASS[k][data], dtype=run.dtype, out=run[1:])
        sums[k] = run[at[1:]] - run[at[:-1]]
    symbol, mark, upper, lower, digit, wide, white = sums
    offsets, flat = word_lists(lines)
    words = np.diff(offsets)
    owner = np.repeat(np.arange(n), words)
    hashed = word_hashes(flat)
    again = np.bincount(owner[_repeats(owner, hashed)], minlength=n)
    doc = np.repeat(np.arange(len(count)), count)
    doc_again = np.bincount(doc[owner][_repeats(doc[owner], hashed)], minlength=len(count))
    doc_words = np.bincount(doc, weights=words, minlength=len(count))
    pairs = mix64(hashed[:-1] * np.uint64(31) + hashed[1:]) if len(hashed) else hashed
    inside = doc[owner][:-1] == doc[owner][1:] if len(hashed) else np.zeros(0, bool)
    pair_owner = doc[owner][:-1][inside] if len(hashed) else np.zeros(0, np.int64)
    pair_again = np.bincount(pair_owner[_repeats(pair_owner, pairs[inside])], minlength=len(count))
    line_hash = pd.util.hash_array(lines.to_numpy(zero_copy_only=False).astype(object), categorize=True)
    seen = np.zeros(n)
    seen[_repeats(doc, line_hash)] = 1.0
    solid = np.maximum(1.0, size - white)
    w = np.maximum(1.0, words)
    dw = np.maximum(1.0, doc_words)
    last = np.where(size > 0, data[np.maximum(at[1:] - 1, 0)] if len(data) else 0, 0)
    own = np.stack([
        symbol / solid, np.minimum(1.0, symbol / w), np.minimum(1.0, mark / w), upper / np.maximum(1.0, upper + lower),
        digit / solid, again / w, np.minimum(1.0, solid / w / 20.0), np.minimum(1.0, words / 40.0), seen,
        np.isin(last, list(_ENDS)).astype(float), (doc_again / dw)[doc], (pair_again / dw)[doc]], axis=1, dtype=np.float32, casting="same_kind")
    return count, own, size.astype(float), doc


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines per text, features of each line, its neighbours and a constant, UTF-8 bytes of each line)."""
    count, own, size, doc = own_features(texts)
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = (doc[1:] == doc[:-1])[:, None]
    before[1:] = np.where(same, own[:-1], 0.0)
    after[:-1] = np.where(same, own[1:], 0.0)
    return count, np.concatenate([own, before, after, np.ones((len(own), 1), np.float32)], axis=1), size


@dataclass(frozen=True)
class Model:
    """weights: of a line's features for the good label; transitions: [from, to]
    with 0 bad and 1 good."""

    weights: np.ndarray
    transitions: np.ndarray


BLANK = Model(np.zeros(3 * _OWN + 1), np.zeros((2, 2)))


def marginals(emit: np.ndarray, count: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all documents at once, line by line: (probability
    of good per line, expected transitions [2, 2] summed, log partition per
    document).  ``emit`` is the good label's potential per line."""
    start = np.concatenate([[0], np.cumsum(count)])[:-1]
    order = np.argsort(-count, kind="stable")
    start, count_s = start[order], count[order]
    steps = int(count_s[0]) if len(count_s) else 0
    live = np.searchsorted(-count_s, -np.arange(steps), side="left")  # documents longer than t
    u = np.stack([np.zeros_like(emit), emit], axis=1)
    fwd, bwd = np.empty_like(u), np.zeros_like(u)
    for t in range(steps):
        i = start[:live[t]] + t
        fwd[i] = u[i] if t == 0 else u[i] + np.logaddexp(fwd[i - 1][:, :1] + trans[0], fwd[i - 1][:, 1:] + trans[1])
    pairs = np.zeros((2, 2))
    full = np.zeros(len(count))
    ends = start + count_s - 1
    has = count_s > 0
    full[order[has]] = np.logaddexp(fwd[ends[has], 0], fwd[ends[has], 1])
    z = np.repeat(full, count)
    for t in range(steps - 2, -1, -1):
        i = start[:live[t + 1]] + t
        nxt = u[i + 1] + bwd[i + 1]
        bwd[i] = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
        joint = fwd[i][:, :, None] + trans + nxt[:, None, :] - z[i][:, None, None]
        pairs += np.exp(joint).sum(axis=0)
    return np.exp(fwd[:, 1] + bwd[:, 1] - z), pairs, full


def fit(count: np.ndarray, x: np.ndarray, label: np.ndarray, steps: int = 200, ridge: float = 1e-3) -> Model:
    """Maximum likelihood with a ridge by Adam; documents of each label weigh alike."""
    if not len(count) or len(set(label.tolist())) < 2:
        return BLANK
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    y = np.repeat(label, count).astype(float)
    inside = np.ones(len(y), bool)
    inside[np.cumsum(count) - 1] = False
    true_pairs = np.zeros((2, 2))
    true_pairs[1, 1], true_pairs[0, 0] = (inside & (y == 1)).sum(), (inside & (y == 0)).sum()
    scale = len(y)
    m = np.zeros(len(w) + 4)
    v = np.zeros(len(w) + 4)
    for step in range(1, steps + 1):
        p, pairs, _ = marginals(x @ w, count, trans)
        grad = np.concatenate([x.T @ (y - p) / scale - ridge * w, ((true_pairs - pairs) / scale - ridge * trans).ravel()])
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, trans = w + move[:-4], trans + move[-4:].reshape(2, 2)
    return Model(w, trans)


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    """Length-weighted mean of the lines' good probability (bytes plus one each)."""
    count, own, size, doc = own_features(texts)
    # the neighbours' part of a line's potential, without their features side by side
    mine, before, after = (own @ model.weights[k * _OWN:(k + 1) * _OWN] for k in range(3))
    same = doc[1:] == doc[:-1]
    emit = mine + model.weights[-1]
    emit[1:] += np.where(same, before[:-1], 0.0)
    emit[:-1] += np.where(same, after[1:], 0.0)
    p, _, _ = marginals(emit, count, model.transitions)
    return np.clip(np.bincount(doc, weights=p * (size + 1), minlength=len(count))
                   / np.bincount(doc, weights=size + 1, minlength=len(count)), 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, longest: int = TRAIN_CHARS) -> Model:
    """Fit on at most ``most`` documents of each label outside the held-out fold,
    of at most ``longest`` characters; the bound makes the driver's part
    (features of those lines) bounded too."""
    small_batches(docs.sparkSession)
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q1")).where("q = q1"))
    short = docs.select("doc_id", F.length(text_of()).alias("chars")).where(F.col("chars") <= longest).select("doc_id").distinct()
    ids = known.join(short, "doc_id").select("doc_id", "q", F.xxhash64("doc_id").alias("h"))
    chosen = [ids.where(F.col("q") == q).orderBy("h").limit(most) for q in (0, 1)]
    texts = docs.select("doc_id", text_of().alias("text")).where(F.length("text") <= longest)
    sample = texts.join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")  # at most 2 * most ids
    sample = sample.orderBy("h", F.xxhash64("text")).limit(2 * most)  # should ids repeat

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, x, _ = line_features(b.column("text"))
            ends = np.cumsum(count)
            rows = [x[e - c:e].tobytes() for c, e in zip(count, ends)]
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("h"), pa.array(rows, pa.binary())], ["q", "h", "x"])

    got = sample.select("q", "h", "text").mapInArrow(features, "q int, h long, x binary").toPandas()
    got = got.sort_values(["q", "h"], kind="stable")
    parts = [np.frombuffer(b, np.float32).reshape(-1, 3 * _OWN + 1) for b in got["x"]]
    if not parts:
        return BLANK
    return fit(np.array([len(x) for x in parts]), np.concatenate(parts).astype(float), got["q"].to_numpy())


def score_batch(texts: pa.Array, model: Model) -> np.ndarray:
    """Scores of the texts, slice by slice: memory follows a slice, or one longer text."""
    batch = pa.RecordBatch.from_arrays([texts], ["t"])
    out = [score_texts(b.column(0), model) for b in slices(iter([batch]), "t", SLICE, per_line=LINE_BYTES)]
    return np.concatenate(out) if out else np.zeros(0)


def score(text: Column, model: Model) -> Column:
    """Score column of a text column; higher is better."""
    @arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(score_batch(texts, model))
    return run(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Every whole text is scored; null and empty texts are one empty line and
    score like one.  Labels that are null, not 0 or 1, or contradict each other
    for a doc_id are left out of training; without labels of both kinds every
    score is 0.5.  Repeated rows score alike, a null doc_id is not held out, an
    empty table gives an empty result, other columns are not read.
    """
    model = train(docs, labels)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score")).select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score is below the threshold; columns unchanged."""
    return docs.where(score(F.col("text"), train(docs, labels)) >= threshold)
