import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from feedlens.llm import byte_bpe, quality_crf
from tests.llm import brute
from tests.llm.conftest import SCHEMA, rows_of
from tests.llm.test_operators import _brute_marginals

tokenizers = pytest.importorskip("public_tokenizers")


def triples(rows):
    return [(r["doc_id"], r["text"], r["source"]) for r in rows]


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


def test_every_stage_of_a_run(spark, pairs, tmp_path, monkeypatch):
    """corpus_pipeline.run on odd rows: each stage's rows from the rows before it, by brute force."""
    import tiktoken

    table = [(*p, None)[:3] for p in pairs if (p[1] or "").count("\n") < 9]
    table += [(400 + k, "BUY!! NOW!! ## " * (5 + k), "a") for k in range(20)]
    labels = [(i, 0 if "!!" in (t or "") else 1, 0) for i, t, _ in table if i is not None]
    spark.createDataFrame(rows_of(table), SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    written, write = [], corpus_pipeline.checkpoint
    monkeypatch.setattr(corpus_pipeline, "checkpoint", lambda df, label: written.append(write(df, label)) or written[-1])
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert last is written[-1] and len(written) == len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert all(df.schema.names == docs.columns for df in written[:4])
    good, deduped, single, mixed, coded = (df.collect() for df in written)

    model = quality_crf.train(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
    kept = []
    for row in table:
        _, x, size = quality_crf.line_features(pa.array([row[1]], pa.string()))
        p, _ = _brute_marginals(x.astype(float) @ model.weights, model.transitions)
        if np.average(p, weights=size + 1) >= quality_crf.THRESHOLD:
            kept.append(row)
    assert 0 < len(kept) < len(table) and same(triples(good), kept)

    lines = [(e[0], e[4], p[2]) for p, e in zip(kept, brute.line_dedup(kept))]
    assert same([(i, t or "", s) for i, t, s in triples(deduped)], lines)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in deduped)

    before = triples(deduped)
    one = [p for p, (i, _, c) in zip(before, brute.classes(before, 5, 80)) if i is None or i == c]
    assert len(one) < len(before) and same(triples(single), one)

    sizes, longest, taken = Counter(), Counter(), Counter()
    for _, t, s in one:
        sizes[s] += len(brute.words(t))
        longest[s] = max(longest[s], len(brute.words(t)))
    target, rows, copies = brute.targets(sizes), Counter(one), Counter(triples(mixed))
    assert not set(copies) - set(rows)
    for (i, t, s), n in rows.items():
        whole = int(target[s] / sizes[s] + 1e-9)
        assert n * whole <= copies[i, t, s] <= n * (whole + 1)
        taken[s] += copies[i, t, s] * len(brute.words(t))
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in sizes)

    ranks = byte_bpe.read_ranks(byte_bpe.public_vocabulary(corpus_pipeline.VOCABULARY))
    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [(r["doc_id"], enc.encode_ordinary(r["text"] or ""), r["text"] or "") for r in mixed]
    assert last.columns == ["doc_id", "ids", "n_tokens", "decoded_sha256"]
    assert same(map(tuple, coded), [(i, x, len(x), hashlib.sha256(t.encode()).hexdigest()) for i, x, t in ids])
