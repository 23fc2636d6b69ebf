"""Every operator against a brute-force version on a table of odd rows, and on an empty one."""

import hashlib
import random
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedlens.llm import byte_bpe, exact_dedup, line_dedup, mixing, ngram_join, quality_crf, quality_rules, sharding
from feedlens.llm import substring_dedup, token_files
from tests.llm import brute
from tests.llm.conftest import CLASH, SCHEMA, rows_of

tokenizers = pytest.importorskip("public_tokenizers")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def want(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_sharding(odd, empty, pairs):
    rows = sorted(sharding.shard_documents(odd, 16).collect(), key=lambda r: r["start_byte"])
    assert want((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want(
        (p[0], len((p[1] or "").encode()) + 1, brute.crc(p[1])) for p in pairs)
    start, slots = 0, defaultdict(int)
    total = sum(r["size"] for r in rows)
    for r in rows:  # gapless bytes and slots, in doc_id order
        assert r["start_byte"] == start
        assert r["shard"] == min(15, (2 * start + r["size"]) * 16 // (2 * total))
        assert r["slot"] == slots[r["shard"]]
        slots[r["shard"]] += 1
        start += r["size"]
    ids = [-1 << 62 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids == sorted(ids)
    assert sharding.shard_documents(empty).count() == 0


def test_shards_are_near_equal(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame(rows_of([(k, "y" * rng.randrange(400)) for k in range(3000)]), SCHEMA)
    sizes = Counter()
    for r in sharding.shard_documents(docs, 7).collect():
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 400


def test_write_shards(spark, tmp_path):
    docs = spark.createDataFrame(rows_of([(k, f"text {k}") for k in range(50)]), SCHEMA)
    sharding.write_shards(docs, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 50 and back.select("__shard").distinct().count() == 4


def test_token_files(spark, odd, empty, pairs, tmp_path):
    from tokenizers import Tokenizer

    data = byte_bpe.public_vocabulary("word_bpe_49k.json")
    tok = Tokenizer.from_str(data.decode())
    tok.encode_special_tokens = True
    path = str(tmp_path / "t")
    token_files.write_token_files(odd, path, data)
    rows = sorted(token_files.token_report(spark, path).collect(), key=lambda r: r["start"])
    expected = {}
    for p in pairs:
        ids = tok.encode(p[1] or "", add_special_tokens=False).ids + [1]
        expected.setdefault(p[0], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    start = 0
    for r in rows:
        assert r["start"] == start
        expected[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
        start += r["n_tokens"]
    assert not any(expected.values())
    ids = [-1 << 62 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids == sorted(ids)
    token_files.write_token_files(empty, str(tmp_path / "e"), data)
    assert token_files.token_report(spark, str(tmp_path / "e")).count() == 0


def test_token_files_query_encodes_as_the_library_does(spark, pairs, tmp_path):
    from tokenizers import Tokenizer

    from feedlens.llm.queries import op2_token_files

    texts = ["a <|endoftext|> b", "foo<|endoftext|>Bar", "<|ENDOFTEXT|>", "<|endoftext|>.", "X<|startoftext|><|endoftext|>!!",
             "<|start of", "<|EndOfText|>éÀ<|endoftext|>", None, "plain!! <|endoftext|"] + [p[1] for p in pairs]
    spark.createDataFrame(rows_of(list(enumerate(texts))), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    tok = Tokenizer.from_str(byte_bpe.public_vocabulary("word_bpe_49k.json").decode())
    ids = [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert 49407 in ids[0] and 49406 in ids[4]
    starts = np.cumsum([0, *map(len, ids)]).tolist()
    assert got(op2_token_files(spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32")) == want(
        (k, starts[k], len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in enumerate(ids))


def test_token_files_read_selectively(spark, odd, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    token_files.write_token_files(odd, path, byte_bpe.public_vocabulary("word_bpe_49k.json"))
    meta = pq.ParquetFile(max(glob.glob(path + "/*.parquet"))).metadata.row_group(0)
    ids = next(meta.column(k) for k in range(meta.num_columns) if meta.column(k).path_in_schema.startswith("ids"))
    assert ids.has_column_index and ids.has_offset_index
    assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(ids.encodings)
    plan = token_files.read_token_files(spark, path).where("doc_id = 7").select("n_tokens")._jdf.queryExecution().toString()
    assert "ids:array" not in plan.split("Physical Plan")[1] and "EqualTo(doc_id,7)" in plan


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_ngram_join(odd, empty, pairs, n, percent):
    assert got(ngram_join.similar_classes(odd, n, percent)) == want(brute.classes(pairs, n, percent))
    assert ngram_join.similar_classes(empty, n, percent).count() == 0


def test_ngram_join_splits_wide_tokens(odd, pairs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    assert got(ngram_join.similar_classes(odd, 4, 85)) == want(brute.classes(pairs, 4, 85))


def test_ngram_join_every_number_of_matches(odd, pairs, monkeypatch):
    """A free index makes every document take the longest prefix."""
    monkeypatch.setattr(ngram_join, "COST", (0.0, 0.0, 1.0))
    monkeypatch.setattr(ngram_join, "excess", lambda counts: counts.astype(float))
    assert got(ngram_join.similar_classes(odd, 4, 85)) == want(brute.classes(pairs, 4, 85))


def test_ngram_join_keeps_one(odd, pairs):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    expected = [i for i, _, c in brute.classes(pairs, 5, 80) if i is None or i == c]
    assert sorted(map(brute.rank, expected)) == sorted(brute.rank(r["doc_id"]) for r in kept.select("doc_id").collect())


def test_byte_bpe(odd, empty, pairs):
    import tiktoken

    data = byte_bpe.public_vocabulary("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(data), special_tokens={})
    expected = []
    for p in pairs:
        ids = enc.encode_ordinary(p[1] or "")
        expected.append((p[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), brute.sha(p[1] or "")))
    assert got(byte_bpe.bpe_report(odd, data, tokenizers.PATTERN)) == want(expected)
    few = byte_bpe.decode(byte_bpe.encode(odd, data, tokenizers.PATTERN, most=3), data)  # nearly all words folded per document
    assert want((r["doc_id"], bytes(r["decoded"]).decode()) for r in few.collect()) == want((p[0], p[1] or "") for p in pairs)
    assert byte_bpe.bpe_report(empty, data, tokenizers.PATTERN).count() == 0


def test_substring_dedup(odd, empty, pairs):
    assert got(substring_dedup.repeat_report(odd)) == want(brute.passages(pairs))
    assert substring_dedup.repeat_report(empty).count() == 0


def test_substring_dedup_of_many_null_ids(spark):
    """Rows without a doc_id do not collect one another's stretches."""
    rng = random.Random(6)
    passages = [" ".join(f"p{rng.randrange(9999)}" for _ in range(20)) for _ in range(40)]
    pairs = [(k, p) for k, p in enumerate(passages)]
    pairs += [(None, f"{k} own words {k} {p} and more {k}") for k, p in enumerate(passages)] + [(None, "1 own words " + passages[1])] * 2
    docs = spark.createDataFrame(rows_of(pairs), SCHEMA)
    assert got(substring_dedup.repeat_report(docs)) == want(brute.passages(pairs))
    hits = substring_dedup.repeated_windows(docs).where(f"key = {substring_dedup.NO_ID}")
    assert max(r["count"] for r in hits.groupBy("key", "alike").count().collect()) < 10


def test_substring_dedup_wide_and_hot_anchors(odd, pairs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "WIDE_ANCHOR", 2)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 500)
    assert got(substring_dedup.repeat_report(odd)) == want(brute.passages(pairs))


def test_words_as_places_in_the_bytes():
    """Words, their hashes and what is joined of them come from the texts' bytes, without a string a word."""
    import pyarrow as pa

    texts = [None, "", "a", "b", " c", "d ", "\t \n", "x" * 64, "x" * 65, "x" * 64 + "y", "é\x85 z", "日本\x0b語", "a\x00", "a", "abcdefgh",
             "abcdefghi  abcdefgh", "q\r\nw " * 9, "a b"]
    words = substring_dedup.Words(pa.array(["gone", *texts], pa.string()).slice(1))
    split = [brute.words(t) for t in texts]
    assert np.diff(words.offsets).tolist() == list(map(len, split))
    flat = [w for s in split for w in s]
    of = dict(zip(flat, words.hashes().tolist()))
    assert [of[w] for w in flat] == words.hashes().tolist() and len(set(of.values())) == len(of)
    assert words.joined(np.ones(len(flat), bool)).to_pylist() == [" ".join(s) for s in split]
    keep = np.array([w not in ("a", "abcdefgh", "w") for w in flat])
    assert words.joined(keep).to_pylist() == [" ".join(w for w in s if w not in ("a", "abcdefgh", "w")) for s in split]
    nothing = substring_dedup.Words(pa.array([None, ""], pa.string()))
    assert nothing.offsets.tolist() == [0, 0, 0] and nothing.joined(nothing.first == 0).to_pylist() == ["", ""]


def test_stretches_of_neighbouring_windows():
    """A stretch is as long as the leftmost smallest sequence inside its windows stays, also where sequences repeat."""
    import pyarrow as pa

    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(60)] + ["x " * 30, "p q r " * 9]
    s = substring_dedup.Stretches(pa.array(texts))
    grams, span = substring_dedup._grams(s.mixed, substring_dedup.GRAM), substring_dedup.WINDOW - substring_dedup.GRAM + 1
    expected, before = [], None
    for text, (i, j) in enumerate(zip(s.offsets[:-1], s.offsets[1:])):
        for k in range(i, j - substring_dedup.WINDOW + 1):
            at = min(range(k, k + span), key=lambda x: (grams[x], x))
            if before != (text, at):
                expected.append([text, k, 0, grams[at]])
            expected[-1][2] += 1
            before = text, at
    assert [list(x) for x in zip(s.text, s.start, s.windows, s.anchor)] == expected and len(expected) > 100


def test_substring_dedup_hands_words_out_in_bounded_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(substring_dedup, "BATCH_WORDS", 100)
    texts = pa.array([" ".join(f"w{k}" for k in range(n, n + 200)) for n in range(3)])
    s = substring_dedup.Stretches(texts)
    asked = [[{"content": int(c), "last": 9, "wide": wide} for c in s.content[s.text == t].view(np.int64)] for t, wide in enumerate((False, True, False))]
    kind = pa.list_(pa.struct([("content", pa.int64()), ("last", pa.int64()), ("wide", pa.bool_())]))
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2]), texts, pa.array(asked, kind)], ["key", "text", "asked"])
    out = list(substring_dedup._words(iter([batch])))
    assert len(out) > 20 and all(sum(map(len, b.column("words").to_pylist())) <= 8 * 100 for b in out)
    rows = [r for b in out for r in b.to_pylist()]
    expected = []
    for k in range(len(s)):
        for w in range(s.windows[k]) if s.text[k] == 1 else [0]:
            n = 13 if s.text[k] == 1 else s.windows[k] + 12
            expected.append((int(s.text[k]), w, s.words[s.start[k] + w:s.start[k] + w + n].tobytes()))
    assert sorted((r["key"], r["first_window"], r["words"]) for r in rows) == sorted(expected)


def test_fm_index_counts():
    rng = np.random.default_rng(3)
    lengths = rng.integers(3, 40, 60)
    words = rng.integers(0, 4, int(lengths.sum())).astype(np.uint64)
    index = substring_dedup.FmIndex(words, lengths)
    ends = np.cumsum(lengths)
    seqs = [words[e - n:e].tolist() for e, n in zip(ends, lengths)]
    starts = [e - n + k for e, n in zip(ends, lengths) for k in range(n - 2)]
    count = Counter(tuple(s[k:k + 3]) for s in seqs for k in range(len(s) - 2))
    rows, low, high = index.search(np.array(starts), 3)
    found = dict(zip(rows.tolist(), (high - low).tolist()))
    for k, s in enumerate(starts):
        c = count[tuple(words[s:s + 3].tolist())]
        assert found.get(k, 1) == c


def test_mixing(odd, empty, pairs):
    rows = mixing.mix_report(odd).collect()
    sizes = Counter()
    for p in pairs:
        sizes[p[2] if len(p) > 2 else None] += len(brute.words(p[1]))
    t = brute.targets(sizes)
    assert want((r["doc_id"], r["size"]) for r in rows) == want((p[0], len(brute.words(p[1]))) for p in pairs)
    by_size = {v: s for s, v in sizes.items()}
    taken = Counter()
    for r in rows:
        s = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(t[s])
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        assert r["size"] == 0 or int(r["target"] / sizes[s] + 1e-9) <= r["taken"] // r["size"] <= int(r["target"] / sizes[s] + 1e-9) + 1
        taken[s] += r["taken"]
    assert got(mixing.mix_report(odd)) == want(rows)  # reruns agree
    assert mixing.mix_report(empty).count() == 0


def test_mixing_meets_targets_over_many_blocks(spark):
    rng = random.Random(4)
    pairs = [(k, "w " * min(400, int(rng.paretovariate(1.1) * 5)), rng.choice("aaaaabcd")) for k in range(4000)]
    docs = spark.createDataFrame(rows_of(pairs), SCHEMA)
    rows = mixing.copies(mixing.units_of(docs), block=64).collect()
    taken, target, count, expect = Counter(), {}, Counter(), Counter()
    for r in rows:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        count[r["source"]] += r["copies"]
        expect[r["source"]] += r["target"] / r["source_size"]
    for s in target:
        assert abs(taken[s] - target[s]) <= 400  # one document
        assert abs(count[s] - expect[s]) < 2


@pytest.mark.parametrize("block", [64, mixing.BLOCK])
def test_mixing_lands_every_source(spark, block):
    """Small sources and one of several blocks, each with a very long document, meet their targets to a few words."""
    rng = random.Random(11)
    units = [(s, rng.randrange(20, 100)) for s, n in (("a", 5000), ("b", 1000), ("c", 2000)) for _ in range(n)]
    units += [("a", 20000), ("b", 20000), ("c", 15000)]
    units = spark.createDataFrame([(k, k, s, x) for k, (s, x) in enumerate(units)], "row long, doc_id long, source string, size long")
    rows = mixing.copies(units, block=block).collect()
    taken, target = Counter(), {}
    for r in rows:
        assert r["copies"] - int(r["target"] / r["source_size"]) in (0, 1)
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert len(rows) == 8003 and max(abs(taken[s] - target[s]) for s in target) < 3


def test_flight_is_fair():
    """Means over many draws come to the probabilities (before the exchanges)."""
    x = [3.0, 5.0, 5.0, 8.0, 1.0, 9.0, 2.0, 7.0]
    rng = np.random.default_rng(0)
    mean = np.mean([[min(1, max(0, q)) for q in mixing.fly([0.4] * 8, x, rng.random(12))] for _ in range(4000)], axis=0)
    assert np.allclose(mean, 0.4, atol=0.04)


def test_mix_rows(odd):
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    n = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    taken = defaultdict(int)
    for r in mixing.mix_report(odd).collect():
        if r["size"]:
            taken[r["doc_id"]] += r["taken"] // r["size"]
    for k, v in taken.items():
        if k not in (None, 8):
            assert n[k] == v


def test_line_dedup(odd, empty, pairs):
    expected = brute.line_dedup(pairs)
    assert got(line_dedup.line_report(odd)) == want(e[:4] for e in expected)
    full = line_dedup.dedup_lines(odd)
    assert set(CLASH) <= set(full.columns)
    assert want((r["doc_id"], r["text"] or "") for r in full.select("doc_id", "text").collect()) == want((e[0], e[4]) for e in expected)
    assert line_dedup.line_report(empty).count() == 0


@pytest.mark.parametrize("batches", [1, 9])
def test_line_runs_compact(spark, odd, pairs, batches):
    assert got(line_dedup.line_report(odd, batches)) == want(e[:4] for e in brute.line_dedup(pairs))


def test_line_runs_levels(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for k in range(5):
        runs.add_batch(spark.createDataFrame([(10 * k + d, h, 0) for d in range(2) for h in range(k + 2)], "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert got(runs.owners().select("h1", "owner")) == [(0, 0), (1, 0), (2, 10), (3, 20), (4, 30), (5, 40)]


def test_exact_dedup(odd, empty, pairs):
    assert got(exact_dedup.exact_groups(odd)) == want(brute.exact(pairs))
    assert got(exact_dedup.exact_groups(odd, leaves=1)) == want(brute.exact(pairs))
    assert exact_dedup.exact_groups(empty).count() == 0
    kept = exact_dedup.drop_exact_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(brute.rank(r[0]) for r in kept.select("doc_id").collect()) == sorted(
        brute.rank(i) for i, k, _, _, _ in brute.exact(pairs) if i == k)


def test_quality_rules(odd, empty, pairs):
    rows = quality_rules.apply_rules(odd).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert want((r["doc_id"], *(r[c] for c in names)) for r in rows) == want((p[0], *brute.rule_counts(p[1])) for p in pairs)
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and (not failed or not r["kept"])
        assert r["kept"] == (not failed and not r["failed_rules"])
    assert quality_rules.apply_rules(empty).count() == 0


def test_native_operators_run_no_python(odd):
    for df in (exact_dedup.exact_groups(odd), line_dedup.line_report(odd), quality_rules.apply_rules(odd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def _brute_marginals(emit, trans):
    """Good probability per line by enumeration of all labellings."""
    n = len(emit)
    total, good = 0.0, np.zeros(n)
    for bits in range(1 << n):
        y = [bits >> k & 1 for k in range(n)]
        w = np.exp(sum(emit[k] * y[k] for k in range(n)) + sum(trans[y[k], y[k + 1]] for k in range(n - 1)))
        total += w
        good += w * np.array(y)
    return good / total, np.log(total)


def test_crf_marginals_and_likelihood_gradient():
    rng = np.random.default_rng(2)
    count = np.array([3, 1, 6, 2])
    emit, trans = rng.normal(size=12), rng.normal(size=(2, 2))
    p, pairs, full = quality_crf.marginals(emit, count, trans)
    at = 0
    for k, n in enumerate(count):
        good, z = _brute_marginals(emit[at:at + n], trans)
        assert np.allclose(p[at:at + n], good) and np.isclose(full[k], z)
        at += n
    step = 1e-5
    for i in range(2):
        for j in range(2):
            t = trans.copy()
            t[i, j] += step
            assert np.isclose((quality_crf.marginals(emit, count, t)[2].sum() - full.sum()) / step, pairs[i, j], atol=1e-3)


def test_classifier_on_odd_rows(spark, odd, empty, pairs):
    labels = spark.createDataFrame([(p[0], 0 if "!!" in (p[1] or "") or "##" in (p[1] or "") else 1, 0) for p in pairs]
                                   + [(7, None, None), (None, 1, 0), (9, 3, 0)], "doc_id long, quality int, toxic int")
    rows = quality_crf.classify(odd, labels).collect()
    assert sorted(brute.rank(r["doc_id"]) for r in rows) == sorted(brute.rank(p[0]) for p in pairs)
    for r in rows:
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert quality_crf.classify(empty, labels).count() == 0
    none = quality_crf.classify(odd, labels.limit(0)).collect()
    assert all(abs(r["score"] - 0.5) < 1e-9 for r in none)
    assert quality_crf.keep_good(odd, labels).columns == odd.columns


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_crf.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r["score"] for r in rows if r["quality"] == 1], [r["score"] for r in rows if r["quality"] == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_line_features_do_not_depend_on_the_batch():
    import pyarrow as pa

    texts = ["a b\n\nc C!! c\nc", None, "", "x " * 50, "été | ## 42\nlast."]
    count, x, size = quality_crf.line_features(pa.array(texts))
    at = 0
    for t, n in zip(texts, count):
        c1, x1, s1 = quality_crf.line_features(pa.array(["zz\nyy", t]).slice(1))
        assert c1[0] == n and np.allclose(x[at:at + n], x1) and np.allclose(size[at:at + n], s1)
        at += n


def test_slices_compute_what_the_whole_does(pairs):
    """Arrow batches cut into slices (as on long partitions) give the rows of the uncut batch."""
    import pyarrow as pa

    from feedlens.llm.common import slices, word_lists

    texts = [p[1] for p in pairs] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    cut = list(slices(iter([batch.slice(1)]), "text", 3000))
    assert len(cut) > 20 and sum(b.num_rows for b in cut) == len(texts) - 1
    at = 1
    for b in cut:
        col, here = b.column("text"), texts[at:at + b.num_rows]
        offsets, flat = word_lists(col)
        words = flat.to_pylist()
        assert [words[s:e] for s, e in zip(offsets[:-1], offsets[1:])] == [brute.words(t) for t in here]
        size, _ = ngram_join.sets_of(col, 4)
        assert size.tolist() == [len(brute.shingles(t, 4)) for t in here]
        ends, codes, chunks = byte_bpe.chunked(col)
        assert ["".join(chunks[c] for c in codes[s:e]) for s, e in zip(ends[:-1], ends[1:])] == [t or "" for t in here]
        count, x, _ = quality_crf.line_features(col)
        assert count.tolist() == [(t or "").count("\n") + 1 for t in here]
        assert np.allclose(x, quality_crf.line_features(pa.array(here, pa.string()))[1])
        assert len(substring_dedup.Stretches(col)) == len(substring_dedup.Stretches(pa.array(here, pa.string())))
        at += b.num_rows


def test_plain_words_by_the_model_alone():
    """The ids of plain words are those of the whole tokenizer, which is not asked for them."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzßàéîõüñçłŉſªº"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(400)})
    other = ["İstanbul", "e\u0301t", "don't", "a1b", "日本", "ﬁne", "ǅ", "STRASSE", "x…", "ά"]
    cache = token_files.WordCache(tok)
    assert cache.direct and all(map(token_files.plain, words)) and not any(map(token_files.plain, other))
    asked, own = [], cache._by_tokenizer
    cache._by_tokenizer = lambda some: asked.extend(some) or own(some)
    expected = [np.array(e.ids, np.int32).tobytes() for e in tok.encode_batch(words + other, add_special_tokens=False)]
    assert cache.encode(words + other) == expected
    assert not set(asked) & set(words)


def test_words_are_split_by_column():
    """What is remembered of a word and its tail, for all words of an array at once, and the ids of both together."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abzAZ09.,!'-<|>éÉ日\x00") for _ in range(rng.randrange(1, 9))) for _ in range(600)}
                   | {"...", "don't", "a'", "A.", "é.", "É", "<|endoftext|>.", "X<|EndOfText|>", "1!?", "'"})
    tails = string.punctuation.replace("'", "")
    for added in ([], ["<|startoftext|>", "<|endoftext|>"]):
        tok.encode_special_tokens = not added
        cache = token_files.WordCache(tok, added)
        expected = []
        for w in words:
            whole = any(a in w.lower() for a in added)
            base = w if whole else w.rstrip(tails)
            if not base or not (base[-1].isascii() and base[-1].isalnum()):
                base = w
            expected.append((base if whole or not base.isascii() else base.lower(), w[len(base):]))
        array = pa.array(["", *words, "b"], pa.large_string())[1:-1]
        assert list(zip(*(x.to_pylist() for x in cache.split(array)))) == expected
        length, ids = cache.encode_array(array)
        want_ids = [e.ids for e in tok.encode_batch(words, add_special_tokens=False)]
        assert length.tolist() == list(map(len, want_ids)) and ids.tolist() == [i for x in want_ids for i in x]
    assert cache.encode([]) == [] and len(cache.encode_array(pa.array([], pa.large_string()))[1]) == 0
    offsets, ids = token_files.encode_texts(pa.array(["", None, "a b.", " ", "c"]), cache, 1)
    assert offsets.tolist() == [0, 1, 2, 6, 7, 9] and [ids[k] for k in (0, 1, 5, 6, 8)] == [1] * 5


def test_token_worker_starts_no_threads():
    """Each thread of the tokenizers library would keep memory of its own in every worker."""
    import os
    import subprocess
    import sys

    code = """
import os, random, types
import pyarrow as pa
from feedlens.llm import byte_bpe, token_files
rng = random.Random(5)
texts = [" ".join("".join(rng.choice("abc\u00e91'") for _ in range(6)) for _ in range(300)) for _ in range(50)]
batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(texts)], ["doc_id", "text"])
spec = types.SimpleNamespace(value=byte_bpe.public_vocabulary("word_bpe_49k.json"))
threads = len(os.listdir("/proc/self/task"))
rows = sum(b.num_rows for b in token_files._encoder(spec, 1, True)(iter([batch])))
print(rows, len(os.listdir("/proc/self/task")) - threads)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(token_files.__file__))))
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    run = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=240)
    assert run.stdout.split() == ["50", "0"], run.stdout + run.stderr


def test_token_workers_are_handed_slices(spark, tmp_path, monkeypatch):
    """Arrow batches of a long partition stay near a slice's bytes, on the way to the ids and back from the files."""
    import pyarrow as pa

    def sizes(spec, end_id, added):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("doc_id"), pa.array([b.nbytes] * b.num_rows, pa.int64()),
                     pa.array([[7] * 1000] * b.num_rows, pa.list_(pa.int32()))], ["at", "doc_id", "n_tokens", "ids"])
        return run

    def bytes_of(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())] * 4, ["doc_id", "start", "n_tokens", "ids_crc32"])

    monkeypatch.setattr(token_files, "_encoder", sizes)
    monkeypatch.setattr(token_files, "_checksum", bytes_of)
    docs = spark.createDataFrame(rows_of([(k, "word " * 800) for k in range(6000)]), SCHEMA).coalesce(1)
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    token_files.write_token_files(docs, path, b"{}")
    most = token_files.SLICE + (1 << 16)
    assert 0 < max(r["n_tokens"] for r in spark.read.parquet(path).collect()) <= most
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    assert 0 < max(r["n_tokens"] for r in token_files.token_report(spark, path).collect()) <= most


def test_byte_bpe_merges_many_words_at_once():
    """All words of a slice side by side, the leftmost of equal pairs first, and the long ones by the heap."""
    import tiktoken

    ranks = byte_bpe.read_ranks(byte_bpe.public_vocabulary("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    words = ["".join(rng.choice("aaabeéñ tnß日 ") for _ in range(rng.choice([1, 2, 3, 7, 20, 63, 64, 65, 90]))) for _ in range(300)]
    words = sorted(set(words) | {"a" * n for n in (2, 3, 5, 63, 64)})
    merges = byte_bpe.Merges(ranks)
    for most in (7, 10_000):
        ends, ids = byte_bpe.word_tokens(words, merges, most)
        assert [ids[s:e].tolist() for s, e in zip(ends[:-1], ends[1:])] == [enc.encode_ordinary(w) for w in words]


def test_quality_memory_follows_a_slice():
    """Four times as many texts are scored in the same memory."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(500)]
    texts = ["\n".join(" ".join(rng.choices(words, k=12)) for _ in range(400)) for _ in range(240)]
    model = quality_crf.Model(np.full(37, 0.1), np.zeros((2, 2)))
    whole = pa.array(texts)
    tracemalloc.start()
    got_scores = quality_crf.score_batch(whole, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    assert np.allclose(got_scores, [quality_crf.score_batch(pa.array([t]), model)[0] for t in texts])
