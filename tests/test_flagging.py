import math
import random

from feedlens.operators.flagging import duplicate_rules, flag_duplicates
from feedlens.operators.similarity import similar_pairs
from feedlens.schema import ARTICLES

from . import pyref


def _df(spark, rows):
    return spark.createDataFrame([(r["feed_no"], r["entry_no"], r["title"], r["url"], None, r["content"])
                                  for r in rows], ARTICLES)


def _flags(spark, rows, similar):
    out = flag_duplicates(_df(spark, rows), similar=similar).collect()
    return {(r.feed_no, r.entry_no): r.method for r in out}


def _random_rows(rng, n):
    urls = ["https://a.com/1", "https://A.com/1/?x", "https://b.com/2", None, None]
    titles = ["Alpha beta gamma", "alpha beta gamma", "BREAKING: alpha beta gamma", "Alpha beta gamme",
              "Delta", None, "Zeta eta theta iota", "zeta eta theta iot"]
    contents = ["one two", "One  two", "three", None, "four"]
    rows = []
    for i in range(n):
        rows.append({"feed_no": rng.randrange(3), "entry_no": i, "url": rng.choice(urls),
                     "title": rng.choice(titles), "content": rng.choice(contents)})
    return rows


def test_exact_rules_match_sequential_walk(spark):
    rng = random.Random(7)
    for n in (5, 12, 24):
        rows = _random_rows(rng, n)
        assert _flags(spark, rows, False) == pyref.walked_flags(_df(spark, rows))


def test_similar_rule_matches_sequential_walk(spark):
    rng = random.Random(11)
    for n in (6, 16):
        rows = _random_rows(rng, n)
        df = _df(spark, rows)
        strings = duplicate_rules(df).select("a", "b").collect()
        pairs = pyref.similar_pairs([r.a for r in strings], [r.b for r in strings])
        assert _flags(spark, rows, True) == pyref.walked_flags(df, pairs)


def test_not_transitive_chain(spark):
    rows = [{"feed_no": 0, "entry_no": 0, "url": "https://x.com/a", "title": "first", "content": "c1"},
            {"feed_no": 0, "entry_no": 1, "url": "https://x.com/a", "title": "second", "content": "c2"},
            {"feed_no": 0, "entry_no": 2, "url": "https://x.com/c", "title": "second", "content": "c3"}]
    got = _flags(spark, rows, False)
    assert got == {(0, 0): "new", (0, 1): "url", (0, 2): "new"}


def test_rule_priority(spark):
    rows = [{"feed_no": 0, "entry_no": 0, "url": "https://x.com/a", "title": "t", "content": "c"},
            {"feed_no": 0, "entry_no": 1, "url": "https://x.com/a", "title": "t", "content": "c"},
            {"feed_no": 1, "entry_no": 0, "url": "https://x.com/b", "title": "T ", "content": "c"}]
    assert _flags(spark, rows, False) == {(0, 0): "new", (0, 1): "url", (1, 0): "title"}


def test_similarity_join_lossless_vs_bruteforce(spark):
    rng = random.Random(5)
    base = ["gene therapy trial results", "new cancer drug approved", "crispr study shows promise",
            "ab", "a", "xyz", "rare disease orphan drug news today"]
    values = []
    for _ in range(150):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(s) + 1)
            if rng.random() < 0.5 and s:
                s.pop(min(k, len(s) - 1))
            else:
                s.insert(k, rng.choice("aeiou st"))
        values.append("".join(s))
    values += ["", "", "q" * 220, "q" * 219 + "r"]
    a_df = spark.createDataFrame([(v,) for v in values], "a string")
    b_df = spark.createDataFrame([(v,) for v in values[::2]], "b string")
    got = {(r.a, r.b) for r in similar_pairs(a_df, b_df).collect()}
    assert got == pyref.similar_pairs(values, values[::2])


HARD = ("abcudefvghiwjklxmnyopzqrst", "abcdefghijklmnopqr\u03b1st")  # ratio 0.851, few shared trigrams


def test_similarity_at_the_least_overlap(spark):
    """Scattered edits leave as few shared trigrams as the threshold allows;
    one pair or more for every length of the short and gram paths."""
    rng = random.Random(13)
    a_vals, b_vals = [HARD[0], HARD[1]], [HARD[1], HARD[0]]
    for n in [*range(1, 40), 46, 47, 60, 75, 120, 199, 200, 230]:
        for _ in range(4):
            x = [chr(0x4E00 + rng.randrange(3000)) for _ in range(n)]
            y = list(x)
            edits = max(1, math.floor(0.3 * n * rng.choice([0.8, 1.0])))
            for k in range(edits):  # evenly spread insertions and deletions
                at = min(len(y) - 1, (k * len(y)) // edits) if y else 0
                if rng.random() < 0.5 and y:
                    y.pop(at)
                else:
                    y.insert(at, chr(0x3042 + k))
            a_vals += ["".join(x), "".join(y)]
            b_vals += ["".join(y), "".join(x)]
    a_vals += ["aab", "abc", "aaaaaaa", "bca"]
    b_vals += ["aba", "cab", "aaaaaab", "abcd"]
    got = {(r.a, r.b) for r in similar_pairs(spark.createDataFrame([(v,) for v in a_vals], "a string"),
                                             spark.createDataFrame([(v,) for v in b_vals], "b string")).collect()}
    expected = pyref.similar_pairs(a_vals, b_vals)
    assert got == expected and HARD in expected and len(expected) > 150


def test_hard_pair_is_flagged(spark):
    rows = [{"feed_no": 0, "entry_no": k, "url": f"https://x.com/{k}", "title": t, "content": f"c{k}"} for k, t in enumerate(HARD[::-1])]
    assert _flags(spark, rows, True) == {(0, 0): "new", (0, 1): "similar_title"}


def test_lowest_bound_is_an_envelope(spark):
    from pyspark.sql import functions as F

    from feedlens.operators.similarity import lowest_bound, overlap_bound
    s = F.col("id")
    rows = spark.range(2, 6000).select(lowest_bound(s, 0.85, 3).alias("low"), overlap_bound(s, 0.85, 3).alias("need")).collect()
    assert all(r.low <= r.need for r in rows)
    assert all(x.low <= y.low for x, y in zip(rows, rows[1:]))


def test_partition_invariance(spark):
    rows = _random_rows(random.Random(3), 20)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for n in ("1", "5", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(_flags(spark, list(reversed(rows)), True))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_verify_bounds_exact_on_long_strings():
    """The batch verifier equals difflib both ways on long strings from small
    alphabets, where most characters are popular (autojunk)."""
    from feedlens.operators.similarity import ratio_at_least, verify_pairs
    rng = random.Random(21)
    a_vals, b_vals = [], []
    for _ in range(1500):
        alpha = rng.choice(["ab", "abc ", "etaoin shrdlu", "xyzáé qwer"])
        x = "".join(rng.choice(alpha) for _ in range(rng.randint(150, 450)))
        y = list(x)
        for _ in range(rng.randint(0, 40)):
            k = rng.randrange(len(y) + 1)
            if rng.random() < 0.5 and y:
                y.pop(min(k, len(y) - 1))
            else:
                y.insert(k, rng.choice(alpha))
        a_vals += [x, "".join(y)]
        b_vals += ["".join(y), x]
    got = verify_pairs(a_vals, b_vals, 0.85)
    assert got == [(ratio_at_least(a, b, 0.85), ratio_at_least(b, a, 0.85)) for a, b in zip(a_vals, b_vals)]
    assert sum(x for x, _ in got) > 100


def test_similarity_over_many_blocks(spark, monkeypatch):
    """Blocks of three strings, some of them empty by chance: every pair once, however the blocks fall."""
    import random

    from feedlens.operators import similarity as S
    monkeypatch.setattr(S, "BLOCK", 3)
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([1, 2, 5, 9, 20, 40]))) for _ in range(12)]
    values = base + [b[:k] + "x" + b[k + 1:] for b in base for k in (0, len(b) // 2)] + [b + "é" for b in base] + ["", "a", "ab"]
    a_df = spark.createDataFrame([(v,) for v in values + values[:5]], "a string")
    b_df = spark.createDataFrame([(v,) for v in values[1::2]], "b string")
    got = [(r.a, r.b) for r in similar_pairs(a_df, b_df).collect()]
    assert len(got) == len(set(got)) and set(got) == pyref.similar_pairs(values, values[1::2])


def test_similarity_shuffles_no_string_for_each_block_that_its_own_meets(spark, monkeypatch):
    """Twelve or more blocks of ten titles, all of near lengths: each title is dealt to the two sides of the product, and once to its block."""
    from pyspark.sql import functions as F

    from feedlens.operators import similarity as S
    monkeypatch.setattr(S, "BLOCK", 10)
    titles = [" ".join(["alpha", "betas", "gamma", "delta"][(k >> 2 * i) % 4] for i in range(4)) + f" {k % 7}" for k in range(120)]
    df = spark.createDataFrame([(v,) for v in titles], "a string")
    moved, frame = [], type(df)
    plain = frame.repartition

    def repartition(self, n, *cols):
        if "s" in self.columns:
            moved.append(self.count())
        for c in self.columns:
            if c.endswith("texts"):
                moved.append(self.agg(F.sum(F.size(c))).first()[0])
        return plain(self, n, *cols)
    monkeypatch.setattr(frame, "repartition", repartition)
    got = [(r.a, r.b) for r in similar_pairs(df, df.withColumnRenamed("a", "b")).collect()]
    assert len(got) == len(set(got)) and set(got) == pyref.similar_pairs(titles, titles)
    assert moved == [120, 120]


def test_similarity_makes_no_row_a_candidate_pair(spark):
    """40 titles of the same few words: blocks travel, candidate pairs do not."""
    import pandas as pd

    from feedlens.operators.similarity import similar_in_blocks
    titles = [" ".join(["alpha", "beta", "gamma", "delta"][(k >> 2 * i) % 4] for i in range(8)) for k in range(40)]
    block = pd.DataFrame({"s": titles, "in_a": True, "in_b": True})
    one, two = block[:25], block[25:]
    found = [similar_in_blocks(one, None, 0.85), similar_in_blocks(two, None, 0.85), similar_in_blocks(one, two, 0.85)]
    got = [(a, b) for f in found for a, b in zip(f["a"], f["b"])]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a, b in pyref.similar_pairs(titles, titles) if a != b}
    assert similar_in_blocks(one, two[:0], 0.85).empty


def test_few_pairs_of_long_titles_are_aligned(monkeypatch):
    """Titles of 200 characters or more with the same characters in other orders: difflib and the
    subsequences see none of them, but all that are similar."""
    import random
    from difflib import SequenceMatcher

    import pandas as pd

    from feedlens.operators import similarity as S
    rng = random.Random(4)
    words = ["thon", "er", "ing", "quiz", "the", "anea", "oth", "nth", "rein", "hat"] * 6 + list("012345")
    titles = [" ".join(rng.sample(words, len(words))) for _ in range(40)]
    titles += [t[:100] + "x" + t[101:] for t in titles[:5]]
    seen = []
    verify = S.verify_pairs
    monkeypatch.setattr(S, "verify_pairs", lambda a, b, t: seen.extend(zip(a, b)) or verify(a, b, t))
    found = S.similar_in_blocks(pd.DataFrame({"s": titles, "in_a": True, "in_b": True}), None, 0.85)
    expected = {(a, b) for a in titles for b in titles if a != b and SequenceMatcher(None, a, b).ratio() >= 0.85}
    assert set(zip(found["a"], found["b"])) == expected and expected
    assert len(seen) < 100


def test_subsequences_side_by_side(monkeypatch):
    """Many pairs at once, over one machine word and several, agree with one pair after the other."""
    import random

    import numpy as np
    import pandas as pd

    from feedlens.operators import similarity as S
    rng = random.Random(5)
    strings = ["".join(rng.choice("abcé") for _ in range(n)) for n in (1, 30, 63, 64, 65, 128, 130, 199) for _ in range(3)]
    block = S.Block(pd.DataFrame({"s": strings, "in_a": True, "in_b": True}))
    i, j = (x.ravel() for x in np.indices((len(strings), len(strings))))
    places = [{c: sum(1 << k for k, d in enumerate(s) if d == c) for c in set(s)} for s in strings]
    assert S.Subsequences(block, block).lengths(i, j).tolist() == [
        S.common_subsequence(strings[p], places[q], len(strings[q])) for p, q in zip(i, j)]


def _long_titles(n, words=150, seed=3):
    """Unrelated titles of one small vocabulary, about 700 characters each, and a near copy of every tenth."""
    import random

    rng = random.Random(seed)
    vocabulary = ["th", "er", "an", "the", "ing", "tion", "ed", "ble", "wh", "re", "st", "on", "es", "or", "ky", "jo", "vex", "qui"]
    out = []
    for k in range(n):
        some = ["".join(rng.choice(vocabulary[:14]) for _ in range(rng.randint(1, 3))) for _ in range(words)]
        for _ in range(6):
            some[rng.randrange(words)] = rng.choice(vocabulary)
        out.append(" ".join(some))
        if k % 10 == 0:
            some[rng.randrange(words)] = "xyz"
            out.append(" ".join(some))
    return out


def test_long_titles_of_one_vocabulary_are_told_apart_before_the_subsequences():
    import pandas as pd

    from feedlens.operators import similarity as S

    titles = _long_titles(60)
    block = S.Block(pd.DataFrame({"s": titles, "in_a": True, "in_b": True}))
    left = {(min(i, j), max(i, j)) for p, q in S._candidates(block, block, True, 0.85) for i, j in zip(p.tolist(), q.tolist())}
    similar = {(i, j) for i in range(len(titles)) for j in range(i + 1, len(titles))
               if S.ratio_at_least(titles[i], titles[j], 0.85) or S.ratio_at_least(titles[j], titles[i], 0.85)}
    assert similar and similar <= left
    assert len(left) <= len(similar) + 5


def test_matcher_decides_as_difflib():
    import random
    from difflib import SequenceMatcher

    from feedlens.operators.similarity import Matcher

    rng = random.Random(7)
    for size in (0, 1, 2, 30, 199, 200, 260, 700):
        for letters in ("ab", "abc de", "etaoinshrdlucmfwypvbgkqjxz" + " e" * 20):
            b = "".join(rng.choice(letters) for _ in range(size))
            a = list(b)
            for _ in range(size // 8):
                at, to = rng.randrange(len(a)), rng.randrange(len(a))
                a[to:to] = a[at:at + rng.choice((0, 1, 9))] or ["z"]
                del a[rng.randrange(len(a))]
            a = "".join(a)
            for x, y in ((a, b), (b, a)):
                ratio = SequenceMatcher(None, x, y).ratio()
                for threshold in (0.5, 0.85, ratio, ratio + 1e-9):
                    assert Matcher(y).reaches(x, threshold) == (ratio >= threshold)
