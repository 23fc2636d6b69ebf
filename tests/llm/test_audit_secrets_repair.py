"""Source audit, secret scan and conversation repair against brute-force versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.llm import conversation_repair, secret_scan, source_audit
from tests.llm.conftest import CLASH, SCHEMA, prose, rows_of


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def want(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# ---------------------------------------------------------------------------- source audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audit_brute(rows, min_docs, top):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    rows = [(TERM.findall(low(t or "")), lang or "", source or "") for t, lang, source in rows]
    df = Counter((lang, term) for terms, lang, _ in rows for term in set(terms))
    kept = defaultdict(list)
    for (lang, term), n in df.items():
        if n >= min_docs:
            kept[lang].append(term)
    count = defaultdict(Counter)
    groups = sorted({(lang, source) for _, lang, source in rows})
    for terms, lang, source in rows:
        ours = Counter(t for t in terms if df[lang, t] >= min_docs)
        count[lang, source] += ours
        count[lang, None] += ours
    def p(key, term):
        c = count[key]
        return 1 + 10 ** 9 * (c[term] + 5) // (sum(c.values()) + 5 * len(kept[key[0]]))
    out = []
    for lang, source in groups:
        pairs = sorted((-sum(abs(p((lang, source), t) - p((lang, other), t)) for t in kept[lang]), other.encode())
                       for x, other in groups if x == lang and other != source)
        out += [(lang, source, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(pairs)]
        over = sorted((p((lang, None), t) - p((lang, source), t), t.encode()) for t in kept[lang]
                      if count[lang, source][t] and p((lang, source), t) > p((lang, None), t))
        out += [(lang, source, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(over[:top])]
    return out


def audit_rows():
    rng = random.Random(3)
    words = ["the", "Of", "and", "über", "niño", "日本", "naïve", "x", "it's", "foo_bar", "A-b", "7up", "zz\x00top", "É"]
    rows = []
    for k in range(150):
        lang, source = rng.choice(["en", "de", None, "xx"]), rng.choice(["a", "b", "c", "é", None, ""])
        rows.append((" ".join(rng.choice(words) for _ in range(rng.randrange(30))), lang, source))
    rows += [(None, "en", "only null"), ("", "en", "only empty"), ("rare words alone", "zz", "p"), ("12 34", "zz", "q"), (None, None, None)]
    rows += [("the " * 5000, "en", "a")] + [("the same row", "de", "b")] * 4
    return rows


def as_docs(spark, rows):
    return spark.createDataFrame([(k, t, lang, source, None, *CLASH) for k, (t, lang, source) in enumerate(rows)], SCHEMA).repartition(5)


@pytest.mark.parametrize("bounds", [{}, {"shard_terms": 2, "round_bytes": 150, "dense_bytes": 64}])
def test_source_audit(spark, empty, bounds):
    """As one shard, and as many shards in several rounds with counts handed on early."""
    rows = audit_rows()
    found = got(source_audit.audit_sources(as_docs(spark, rows), min_docs=6, top=4, **bounds))
    assert found == want(audit_brute(rows, 6, 4))
    if not bounds:
        assert source_audit.audit_sources(empty).count() == 0


def test_no_kept_terms(spark):
    rows = audit_rows()
    found = got(source_audit.audit_sources(as_docs(spark, rows)))
    assert found == want(audit_brute(rows, 30, 50))
    assert {r[4] for r in found if r[0] == "zz"} == {0}


def test_terms_and_perfect_hash():
    texts = pa.array(["Ab c1d", "", None, "é_É Z", "zz", "\x00"])
    owner, flat = source_audit.terms_of(texts.slice(0))
    assert list(zip(owner.tolist(), flat.to_pylist())) == [(0, "ab"), (0, "c"), (0, "d"), (3, "é"), (3, "É"), (3, "z"), (4, "zz")]
    keys = pa.array([f"key{k}" for k in range(5000)], pa.large_string())
    hashes = source_audit.term_hashes(keys)
    hashes[17] = hashes[4000]  # two keys of one hash
    sizes, bits, order = source_audit.perfect_hash(hashes)
    assert sorted(order.tolist()) == list(range(5000)) and int(bits.sum()) == 4998
    row = {"shard": 0, "shards": 1, "terms": keys.take(pa.array(order)).to_pylist(), "sizes": sizes, "bits": np.packbits(bits).tobytes()}
    index = source_audit.TermIndex([row])
    slots = index.slots(keys, hashes)
    assert sorted(slots.tolist()) == list(range(5000))
    strange = pa.array([f"other{k}" for k in range(5000)], pa.large_string())
    assert set(index.slots(strange, source_audit.term_hashes(strange)).tolist()) == {-1}


def test_scaled_is_exact():
    rng = random.Random(1)
    for _ in range(500):
        total = rng.randrange(6, 9 * 10 ** 15)
        count = rng.randrange(total - 4)
        assert source_audit.scaled(np.array([count]), np.array([total]))[0] == 1 + 10 ** 9 * (count + 5) // total


# ---------------------------------------------------------------------------- secret scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
RULES = [("assign", ASSIGN, lambda m: len(m.group(2)) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
         ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 24)]


def base_spans(text):
    return [(m.start(), k, m.end(), m) for k, (_, rule, good) in enumerate(RULES) for m in rule.finditer(text) if good(m)]


def rest(text):
    for _, rule, good in RULES:
        text = rule.sub(lambda m: " " * len(m.group()) if good(m) else m.group(), text)
    return text


def secrets_brute(texts):
    texts = [t or "" for t in texts]
    labelled = [set(), set()]
    for t in texts:
        labelled[1] |= {m.group(2) if k == 0 else m.group() for _, k, _, m in base_spans(t)}
        labelled[0] |= {x for x in re.findall(secret_scan.IDENTIFIER, rest(t)) if len(x) < secret_scan.LONG}
    ratio = None
    if min(map(len, labelled)) >= secret_scan.LEAST_TOKENS:
        pairs = [Counter(p for t in tokens for p in zip(t, t[1:])) for tokens in labelled]
        first = [Counter(p for t in tokens for p in t[:-1]) for tokens in labelled]
        side, back, even = len(secret_scan.ALPHABET) + 1, secret_scan.BACKOFF, secret_scan.EVEN
        last = Counter(p for t in labelled[0] for p in t[1:])
        every = sum(last.values()) + side * secret_scan.SMOOTH
        def ratio(a, b):
            plain = (pairs[0][a, b] + back * (last[b] + secret_scan.SMOOTH) / every) / (first[0][a] + back)
            chance = (1 - even) * (pairs[1][a, b] + back / side) / (first[1][a] + back) + even / side
            return round(1000 * math.log(chance / plain))
    out = []
    for t in texts:
        spans = [(s, k, e) for s, k, e, _ in base_spans(t)]
        n = [sum(1 for x in spans if x[1] == k) for k in range(3)]
        extra = [] if ratio is None else [
            (m.start(), 3, m.end()) for m in re.finditer(secret_scan.CANDIDATE, rest(t))
            if sum(ratio(a, b) for a, b in zip(m.group(), m.group()[1:])) > round(1000 * secret_scan.LOG_ODDS)]
        say = lambda x: ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(x))
        out.append((*n, len(extra), hashlib.sha256(say(spans).encode()).hexdigest(), say(spans + extra)))
    return out


def secret_texts():
    rng = random.Random(5)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    noise = lambda n, of=chars: "".join(rng.choice(of) for _ in range(n))
    texts = [None, "", " \n", "token", "secret=token :abcdef", "TOKEN == x", "pass​word=abcdefg", "api_key: 'abcdef' apikey=\"abc-de\" Api_Key=12345",
             "😀 password = \"hunter22\" é secret:short Passwd='ab+/=.-_'", "AKIA" + "A" * 15, "xAKIA" + "Z9" * 8 + "b", "token=" + "0123456789abcdef" * 3,
             "f" * 23, "g" + "0f" * 12 + "g", "toKen=abcdefg ſecret=abcdefg toKen=zzzzzzz", "token=token=abcdefg"]
    texts += [f"{prose(rng, 20)} {noise(40)} {prose(rng, 20)}" for _ in range(10)]
    texts += [f"{prose(rng, 30)} {kind}{noise(32, '0123456789abcdef')} {prose(rng, 8)}" for kind in ("token = '", "", "secret: ") for _ in range(15)]
    texts += [prose(rng, 60) + " incomprehensibilityofthesewords notwithstandingcorpusfilterHaus" for _ in range(10)]
    texts += [" ".join("abcdef0123456789" * 2 for _ in range(700)), "the " * 30000 + noise(30)]
    return texts


def test_secret_scan(spark, empty):
    texts = secret_texts()
    docs = spark.createDataFrame(rows_of(list(enumerate(texts)) + [(None, "token=abcdefg"), (3, "token"), (3, "token")]), SCHEMA).repartition(4)
    found = sorted((tuple(r) for r in secret_scan.find_secrets(docs).collect()), key=repr)
    ids = [*range(len(texts)), None, 3, 3]
    expected = secrets_brute(texts + ["token=abcdefg", "token", "token"])
    assert found == sorted(((i, *e) for i, e in zip(ids, expected)), key=repr)
    by_id = {i: e for i, e in zip(ids, expected)}
    n = next(k for k, t in enumerate(texts) if t and t.startswith("token=token="))
    for k in range(n + 1, n + 11):  # the random strings are found, the long words are not
        assert by_id[k][3] == 1
    assert all(by_id[k][3] == 0 for k in range(n + 1 + 10 + 45, n + 1 + 10 + 45 + 10))
    assert secret_scan.find_secrets(empty).count() == 0


def test_without_labelled_secrets(spark):
    docs = spark.createDataFrame(rows_of([(1, "QwErTy0123456789zzZ9x8Y7" * 2), (2, "token=abcdefg")]), SCHEMA)
    rows = {r["doc_id"]: r for r in secret_scan.find_secrets(docs).collect()}
    assert rows[1]["spans"] == "" and rows[2]["spans"] == "assign:0:13"


def test_running_sums(spark):
    for n in (0, 1, 63, 64, 65, 1000):
        row = spark.range(1).select(secret_scan.running_sums(F.array(*[F.lit(k).cast("long") for k in range(n)]).cast("array<bigint>")).alias("s")).first()
        assert row["s"] == np.cumsum(range(n)).tolist()


# ---------------------------------------------------------------------------- conversation repair

CONVERSATIONS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                              T.StructField("text", T.StringType()), *[T.StructField(c, T.StringType()) for c in ("audit", "cost", "rid", "block", "h1", "first")]])
KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
NEXT, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")


def cheapest(rows):
    """Least (cost, audit, repaired rows) of (role, text, must go, truncated), by forward search over prefixes."""
    def inserted(best):
        for _ in range(3):
            for q in list(best):
                c, a, t = best[q]
                new = (c + 5, a + "I", t + [f"{ROLE[q]}:"])
                if NEXT[q] not in best or new[:2] < best[NEXT[q]][:2]:
                    best[NEXT[q]] = new
        return best
    best = inserted({0: (0, "", [])})
    for role, text, gone, cut in rows:
        step = {}
        def offer(q, x):
            if q not in step or x[:2] < step[q][:2]:
                step[q] = x
        for q, (c, a, t) in best.items():
            offer(q, (c + 2, a + "D", t))
            if not gone:
                offer(NEXT[q], (c + 1 + 5 * cut, a + "R", t + [f"{ROLE[q]}:{text}"]))
                if (role[:1], q) in KEEP:
                    offer(KEEP[role[:1], q], (c + 5 * cut, a + "K", t + [f"{role}:{text}"]))
        best = inserted(step)
    return min((best[q] for q in (0, 3) if q in best), key=lambda x: x[:2])


def repair_brute(rows, damaged=True):
    groups, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        say = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20 if damaged else 19
        role, text = say(role), say(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv in ids:
        found = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
        turns = [r[0] for r in found if r[0] is not None]
        seen, marked, n = set(), [], Counter()
        for _, role, text in found:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit, lines = cheapest(marked)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def conversation_rows():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "cut off", "", "  \n", "Why? ", "é😀.", "a.\u0085", " ", "line\nline.\n", "x" * 5000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u", "assistant", "user"]
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 9)):
            if rng.random() < 0.9:
                rows.append((conv, turn * rng.choice([1, 1, 1, 2]) if rng.random() < 0.97 else None,
                             rng.choice(roles) if rng.random() < 0.6 else roles[turn % 2], rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    rows += [(None, t, "user", "Null conversation.") for t in range(5)] + [(500, None, r, "No turn.") for r in ("user", "assistant")]
    rows += [(501, 7, "user", "Same row.")] * 40 + [(501, 8, "assistant", "Same row.")] * 3 + [(501, 9, "user", "Same row.")] * 2
    rows += [(600, t, ("user", "assistant", "user", "system", "tool")[t % 7 % 5], rng.choice(texts[:3]) + str(t) + rng.choice([".", ""])) for t in range(300)]
    dropped = next(k for k in range(1000, 2000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "Dropped."), (2001, -(2 ** 40), "user", "Far."), (2001, 2 ** 40, "assistant", None)]
    # rows of one turn and role go by a hash of the text: keep one text each
    one = {}
    for r in rows:
        one.setdefault((r[0], r[1], r[2] if r[2] is not None else " "), r[3])
    return [(c, t, r, one[c, t, r if r is not None else " "]) for c, t, r, _ in rows if zlib.crc32(f"{c}:{t}".encode()) % 20 != 4 or r == "user"]


@pytest.fixture(scope="module")
def conversations(spark):
    rows = conversation_rows()
    return rows, spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], CONVERSATIONS).repartition(5)


@pytest.mark.parametrize("bits", [16, 2])
def test_conversation_repair(conversations, bits):
    """Whole conversations in a block, and conversations over many blocks of four rows."""
    rows, df = conversations
    assert got(conversation_repair.repair(df, bits=bits)) == want(repair_brute(rows))


def test_repair_without_damage(spark, conversations):
    rows, df = conversations
    assert got(conversation_repair.repair(df, damaged=False)) == want(repair_brute(rows, False))
    assert conversation_repair.repair(df.limit(0)).count() == 0


def test_rows_of_one_turn(spark):
    """Different texts of one turn and role: any order, but the same in every run."""
    rows = [(1, 0, "user", f"Text {k}.") for k in range(6)] + [(1, 1, "assistant", "End.")]
    runs = {tuple(got(conversation_repair.repair(spark.createDataFrame([(*r, *["c"] * 6) for r in rows], CONVERSATIONS).repartition(n), damaged=False)))
            for n in (1, 4)}
    assert len(runs) == 1
