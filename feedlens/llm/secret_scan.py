"""Secret scan: fixed rules, and character Markov models for what they miss (native).

Two first-order Markov models over the characters of tokens are trained from
samples that the rules label: the secrets they find (random strings), and the
tokens of the rest of the text (ordinary identifiers).  A long token outside the
rules' spans is a secret when the log-likelihood ratio of the two models
says so.  Texts are read once; no user function runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import let, sha256_hex, text_of
from feedlens.session import checkpoint, discard

# ---------------------------------------------------------------------------
# The rules, and the kinds in the order that breaks ties
# ---------------------------------------------------------------------------
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 6
#: Runs of the rules' characters are maximal, so the least length may stand in
#: the pattern: AKIA and 16 more, 24 hexadecimal digits.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEYWORDS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")
# ---------------------------------------------------------------------------

#: What the models judge: tokens of at least LONG of these characters.  What
#: they learn ordinary identifiers from: shorter ones, since the long are not labelled.
LONG = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LONG},}}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{6,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_SIDE = len(ALPHABET) + 1  # 0: any other character

#: Bounds of the labelled sample: distinct tokens of each label, and texts that
#: the identifiers come from (those with the smallest hashes).
TRAIN_TOKENS = 20_000
TRAIN_TEXTS = 2_000
#: A character pair's probability leans on this many pairs drawn from what the
#: model falls back on: for ordinary tokens the single characters (each counted
#: SMOOTH times more), for random strings any character alike, which also makes
#: up EVEN of their model, for the labelled secrets may know one alphabet only.
BACKOFF = 5.0
SMOOTH = 0.5
EVEN = 0.5
#: How much likelier (natural log) a secret must be: one token in 10,000 is one.
LOG_ODDS = math.log(10_000)
#: A model of fewer random strings than this judges nothing.
LEAST_TOKENS = 20
_CHUNK = 64


def running_sums(numbers: Column) -> Column:
    """Prefix sums of an array, in chunks so that the work stays near linear."""
    def chunked(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x))
        before = F.aggregate(totals, F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all")),
                             lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["all"], F.array(a["sum"])).alias("all")),
                             lambda a: a["all"])
        return let(before, lambda base: F.flatten(F.transform(chunks, lambda c, k: F.transform(
            c, lambda x, j: base[k] + F.aggregate(F.slice(c, 1, j + 1), F.lit(0).cast("long"), lambda a, y: a + y)))))
    count = F.ceil(F.size(numbers) / _CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(1), count), lambda k: F.slice(numbers, (k - 1) * _CHUNK + 1, F.lit(_CHUNK)))
    return F.when(F.size(numbers) == 0, F.array().cast("array<bigint>")).otherwise(let(chunks, chunked))


_SPANS = "array<struct<start:bigint,kind:int,end:bigint,match:string>>"


def spans(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end, match), code points, end exclusive."""
    def place(found: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(pieces, found, lambda p, m: (F.length(p) + F.length(m)).cast("long"))
        return F.when(F.size(found) == 0, F.array().cast(_SPANS)).otherwise(F.zip_with(found, running_sums(steps), lambda m, end: F.struct(
            (end - F.length(m)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m.alias("match"))))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def _value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 2)


def _without(text: Column, pattern: str, goes) -> Column:
    """The text with the matches that ``goes`` accepts turned into as many spaces."""
    def blank(found: Column) -> Column:
        parts = F.zip_with(F.split(text, pattern, -1), found, lambda p, m: F.concat(
            p, F.coalesce(F.when(goes(m), F.repeat(F.lit(" "), F.length(m))).otherwise(m), F.lit(""))))
        return F.when(F.size(found) == 0, text).otherwise(F.array_join(parts, ""))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), blank)


def _has_keyword(text: Column) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for word in KEYWORDS:
        out = out | low.contains(word)
    return out


def _long_enough(match: Column) -> Column:
    return F.length(_value(match)) >= ASSIGN_CHARS


def _always(match: Column) -> Column:
    return match.isNotNull()


def rest_of(text: Column) -> Column:
    """The text with the rules' matches blanked."""
    text = F.when(_has_keyword(text), _without(text, ASSIGN, _long_enough)).otherwise(text)
    text = let(text, lambda t: F.when(t.contains("AKIA"), _without(t, ACCESS, _always)).otherwise(t))
    return let(text, lambda t: _without(t, HEX, _always))


def scan(docs: DataFrame) -> DataFrame:
    """One row per input row, without the text: doc_id, the rules' spans
    (``assign``, ``access``, ``hex``) and the candidates of the models."""
    none = F.array().cast(_SPANS)
    text = docs.select("doc_id", text_of().alias("__text"))
    t = F.col("__text")
    assign = F.when(_has_keyword(t), F.filter(spans(t, ASSIGN, 0), lambda x: _long_enough(x["match"]))).otherwise(none)
    access = F.when(t.contains("AKIA"), spans(t, ACCESS, 1)).otherwise(none)
    long = F.regexp_like(t, F.lit(CANDIDATE))
    return text.select("doc_id", assign.alias("assign"), access.alias("access"), spans(t, HEX, 2).alias("hex"),
                       F.when(long, let(rest_of(t), lambda r: spans(r, CANDIDATE, 3))).otherwise(none).alias("candidates"))


# ---------------------------------------------------------------------------- models

def samples(docs: DataFrame, scanned: DataFrame, tokens: int = TRAIN_TOKENS, texts: int = TRAIN_TEXTS) -> DataFrame:
    """(label, token): distinct secrets that the rules found (1) and distinct
    tokens of the rest of ``texts`` texts (0), those of smallest hash."""
    found = scanned.select(F.explode(F.concat(F.transform("assign", lambda x: _value(x["match"])), F.transform("access", lambda x: x["match"]),
                                              F.transform("hex", lambda x: x["match"]))).alias("token"))
    body = docs.select(text_of().alias("text"), F.xxhash64(text_of()).alias("h")).where("text <> ''")
    chosen = body.select("h").distinct().orderBy("h").limit(texts)
    plain = (body.join(F.broadcast(chosen), "h").dropDuplicates(["h"])  # at most ``texts`` hashes
             .select(F.explode(F.regexp_extract_all(rest_of(F.col("text")), F.lit(IDENTIFIER), F.lit(0))).alias("token"))
             .where(F.length("token") < LONG))
    pick = lambda df, label: (df.distinct().orderBy(F.xxhash64("token"), "token").limit(tokens)
                              .select(F.lit(label).alias("label"), "token"))
    return pick(found, 1).unionAll(pick(plain, 0))


def log_ratios(sample: DataFrame) -> list[int] | None:
    """Log-likelihood ratio (random to ordinary, in thousandths) of every
    character after every other; None without enough of both.  What is collected is
    bounded by the square of the alphabet."""
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(F.col("token"), i, F.lit(1)))
    pairs = sample.select("label", F.explode(F.transform(F.sequence(F.lit(0), F.length("token") - 1), lambda i: F.struct(
        F.when(i > 0, place(i)).otherwise(F.lit(-1)).alias("a"), place(i + 1).alias("b")))).alias("p"))
    count = [[[0] * _SIDE for _ in range(_SIDE)] for _ in range(2)]
    tokens = [0, 0]
    for r in pairs.groupBy("label", "p.a", "p.b").count().collect():
        if r["a"] < 0:  # a token's first character
            tokens[r["label"]] += r["count"]
        else:
            count[r["label"]][r["a"]][r["b"]] = r["count"]
    if min(tokens) < LEAST_TOKENS:
        return None
    single = [SMOOTH + sum(row[b] for row in count[0]) for b in range(_SIDE)]
    single = [x / sum(single) for x in single]
    out = []
    for plain, random in zip(*count):
        all_plain, all_random = sum(plain) + BACKOFF, sum(random) + BACKOFF
        for b in range(_SIDE):
            ordinary = (plain[b] + BACKOFF * single[b]) / all_plain
            chance = (1 - EVEN) * (random[b] + BACKOFF / _SIDE) / all_random + EVEN / _SIDE
            out.append(round(1000 * math.log(chance / ordinary)))
    return out


def evidence(token: Column, ratios: list[int]) -> Column:
    """The token's log-likelihood ratio in thousandths."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")  # folded to a literal
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return let(places, lambda p: F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(0),
                                             lambda a, i: a + F.get(table, F.get(p, i - 1) * _SIDE + F.get(p, i))))


def _joined(found: Column) -> Column:
    """kind:start:end by start, then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    bare = F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    return F.array_join(F.transform(F.array_sort(bare), lambda x: F.concat_ws(":", names[x["kind"]], x["start"], x["end"])), ",")


def find_secrets(docs: DataFrame, tokens: int = TRAIN_TOKENS, texts: int = TRAIN_TEXTS, log_odds: float = LOG_ODDS) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_random,
    base_sha256 (of the rules' spans) and spans (all).

    Matches are found in whole texts; null counts as empty and has no spans, and
    repeated rows are scanned each for itself; a null doc_id stays null.  The
    models are trained on at most ``tokens`` distinct tokens of each label; with
    fewer than LEAST_TOKENS of either they add nothing.  An empty table
    gives an empty result; other columns are not read.
    """
    scanned = checkpoint(scan(docs), "secrets")
    sample = checkpoint(samples(docs, scanned, tokens, texts), "secret-samples")
    ratios = log_ratios(sample)
    discard(sample)
    added = F.array().cast(_SPANS) if ratios is None else F.filter(
        "candidates", lambda x: evidence(x["match"], ratios) > round(1000 * log_odds))
    base = F.concat("assign", "access", "hex")
    return scanned.withColumn("random", added).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        sha256_hex(_joined(base)).alias("base_sha256"), _joined(F.concat(base, "random")).alias("spans"))
