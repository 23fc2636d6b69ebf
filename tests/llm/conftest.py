import random

import pytest
from pyspark.sql import types as T

CLASH = ["size", "shard", "slot", "row", "part", "key", "sig", "n", "hits", "label", "h1", "word", "lines", "p", "block",
         "score", "kept", "keep_id", "ids", "target", "copies", "owner", "token", "anchor", "run", "digest", "h"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in CLASH]])


def rows_of(pairs):
    """(doc_id, text[, source]) to rows of SCHEMA."""
    return [(p[0], p[1], None, p[2] if len(p) > 2 else None, None, *CLASH) for p in pairs]


def prose(rng, n, lines=0.1):
    vocab = ["the", "of", "and", "to", "Haus", "über", "niño", "corpus", "filter", "Straße", "l'eau", "we're", "x1", "42", "日本", "naïve,"]
    words = [rng.choice(vocab) + rng.choice(["", "", "s", "ing", str(rng.randrange(50))]) for _ in range(n)]
    return "".join(w + ("\n" if rng.random() < lines else " ") for w in words).strip()


def odd_pairs():
    """Nulls, empty, blank and long texts, ties, repeated rows, near copies, shared lines and passages."""
    rng = random.Random(7)
    base, passage = prose(rng, 120), prose(rng, 40, 0)
    words = base.split(" ")
    near = " ".join(words[:50] + ["changed"] + words[51:])
    shared = "A line that several documents of this table share"
    pairs = [(None, base, "b"), (None, None), (None, prose(rng, 30)), (1, None, "a"), (2, "", "a"), (3, " \n\t ", "a"), (4, "one"), (5, "one two"),
             (6, "One Two", "b"), (7, base, "a"), (8, base, "a"), (8, base, "a"), (9, near, "b"), (10, base.upper(), "c"),
             (11, prose(rng, 60) + " " + passage + " " + prose(rng, 20)), (12, passage, "c"), (13, prose(rng, 5) + " " + passage),
             (14, "\n".join([shared, prose(rng, 10, 0), "  " + shared.upper() + "\t", "short", "short"]), "a"),
             (15, "\n".join(["short", shared, "", shared])), (16, "\n\n" + prose(rng, 20, 0) + "\r\n" + shared + "\n"),
             (17, "rep rep rep rep " * 40), (18, " \x1f é é ｆｕｌｌ 😀😀 <|endoftext|> '\x00'"), (19, "x" * 3000 + " " + "ab" * 500),
             (20, prose(rng, 20000), "a"), (-5, base.replace(" ", "  "), "b"), (21, "THE!! END!! " * 30, "a"), (22, "a ## b $$ c && " * 20)]
    pairs += [(100 + k, prose(rng, rng.randrange(1, 90)), rng.choice(["a", "b", "c", None])) for k in range(60)]
    copies = [prose(rng, 70)]
    for k in range(25):
        w = copies[0].split(" ")
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(1000)}"
        copies.append(" ".join(w))
    pairs += [(300 + k, c, "a") for k, c in enumerate(copies)]
    return pairs


@pytest.fixture(scope="session")
def pairs():
    return odd_pairs()


@pytest.fixture(scope="session")
def odd(spark, pairs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(rows_of(pairs), SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
