"""Quality rules as a threshold table compiled into one projection (native).

``MEASURES`` names the ratios, ``RULES`` is the threshold table.  ``compile_rules``
turns the table into Column expressions; no user function runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import WHITE, WHITE_RUN, let, text_of

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = ("the of and to in a is that for it as was with be by on are this "
              "der die das und ist in zu den von mit für im ein eine auf "
              "le la les des et est en un une que pour dans du au par "
              "el los las que y del se por con para una su").split()

#: (measure, lowest, highest); a document passes when every measure is within
#: its limits.  Null means no limit on that side.
RULES = (
    ("mean_word_chars", 2.0, 14.0),      # code points per word
    ("symbol_ratio", None, 0.2),         # symbols per word
    ("stop_word_ratio", 0.01, None),     # stop words per word
    ("repeat_word_ratio", None, 0.3),    # words in repeated 3-word windows per word
    ("dup_line_ratio", None, 0.5),       # repeated lines per line with a word
    ("shout_ratio", None, 0.5),          # upper-case ASCII letters per word character
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _repeated_words(words: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more.

    Pairs (64-bit window hash, position) are sorted, so equal windows are
    neighbours and the work stays n log n however often a window repeats.
    """
    def count(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                            lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))
        def covered(g: Column) -> Column:
            hit = F.filter(g, lambda x, k: ((k > 0) & (F.get(g, k - 1)["h"] == x["h"]))
                           | ((k < F.size(g) - 1) & (F.get(g, k + 1)["h"] == x["h"])))
            at = F.array_sort(F.transform(hit, lambda x: x["i"]))
            return let(at, lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.when(k == F.size(p) - 1, F.lit(3))
                            .otherwise(F.least(F.lit(3), F.get(p, k + 1) - x))),
                F.lit(0).cast("long"), lambda acc, x: acc + x))
        return let(F.sort_array(grams), covered)
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(count(words))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the base rules and the ratios of the threshold table."""
    text = text_of()
    words = F.split(F.btrim(text, F.lit(WHITE)), WHITE_RUN)
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    stop = F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])
    parts = docs.select("doc_id", text.alias("__text"), words.alias("__words"), lines.alias("__lines"))
    counted = parts.select(
        "doc_id",
        F.when(F.col("__words")[0] == "", F.lit(0)).otherwise(F.size("__words")).cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("__text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__lines").cast("long").alias("n_lines"),
        _repeated_words(F.col("__words")).alias("n_repeat_words"),
        F.size(F.filter("__words", lambda w: F.array_contains(stop, F.lower(w)))).cast("long").alias("n_stop_words"),
        F.length(F.regexp_replace("__text", "[^A-Z]+", "")).cast("long").alias("n_upper"))
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        per("word_chars", "n_words").alias("mean_word_chars"), per("n_symbols", "n_words").alias("symbol_ratio"),
        per("n_stop_words", "n_words").alias("stop_word_ratio"),
        per("n_repeat_words", "n_words").alias("repeat_word_ratio"),
        per("n_dup_lines", "n_lines").alias("dup_line_ratio"), per("n_upper", "word_chars").alias("shout_ratio"))


def compile_rules(rules=RULES) -> tuple[Column, Column]:
    """(verdict, names of the failed rules) as expressions over the measures."""
    fails = []
    for name, low, high in rules:
        c = F.col(name)
        over = [x for x in (c < F.lit(low) if low is not None else None,
                            c > F.lit(high) if high is not None else None) if x is not None]
        fails.append((name, reduce(lambda a, b: a | b, over, F.lit(False))))
    failed = F.filter(F.array(*[F.when(x, F.lit(n)) for n, x in fails]), lambda x: x.isNotNull())
    return ~reduce(lambda a, b: a | b, (x for _, x in fails), F.lit(False)), failed


def apply_rules(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per input row: doc_id, the base counts, ``base_failed``, ``kept``
    and ``failed_rules``.

    Null and empty texts have no words, fail the base and are not kept; a null
    doc_id stays null; repeated rows are judged each for itself; an empty
    table gives an empty result; other columns are not read.
    """
    verdict, failed = compile_rules(rules)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & verdict).alias("kept"), failed.alias("failed_rules"))
