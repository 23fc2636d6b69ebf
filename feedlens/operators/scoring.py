"""Impact scoring and topic classification.

The lexicons are tiny literal tables, so the keyword-containment "join"
(article x keyword where text contains keyword) is unrolled into one projection
of ``contains`` tests: no shuffle, no broadcast, codegen'd.  ``article_text``
is computed once per row and referenced by every test.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import article_text, extract_domain

SECONDS_PER_DAY = 86400


def prepare_reporting(df: DataFrame) -> DataFrame:
    """The reporting view of queried articles: ``source`` and
    ``content_length``.  Scores, topics, profiles and summaries read the whole
    ``content``."""
    return (df.withColumn("source", F.coalesce(extract_domain("url"), F.lit("")))
              .withColumn("content_length", F.coalesce(F.length("content"), F.lit(0)).cast("int")))


def _sum(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols) if cols else F.lit(0)


def keyword_score(text: Column, impact: dict[str, int]) -> Column:
    """D4 + the keyword part of I1: sum of weights of contained keywords."""
    return _sum([F.when(text.contains(k), F.lit(w)).otherwise(F.lit(0)) for k, w in impact.items()])


def days_old(published: Column, as_of) -> Column:
    """Whole days between publication and ``as_of``, floored (future < 0)."""
    ref = F.lit(str(as_of)).cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("SECOND", published, ref) / F.lit(SECONDS_PER_DAY))


def impact_score(text: Column, as_of, impact: dict[str, int] = L.IMPACT_KEYWORDS,
                 occurrences="occurrences", content_length="content_length",
                 published="published_date") -> Column:
    """Keywords + 2 x occurrences + long-content bonus + recency bonus."""
    occ = F.coalesce(F.col(occurrences), F.lit(1)) * 2
    longer = F.when(F.coalesce(F.col(content_length), F.lit(0)) > 300, 1).otherwise(0)
    age = days_old(F.col(published), as_of)
    recent = F.when(age <= 1, 2).when(age <= 3, 1).otherwise(0)
    return (keyword_score(text, impact) + occ + longer + recent).cast("double")


def classify_topic(text: Column, topics: dict[str, list[str]] = L.TOPIC_KEYWORDS,
                   default: str = L.DEFAULT_TOPIC) -> Column:
    """Topic with most contained keywords; ties -> earlier topic; none -> default."""
    cands = []
    for prio, (topic, words) in enumerate(topics.items()):
        hits = _sum([F.when(text.contains(w), 1).otherwise(0) for w in words])
        cands.append(F.struct(hits.alias("hits"), F.lit(-prio).alias("neg_priority"),
                              F.lit(topic).alias("topic")))
    best = F.greatest(*cands) if len(cands) > 1 else cands[0]
    return F.when(best["hits"] > 0, best["topic"]).otherwise(F.lit(default))


def score_articles(df: DataFrame, as_of, impact: dict[str, int] = L.IMPACT_KEYWORDS,
                   topics: dict[str, list[str]] = L.TOPIC_KEYWORDS) -> DataFrame:
    """Adds ``impact_score`` and ``topic`` (expects the reporting view)."""
    t = df.withColumn("_text", article_text("title", "content"))
    return (t.withColumn("impact_score", impact_score(F.col("_text"), as_of, impact))
             .withColumn("topic", classify_topic(F.col("_text"), topics))
             .drop("_text"))
