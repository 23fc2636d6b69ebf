"""Profiles of a set of queried articles.

Each metric is one aggregate with partial (map-side) aggregation.  The profile
record (E11) takes them all from one pass; the only collected lists are bounded: the
top-k sources (k rows) and the occurrence distribution (one entry per distinct
occurrence count).  "First encountered" tie-breaks use the smallest article
``number`` (the order the articles are listed in).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import extract_domain
from ..session import checkpoint
from .days import profile_rows


def _truthy(c: str):
    return F.col(c).isNotNull() & (F.col(c) != "")


def domain_counts(df: DataFrame) -> DataFrame:
    """E5: articles per URL domain (articles with a URL only)."""
    return (df.where(_truthy("url"))
              .groupBy(extract_domain("url").alias("domain"))
              .agg(F.count(F.lit(1)).alias("articles"), F.min("number").alias("first_number")))


def top_sources(df: DataFrame, k: int = 5) -> DataFrame:
    """The k domains with most articles; ties -> first encountered."""
    w = Window.orderBy(F.col("articles").desc(), F.col("first_number").asc())
    return (domain_counts(df).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k).select("rank", "domain", "articles"))


# Items that a heavy-hitter sketch tracks, and its error: an item that it does not
# track has at most SKETCH_ERROR / items of all rows (frequent-items sketch of a hash
# map with at least items / 0.75 places and an error of 3.5 / places).
SKETCH_ITEMS = 10_000
SKETCH_ERROR = 3.5 * 0.75


def source_sketch(df: DataFrame, by: list[str] | None = None, items: int = SKETCH_ITEMS) -> DataFrame:
    """Mergeable heavy-hitter sketches of the domains, of bounded size (one, or one for each ``by``)."""
    dom = df.where(_truthy("url")).withColumn("_domain", extract_domain("url"))
    return dom.groupBy(*(by or [])).agg(F.expr(f"approx_top_k_accumulate(_domain, {int(items)})").alias("sketch"),
                                        F.count(F.lit(1)).alias("rows"))


def top_sources_bounded(df: DataFrame, k: int = 5, items: int = SKETCH_ITEMS, sketches: DataFrame | None = None) -> DataFrame:
    """G3 with bounded memory: a sketch names the candidates, a second pass counts only these.

    A domain that the sketch does not track has at most rows * SKETCH_ERROR / items
    rows.  When the k-th counted candidate has more than that, none is
    missing, ties included; else (nearly tied domains) all domains are counted as in
    ``top_sources``.  ``sketches`` are those of disjoint parts of ``df``, made earlier.
    """
    sketches = source_sketch(df, items=items) if sketches is None else sketches
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {int(items)})").alias("sketch"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    found = merged.select("rows", F.expr(f"approx_top_k_estimate(sketch, {int(items)})").alias("top")).first()
    if not found["rows"]:
        return top_sources(df, k)
    names = [r["item"] for r in found["top"]]  # at most ``items``
    spark = df.sparkSession
    candidates = F.broadcast(spark.createDataFrame([(x,) for x in names], "_candidate string"))
    dom = df.where(_truthy("url")).withColumn("_domain", extract_domain("url"))
    counted = checkpoint(dom.join(candidates, F.col("_domain") == F.col("_candidate"), "left_semi").groupBy(F.col("_domain").alias("domain"))
                         .agg(F.count(F.lit(1)).alias("articles"), F.min("number").alias("first_number")), "candidates")
    best = counted.orderBy(F.col("articles").desc(), F.col("first_number").asc()).limit(k)
    least = best.agg(F.min("articles").alias("least"), F.count(F.lit(1)).alias("n")).first()
    whole = len(names) < items and found["rows"] <= items  # nothing was ever dropped from the sketch
    if not whole and (least["n"] < k or least["least"] <= found["rows"] * SKETCH_ERROR / items):
        return top_sources(df, k)
    w = Window.orderBy(F.col("articles").desc(), F.col("first_number").asc())  # over k rows
    return best.withColumn("rank", F.row_number().over(w)).select("rank", "domain", "articles")


def unique_sources(df: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Number of distinct domains.  Exact by default; with ``approx_rsd``
    (relative standard deviation, e.g. 0.01) a HyperLogLog++ sketch merges
    per partition instead of shuffling distinct values."""
    dom = extract_domain("url")
    agg = (F.approx_count_distinct(dom, approx_rsd) if approx_rsd is not None
           else F.count_distinct(dom))
    return df.where(_truthy("url")).agg(agg.alias("unique_sources"))


def actual_date_range(df: DataFrame) -> DataFrame:
    """First and last publication day."""
    d = F.to_date("published_date")
    return df.agg(F.min(d).alias("first_day"), F.max(d).alias("last_day"))


def avg_content_length(df: DataFrame) -> DataFrame:
    """Mean content length, truncated to an integer (absent content = 0)."""
    return df.agg(F.avg(F.length(F.coalesce("content", F.lit(""))))
                  .cast("int").alias("avg_content_length"))


def hour_histogram(df: DataFrame) -> DataFrame:
    """Hour of day -> articles."""
    return (df.where(F.col("published_date").isNotNull())
              .groupBy(F.hour("published_date").alias("hour"))
              .agg(F.count(F.lit(1)).alias("articles"), F.min("number").alias("first_number")))


def peak_hour(df: DataFrame) -> DataFrame:
    """The busiest hour (ties -> first encountered), rendered 'HH:00 (n articles)'."""
    h = hour_histogram(df).agg(
        F.max_by(F.struct("hour", "articles"),
                 F.struct(F.col("articles"), -F.col("first_number"))).alias("best"))
    hour = F.coalesce(F.col("best.hour"), F.lit(0))
    n = F.coalesce(F.col("best.articles"), F.lit(0))
    return h.select(hour.alias("peak_hour"), n.alias("peak_hour_articles"),
                    F.format_string("%02d:00 (%d articles)", hour, n).alias("peak_publishing_hour"))


def occurrence_distribution(df: DataFrame) -> DataFrame:
    """E2 over queried articles: occurrences -> number of articles."""
    return df.groupBy("occurrences").agg(F.count(F.lit(1)).alias("articles"))


def profile_articles(df: DataFrame, start, end, k: int = 5, generated_at=None,
                     source_file: str | None = None) -> DataFrame:
    """Every metric of a queried range as one row (no row when empty).

    ``top_sources`` and ``occurrence_distribution`` are also rendered as text
    (``domain: n`` joined by '; ', ascending ``occ: n``) for flat comparison.
    All metrics come from one grouped pass over the articles (``days.profile_rows``).
    """
    return profile_rows(df, F.col("number"), start, end, k, generated_at, source_file)


def source_counts(selection: DataFrame, period: list[str] | None = None) -> DataFrame:
    """Selected articles per source, count desc, ties -> first in selection."""
    p = list(period or [])
    g = selection.groupBy(*p, "source").agg(F.count(F.lit(1)).alias("articles"),
                                            F.min("position").alias("first_position"))
    w = (Window.partitionBy(*p) if p else Window.partitionBy()).orderBy(
        F.col("articles").desc(), F.col("first_position").asc())
    return g.withColumn("source_rank", F.row_number().over(w))


def topic_counts(selection: DataFrame, period: list[str] | None = None, k: int | None = 3) -> DataFrame:
    """E13 + G4: selected articles per topic, count desc, ties -> first in selection."""
    p = list(period or [])
    g = selection.groupBy(*p, "topic").agg(F.count(F.lit(1)).alias("articles"),
                                           F.min("position").alias("first_position"))
    w = (Window.partitionBy(*p) if p else Window.partitionBy()).orderBy(
        F.col("articles").desc(), F.col("first_position").asc())
    out = g.withColumn("topic_rank", F.row_number().over(w))
    return out.where(F.col("topic_rank") <= k) if k else out
