"""Day summaries: mergeable partial aggregates per publication day.

One table (day, metric, key, n, first, sketch) holds what E2 and E5-E11 and F1 need of
a day; a date range sums its day rows and reads no article:

* ``articles``                the number of articles; ``sketch`` counts the day's domains
* ``characters``              the sum of content lengths
* ``occurrences``  key=count  articles seen that often
* ``hour``         key=hour   articles of that hour
* ``domain``       key=domain articles of that domain

``first`` is the place of the first listed article (newest first, ties in arrival
order) among those counted: what decides ties.  Undated articles
belong to no day and no range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extract_domain
from ..session import checkpoint
from .filters import day_bounds, filter_date_range
from .ordering import number_articles


def listed() -> Column:
    """Newest first, ties in arrival order, as a struct that sorts that way."""
    return F.struct((-F.unix_micros(F.col("published_date").cast("timestamp"))).alias("age"), "feed_no", "entry_no")


def _counts(articles: DataFrame, at: Column) -> DataFrame:
    """(day, at, domain, metric, key, n): what every article adds to the metrics."""
    domain = F.when(F.col("url") != "", extract_domain("url"))
    rows = articles.select(
        F.to_date("published_date").alias("day"), at.alias("at"), domain.alias("domain"), F.hour("published_date").alias("hour"),
        "occurrences", F.length(F.coalesce("content", F.lit(""))).cast("long").alias("characters"))
    one = lambda metric, key, n: F.struct(F.lit(metric).alias("metric"), key.cast("string").alias("key"), n.cast("long").alias("n"))
    none = F.lit(None)
    parts = F.array(one("articles", none, F.lit(1)), one("characters", none, F.col("characters")), one("occurrences", F.col("occurrences"), F.lit(1)),
                    one("hour", F.col("hour"), F.lit(1)), one("domain", F.col("domain"), F.lit(1)))
    return rows.select("day", "at", "domain", F.inline(parts)).where("metric NOT IN ('domain', 'hour') OR key IS NOT NULL")


def summarize_days(articles: DataFrame) -> DataFrame:
    """The summary of every day of ``articles`` (unique articles with occurrences)."""
    # the sketch passes over empty strings, and an address without a host has the domain ""
    named = F.when(F.col("metric") == "articles", F.concat(F.lit("/"), "domain"))
    return _counts(articles.where("published_date IS NOT NULL"), listed()).groupBy("day", "metric", "key").agg(
        F.sum("n").alias("n"), F.min("at").alias("first"), F.hll_sketch_agg(named).alias("_sketch")).select(
        "day", "metric", "key", "n", "first", F.when(F.col("metric") == "articles", F.col("_sketch")).alias("sketch"))


def merge_summaries(one: DataFrame, two: DataFrame) -> DataFrame:
    """The summary of two disjoint sets of articles."""
    return one.unionByName(two).groupBy("day", "metric", "key").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.hll_union_agg("sketch").alias("sketch"))


def _range(summary: DataFrame, start, end) -> DataFrame:
    lo, hi = day_bounds(start, end)
    return summary.where((F.col("day") >= F.lit(lo.date())) & (F.col("day") < F.lit(hi.date())))


def profile_days(summary: DataFrame, start, end, k: int = 5, generated_at=None, source_file: str | None = None) -> DataFrame:
    """E11 of a date range from its day rows, as ``profile.profile_articles`` gives it (no row when empty)."""
    days = _range(summary, start, end)
    merged = days.groupBy("metric", "key").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.min("day").alias("first_day"),
                                               F.max("day").alias("last_day"))
    return _record(merged, start, end, k, generated_at, source_file)


def profile_rows(articles: DataFrame, at: Column, start, end, k: int = 5, generated_at=None, source_file: str | None = None) -> DataFrame:
    """The same record straight from articles, in one grouped pass over them; ``at`` orders them."""
    merged = _counts(articles, at).groupBy("metric", "key").agg(F.sum("n").alias("n"), F.min("at").alias("first"), F.min("day").alias("first_day"),
                                                               F.max("day").alias("last_day"))
    return _record(merged, start, end, k, generated_at, source_file)


def _record(merged: DataFrame, start, end, k: int, generated_at, source_file) -> DataFrame:
    """The profile record from the merged metrics: a row for each domain, hour and occurrence count."""
    merged = checkpoint(merged, "metrics")
    of = lambda metric: F.col("metric") == metric
    value = lambda metric, c: F.max(F.when(of(metric), F.col(c)))
    hour = F.struct(F.col("key").cast("int").alias("hour"), "n")
    # the longest list is that of occurrence counts: one entry for each distinct count
    rec = merged.where(~of("domain")).agg(
        value("articles", "n").alias("total_articles"), value("characters", "n").alias("characters"),
        value("articles", "first_day").alias("d0"), value("articles", "last_day").alias("d1"),
        F.min_by(F.when(of("hour"), hour), F.when(of("hour"), F.struct((-F.col("n")).alias("o"), "first"))).alias("peak"),
        F.sort_array(F.collect_list(F.when(of("occurrences"), F.struct(F.col("key").cast("long").alias("occurrences"), F.col("n").alias("articles"))))).alias("occ"))
    top = merged.where(of("domain")).orderBy(F.col("n").desc(), F.col("first").asc()).limit(k)
    top = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "first", F.col("key").alias("domain"), F.col("n").alias("articles")))).alias("top"))
    sources = merged.where(of("domain")).agg(F.count(F.lit(1)).alias("unique_sources"))
    text = lambda c, a, b: F.array_join(F.transform(c, lambda s: F.concat(s[a].cast("string"), F.lit(": "), s[b].cast("string"))), "; ")
    busiest = F.coalesce("peak.hour", F.lit(0)), F.coalesce("peak.n", F.lit(0))
    return rec.crossJoin(top).crossJoin(sources).where("total_articles > 0").select(  # three one-row frames
        F.lit(f"{start} to {end}").alias("query_date_range"), "total_articles",
        F.when(F.col("d0").isNotNull(), F.concat_ws(" to ", F.date_format("d0", "yyyy-MM-dd"), F.date_format("d1", "yyyy-MM-dd")))
         .otherwise(F.lit("N/A")).alias("actual_date_range"), "unique_sources",
        F.transform("top", lambda s: F.struct(s["domain"].alias("domain"), s["articles"].alias("articles"))).alias("top_sources"),
        text("top", "domain", "articles").alias("top_sources_text"), F.map_from_entries("occ").alias("occurrence_distribution"),
        text("occ", "occurrences", "articles").alias("occurrence_distribution_text"),
        (F.col("characters") / F.col("total_articles")).cast("int").alias("avg_content_length"),
        F.format_string("%02d:00 (%d articles)", *busiest).alias("peak_publishing_hour"),
        F.lit(None if generated_at is None else str(generated_at)).cast("string").alias("generated_at"), F.lit(source_file).cast("string").alias("source_file"))


def unique_sources_days(summary: DataFrame, start, end) -> DataFrame:
    """E6 of a date range from the days' sketches alone (an estimate, about 1 % off)."""
    return _range(summary, start, end).where("metric = 'articles'").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_sources"))


def number_days(articles: DataFrame, summary: DataFrame, start, end) -> DataFrame:
    """F1 for a date range of stored articles: numbers as in the whole table.

    The rows per day are an order-statistic index: newest first, what precedes a range is the
    sum of the newer days' counts.  Of the articles only the range is read (C1
    prunes the stored days) and only its keys are sorted.
    """
    _, hi = day_bounds(start, end)
    newer = summary.where((F.col("metric") == "articles") & (F.col("day") >= F.lit(hi.date()))).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_newer"))
    inside = filter_date_range(articles, start, end)
    keys = number_articles(inside.select("article_key", "published_date", "feed_no", "entry_no"))
    numbers = keys.crossJoin(newer).select("article_key", (F.col("_newer") + F.col("number")).alias("number"))  # one-row side
    return inside.drop("number").join(numbers, "article_key")
