"""Story selection under topic quotas.

The reference walks the score-sorted list once with two caps.  Because the
per-topic coverage only grows when an article is selected, the walk equals a
set of ``row_number`` filters:

* main stories: of the 10 best, those whose rank within their topic (among
  the 10) is <= 2, then the first 6;
* quick hits: of the first 15 articles not chosen as main, those whose rank
  within their topic (among the 15) is <= 3 - main stories of that topic, then
  the first 12.

Everything is per period.  The first window keeps the best 25 per period
(``row_number <= k`` becomes a WindowGroupLimit that also runs before the
shuffle, so a period holding a third of the data ships at most 25 rows per map
task); every later window sees at most 25 rows per period.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint


@dataclass(frozen=True)
class Quotas:
    main_pool: int = 10        # best articles considered for main stories
    main_cap: int = 6          # main stories at most
    main_per_topic: int = 2    # main stories per topic at most
    quick_pool: int = 15       # non-main articles considered for quick hits
    quick_cap: int = 12        # quick hits at most
    total_per_topic: int = 3   # main + quick per topic at most
    story_slots: int = 6       # the script presents the first 6 as stories
    main_seconds: int = 180
    quick_seconds: int = 20


def _order() -> list[Column]:
    return [F.col("impact_score").desc(), F.col("number").asc()]


def select_stories(scored: DataFrame, period: list[str] | None = None,
                   q: Quotas = Quotas()) -> DataFrame:
    """F2 + F3 + F4 + F5 + H2: the selection table, one row per chosen article
    with ``slot`` (main/quick), ``position`` (1.. in selection order) and
    ``section`` (story/quick_hit, by position as the script renders it)."""
    p = list(period or [])
    pw = Window.partitionBy(*p) if p else Window.partitionBy()
    cut = scored.withColumn("rank", F.row_number().over(pw.orderBy(*_order()))) \
                .where(F.col("rank") <= q.main_pool + q.quick_pool)
    # the only step over the full table; the cut (<= 25 rows per period) is
    # written once so the windows and joins below never rescan the input
    cut = checkpoint(cut)

    # F2 main stories
    top = cut.where(F.col("rank") <= q.main_pool)
    top = top.withColumn("topic_rank", F.row_number().over(
        Window.partitionBy(*p, "topic").orderBy("rank"))).where(F.col("topic_rank") <= q.main_per_topic)
    main = top.withColumn("slot_pos", F.row_number().over(pw.orderBy("rank"))) \
              .where(F.col("slot_pos") <= q.main_cap).drop("topic_rank")

    # D3 remaining candidates, F3 quick hits
    rest = cut.join(main.select(*p, "rank"), on=[*p, "rank"], how="left_anti")
    rest = rest.withColumn("rest_pos", F.row_number().over(pw.orderBy("rank"))) \
               .where(F.col("rest_pos") <= q.quick_pool)
    main_topics = main.groupBy(*p, "topic").agg(F.count(F.lit(1)).alias("main_in_topic"))
    rest = rest.join(main_topics, on=[*p, "topic"], how="left") \
               .withColumn("main_in_topic", F.coalesce("main_in_topic", F.lit(0)))
    rest = rest.withColumn("topic_rank", F.row_number().over(
        Window.partitionBy(*p, "topic").orderBy("rank")))
    quick = rest.where(F.col("main_in_topic") + F.col("topic_rank") <= q.total_per_topic) \
                .withColumn("slot_pos", F.row_number().over(pw.orderBy("rank"))) \
                .where(F.col("slot_pos") <= q.quick_cap) \
                .drop("rest_pos", "main_in_topic", "topic_rank")

    n_main = main.groupBy(*p).agg(F.count(F.lit(1)).alias("n_main"))
    main = main.withColumn("slot", F.lit("main")).withColumn("n_main", F.lit(0))
    if p:
        quick = quick.join(n_main, on=p, how="left")
    else:
        quick = quick.crossJoin(n_main)  # one row: the number of main stories
    quick = quick.withColumn("slot", F.lit("quick")).withColumn("n_main", F.coalesce("n_main", F.lit(0)))
    sel = main.unionByName(quick.select(*main.columns))
    sel = sel.withColumn("position", (F.col("slot_pos") + F.col("n_main")).cast("int")) \
             .withColumn("section", F.when(F.col("position") <= q.story_slots, F.lit("story"))
                         .otherwise(F.lit("quick_hit"))) \
             .drop("slot_pos", "n_main")
    return checkpoint(sel)


def estimated_duration(selection: DataFrame, period: list[str] | None = None,
                       q: Quotas = Quotas()) -> DataFrame:
    """180 s per main story + 20 s per quick hit, and minutes to 1 decimal."""
    p = list(period or [])
    g = selection.groupBy(*p) if p else selection.groupBy()
    secs = F.sum(F.when(F.col("slot") == "main", q.main_seconds).otherwise(q.quick_seconds))
    out = g.agg(F.count_if(F.col("slot") == "main").alias("main_stories"),
                F.count_if(F.col("slot") == "quick").alias("quick_hits"),
                secs.cast("long").alias("duration_seconds"))
    return out.withColumn("duration_minutes",
                          F.format_string("%.1f", F.col("duration_seconds") / F.lit(60.0)))
