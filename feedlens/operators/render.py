"""Rendered outputs: digest script, trends and sources text, link posts
(R1-R5, D1, E14).

Documents are built per period with ``collect_list`` over the selection, which
holds at most 18 rows per period (6 main + 12 quick), so no group is unbounded.
Text is assembled with ``array_join`` on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import (link_line, strip_tags, strip_ws, summary_brief, summary_detailed,
                              topic_label)
from .profile import source_counts, topic_counts

# ---------------------------------------------------------------------------
# Fixed values (document texts that must equal the reference's output)
# ---------------------------------------------------------------------------
SCRIPT_TITLE = "=== BIOTECH WEEKLY PODCAST ==="
SCRIPT_WELCOME = ("Welcome to this week's biotech news roundup. I'm your host, and today we're "
                  "covering the latest developments in biotechnology, from breakthrough discoveries "
                  "to industry updates.")
MAIN_HEADER = "=== MAIN STORIES ==="
STORY_RULE = "---"
QUICK_HEADER = "=== QUICK HITS ==="
QUICK_INTRO = "Now for some quick updates from around the biotech world:"
QUICK_BULLET = "• "
TRENDS_HEADER = "=== TRENDS & INSIGHTS ==="
SCRIPT_CLOSING = ("That wraps up this week's biotech news. Thanks for listening, and we'll see you "
                  "next week with more updates from the world of biotechnology.")
TRENDS_OPEN = "Looking at this week's developments, "
TRENDS_FOCUS = "the focus has been on {} research, "
TRENDS_SECOND = "followed by {}. "
TRENDS_SINGLE = "showing a concentrated effort in this area. "
TRENDS_SOURCES = "We're seeing coverage from {} different sources, "
TRENDS_CLOSE = "indicating broad industry interest in these developments."
SOURCES_HEADER = "=== SOURCES SUMMARY ==="
SOURCES_INTRO = "This podcast was compiled from the following sources:"
SOURCES_TOTAL = "Total sources: {}"
ARTICLES_TOTAL = "Total articles: {}"
NO_SELECTION = "No articles selected for podcast generation."
POST_TITLE = "🔬 This Week's Top Biotech News"
POST_INTRO = "Here are the key developments in biotechnology this week:"
POST_INTRO_COMPACT = "Key developments in biotechnology:"
POST_TAGS = "#Biotech #Biotechnology #Science #Innovation #Healthcare #Research"
POST_NO_TITLES = "No articles found in podcast."
POST_NO_MAP = "No article data available for URL mapping."
STORY_PREFIX = "Story "
# ---------------------------------------------------------------------------


def _lit_lines(*lines: str) -> Column:
    return F.array(*[F.lit(s) for s in lines])


def _group(df: DataFrame, p: list[str]):
    return df.groupBy(*p) if p else df.groupBy()


def _join_period(left: DataFrame, right: DataFrame, p: list[str]) -> DataFrame:
    return left.join(right, on=p, how="left") if p else left.crossJoin(right)


def trends_sentence(selection: DataFrame, period: list[str] | None = None) -> DataFrame:
    """R2: the trends paragraph from the top two topics and the source count."""
    p = list(period or [])
    tops = topic_counts(selection, p, k=2)
    t = _group(tops, p).agg(
        F.max(F.when(F.col("topic_rank") == 1, F.col("topic"))).alias("t1"),
        F.max(F.when(F.col("topic_rank") == 2, F.col("topic"))).alias("t2"))
    s = _group(selection, p).agg(F.count_distinct("source").alias("n_sources"))
    both = s.join(t, on=p, how="left") if p else s.crossJoin(t)
    focus = F.when(F.col("t1").isNotNull(), F.concat(
        F.lit(TRENDS_FOCUS.split("{}")[0]), topic_label("t1"), F.lit(TRENDS_FOCUS.split("{}")[1]),
        F.when(F.col("t2").isNotNull(), F.concat(F.lit(TRENDS_SECOND.split("{}")[0]), topic_label("t2"),
                                                 F.lit(TRENDS_SECOND.split("{}")[1])))
         .otherwise(F.lit(TRENDS_SINGLE)))).otherwise(F.lit(""))
    text = F.concat(F.lit(TRENDS_OPEN), focus,
                    F.lit(TRENDS_SOURCES.split("{}")[0]), F.col("n_sources").cast("string"),
                    F.lit(TRENDS_SOURCES.split("{}")[1]), F.lit(TRENDS_CLOSE))
    return both.select(*p, text.alias("trends"))


def sources_section(selection: DataFrame, period: list[str] | None = None) -> DataFrame:
    """The sources summary block (lines joined by newlines)."""
    p = list(period or [])
    sc = source_counts(selection, p)
    line = F.concat(F.lit(QUICK_BULLET), F.col("source"), F.lit(": "), F.col("articles").cast("string"),
                    F.lit(" article"), F.when(F.col("articles") > 1, F.lit("s")).otherwise(F.lit("")))
    per = _group(sc, p).agg(
        F.sort_array(F.collect_list(F.struct("source_rank", line.alias("line")))).alias("_l"),
        F.count(F.lit(1)).alias("n_sources"), F.sum("articles").alias("n_articles"))
    lines = F.concat(_lit_lines(SOURCES_HEADER, "", SOURCES_INTRO, ""),
                     F.transform("_l", lambda s: s["line"]),
                     F.array(F.lit(""),
                             F.concat(F.lit(SOURCES_TOTAL.format("")), F.col("n_sources").cast("string")),
                             F.concat(F.lit(ARTICLES_TOTAL.format("")), F.col("n_articles").cast("string"))))
    return per.select(*p, F.array_join(lines, "\n").alias("sources_summary"))


def script_lines(selection: DataFrame) -> DataFrame:
    """Per selected article, its lines in the script (story or quick-hit block)."""
    title = F.coalesce(F.col("title"), F.lit(""))
    story = F.array(F.concat(F.lit(STORY_PREFIX), F.col("position").cast("string"), F.lit(": "), title),
                    F.lit(""), summary_detailed("content"), F.lit(""), F.lit(STORY_RULE), F.lit(""))
    quick = F.array(F.concat(F.lit(QUICK_BULLET), title), F.concat(F.lit("  "), summary_brief("content")),
                    F.lit(""))
    return selection.withColumn("lines", F.when(F.col("section") == "story", story).otherwise(quick))


def render_script(selection: DataFrame, period: list[str] | None = None,
                  periods: DataFrame | None = None) -> DataFrame:
    """One script document per period with a non-empty selection; with
    ``periods`` (all period keys), periods without one get the no-selection
    sentence."""
    p = list(period or [])
    if periods is not None:
        out = render_script(selection, p)
        keys = periods.select(*p).distinct() if p else periods.limit(1).select(F.lit(1).alias("_one"))
        if p:
            return keys.join(out, on=p, how="left").select(
                *p, F.coalesce("script", F.lit(NO_SELECTION)).alias("script"))
        return keys.crossJoin(out.select(F.max("script").alias("script"))).select(
            F.coalesce("script", F.lit(NO_SELECTION)).alias("script"))
    blocks = _group(script_lines(selection), p).agg(
        F.sort_array(F.collect_list(F.struct("position", "section", "lines"))).alias("_b"))
    stories = F.flatten(F.transform(F.filter("_b", lambda s: s["section"] == "story"), lambda s: s["lines"]))
    quicks = F.flatten(F.transform(F.filter("_b", lambda s: s["section"] != "story"), lambda s: s["lines"]))
    doc = _join_period(_join_period(blocks, trends_sentence(selection, p), p), sources_section(selection, p), p)
    lines = F.concat(
        _lit_lines(SCRIPT_TITLE, "", SCRIPT_WELCOME, "", MAIN_HEADER, ""),
        stories,
        F.when(F.size(quicks) > 0, F.concat(_lit_lines(QUICK_HEADER, "", QUICK_INTRO, ""), quicks))
         .otherwise(F.array().cast("array<string>")),
        _lit_lines(TRENDS_HEADER, ""), F.array(F.col("trends")),
        _lit_lines("", SCRIPT_CLOSING, ""), F.array(F.col("sources_summary")))
    return doc.select(*p, F.array_join(lines, "\n").alias("script"))


def extract_script_titles(scripts: DataFrame, period: list[str] | None = None,
                          col: str = "script") -> DataFrame:
    """Titles named in script documents, in order: 'Story n: t' lines before
    the quick-hits header, then '• t' lines up to the next '===' line; tags
    stripped.  One window per document (its lines), never across documents."""
    p = list(period or [])
    lines = scripts.select(*p, F.posexplode(F.split(F.col(col), "\n")).alias("line_no", "raw"))
    lines = lines.withColumn("line", strip_ws("raw"))
    w = (Window.partitionBy(*p) if p else Window.partitionBy()).orderBy("line_no") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_marker = F.col("line") == QUICK_HEADER
    lines = lines.withColumn("in_quick", F.max(is_marker.cast("int")).over(w) > 0)
    lines = lines.withColumn("past_quick", F.max(
        (F.col("in_quick") & ~is_marker & F.col("line").startswith("===")).cast("int")).over(w) > 0)
    story = ~F.col("in_quick") & F.col("line").startswith(STORY_PREFIX) & (F.instr("line", ":") > 0)
    quick = (F.col("in_quick") & ~F.col("past_quick") & ~is_marker
             & F.col("line").startswith(QUICK_BULLET) & ~F.col("line").startswith(QUICK_BULLET + "="))
    title = F.when(story, strip_ws(F.expr("substr(line, instr(line, ':') + 1)"))) \
             .when(quick, strip_ws(F.expr(f"substr(line, {len(QUICK_BULLET) + 1})")))
    out = lines.where(story | quick).select(*p, "line_no", strip_tags(title).alias("title"))
    wp = (Window.partitionBy(*p) if p else Window.partitionBy()).orderBy("line_no")
    return out.withColumn("position", F.row_number().over(wp).cast("int")).drop("line_no")


def title_url_map(articles: DataFrame, period: list[str] | None = None) -> DataFrame:
    """Title -> URL, the last listed article wins; rows lacking either
    are dropped.  Keys are tag-stripped like the titles they are matched with."""
    p = list(period or [])
    ok = F.col("title").isNotNull() & (F.col("title") != "") & F.col("url").isNotNull() & (F.col("url") != "")
    return (articles.where(ok).groupBy(*p, strip_tags("title").alias("title"))
            .agg(F.max_by("url", "number").alias("url")))


def attach_links(titles: DataFrame, url_map: DataFrame, period: list[str] | None = None) -> DataFrame:
    """Each title with its URL when known (left outer equi-join)."""
    p = list(period or [])
    return titles.join(url_map, on=[*p, "title"], how="left")


def link_post(linked: DataFrame, period: list[str] | None = None, compact: bool = False,
              have_map: DataFrame | None = None, periods: DataFrame | None = None) -> DataFrame:
    """The link post per period, standard or compact.  Periods whose URL map
    is empty get the no-data sentence (pass ``have_map`` = periods with a map);
    with ``periods`` (all period keys), periods whose script names no article
    get the no-titles sentence."""
    p = list(period or [])
    if periods is not None:
        out = link_post(linked, p, compact, have_map)
        if p:
            return periods.select(*p).distinct().join(out, on=p, how="left").select(
                *p, F.coalesce("post", F.lit(POST_NO_TITLES)).alias("post"))
        return periods.limit(1).select(F.lit(1).alias("_one")).crossJoin(
            out.select(F.max("post").alias("post"))).select(
            F.coalesce("post", F.lit(POST_NO_TITLES)).alias("post"))
    line = link_line("position", "title", "url")
    per = _group(linked, p).agg(F.sort_array(F.collect_list(F.struct("position", line.alias("line"))))
                                .alias("_l"))
    items = F.transform("_l", lambda s: s["line"])
    if compact:
        body = F.concat(_lit_lines(POST_TITLE, "", POST_INTRO_COMPACT, ""), items, _lit_lines("", POST_TAGS))
    else:
        spaced = F.flatten(F.transform("_l", lambda s: F.array(s["line"], F.lit(""))))
        body = F.concat(_lit_lines(POST_TITLE, "", POST_INTRO, ""), spaced, _lit_lines(POST_TAGS))
    text = F.array_join(body, "\n")
    if have_map is not None:
        per = _join_period(per, have_map.withColumn("_has_map", F.lit(True)), p) if p else \
            per.crossJoin(have_map.agg((F.count(F.lit(1)) > 0).alias("_has_map")))
        text = F.when(F.coalesce(F.col("_has_map"), F.lit(False)), text).otherwise(F.lit(POST_NO_MAP))
    return per.select(*p, text.alias("post"))
