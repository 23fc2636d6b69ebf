"""The registered queries: one Spark job per operator of the inventory, each
paired (where SQL can state it) with DuckDB oracle SQL over the same tables.

Every query reads the full test tables through an adapter; fixed parameters
are the ``as_of`` instant and the reporting period below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as TX
from ..operators import dedup, profile
from ..operators import render as R
from ..operators.lexicon_join import lexicon_scores, lexicon_topics
from ..operators.ordering import number_articles, number_in_range
from ..operators.render import (attach_links, extract_script_titles, link_post, render_script,
                                sources_section, title_url_map, trends_sentence)
from ..operators.scoring import classify_topic, impact_score, prepare_reporting, score_articles
from ..operators.selection import estimated_duration, select_stories
from ..sources.adapters import documents_articles, pages_articles
from . import oracle as O
from .jobs import query_period, with_week

AS_OF = O.AS_OF
PERIOD = O.PERIOD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------- shared stages

def _numbered(spark, sf_dir, adapter=documents_articles) -> DataFrame:
    return number_articles(dedup.merge_by_key(adapter(spark, sf_dir)))


def _queried(spark, sf_dir, adapter=documents_articles) -> DataFrame:
    return number_in_range(dedup.merge_by_key(adapter(spark, sf_dir)), *PERIOD)


def _reporting(spark, sf_dir, adapter=documents_articles) -> DataFrame:
    return prepare_reporting(_queried(spark, sf_dir, adapter))


def _scored(spark, sf_dir, impact, topics, adapter=documents_articles, week=False) -> DataFrame:
    s = score_articles(_reporting(spark, sf_dir, adapter), AS_OF, impact, topics)
    return with_week(s) if week else s


def _selection(spark, sf_dir, impact=L.CORPUS_IMPACT_KEYWORDS, topics=L.CORPUS_TOPIC_KEYWORDS,
               week=False) -> DataFrame:
    period = ["week"] if week else []
    return select_stories(_scored(spark, sf_dir, impact, topics, week=week), period)


DOCS, PAGES = O.DOCS, O.PAGES
ART = "feed_no, entry_no, title, url, published_date, content"


# --------------------------------------------------------------------------- A / H: adapters

@register("articles_documents", f"SELECT {ART} FROM ({DOCS}) a")
def q_articles_documents(spark, sf_dir):
    """H1 union of polls + B1 cleaning over every document."""
    return documents_articles(spark, sf_dir)


@register("articles_pages", f"SELECT {ART} FROM ({PAGES}) a")
def q_articles_pages(spark, sf_dir):
    """B1 over raw HTML pages (tags, entities, whitespace)."""
    return pages_articles(spark, sf_dir)


# --------------------------------------------------------------------------- B: keys

def _keys(df: DataFrame) -> DataFrame:
    return df.select("feed_no", "entry_no",
                     TX.normalize_url("url").alias("norm_url"),
                     TX.normalize_title("title").alias("norm_title"),
                     TX.content_hash("content").alias("content_hash"),
                     TX.article_key().alias("article_key"))


def _keys_sql(adapter: str) -> str:
    return (f"SELECT feed_no, entry_no, {O.normalize_url('url')} AS norm_url, "
            f"{O.normalize_title('title')} AS norm_title, {O.content_hash('content')} AS content_hash, "
            f"{O.article_key()} AS article_key FROM ({adapter}) a")


@register("article_keys", _keys_sql(DOCS))
def q_article_keys(spark, sf_dir):
    """B2 normalize_url, B3 normalize_title, B4 content_hash, B5 article_key."""
    return _keys(documents_articles(spark, sf_dir))


@register("article_keys_pages", _keys_sql(PAGES))
def q_article_keys_pages(spark, sf_dir):
    return _keys(pages_articles(spark, sf_dir))


@register("extract_domain", f"SELECT page_id, url, {O.extract_domain('url')} AS domain FROM pages")
def q_extract_domain(spark, sf_dir):
    """B6 over every page URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", TX.extract_domain("url").alias("domain"))


@register("text_functions", f"""
SELECT feed_no, entry_no, {O.preview('content')} AS preview_500, {O.preview('content', 200)} AS preview_200,
       {O.strip_tags('title')} AS title_untagged, {O.article_text()} AS article_text,
       {O.summary_detailed('content')} AS summary_detailed,
       {O.summary_brief('content')} AS summary_brief
FROM ({DOCS}) a""")
def q_text_functions(spark, sf_dir):
    """B7 strip_tags, B8 preview, B9 article_text, B10/B11 summaries."""
    a = documents_articles(spark, sf_dir)
    return a.select("feed_no", "entry_no", TX.preview("content").alias("preview_500"),
                    TX.preview("content", 200).alias("preview_200"),
                    TX.strip_tags("title").alias("title_untagged"),
                    TX.article_text().alias("article_text"),
                    TX.summary_detailed("content").alias("summary_detailed"),
                    TX.summary_brief("content").alias("summary_brief"))


@register("text_functions_pages", f"""
SELECT feed_no, entry_no, {O.strip_tags('title')} AS title_untagged,
       {O.summary_detailed('content')} AS summary_detailed,
       {O.summary_brief('content')} AS summary_brief
FROM ({PAGES}) a""")
def q_text_functions_pages(spark, sf_dir):
    a = pages_articles(spark, sf_dir)
    return a.select("feed_no", "entry_no", TX.strip_tags("title").alias("title_untagged"),
                    TX.summary_detailed("content").alias("summary_detailed"),
                    TX.summary_brief("content").alias("summary_brief"))


# --------------------------------------------------------------------------- E1 / E2 / F1 / C

UNIQ = "article_key, feed_no, entry_no, title, url, published_date, content, occurrences"


@register("merge_by_key", f"SELECT {UNIQ} FROM ({O.unique_sql(DOCS)}) u")
def q_merge_by_key(spark, sf_dir):
    """First arrival per article key + occurrences."""
    return dedup.merge_by_key(documents_articles(spark, sf_dir))


@register("merge_by_key_pages", f"SELECT {UNIQ} FROM ({O.unique_sql(PAGES)}) u")
def q_merge_by_key_pages(spark, sf_dir):
    return dedup.merge_by_key(pages_articles(spark, sf_dir))


@register("occurrence_histogram",
          f"SELECT occurrences, count(*) AS articles FROM ({O.unique_sql(DOCS)}) u GROUP BY occurrences")
def q_occurrence_histogram(spark, sf_dir):
    """Occurrences -> number of unique articles."""
    return dedup.occurrence_histogram(dedup.merge_by_key(documents_articles(spark, sf_dir)))


@register("number_articles", f"SELECT article_key, number FROM ({O.numbered_sql(DOCS)}) n")
def q_number_articles(spark, sf_dir):
    """F1 + G1: global newest-first numbering without a single-partition window."""
    return _numbered(spark, sf_dir).select("article_key", "number")


@register("filter_date_range",
          f"SELECT number, article_key, published_date, occurrences FROM ({O.range_sql(DOCS)}) r")
def q_filter_date_range(spark, sf_dir):
    """Inclusive day range, numbers kept."""
    return _queried(spark, sf_dir).select("number", "article_key", "published_date", "occurrences")


@register("last_n_days", f"SELECT number, article_key FROM ({O.range_sql(DOCS, '2024-01-09', '2024-01-16')}) r")
def q_last_n_days(spark, sf_dir):
    """The 7 days up to as_of."""
    from ..operators.filters import last_n_days_bounds
    return number_in_range(dedup.merge_by_key(documents_articles(spark, sf_dir)),
                           *last_n_days_bounds(AS_OF, 7)).select("number", "article_key")


# --------------------------------------------------------------------------- E5-E11, G3 (profile)

REP_P = O.reporting_sql(PAGES)
REP_D = O.reporting_sql(DOCS)


@register("domain_counts", f"""
SELECT {O.extract_domain('url')} AS domain, count(*) AS articles, min(number) AS first_number
FROM ({REP_P}) r WHERE url IS NOT NULL AND url <> '' GROUP BY 1""")
def q_domain_counts(spark, sf_dir):
    """E5 over the pages period (real hosts, ports, queries)."""
    return profile.domain_counts(_reporting(spark, sf_dir, pages_articles))


@register("top_sources", f"""
SELECT * FROM (SELECT row_number() OVER (ORDER BY count(*) DESC, min(number)) AS rank,
                      {O.extract_domain('url')} AS domain, count(*) AS articles
               FROM ({REP_P}) r WHERE url IS NOT NULL AND url <> '' GROUP BY 2) WHERE rank <= 5""")
def q_top_sources(spark, sf_dir):
    """Top 5 domains, ties -> first encountered."""
    return profile.top_sources(_reporting(spark, sf_dir, pages_articles), 5)


@register("top_sources_bounded", f"""
SELECT * FROM (SELECT row_number() OVER (ORDER BY count(*) DESC, min(number)) AS rank,
                      {O.extract_domain('url')} AS domain, count(*) AS articles
               FROM ({REP_P}) r WHERE url IS NOT NULL AND url <> '' GROUP BY 2) WHERE rank <= 5""")
def q_top_sources_bounded(spark, sf_dir):
    """G3 by a mergeable sketch and a count of its candidates only."""
    return profile.top_sources_bounded(_reporting(spark, sf_dir, pages_articles), 5)


@register("unique_sources", f"""
SELECT count(DISTINCT {O.extract_domain('url')}) AS unique_sources
FROM ({REP_P}) r WHERE url IS NOT NULL AND url <> ''""")
def q_unique_sources(spark, sf_dir):
    """Distinct domains."""
    return profile.unique_sources(_reporting(spark, sf_dir, pages_articles))


@register("actual_date_range", f"""
SELECT min(CAST(published_date AS DATE)) AS first_day, max(CAST(published_date AS DATE)) AS last_day
FROM ({REP_D}) r""")
def q_actual_date_range(spark, sf_dir):
    """E7."""
    return profile.actual_date_range(_reporting(spark, sf_dir))


@register("avg_content_length", f"""
SELECT CAST(trunc(avg(length(coalesce(content, '')))) AS INTEGER) AS avg_content_length FROM ({REP_D}) r""")
def q_avg_content_length(spark, sf_dir):
    """E8."""
    return profile.avg_content_length(_reporting(spark, sf_dir))


@register("hour_histogram", f"""
SELECT CAST(hour(published_date) AS INTEGER) AS hour, count(*) AS articles, min(number) AS first_number
FROM ({REP_D}) r WHERE published_date IS NOT NULL GROUP BY 1""")
def q_hour_histogram(spark, sf_dir):
    """E9."""
    return profile.hour_histogram(_reporting(spark, sf_dir))


@register("peak_hour", f"""
SELECT CAST(hour AS INTEGER) AS peak_hour, articles AS peak_hour_articles,
       lpad(CAST(hour AS VARCHAR), 2, '0') || ':00 (' || CAST(articles AS VARCHAR) || ' articles)'
         AS peak_publishing_hour
FROM (SELECT hour(published_date) AS hour, count(*) AS articles, min(number) AS first_number
      FROM ({REP_D}) r WHERE published_date IS NOT NULL GROUP BY 1)
ORDER BY articles DESC, first_number LIMIT 1""")
def q_peak_hour(spark, sf_dir):
    """Busiest hour, ties -> first encountered."""
    return profile.peak_hour(_reporting(spark, sf_dir))


def _profile_sql(rep: str, start: str, end: str) -> str:
    dom = O.extract_domain("url")
    return f"""
WITH r AS ({rep}),
top AS (SELECT * FROM (SELECT row_number() OVER (ORDER BY count(*) DESC, min(number)) AS rank,
                              {dom} AS domain, count(*) AS articles
                       FROM r WHERE url IS NOT NULL AND url <> '' GROUP BY 2) WHERE rank <= 5),
occ AS (SELECT occurrences, count(*) AS articles FROM r GROUP BY 1),
hr AS (SELECT hour(published_date) AS hour, count(*) AS n, min(number) AS first_number
       FROM r WHERE published_date IS NOT NULL GROUP BY 1),
pk AS (SELECT hour, n FROM hr ORDER BY n DESC, first_number LIMIT 1)
SELECT '{start} to {end}' AS query_date_range,
       (SELECT count(*) FROM r) AS total_articles,
       coalesce((SELECT strftime(min(published_date), '%Y-%m-%d') || ' to ' || strftime(max(published_date), '%Y-%m-%d') FROM r), 'N/A')
         AS actual_date_range,
       (SELECT count(DISTINCT {dom}) FROM r WHERE url IS NOT NULL AND url <> '') AS unique_sources,
       (SELECT string_agg(domain || ': ' || CAST(articles AS VARCHAR), '; ' ORDER BY rank) FROM top) AS top_sources_text,
       (SELECT string_agg(CAST(occurrences AS VARCHAR) || ': ' || CAST(articles AS VARCHAR), '; ' ORDER BY occurrences) FROM occ)
         AS occurrence_distribution_text,
       (SELECT CAST(trunc(avg(length(coalesce(content, '')))) AS INTEGER) FROM r) AS avg_content_length,
       coalesce((SELECT lpad(CAST(hour AS VARCHAR), 2, '0') || ':00 (' || CAST(n AS VARCHAR) || ' articles)' FROM pk),
                '00:00 (0 articles)') AS peak_publishing_hour
WHERE (SELECT count(*) FROM r) > 0
"""


_PROFILE_COLS = ["query_date_range", "total_articles", "actual_date_range", "unique_sources",
                 "top_sources_text", "occurrence_distribution_text", "avg_content_length",
                 "peak_publishing_hour"]


@register("profile_period", _profile_sql(REP_D, *PERIOD))
def q_profile_period(spark, sf_dir):
    """The period profile record (flat columns)."""
    return profile.profile_articles(_reporting(spark, sf_dir), *PERIOD).select(*_PROFILE_COLS)


@register("profile_period_pages", _profile_sql(REP_P, *PERIOD))
def q_profile_period_pages(spark, sf_dir):
    return profile.profile_articles(_reporting(spark, sf_dir, pages_articles), *PERIOD).select(*_PROFILE_COLS)


# --------------------------------------------------------------------------- D4 / I1 / I2 / G2

def _scores_sql(impact, topics, adapter=DOCS):
    return (f"SELECT number, impact_score, topic FROM "
            f"({O.scored_sql(adapter, impact, topics)}) s")


@register("impact_scores", _scores_sql(L.IMPACT_KEYWORDS, L.TOPIC_KEYWORDS))
def q_impact_scores(spark, sf_dir):
    """I1 + I2 with the default lexicons."""
    return _scored(spark, sf_dir, L.IMPACT_KEYWORDS, L.TOPIC_KEYWORDS).select("number", "impact_score", "topic")


@register("impact_scores_corpus", _scores_sql(L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS))
def q_impact_scores_corpus(spark, sf_dir):
    """I1 + I2 with the corpus lexicons (real ties between topics)."""
    return _scored(spark, sf_dir, L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS) \
        .select("number", "impact_score", "topic")


@register("impact_scores_pages", _scores_sql(L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS, PAGES))
def q_impact_scores_pages(spark, sf_dir):
    return _scored(spark, sf_dir, L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS, pages_articles) \
        .select("number", "impact_score", "topic")


def _lexicon_hits_sql() -> str:
    kws = " UNION ALL ".join(f"SELECT {O.q(k)} AS keyword, {w} AS weight"
                             for k, w in L.CORPUS_IMPACT_KEYWORDS.items())
    return f"""
SELECT r.number, k.keyword, k.weight
FROM ({REP_D}) r JOIN ({kws}) k ON strpos({O.article_text()}, k.keyword) > 0"""


@register("lexicon_hits", _lexicon_hits_sql())
def q_lexicon_hits(spark, sf_dir):
    """D4 as a table: article x keyword where the text contains the keyword.
    The lexicon is a literal array, exploded per row (no join)."""
    rep = _reporting(spark, sf_dir)
    kw = F.array(*[F.struct(F.lit(k).alias("keyword"), F.lit(w).alias("weight"))
                   for k, w in L.CORPUS_IMPACT_KEYWORDS.items()])
    t = rep.select("number", TX.article_text("title", "content").alias("_t"), F.explode(kw).alias("k"))
    return t.where(F.col("_t").contains(F.col("k.keyword"))).select("number", "k.keyword", "k.weight")


# every distinct benchmark word of four letters or more as a keyword, weighed by its length
_LEXICON_SQL = """
SELECT word AS keyword, CAST(length(word) AS INTEGER) AS weight FROM (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM benchmark)"""


def _benchmark_lexicon(spark, sf_dir) -> DataFrame:
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))
    return (spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.explode(words).alias("keyword")).distinct()
            .withColumn("weight", F.length("keyword")))


@register("lexicon_scores", f"""
SELECT r.number, sum(k.weight) AS keyword_score, count(*) AS hits
FROM ({REP_D}) r JOIN ({_LEXICON_SQL}) k ON strpos({O.article_text()}, k.keyword) > 0 GROUP BY 1""")
def q_lexicon_scores(spark, sf_dir):
    """D4 / I1 with a lexicon table: a join on each keyword's rarest gram."""
    return lexicon_scores(_reporting(spark, sf_dir), _benchmark_lexicon(spark, sf_dir))


def _topic_table(spark, topics: dict) -> DataFrame:
    rows = [(t, p, w) for p, (t, words) in enumerate(topics.items()) for w in words]
    return spark.createDataFrame(rows, "topic string, priority int, keyword string")


@register("lexicon_topics", f"SELECT number, topic FROM ({O.scored_sql(DOCS, L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS)}) s")
def q_lexicon_topics(spark, sf_dir):
    """I2 with the topics' keywords as a table."""
    return lexicon_topics(_reporting(spark, sf_dir), _topic_table(spark, L.CORPUS_TOPIC_KEYWORDS), L.DEFAULT_TOPIC)


@register("rank_by_impact", f"""
SELECT number, row_number() OVER (ORDER BY impact_score DESC, number) AS impact_rank
FROM ({O.scored_sql(DOCS, L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS)}) s""")
def q_rank_by_impact(spark, sf_dir):
    """Score desc, stable over newest-first (global numbering as in F1)."""
    return _rank_global(_scored(spark, sf_dir, L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS))


def _rank_global(s: DataFrame) -> DataFrame:
    ranked = number_articles(s.select(F.col("number").alias("n0"), "impact_score",
                                      F.col("number").alias("number_key")),
                             [F.col("impact_score").desc(), F.col("number_key").asc()])
    return ranked.select(F.col("n0").alias("number"), F.col("number").alias("impact_rank"))


# --------------------------------------------------------------------------- F2-F5, H2, D3, E12-E15

SEL_COLS = "slot, position, section, number, topic, impact_score, title, source"


def _sel_sql(week: bool = False) -> str:
    s = O.scored_sql(DOCS, L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS, week=week)
    return O.selection_sql(s, ["week"] if week else [])


@register("selection", f"SELECT {SEL_COLS} FROM ({_sel_sql()}) x")
def q_selection(spark, sf_dir):
    """F2 main stories + F3 quick hits + F4 sections + F5 positions + H2 union."""
    return _selection(spark, sf_dir).select(*[c.strip() for c in SEL_COLS.split(",")])


@register("selection_weekly", f"SELECT week, {SEL_COLS} FROM ({_sel_sql(True)}) x")
def q_selection_weekly(spark, sf_dir):
    """The same selection, one per ISO week, in a single job."""
    return _selection(spark, sf_dir, week=True).select("week", *[c.strip() for c in SEL_COLS.split(",")])


@register("selection_default_lexicon", f"""SELECT {SEL_COLS} FROM ({O.selection_sql(
    O.scored_sql(DOCS, L.IMPACT_KEYWORDS, L.TOPIC_KEYWORDS), [])}) x""")
def q_selection_default(spark, sf_dir):
    s = _scored(spark, sf_dir, L.IMPACT_KEYWORDS, L.TOPIC_KEYWORDS)
    return select_stories(s).select(*[c.strip() for c in SEL_COLS.split(",")])


@register("main_stories", f"SELECT position, number, topic FROM ({_sel_sql()}) x WHERE slot = 'main'")
def q_main_stories(spark, sf_dir):
    """F2."""
    return _selection(spark, sf_dir).where(F.col("slot") == "main").select("position", "number", "topic")


@register("quick_hits", f"SELECT position, number, topic FROM ({_sel_sql()}) x WHERE slot = 'quick'")
def q_quick_hits(spark, sf_dir):
    """F3 (uses D3, the anti-join of main stories)."""
    return _selection(spark, sf_dir).where(F.col("slot") == "quick").select("position", "number", "topic")


@register("estimated_duration", f"""
SELECT count(*) FILTER (WHERE slot = 'main') AS main_stories, count(*) FILTER (WHERE slot = 'quick') AS quick_hits,
       CAST(sum(CASE WHEN slot = 'main' THEN 180 ELSE 20 END) AS BIGINT) AS duration_seconds,
       printf('%.1f', sum(CASE WHEN slot = 'main' THEN 180 ELSE 20 END) / 60.0) AS duration_minutes
FROM ({_sel_sql()}) x""")
def q_estimated_duration(spark, sf_dir):
    """E15."""
    return estimated_duration(_selection(spark, sf_dir))


@register("source_counts", f"""
SELECT source, count(*) AS articles, min(position) AS first_position,
       row_number() OVER (ORDER BY count(*) DESC, min(position)) AS source_rank
FROM ({_sel_sql()}) x GROUP BY source""")
def q_source_counts(spark, sf_dir):
    """E12."""
    return profile.source_counts(_selection(spark, sf_dir))


@register("topic_counts", f"""
SELECT * FROM (SELECT topic, count(*) AS articles, min(position) AS first_position,
       row_number() OVER (ORDER BY count(*) DESC, min(position)) AS topic_rank
FROM ({_sel_sql()}) x GROUP BY topic) WHERE topic_rank <= 3""")
def q_topic_counts(spark, sf_dir):
    """E13 + G4 (top 3 topics)."""
    return profile.topic_counts(_selection(spark, sf_dir), k=3)


def _trends_sql(sel: str) -> str:
    return f"""
WITH s AS ({sel}),
t AS (SELECT topic, row_number() OVER (ORDER BY count(*) DESC, min(position)) AS rk FROM s GROUP BY topic)
SELECT {O.q(R.TRENDS_OPEN)} ||
  coalesce({O.q(R.TRENDS_FOCUS.split('{}')[0])} || replace((SELECT topic FROM t WHERE rk = 1), '_', ' ')
    || {O.q(R.TRENDS_FOCUS.split('{}')[1])} ||
    coalesce({O.q(R.TRENDS_SECOND.split('{}')[0])} || replace((SELECT topic FROM t WHERE rk = 2), '_', ' ')
      || {O.q(R.TRENDS_SECOND.split('{}')[1])}, {O.q(R.TRENDS_SINGLE)}), '')
  || {O.q(R.TRENDS_SOURCES.split('{}')[0])} || CAST((SELECT count(DISTINCT source) FROM s) AS VARCHAR)
  || {O.q(R.TRENDS_SOURCES.split('{}')[1])} || {O.q(R.TRENDS_CLOSE)} AS trends
"""


def _sources_sql(sel: str) -> str:
    nl = "chr(10)"
    return f"""
WITH s AS ({sel}),
c AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, min(position)) AS rk
      FROM s GROUP BY source)
SELECT {O.q(R.SOURCES_HEADER)} || {nl} || {nl} || {O.q(R.SOURCES_INTRO)} || {nl} || {nl} ||
       (SELECT string_agg({O.q(R.QUICK_BULLET)} || source || ': ' || CAST(n AS VARCHAR) || ' article'
                          || CASE WHEN n > 1 THEN 's' ELSE '' END, {nl} ORDER BY rk) FROM c)
       || {nl} || {nl} || {O.q(R.SOURCES_TOTAL.format(''))} || CAST((SELECT count(*) FROM c) AS VARCHAR)
       || {nl} || {O.q(R.ARTICLES_TOTAL.format(''))} || CAST((SELECT count(*) FROM s) AS VARCHAR) AS sources_summary
"""


@register("trends_sentence", _trends_sql(_sel_sql()))
def q_trends_sentence(spark, sf_dir):
    """R2."""
    return trends_sentence(_selection(spark, sf_dir))


@register("sources_section", _sources_sql(_sel_sql()))
def q_sources_section(spark, sf_dir):
    """R3."""
    return sources_section(_selection(spark, sf_dir))


def _script_sql(sel: str) -> str:
    nl = "chr(10)"
    title = "coalesce(title, '')"
    story = (f"'Story ' || CAST(position AS VARCHAR) || ': ' || {title} || {nl} || {nl} || "
             f"{O.summary_detailed('content')} || {nl} || {nl} || '---' || {nl}")
    quick = f"{O.q(R.QUICK_BULLET)} || {title} || {nl} || '  ' || {O.summary_brief('content')} || {nl}"
    head = nl.join([])
    return f"""
WITH s AS ({sel}),
st AS (SELECT string_agg({story}, {nl} ORDER BY position) AS b FROM s WHERE section = 'story'),
qh AS (SELECT string_agg({quick}, {nl} ORDER BY position) AS b FROM s WHERE section <> 'story')
SELECT {O.q(R.SCRIPT_TITLE)} || {nl} || {nl} || {O.q(R.SCRIPT_WELCOME)} || {nl} || {nl} || {O.q(R.MAIN_HEADER)} || {nl} || {nl}
  || coalesce((SELECT b FROM st) || {nl}, '')
  || coalesce({O.q(R.QUICK_HEADER)} || {nl} || {nl} || {O.q(R.QUICK_INTRO)} || {nl} || {nl} || (SELECT b FROM qh) || {nl}, '')
  || {O.q(R.TRENDS_HEADER)} || {nl} || {nl} || ({_trends_sql(sel)}) || {nl} || {nl} || {O.q(R.SCRIPT_CLOSING)} || {nl} || {nl}
  || ({_sources_sql(sel)}) AS script
WHERE (SELECT count(*) FROM s) > 0
"""


@register("render_script", _script_sql(_sel_sql()))
def q_render_script(spark, sf_dir):
    """The digest script (one document for the period)."""
    return render_script(_selection(spark, sf_dir))


# --------------------------------------------------------------------------- J1-J3, D2, E3, E4

from ..operators import flagging as FG  # noqa: E402
from ..operators.similarity import similar_pairs  # noqa: E402


def _rules_sql(adapter: str) -> str:
    t = O.normalize_title("title")
    return f"""
SELECT feed_no, entry_no, {O.normalize_url('url')} AS u, {t} AS t, {O.content_hash('content')} AS h,
       CASE WHEN title IS NOT NULL AND title <> '' THEN coalesce({t}, '') END AS a,
       CASE WHEN {t} IS NOT NULL THEN coalesce({O.normalize_title(t)}, '') END AS b
FROM ({adapter}) x"""


def _walk_sql(adapter: str, similar: bool = False) -> str:
    return walk_sql(_rules_sql(adapter), O.similar_sql(_rules_sql(adapter)) if similar else None)


def walk_sql(rules: str, pairs: str | None = None) -> str:
    """The sequential rule as a recursive CTE carrying the seen sets; ``pairs``
    gives the similar (a, b)."""
    like = f"SELECT a, list(DISTINCT md5(b)) AS near FROM ({pairs}) s GROUP BY a" if pairs else \
        "SELECT CAST(NULL AS VARCHAR) AS a, CAST([] AS VARCHAR[]) AS near WHERE false"
    return f"""
WITH RECURSIVE sim AS MATERIALIZED ({like}),
r AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY feed_no, entry_no) AS i, feed_no, entry_no,
         md5(u) AS u, md5(t) AS t, h, md5(b) AS b, coalesce(sim.near, []) AS near
  FROM ({rules}) k LEFT JOIN sim ON sim.a = k.a),
walk AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS su, CAST([] AS VARCHAR[]) AS st,
         CAST([] AS VARCHAR[]) AS sh, CAST([] AS VARCHAR[]) AS sb, CAST(NULL AS VARCHAR) AS method
  UNION ALL
  SELECT r.i,
         CASE WHEN x.m = 'new' AND r.u IS NOT NULL THEN list_append(w.su, r.u) ELSE w.su END,
         CASE WHEN x.m = 'new' AND r.t IS NOT NULL THEN list_append(w.st, r.t) ELSE w.st END,
         CASE WHEN x.m = 'new' AND r.h IS NOT NULL THEN list_append(w.sh, r.h) ELSE w.sh END,
         CASE WHEN x.m = 'new' AND r.b IS NOT NULL THEN list_append(w.sb, r.b) ELSE w.sb END,
         x.m
  FROM walk w JOIN r ON r.i = w.i + 1,
  LATERAL (SELECT CASE WHEN r.u IS NOT NULL AND list_contains(w.su, r.u) THEN 'url'
                       WHEN r.t IS NOT NULL AND list_contains(w.st, r.t) THEN 'title'
                       WHEN r.h IS NOT NULL AND list_contains(w.sh, r.h) THEN 'content'
                       WHEN list_has_any(w.sb, r.near) THEN 'similar_title'
                       ELSE 'new' END AS m) x)
SELECT r.feed_no, r.entry_no, w.method <> 'new' AS is_duplicate, w.method
FROM walk w JOIN r USING (i)"""


@register("duplicate_rules", f"SELECT * FROM ({_rules_sql(DOCS)}) x")
def q_duplicate_rules(spark, sf_dir):
    """Rule keys per row (url, title, content hash) and similarity strings."""
    return FG.duplicate_rules(documents_articles(spark, sf_dir))


@register("flag_duplicates_exact", _walk_sql(DOCS))
def q_flag_duplicates_exact(spark, sf_dir):
    """Ordered greedy flagging by the three exact rules."""
    return FG.flag_duplicates(documents_articles(spark, sf_dir), similar=False) \
        .select("feed_no", "entry_no", "is_duplicate", "method")


@register("flag_duplicates_exact_pages", _walk_sql(PAGES))
def q_flag_duplicates_exact_pages(spark, sf_dir):
    return FG.flag_duplicates(pages_articles(spark, sf_dir), similar=False) \
        .select("feed_no", "entry_no", "is_duplicate", "method")


@register("flag_counts_exact", f"SELECT method, count(*) AS rows FROM ({_walk_sql(DOCS)}) w GROUP BY method")
def q_flag_counts_exact(spark, sf_dir):
    """E4 over J2."""
    return FG.flag_counts(FG.flag_duplicates(documents_articles(spark, sf_dir), similar=False))


@register("ingest_counters_exact", f"""
SELECT (SELECT count(*) FROM ({_walk_sql(DOCS)}) w) AS total_found,
       (SELECT count(*) FILTER (WHERE is_duplicate) FROM ({_walk_sql(DOCS)}) w) AS duplicates_flagged,
       (SELECT count(*) FROM ({O.unique_sql(DOCS)}) u) AS unique_articles""")
def q_ingest_counters_exact(spark, sf_dir):
    """Found / flagged / unique (flags by J2; unique by E1)."""
    raw = documents_articles(spark, sf_dir)
    return FG.ingest_counters(FG.flag_duplicates(raw, similar=False), dedup.merge_by_key(raw))


@register("similar_titles")
def q_similar_titles(spark, sf_dir):
    """(new title, seen title) pairs with ratio >= 0.85, over all titles
    (rows-only here; exact against brute force in tests)."""
    rules = FG.duplicate_rules(documents_articles(spark, sf_dir))
    return similar_pairs(rules.select("a"), rules.select("b"))


@register("similar_titles_pages", O.similar_sql(_rules_sql(PAGES)))
def q_similar_titles_pages(spark, sf_dir):
    rules = FG.duplicate_rules(pages_articles(spark, sf_dir))
    return similar_pairs(rules.select("a"), rules.select("b"))


@register("flag_duplicates")
def q_flag_duplicates(spark, sf_dir):
    """The four rules including similar titles (rows-only here; exact
    against the sequential rule in tests)."""
    return FG.flag_duplicates(documents_articles(spark, sf_dir), similar=True) \
        .select("feed_no", "entry_no", "is_duplicate", "method")


@register("flag_counts")
def q_flag_counts(spark, sf_dir):
    """E4 over J3."""
    return FG.flag_counts(FG.flag_duplicates(documents_articles(spark, sf_dir), similar=True))


# --------------------------------------------------------------------------- R4, R5, D1, E14

def _titles_sql(script_sql: str) -> str:
    qh, bullet = O.q(R.QUICK_HEADER), O.q(R.QUICK_BULLET)
    line = "line"
    return f"""
WITH doc AS ({script_sql}),
l0 AS (SELECT unnest(string_split(script, chr(10))) AS raw,
              generate_subscripts(string_split(script, chr(10)), 1) AS line_no FROM doc),
l1 AS (SELECT line_no, {O.strip_ws('raw')} AS line FROM l0),
l2 AS (SELECT *, max(CASE WHEN line = {qh} THEN 1 ELSE 0 END) OVER (ORDER BY line_no) > 0 AS in_quick FROM l1),
l3 AS (SELECT *, max(CASE WHEN in_quick AND line <> {qh} AND starts_with(line, '===') THEN 1 ELSE 0 END)
                  OVER (ORDER BY line_no) > 0 AS past_quick FROM l2),
l4 AS (SELECT line_no,
         CASE WHEN NOT in_quick AND starts_with(line, {O.q(R.STORY_PREFIX)}) AND strpos(line, ':') > 0
                THEN {O.strip_tags(O.strip_ws(f"substr({line}, strpos({line}, ':') + 1)"))}
              WHEN in_quick AND NOT past_quick AND line <> {qh} AND starts_with(line, {bullet})
                   AND NOT starts_with(line, {bullet} || '=')
                THEN {O.strip_tags(O.strip_ws(f"substr({line}, {len(R.QUICK_BULLET) + 1})"))} END AS title
       FROM l3)
SELECT title, CAST(row_number() OVER (ORDER BY line_no) AS INTEGER) AS position FROM l4 WHERE title IS NOT NULL"""


def _map_sql(rep: str) -> str:
    return f"""
SELECT {O.strip_tags('title')} AS title, arg_max(url, number) AS url FROM ({rep}) r
WHERE title IS NOT NULL AND title <> '' AND url IS NOT NULL AND url <> '' GROUP BY 1"""


def _linked_sql(sel: str, rep: str) -> str:
    return f"""
SELECT t.title, t.position, m.url FROM ({_titles_sql(_script_sql(sel))}) t
LEFT JOIN ({_map_sql(rep)}) m ON m.title = t.title"""


def _post_sql(sel: str, rep: str, compact: bool) -> str:
    nl = "chr(10)"
    line = ("CAST(position AS VARCHAR) || '. ' || CASE WHEN url IS NOT NULL THEN '[' || title || '](' || url || ')' "
            "ELSE title END")
    if compact:
        body = (f"{O.q(R.POST_TITLE)} || {nl} || {nl} || {O.q(R.POST_INTRO_COMPACT)} || {nl} || {nl} || "
                f"string_agg({line}, {nl} ORDER BY position) || {nl} || {nl} || {O.q(R.POST_TAGS)}")
    else:
        body = (f"{O.q(R.POST_TITLE)} || {nl} || {nl} || {O.q(R.POST_INTRO)} || {nl} || {nl} || "
                f"string_agg({line} || {nl} || {nl}, '' ORDER BY position) || {O.q(R.POST_TAGS)}")
    return f"""
SELECT CASE WHEN (SELECT count(*) FROM ({_map_sql(rep)}) m) = 0 THEN {O.q(R.POST_NO_MAP)} ELSE {body} END AS post
FROM ({_linked_sql(sel, rep)}) j HAVING count(*) > 0"""


def _digest_parts(spark, sf_dir):
    queried = _reporting(spark, sf_dir)
    sel = select_stories(score_articles(queried, AS_OF, L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS))
    script = render_script(sel)
    titles = extract_script_titles(script)
    url_map = title_url_map(queried)
    return sel, script, titles, url_map


@register("extract_script_titles", _titles_sql(_script_sql(_sel_sql())))
def q_extract_script_titles(spark, sf_dir):
    """Titles named in the rendered script, in order."""
    _, _, titles, _ = _digest_parts(spark, sf_dir)
    return titles


@register("title_url_map", _map_sql(REP_D))
def q_title_url_map(spark, sf_dir):
    """Tag-stripped title -> URL of the last listed article."""
    return title_url_map(_reporting(spark, sf_dir))


@register("attach_links", _linked_sql(_sel_sql(), REP_D))
def q_attach_links(spark, sf_dir):
    """Script titles left-joined with the title -> URL map."""
    _, _, titles, url_map = _digest_parts(spark, sf_dir)
    return attach_links(titles, url_map).select("title", "position", "url")


@register("link_post", _post_sql(_sel_sql(), REP_D, compact=False))
def q_link_post(spark, sf_dir):
    """R4 standard post."""
    _, _, titles, url_map = _digest_parts(spark, sf_dir)
    return link_post(attach_links(titles, url_map), compact=False, have_map=url_map)


@register("link_post_compact", _post_sql(_sel_sql(), REP_D, compact=True))
def q_link_post_compact(spark, sf_dir):
    """R4 compact post."""
    _, _, titles, url_map = _digest_parts(spark, sf_dir)
    return link_post(attach_links(titles, url_map), compact=True, have_map=url_map)


@register("render_script_weekly", f"""
WITH ws AS MATERIALIZED ({_sel_sql(True)})
SELECT w.week, x.script FROM (SELECT DISTINCT week FROM ws) w,
LATERAL ({_script_sql("SELECT * FROM ws WHERE ws.week = w.week")}) x""")
def q_render_script_weekly(spark, sf_dir):
    """R1 per ISO week in one job, one document a week."""
    return render_script(_selection(spark, sf_dir, week=True), ["week"])


@register("flag_counts_pages", f"SELECT method, count(*) AS rows FROM ({_walk_sql(PAGES, True)}) w GROUP BY method")
def q_flag_counts_pages(spark, sf_dir):
    """E4 over J3 on pages."""
    return FG.flag_counts(FG.flag_duplicates(pages_articles(spark, sf_dir), similar=True))


@register("flag_duplicates_pages", _walk_sql(PAGES, True))
def q_flag_duplicates_pages(spark, sf_dir):
    """J3 over the pages adapter (HTML titles, URLs with queries and fragments)."""
    return FG.flag_duplicates(pages_articles(spark, sf_dir), similar=True) \
        .select("feed_no", "entry_no", "is_duplicate", "method")
