"""Queries over the file sources and sinks (A1-A7, B13, M4): each writes files
from the test tables into the shared checkpoint folder and reads them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..operators.days import number_days, profile_days, unique_sources_days
from ..operators.dedup import merge_by_key
from ..session import table_path
from ..sources.adapters import documents_articles, pages_articles
from ..sources.feeds import DEFAULT_TITLE, extract_entries, read_entries, read_feed_registry, read_feeds
from ..sources.reports import FILTERED_RULE, INGEST_RULE, read_article_report
from ..sources.sinks import write_articles, write_documents, write_stage
from . import oracle as O
from .jobs import CORPUS_LEXICONS, query_period
from .registry import _PROFILE_COLS, _profile_sql, _reporting, register
from .run import run_digest

ITEMS = 50  # entries of one feed document
FILE_ITEMS = 500  # entries of the documents of one landed file, up to one document more


def _xml(c: Column) -> Column:
    """Text as XML character data; characters that XML 1.0 lacks become spaces."""
    c = F.regexp_replace(c, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]", " ")
    for raw, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(ref))
    return c


def _element(name: str, c: Column) -> Column:
    return F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"<{name}>"), _xml(c), F.lit(f"</{name}>"))).otherwise(F.lit(""))


def _land(entries: DataFrame, path: str, head: Column, tail: str) -> None:
    """Feed documents of the entries (feed_no, entry_no, entry) of ITEMS consecutive numbers, in folders
    ``feed_no=<n>``.  A feed's consecutive documents share a file (one root over them) up to FILE_ITEMS entries: their
    number follows the entries, however sparse a feed's numbers are."""
    e = entries.withColumn("chunk", F.expr(f"entry_no div {ITEMS}"))
    before = F.sum("n").over(Window.partitionBy("feed_no").orderBy("chunk")) - F.col("n")
    files = e.groupBy("feed_no", "chunk").agg(F.count(F.lit(1)).alias("n")).withColumn("before", before).select(
        F.col("feed_no").alias("f"), F.col("chunk").alias("c"), F.expr(f"before div {FILE_ITEMS}").alias("file"))
    docs = e.groupBy("feed_no", "chunk").agg(F.array_sort(F.collect_list(F.struct("entry_no", "entry"))).alias("entries"))
    doc = F.concat(head, F.array_join(F.transform("entries", lambda x: x["entry"]), ""), F.lit(tail))
    placed = docs.join(files, docs["feed_no"].eqNullSafe(files["f"]) & docs["chunk"].eqNullSafe(files["c"])).select(
        "feed_no", "file", "chunk", doc.alias("doc"))
    whole = placed.groupBy("feed_no", "file").agg(F.array_sort(F.collect_list(F.struct("chunk", "doc"))).alias("docs"))
    body = F.concat(F.lit("<feeds>"), F.array_join(F.transform("docs", lambda x: x["doc"]), ""), F.lit("</feeds>"))
    whole.select("feed_no", "file", body.alias("value")).write.mode("append").partitionBy("feed_no", "file").text(path)


def write_rss(articles: DataFrame, path: str) -> None:
    """The entries as landed RSS documents."""
    date = F.concat(F.date_format("published_date", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    item = F.concat(F.lit("<item>"), _element("title", F.col("title")), _element("link", F.col("url")),
                    _element("pubDate", date), _element("content:encoded", F.col("content")), F.lit("</item>"))
    head = F.concat(F.lit('<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>'),
                    F.col("feed_no").cast("string"), F.lit("</title><description>landed</description>"))
    _land(articles.select("feed_no", "entry_no", item.alias("entry")), path, head, "</channel></rss>")


@register("feed_registry", """
SELECT CAST(row_number() OVER (ORDER BY url) AS INTEGER) AS feed_no, url AS feed_url
FROM (SELECT DISTINCT 'https://' || source || '.example.com/feed' AS url FROM documents)""")
def q_feed_registry(spark, sf_dir):
    """A1: one registry line per source, behind a comment and blank lines."""
    path = table_path(spark, "registry")
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/feed"))
    lines = spark.read.parquet(f"{sf_dir}/documents.parquet").select(url.alias("url")).distinct().orderBy("url")
    text = lines.agg(F.concat(F.lit("# feeds\n\n"), F.array_join(F.array_sort(F.collect_list("url")), " \n\n")).alias("value"))
    text.coalesce(1).write.text(path)  # a registry is one small file
    return read_feed_registry(spark, path)


@register("feed_entries", f"""
SELECT feed_no, coalesce(nullif(title, ''), {O.q(DEFAULT_TITLE)}) AS title, url,
       coalesce(published_date, TIMESTAMP '{O.AS_OF}') AS published_date, {O.clean_content('content')} AS content
FROM ({O.DOCS}) a""")
def q_feed_entries(spark, sf_dir):
    """A2 + A3: every article written into RSS documents, read and extracted."""
    path = table_path(spark, "feeds")
    write_rss(documents_articles(spark, sf_dir), path)
    return extract_entries(read_feeds(spark, path), O.AS_OF).drop("entry_no")


def write_atom(articles: DataFrame, path: str) -> None:
    """The same as Atom documents."""
    date = F.date_format("published_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    link = F.when(F.col("url") != "", F.concat(F.lit('<link rel="self" href="https://self.example.com/"/><link rel="alternate" href="'),
                                              F.replace(_xml(F.col("url")), F.lit('"'), F.lit("&quot;")), F.lit('"/>'))).otherwise(F.lit(""))
    entry = F.concat(F.lit("<entry>"), _element("title", F.col("title")), F.coalesce(link, F.lit("")), _element("published", date),
                     _element("content", F.col("content")), F.lit("</entry>"))
    head = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>'), F.col("feed_no").cast("string"), F.lit("</title>"))
    _land(articles.select("feed_no", "entry_no", entry.alias("entry")), path, head, "</feed>")


@register("feed_entries_mixed", f"""
SELECT feed_no, coalesce(nullif(title, ''), {O.q(DEFAULT_TITLE)}) AS title, url,
       coalesce(published_date, TIMESTAMP '{O.AS_OF}') AS published_date, {O.clean_content('content')} AS content
FROM ({O.DOCS}) a""")
def q_feed_entries_mixed(spark, sf_dir):
    """A2 + A3 + H1: every article in one folder of RSS and Atom documents and
    broken files, read in one call (the first poll is RSS, the second Atom)."""
    path = table_path(spark, "mixed-feeds")
    rows = documents_articles(spark, sf_dir)
    write_rss(rows.where("feed_no < 100"), path)
    write_atom(rows.where("feed_no >= 100"), path)
    broken = rows.select("feed_no").distinct().select((F.col("feed_no") + 1000).alias("feed_no"), F.lit(0).alias("chunk"),
                                                      F.lit("<html><body>moved</body></html>").alias("value"))
    broken.write.mode("append").partitionBy("feed_no", "chunk").text(path)
    return read_entries(spark, path, O.AS_OF).drop("entry_no")


def write_filtered_report(articles: DataFrame, path: str) -> None:
    """Plain-text blocks as a filtered report has them, one article each."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    block = F.concat(
        F.lit("Article "), F.col("number").cast("string"), F.lit("\n" + "-" * 30), F.lit("\nTitle: "), blank("title"),
        F.lit("\nURL: "), blank("url"), F.lit("\nSource: "), blank("source"),
        F.lit("\nPublished: "), F.coalesce(F.date_format("published_date", "yyyy-MM-dd HH:mm:ss"), F.lit("None")),
        F.lit("\nOccurrences: "), F.col("occurrences").cast("string"),
        F.lit("\nContent Length: "), F.col("content_length").cast("string"), F.lit(" characters"),
        F.lit("\nContent: "), blank("content"), F.lit("\n\n" + FILTERED_RULE + "\n"))
    articles.select(block.alias("value")).write.text(path)


@register("article_report_filtered", f"""
SELECT number, nullif(title, '') AS title, url, nullif(source, '') AS source, published_date, occurrences, content_length,
       nullif(content, '') AS content FROM ({O.reporting_sql(O.DOCS)}) r""")
def q_article_report_filtered(spark, sf_dir):
    """A4 for filtered reports: the period's reporting view as a report, read back."""
    path = table_path(spark, "filtered-reports")
    write_filtered_report(_reporting(spark, sf_dir), path)
    return read_article_report(spark, path, filtered=True)


@register("article_report", f"""
SELECT CAST(entry_no * 4 + feed_no // 100 AS BIGINT) AS number, nullif(title, '') AS title, url, published_date,
       CAST(1 AS BIGINT) AS occurrences, nullif(content, '') AS content FROM ({O.DOCS}) a""")
def q_article_report(spark, sf_dir):
    """A4 + B13: every article as a block of a plain-text report, read back."""
    path = table_path(spark, "reports")
    a = documents_articles(spark, sf_dir)
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    block = F.concat(
        F.lit("Article "), (F.col("entry_no") * 4 + F.floor(F.col("feed_no") / 100)).cast("string"), F.lit("\n" + "-" * 30),
        F.lit("\nTitle: "), blank("title"), F.lit("\nURL: "), blank("url"),
        F.lit("\nPublished: "), F.coalesce(F.date_format("published_date", "yyyy-MM-dd HH:mm:ss"), F.lit("None")),
        F.lit("\nOccurrences: 1\nContent: "), blank("content"), F.lit("\n\n" + INGEST_RULE + "\n"))
    a.select(block.alias("value")).write.text(path)
    return read_article_report(spark, path)


@register("write_articles", f"""
SELECT article_key, CAST(published_date AS DATE) AS published_day, occurrences FROM ({O.unique_sql(O.DOCS)}) u""")
def q_write_articles(spark, sf_dir):
    """A5: the unique articles written by day and read back."""
    path = table_path(spark, "articles")
    write_articles(merge_by_key(documents_articles(spark, sf_dir)), path)
    return spark.read.parquet(f"{path}/articles").select("article_key", "published_day", "occurrences")


@register("write_stage", f"SELECT feed_no, entry_no, title, content FROM ({O.DOCS}) a")
def q_write_stage(spark, sf_dir):
    """The raw entries as a stage partitioned by feed, read back."""
    path = write_stage(documents_articles(spark, sf_dir), table_path(spark, "run"), "r", "raw", "entries", partition_by=["feed_no"])
    return spark.read.parquet(path).select("feed_no", "entry_no", "title", "content")


@register("write_documents", f"SELECT feed_no, content AS value FROM ({O.DOCS}) a")
def q_write_documents(spark, sf_dir):
    """Every cleaned text as a line of its feed's documents, read back."""
    path = table_path(spark, "texts")
    write_documents(documents_articles(spark, sf_dir), path, "content", partition_by=["feed_no"])
    return spark.read.text(path).select("feed_no", "value")


@register("run_digest", f"""SELECT slot, position, section, number, topic, impact_score, title, source FROM ({O.selection_sql(
    O.scored_sql(O.DOCS, L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS), [])}) x""")
def q_run_digest(spark, sf_dir) -> DataFrame:
    """M4: the whole run over its written stages; its selection."""
    out = run_digest(spark, documents_articles(spark, sf_dir), table_path(spark, "digest"), O.AS_OF, run_id="r",
                     start=O.PERIOD[0], end=O.PERIOD[1], lexicons=CORPUS_LEXICONS)
    return spark.read.parquet(out["selection"]).select("slot", "position", "section", "number", "topic", "impact_score", "title", "source")


def _stored(spark, sf_dir, adapter=documents_articles) -> str:
    """The unique articles and their day summary, written by day (A5)."""
    path = table_path(spark, "stored")
    write_articles(merge_by_key(adapter(spark, sf_dir)), path)
    return path


@register("query_period_stored", f"SELECT article_key, published_date, occurrences FROM ({O.range_sql(O.DOCS)}) r")
def q_query_period_stored(spark, sf_dir):
    """M2 / C1 over stored articles: only the period's days are read."""
    return query_period(spark.read.parquet(f"{_stored(spark, sf_dir)}/articles"), *O.PERIOD).select("article_key", "published_date", "occurrences")


@register("number_range_stored", f"SELECT number, article_key FROM ({O.range_sql(O.DOCS)}) r")
def q_number_range_stored(spark, sf_dir):
    """F1 of a period from the counts per day and the period's own days."""
    path = _stored(spark, sf_dir)
    return number_days(spark.read.parquet(f"{path}/articles"), spark.read.parquet(f"{path}/day_summary"), *O.PERIOD).select("number", "article_key")


@register("profile_period_days", _profile_sql(O.reporting_sql(O.DOCS), *O.PERIOD))
def q_profile_period_days(spark, sf_dir):
    """E11 of a period merged from day summaries, without the articles."""
    return profile_days(spark.read.parquet(f"{_stored(spark, sf_dir)}/day_summary"), *O.PERIOD).select(*_PROFILE_COLS)


@register("profile_period_days_pages", _profile_sql(O.reporting_sql(O.PAGES), *O.PERIOD))
def q_profile_period_days_pages(spark, sf_dir):
    return profile_days(spark.read.parquet(f"{_stored(spark, sf_dir, pages_articles)}/day_summary"), *O.PERIOD).select(*_PROFILE_COLS)


@register("unique_sources_days")
def q_unique_sources_days(spark, sf_dir):
    """E6 of a period from the days' sketches (an estimate; tests hold it against the exact count)."""
    return unique_sources_days(spark.read.parquet(f"{_stored(spark, sf_dir, pages_articles)}/day_summary"), *O.PERIOD)
