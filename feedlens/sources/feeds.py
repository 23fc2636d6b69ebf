"""Feed sources (A1-A3): the feed registry and landed RSS / Atom documents.

Feeds are read with Spark's XML source at ``rowTag='channel'`` (RSS) or
``'feed'`` (Atom) with explicit schemas; the entry array is exploded with its
position so arrival order is kept.  A malformed document yields a row with
``_corrupt_record`` (counted, never fatal) and the entries read before the
defect, like a lenient feed parser that warns and continues.  A landed file
names its registry row by a folder ``feed_no=<n>`` or a file name
``<n>-<anything>.xml``; without either the number is NULL.

A folder may hold both formats: ``read_entries`` takes every document as what
its row tag says, and ``stream_entries`` does so for files as they land.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_content
from ..schema import ARTICLE_COLUMNS

# ---------------------------------------------------------------------------
# Fixed values (defaults of the reference's entry extraction)
# ---------------------------------------------------------------------------
DEFAULT_TITLE = "No title available"
FEED_TITLE_DEFAULT = "Unknown"
# ---------------------------------------------------------------------------

S = T.StringType()

RSS_SCHEMA = T.StructType([
    T.StructField("title", S), T.StructField("description", S),
    T.StructField("item", T.ArrayType(T.StructType([
        T.StructField("title", S), T.StructField("link", S), T.StructField("pubDate", S),
        T.StructField("updated", S), T.StructField("atom:updated", S), T.StructField("dc:date", S),
        T.StructField("content:encoded", S), T.StructField("description", S),
        T.StructField("summary", S)]))),
    T.StructField("_corrupt_record", S),
])

_TEXT = T.StructType([T.StructField("_VALUE", S), T.StructField("_type", S)])
ATOM_SCHEMA = T.StructType([
    T.StructField("title", _TEXT), T.StructField("subtitle", _TEXT),
    T.StructField("entry", T.ArrayType(T.StructType([
        T.StructField("title", _TEXT),
        T.StructField("link", T.ArrayType(T.StructType([T.StructField("_href", S),
                                                        T.StructField("_rel", S)]))),
        T.StructField("published", S), T.StructField("updated", S),
        T.StructField("summary", _TEXT), T.StructField("content", _TEXT)]))),
    T.StructField("_corrupt_record", S),
])


def read_feed_registry(spark: SparkSession, path: str) -> DataFrame:
    """A1: (feed_no, feed_url).  Lines are stripped; blank lines and lines that
    start with '#' (before stripping) are skipped; feed_no counts kept lines
    from 1.  Each registry file is one small record (whole-text read)."""
    files = spark.read.option("wholetext", True).text(path)
    lines = files.select(F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "raw"))
    kept = lines.where(~F.col("raw").startswith("#")).withColumn("feed_url", F.trim("raw")) \
                .where(F.col("feed_url") != "")
    from pyspark.sql import Window
    return kept.select(F.row_number().over(Window.orderBy("line_no")).cast("int").alias("feed_no"),
                       "feed_url")


def _feed_no_from_path() -> Column:
    path = F.col("_metadata.file_path")
    number = F.coalesce(F.regexp_extract(path, r"/feed_no=(\d+)/", 1).try_cast("int"),
                        F.regexp_extract(path, r"/(\d+)[^/]*$", 1).try_cast("int"))
    return number


def parse_rfc822(col: Column) -> Column:
    """RFC-822 / RFC-3339 date text -> UTC timestamp_ntz, NULL when unparsable."""
    c = F.trim(F.regexp_replace(col, r"^\s*[A-Za-z]{3},\s*", ""))
    def at(fmt):
        return F.try_to_timestamp(c, F.lit(fmt))
    ts = F.coalesce(at("d MMM yyyy HH:mm:ss Z"), at("d MMM yyyy HH:mm:ss z"),
                    at("d MMM yyyy HH:mm Z"), at("d MMM yyyy HH:mm:ss"),
                    F.try_to_timestamp(c))
    # instants -> UTC wall time (the session time zone is pinned to UTC)
    return ts.cast("timestamp_ntz")


FORMATS = {"rss": ("channel", RSS_SCHEMA), "atom": ("feed", ATOM_SCHEMA)}


def _load(reader, path: str, fmt: str) -> DataFrame:
    tag, schema = FORMATS[fmt]
    return (reader.format("xml").option("rowTag", tag).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", True)
            .schema(schema).load(path))


def _documents(raw: DataFrame, fmt: str) -> DataFrame:
    feed_no = _feed_no_from_path().alias("feed_no")
    title, description, entries = (("title", "description", "item") if fmt == "rss"
                                   else ("title._VALUE", "subtitle._VALUE", "entry"))
    return raw.select(feed_no, F.coalesce(title, F.lit(FEED_TITLE_DEFAULT)).alias("feed_title"),
                      F.coalesce(description, F.lit("")).alias("feed_description"),
                      F.col(entries).alias("entries"), "_corrupt_record")


def read_feeds(spark: SparkSession, path: str, fmt: str = "rss") -> DataFrame:
    """A2: one row per landed feed document of one format: feed_no, title,
    description, entries (array) and the corrupt-record text when the XML is malformed."""
    return _documents(_load(spark.read, path, fmt), fmt)


def extract_entries(feeds: DataFrame, as_of, fmt: str = "rss") -> DataFrame:
    """A3: entries -> articles.  Title defaults to 'No title available'; the
    date is published, else updated, else ``as_of``; content is the encoded
    content, else summary/description, cleaned (B1).  Entries of a malformed
    document that were read before the defect count."""
    e = feeds.select("feed_no", F.posexplode_outer("entries").alias("entry_no", "e")) \
          .where(F.col("e").isNotNull())
    as_of_ts = F.lit(str(as_of)).cast("timestamp_ntz")
    if fmt == "rss":
        title = F.col("e.title")
        url = F.col("e.link")
        published = F.coalesce(*[parse_rfc822(F.col(f"e.`{c}`")) for c in ("pubDate", "updated", "atom:updated", "dc:date")])
        content = F.coalesce(F.col("e.`content:encoded`"), F.col("e.summary"), F.col("e.description"),
                             F.lit(""))
    else:
        title = F.col("e.title._VALUE")
        links = F.filter("e.link", lambda l: l["_rel"].isNull() | (l["_rel"] == "alternate"))
        url = F.coalesce(F.get(links, 0)["_href"], F.get(F.col("e.link"), 0)["_href"])
        published = F.coalesce(parse_rfc822(F.col("e.published")), parse_rfc822(F.col("e.updated")))
        content = F.coalesce(F.col("e.content._VALUE"), F.col("e.summary._VALUE"), F.lit(""))
    out = e.select(
        F.col("feed_no").cast("int").alias("feed_no"),
        F.col("entry_no").cast("long").alias("entry_no"),
        F.coalesce(title, F.lit(DEFAULT_TITLE)).alias("title"),
        F.when(url != "", url).alias("url"),
        F.coalesce(published, as_of_ts).alias("published_date"),
        clean_content(content).alias("content"))
    return out.select(*ARTICLE_COLUMNS)


def read_entries(spark: SparkSession, path: str, as_of) -> DataFrame:
    """A2 + A3 + H1 over a folder of RSS and Atom documents, in one job.  A document
    that is neither has no row; of one with a defect the entries before it count."""
    parts = [extract_entries(read_feeds(spark, path, fmt), as_of, fmt) for fmt in FORMATS]
    return parts[0].unionAll(parts[1])


def stream_entries(spark: SparkSession, path: str, as_of, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream over the files that land in the folder; the log of
    files read is the stream's checkpoint."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    parts = [extract_entries(_documents(_load(reader, path, fmt), fmt), as_of, fmt) for fmt in FORMATS]
    return parts[0].unionAll(parts[1])


def corrupt_feed_count(feeds: DataFrame) -> DataFrame:
    """Malformed feed documents (reported, never fatal)."""
    # (the XML source refuses queries that read only the corrupt-record column)
    return feeds.agg(F.count_if(F.col("_corrupt_record").isNotNull()).alias("malformed_feeds"),
                     F.count("entries").alias("feeds_with_entries"),
                     F.count(F.lit(1)).alias("feed_documents"))
