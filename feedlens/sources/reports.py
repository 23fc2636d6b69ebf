"""A4: read existing plain-text article reports back into rows.

A report is a header followed by article blocks separated by a rule of '='
characters at a line's start (70 in ingest reports, 60 in filtered reports).
Spark's text source splits on line break and rule (multi-character
``lineSep``), so every block is one record and the parse is a set of per-record regex extractions: no driver-side
line loop, splittable across files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_ws

INGEST_RULE = "=" * 70
FILTERED_RULE = "=" * 60
_DASHES = "-" * 30


def _field(name: str):
    return F.regexp_extract("value", r"(?m)^[ \t]*" + name + r": ([^\r\n]*?)[ \t\r]*$", 1)


def read_article_report(spark: SparkSession, path: str, filtered: bool = False) -> DataFrame:
    """Rows of (number, title, url, [source,] published_date, occurrences,
    [content_length,] content).  Unparsable dates are NULL; a bad content
    length is 0; empty fields are NULL."""
    rule = "\n" + (FILTERED_RULE if filtered else INGEST_RULE)
    blocks = spark.read.option("lineSep", rule).text(path)
    art = blocks.where(F.col("value").rlike(r"(?m)^[ \t]*Article \S+[ \t]*\r?\n[^\n]*" + _DASHES))
    # content runs to the end of its block or to a line that starts with '='
    content_tail = F.regexp_extract("value", r"(?s)\n[ \t]*Content: (.*?)(?:\n[ \t]*=.*)?\z", 1)
    content = strip_ws(F.array_join(F.transform(F.split(content_tail, r"\r?\n"), lambda l: strip_ws(l)), " "))

    def nz(c):
        return F.when(c != "", c)

    cols = [
        F.regexp_extract("value", r"(?m)^[ \t]*Article (\S+)", 1).try_cast("long").alias("number"),
        nz(_field("Title")).alias("title"),
        nz(_field("URL")).alias("url"),
    ]
    if filtered:
        cols.append(nz(_field("Source")).alias("source"))
    cols += [
        F.try_to_timestamp(_field("Published"), F.lit("yyyy-MM-dd HH:mm:ss"))
         .cast("timestamp_ntz").alias("published_date"),
        F.expr("try_cast(" + "regexp_extract(value, '(?m)^[ \\t]*Occurrences: ([^\\r\\n]*?)[ \\t\\r]*$', 1)"
               + " as bigint)").alias("occurrences"),
    ]
    if filtered:
        n = F.expr("try_cast(replace(regexp_extract(value, '(?m)^[ \\t]*Content Length: ([^\\r\\n]*?)[ \\t\\r]*$', 1),"
                   " ' characters', '') as int)")
        cols.append(F.coalesce(n, F.lit(0)).alias("content_length"))
    cols.append(nz(content).alias("content"))
    return art.select(*cols)
