"""Table schemas shared by the operators."""

from pyspark.sql import types as T

# One row per feed entry as it arrived.  (feed_no, entry_no) is the arrival
# order: feeds in registry order, entries in feed order.  Every "first seen"
# rule of the digest ends its ordering in these two columns.
ARTICLES = T.StructType([
    T.StructField("feed_no", T.IntegerType(), False),
    T.StructField("entry_no", T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("published_date", T.TimestampNTZType(), True),
    T.StructField("content", T.StringType(), True),
])

ARTICLE_COLUMNS = [f.name for f in ARTICLES.fields]
ORDER_COLUMNS = ["feed_no", "entry_no"]
