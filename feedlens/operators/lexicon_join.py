"""D4, I1 and I2 with a lexicon table of any size.

``scoring`` unrolls a lexicon into the plan, one ``contains`` a keyword, which
suits a few dozen.  Here keywords are rows.  A text contains a keyword only if it
contains the keyword's rarest gram of three characters (the whole keyword, if it is
shorter), so texts and keywords are joined on that gram and only these pairs
are tested with ``contains``.  Texts travel once more, for the test.

Grams are numbers, made of a whole batch's characters at a time: a text costs in proportion to
its length (``substring`` walks a text from its start).  A bitmap of fixed size over the keywords' grams keeps most
others from becoming rows; the join on the grams decides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import article_text
from ..session import checkpoint

GRAM = 3


#: Slots of the bitmap (a prime; it never decides a match).
SLOTS = 65521


def gram_numbers(text: str, size: int) -> np.ndarray:
    """The grams of a text as numbers, in order: equal for equal grams only, also of different sizes."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    count = max(len(c) - size + 1, 0)
    out = np.zeros(count, np.int64)
    for k in range(size):
        out = out * 0x110001 + c[k:k + count]  # three characters stay below 2^63
    return out


def _text_grams(sizes: list[int], slots: list[int]):
    """The distinct grams of a text, of the sizes that keywords have, as far as the bitmap has them."""
    wanted = np.zeros(SLOTS, bool)
    wanted[slots] = True

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def grams(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            g = np.concatenate([gram_numbers(text, n) for n in sizes])
            out.append(np.unique(g[wanted[g % SLOTS]]))
        return pd.Series(out)
    return grams


@F.pandas_udf(T.ArrayType(T.LongType()))
def _word_grams(words: pd.Series) -> pd.Series:
    return pd.Series([np.unique(gram_numbers(w, min(len(w), GRAM))) for w in words])


def lexicon_matches(texts: DataFrame, lexicon: DataFrame, key: str, text: str, keyword: str = "keyword") -> DataFrame:
    """Every row of ``lexicon`` joined to the ``key`` of every text that contains its
    keyword.  ``key`` is unique.  Null and empty keywords and null texts match nothing."""
    words = lexicon.where(F.col(keyword) != "")
    names = checkpoint(words.select(F.col(keyword).alias("_word")).distinct().withColumn("_wid", F.monotonically_increasing_id()), "keywords")
    body = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_text IS NOT NULL")
    sizes = [r[0] for r in names.select(F.least(F.length("_word"), F.lit(GRAM)).alias("n")).distinct().collect()]  # 1 to GRAM
    if not sizes:
        tested = body.limit(0).select("_key", F.lit("").alias("_word"))
    else:
        anchors = checkpoint(names.select("_wid", "_word", F.explode(_word_grams("_word")).alias("_gram")), "anchors")
        wanted = anchors.select("_gram").distinct()
        slots = [r[0] for r in wanted.select((F.col("_gram") % SLOTS).alias("slot")).distinct().collect()]  # SLOTS at most
        # the grams of the texts that any keyword has, written once: counted, then joined
        grams = body.select("_key", F.explode(_text_grams(sizes, slots)("_text")).alias("_gram"))
        present = checkpoint(grams.join(wanted, "_gram"), "lexicon-grams")
        common = present.groupBy("_gram").agg(F.count(F.lit(1)).alias("_df"))
        rare = anchors.join(common, "_gram", "left").withColumn("_r", F.row_number().over(
            Window.partitionBy("_wid").orderBy(F.col("_df").asc_nulls_first(), "_gram"))).where("_r = 1 AND _df IS NOT NULL")
        hits = present.join(rare.select("_gram", "_wid", "_word"), "_gram").select("_key", "_word")
        tested = hits.join(body, "_key").where(F.col("_text").contains(F.col("_word"))).select("_key", "_word")
    found = tested.join(words, tested["_word"] == words[keyword]).drop("_word")
    return found.withColumnRenamed("_key", key)


def lexicon_scores(articles: DataFrame, lexicon: DataFrame, key: str = "number") -> DataFrame:
    """D4 as a sum: (key, keyword_score, hits) of every article that has a keyword of ``lexicon`` (keyword, weight)."""
    texts = articles.select(key, article_text("title", "content").alias("_body"))
    return lexicon_matches(texts, lexicon, key, "_body").groupBy(key).agg(
        F.sum("weight").alias("keyword_score"), F.count(F.lit(1)).alias("hits"))


def lexicon_topics(articles: DataFrame, lexicon: DataFrame, default: str, key: str = "number") -> DataFrame:
    """I2 with a table (topic, priority, keyword): the topic with most keywords found,
    ties to the smaller priority; ``default`` where none is."""
    texts = articles.select(key, article_text("title", "content").alias("_body"))
    count = lexicon_matches(texts, lexicon, key, "_body").groupBy(key, "topic").agg(F.count(F.lit(1)).alias("n"), F.min("priority").alias("p"))
    best = count.groupBy(key).agg(F.min_by("topic", F.struct((-F.col("n")).alias("n"), "p")).alias("topic"))
    return articles.select(key).join(best, key, "left").select(key, F.coalesce("topic", F.lit(default)).alias("topic"))
