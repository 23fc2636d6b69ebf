"""E1 / M1 as an upsert: the unique-article table kept up to date poll by poll.

The table is a base run and a delta run, both bucketed and sorted by article key.
A poll is merged by key (E1) and joined into the delta; ``articles()``
merge-joins base and delta.  When the delta has more than ``1 / ratio`` of the
base's rows it is merged into a new base.  None of these joins shuffles or sorts a run:
only the poll's own rows are dealt.  A poll is named, and a name that
the manifest holds is not taken again, so a restarted job may repeat it.  As a
sink of a stream, ``store.sink`` is a ``foreachBatch`` function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import arrival_order, merge_by_key
from ..schema import ARTICLE_COLUMNS
from .runs import RunStore

KEY = ["article_key"]
TABLE = "articles"


class ArticleStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, ratio: int = 4):
        self.store, self.ratio = RunStore(spark, root, buckets), ratio

    def upsert(self, entries: DataFrame, poll: str) -> bool:
        """M1 of one poll; False when the poll had been taken before."""
        if self.store.is_done(poll):
            return False
        new, runs = merge_by_key(entries), self.store.runs(TABLE)
        if len(runs) < 2:
            runs = runs + [self.store.write(new, TABLE, KEY)]
        else:
            merged = _merge(self.store.open(runs[1]), self.store.dealt(new, KEY))
            runs = [runs[0], self.store.write(merged, TABLE, KEY, dealt=True)]
        if len(runs) == 2 and runs[1]["rows"] * self.ratio > runs[0]["rows"]:
            runs = [self.store.write(self._merged(runs), TABLE, KEY, dealt=True)]
        self.store.commit({TABLE: runs}, poll)
        return True

    def articles(self) -> DataFrame:
        """E1 of all polls so far: article_key, the article columns, occurrences."""
        runs = self.store.runs(TABLE)
        if not runs:
            raise ValueError(f"no poll has been stored under {self.store.root}")
        return self._merged(runs)

    def sink(self, batch: DataFrame, batch_id: int) -> None:
        self.upsert(batch, f"batch-{batch_id}")

    def _merged(self, runs: list[dict]) -> DataFrame:
        base = self.store.open(runs[0])
        return _merge(base, self.store.open(runs[1])) if len(runs) == 2 else base


def _merge(one: DataFrame, two: DataFrame) -> DataFrame:
    """Of two merged tables: the earlier first arrival of every key, and both counts."""
    columns = [*ARTICLE_COLUMNS, "occurrences"]
    a = one.select("article_key", F.struct(arrival_order().alias("at"), *columns).alias("a"))
    b = two.select("article_key", F.struct(arrival_order().alias("at"), *columns).alias("b"))
    first = F.when(F.col("b").isNull() | (F.col("a.at") <= F.col("b.at")), F.col("a")).otherwise(F.col("b"))
    seen = F.coalesce("a.occurrences", F.lit(0)) + F.coalesce("b.occurrences", F.lit(0))
    return a.hint("merge").join(b, "article_key", "full").select("article_key", first.alias("x"), seen.cast("long").alias("n")).select(
        "article_key", *[f"x.{c}" for c in ARTICLE_COLUMNS], F.col("n").alias("occurrences"))
