"""J2 / J3 across polls: the seen sets as tables that live on between runs.

``flag`` decides one poll against the keys of all earlier new rows and adds the
keys of its own new rows, so the flags of a sequence of polls are those of one run over
all their rows in that order.  The state is two tables of bucketed
runs:

* ``keys``     (kt, kv)             rule keys of new rows, bucketed by both
* ``blocks``   (cell, lc, texts)    the seen title strings in blocks of one length class (lc),
                                    a row a block, bucketed by its number

A poll's rows are dealt the way the runs are and joined with them; the runs
themselves are not shuffled.  For similar titles the poll's strings are put into blocks
too; each goes to the seen blocks of near length classes, and the two are compared as
``operators.similarity`` compares blocks: no pair of strings is a row.  Runs are
compacted when a table has ``fanout`` of them, blocks then filled up anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import similarity as S
from ..operators.flagging import decide, exact_hits, keys_of, method_of, numbered_rules, shared_keys
from ..session import checkpoint, discard
from .runs import RunStore

KEYS = {"keys": ["kt", "kv"], "blocks": ["cell"]}

# Strings of a block of seen titles.
SEEN_BLOCK = 1000


class DuplicateState:
    def __init__(self, spark: SparkSession, root: str, similar: bool = True, threshold: float = S.DEFAULT_THRESHOLD,
                 buckets: int | None = None, fanout: int = 4):
        self.store, self.similar, self.threshold, self.fanout = RunStore(spark, root, buckets), similar, threshold, fanout

    def runs(self, table: str) -> list[DataFrame]:
        return [self.store.open(r).hint("merge") for r in self.store.runs(table)]

    # ------------------------------------------------------------------ against the state

    def seen_keys(self, rules: DataFrame) -> DataFrame:
        """(seq, kt) for every key of the poll that an earlier poll's new row has (no key is in two runs)."""
        keys = self.store.dealt(keys_of(rules), KEYS["keys"])
        found = [keys.join(run, KEYS["keys"]).select("seq", "kt") for run in self.runs("keys")]
        return reduce(DataFrame.unionAll, found) if found else keys.select("seq", "kt").limit(0)

    def seen_titles(self, strings: DataFrame) -> DataFrame:
        """The new-side strings (a) that are similar to a seen title."""
        blocks = self.runs("blocks")
        if not blocks:
            return strings.select("a").limit(0)
        union = lambda frames: reduce(DataFrame.unionAll, frames)
        apart = S.length_classes(self.threshold)[1]
        mine = checkpoint(S.blocks_of(strings.select(F.col("a").alias("s")), self.threshold, SEEN_BLOCK).select("lc", F.col("texts").alias("a")), "poll-blocks")
        # two numbers a seen block
        cells = union([run.select("cell", "lc") for run in blocks]).distinct().withColumnRenamed("lc", "near")
        dealt = self.store.dealt(mine.join(F.broadcast(cells), F.abs(F.col("lc") - F.col("near")) <= apart).select("cell", "a"), KEYS["blocks"])
        met = union([dealt.join(run, "cell").select("a", F.col("texts").alias("b")) for run in blocks])
        return checkpoint(met.mapInArrow(S.similar_to_block(self.threshold), "a string").distinct(), "poll-candidates")

    # ------------------------------------------------------------------ one poll

    def flag(self, df: DataFrame, poll: str) -> DataFrame:
        """feed_no, entry_no, is_duplicate, method of the poll's rows, which come
        after those of all earlier polls; afterwards its keys count as seen.

        A poll that the manifest names was decided before: its rows are an error.
        """
        if self.store.is_done(poll):
            raise ValueError(f"poll {poll!r} has been flagged before")
        rules = numbered_rules(df)
        seen = checkpoint(self.seen_keys(rules), "seen-keys")
        free = rules.join(seen, "seq", "left_anti")
        like = None
        if self.similar:
            like = checkpoint(self.seen_titles(free.select("a").where("a IS NOT NULL").distinct()), "seen-titles")
            free = free.join(like, "a", "left_anti")
        free = checkpoint(free, "free")
        pairs = checkpoint(S.similar_pairs(free.select("a"), free.select("b"), self.threshold), "similar") if self.similar else None
        walk = shared_keys(free, pairs)
        status, _ = decide(walk)
        status = checkpoint(status, "status")
        new = free.join(status.where("status = 2"), "seq", "left_anti")
        # a row flagged by the state may also share an earlier rule's key with a new row of this poll
        fresh = keys_of(new).groupBy("kt", "kv").agg(F.min("seq").alias("_first"))  # new rows share no key
        inside = keys_of(rules).join(fresh, ["kt", "kv"]).where(F.col("_first") < F.col("seq")).select("seq", "kt")
        hits = seen.unionAll(inside).groupBy("seq").agg(F.min("kt").alias("kt"))
        new = checkpoint(new, "new")
        dup = F.col("_new").isNull()
        method = F.when(dup, F.coalesce(method_of(F.col("kt")), F.lit("similar_title"))).otherwise(F.lit("new"))
        flags = checkpoint(rules.select("feed_no", "entry_no", "seq").join(new.select("seq", F.lit(True).alias("_new")), "seq", "left")
                           .join(hits, "seq", "left").select("feed_no", "entry_no", dup.alias("is_duplicate"), method.alias("method")), "flags")
        self._add(new, poll)
        discard(rules, seen, free, status, new, *walk.tables(), *[x for x in (like, pairs) if x is not None])
        return flags

    def _cells(self, strings: DataFrame) -> DataFrame:
        return S.blocks_of(strings, self.threshold, SEEN_BLOCK).select(F.xxhash64("lc", "k").alias("cell"), "lc", "texts")

    def _add(self, new: DataFrame, poll: str) -> None:
        rows = {"keys": keys_of(new).select("kt", "kv").distinct()}
        if self.similar:
            rows |= {"blocks": self._cells(new.select(F.col("b").alias("s")).where("s IS NOT NULL").distinct())}
        tables = {}
        for table, df in rows.items():
            runs = self.store.runs(table) + [self.store.write(df, table, KEYS[table])]
            if len(runs) > self.fanout:  # one shuffle of the table in ``fanout`` polls
                all_rows = reduce(DataFrame.unionAll, [self.store.open(r) for r in runs])
                if table == "blocks":
                    all_rows = self._cells(all_rows.select(F.explode("texts").alias("s")).distinct())
                runs = [self.store.write(all_rows, table, KEYS[table])]
            tables[table] = runs
        self.store.commit(tables, poll)
