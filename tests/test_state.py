"""State between polls: a sequence of polls gives what one run over all rows gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedlens.operators.dedup import merge_by_key
from feedlens.operators.flagging import duplicate_rules, flag_duplicates, keys_of, numbered_rules
from feedlens.plans.registry import QUERIES
from feedlens.schema import ARTICLES
from feedlens.state.articles import ArticleStore
from feedlens.state.duplicates import DuplicateState
from feedlens.state.runs import RunStore, StaleStore

from . import pyref
from .test_flagging import HARD, _random_rows

T0 = dt.datetime(2024, 1, 5, 12, 0, 0)


def _frame(spark, rows):
    return spark.createDataFrame([(r["feed_no"], r["entry_no"], r["title"], r["url"], T0, r["content"]) for r in rows], ARTICLES)


def _rows(seed, n):
    rows = _random_rows(random.Random(seed), n)
    return sorted(rows, key=lambda r: (r["feed_no"], r["entry_no"]))


def _all(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------------------- articles

def test_polls_equal_one_batch(spark, tmpdir_path):
    rows = _rows(3, 60)
    random.Random(4).shuffle(rows)  # polls need not come in arrival order
    store = ArticleStore(spark, f"{tmpdir_path}/store", buckets=3, ratio=2)
    for k in range(0, 60, 20):
        assert store.upsert(_frame(spark, rows[k:k + 20]), f"poll-{k}")
    assert not store.upsert(_frame(spark, rows[:20]), "poll-0")  # taken before
    expected = _all(merge_by_key(_frame(spark, rows)))
    assert _all(store.articles()) == expected
    assert len(store.store.runs("articles")) <= 2
    again = ArticleStore(spark, f"{tmpdir_path}/store")  # another session finds it
    assert again.store.buckets == 3 and _all(again.articles()) == expected
    again.store.vacuum()
    assert _all(ArticleStore(spark, f"{tmpdir_path}/store").articles()) == expected


def test_failed_swap_leaves_the_old_version(spark, tmpdir_path):
    store = ArticleStore(spark, f"{tmpdir_path}/store", buckets=2)
    store.upsert(_frame(spark, _rows(1, 10)), "a")
    before = _all(store.articles())
    other = RunStore(spark, f"{tmpdir_path}/store")
    run = store.store.write(merge_by_key(_frame(spark, _rows(2, 10))), "articles", ["article_key"])  # no commit follows
    assert _all(ArticleStore(spark, f"{tmpdir_path}/store").articles()) == before
    store.store.commit({"articles": store.store.runs("articles") + [run]}, "b")
    with pytest.raises(StaleStore):
        other.commit({"articles": []}, "c")
    assert len(RunStore(spark, f"{tmpdir_path}/store").runs("articles")) == 2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_article_runs_are_not_shuffled(spark, tmpdir_path):
    store = ArticleStore(spark, f"{tmpdir_path}/store", buckets=4, ratio=0)
    for k in range(3):
        store.upsert(_frame(spark, _rows(k, 20)), str(k))
    plan = _plan(store.articles())
    assert plan.count("Bucketed: true") == 2 and "SortMergeJoin" in plan
    assert "Exchange" not in plan and "Sort [" not in plan


def test_no_tables_stay_in_the_catalog(spark, tmpdir_path):
    store = ArticleStore(spark, f"{tmpdir_path}/store")
    store.upsert(_frame(spark, _rows(0, 5)), "a")
    store.articles().count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("run_")]


def test_repeated_arrivals(spark):
    """Files without a feed number repeat arrivals: no row is lost or doubled."""
    rows = [{"feed_no": 0, "entry_no": k, "title": None, "url": u, "content": None} for k, u in
            ((0, "http://x/a"), (0, "http://x/a"), (1, "http://x/b"), (1, "http://x/c"))]
    df = _frame(spark, rows).select(F.lit(None).cast("int").alias("feed_no"), *ARTICLES.fieldNames()[1:])
    merged = {r["article_key"]: r["occurrences"] for r in merge_by_key(df).collect()}
    assert merged == {"url:http://x/a": 2, "url:http://x/b": 1, "url:http://x/c": 1}
    flags = sorted((r["entry_no"], r["method"]) for r in flag_duplicates(df, similar=False).collect())
    assert flags == [(0, "new"), (0, "url"), (1, "new"), (1, "new")]
    assert sorted(r["method"] for r in flag_duplicates(df.limit(2), similar=True).collect()) == ["new", "url"]


def test_same_arrival_of_other_rows_reruns_agree(spark):
    rows = [{"feed_no": 0, "entry_no": 0, "title": f"t{k}", "url": "http://x/a", "content": f"c{k}"} for k in range(5)]
    runs = {tuple(_all(merge_by_key(_frame(spark, x).repartition(n)))) for x, n in ((rows, 1), (rows[::-1], 4))}
    assert len(runs) == 1


# ---------------------------------------------------------------------------- flags

def _flags(state, spark, rows, cuts, similar):
    out = {}
    for k, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        if lo < hi:
            for r in state.flag(_frame(spark, rows[lo:hi]), f"poll-{k}").collect():
                out[r["feed_no"], r["entry_no"]] = r["method"]
    return out


@pytest.mark.parametrize("cuts", [[], [5, 9, 13]])
def test_exact_flags_over_polls(spark, tmpdir_path, cuts):
    rows = _rows(7, 24)
    state = DuplicateState(spark, f"{tmpdir_path}/state", similar=False, buckets=2, fanout=2)
    assert _flags(state, spark, rows, cuts, False) == pyref.walked_flags(_frame(spark, rows))


@pytest.mark.parametrize("cuts", [[6]])
def test_similar_flags_over_polls(spark, tmpdir_path, cuts):
    rows = _rows(11, 14)
    rows += [{"feed_no": 5, "entry_no": k, "url": f"https://x.com/{k}", "title": t, "content": f"c{k}"}
             for k, t in enumerate([HARD[1], "ab cd ef", "", "q" * 220, HARD[0], "ab cd e", None, "q" * 219 + "r", "BREAKING: Zeta eta theta"])]
    strings = duplicate_rules(_frame(spark, rows)).select("a", "b").collect()
    pairs = pyref.similar_pairs([r.a for r in strings], [r.b for r in strings])
    state = DuplicateState(spark, f"{tmpdir_path}/state", buckets=2, fanout=2)
    expected = pyref.walked_flags(_frame(spark, rows), pairs)
    assert _flags(state, spark, rows, [*cuts, 17], True) == expected
    assert "similar_title" in expected.values()


def test_seen_keys_are_not_shuffled(spark, tmpdir_path):
    state = DuplicateState(spark, f"{tmpdir_path}/state", similar=False, buckets=4)
    rows = _rows(2, 30)
    state.flag(_frame(spark, rows[:15]), "a")
    with pytest.raises(ValueError):
        state.flag(_frame(spark, rows[:15]), "a")
    rules = numbered_rules(_frame(spark, rows[15:]))
    state.flag(_frame(spark, rows[15:20]), "b")
    plan = _plan(state.seen_keys(rules))
    assert plan.count("Bucketed: true") == 2
    assert plan.count("Exchange ") == plan.count("REPARTITION_BY_NUM") == 2  # the poll's own keys, dealt to either run


def test_title_index_is_not_shuffled(spark, tmpdir_path, monkeypatch):
    """Of the joins with the title index, only the poll's side is dealt."""
    from feedlens.state import duplicates

    state = DuplicateState(spark, f"{tmpdir_path}/state", buckets=4)
    for k in range(2):
        state.flag(_frame(spark, _rows(k, 20)), str(k))
    plans = []
    monkeypatch.setattr(duplicates, "checkpoint", lambda df, label="": plans.append((label, _plan(df))) or df)
    state.seen_titles(spark.createDataFrame([("alpha beta gamma",), ("zeta eta theta iot",)], "a string"))
    plan = dict(plans)["poll-candidates"]
    scans = [i for i, line in enumerate(plan.split("\n")) if "Bucketed: true" in line]
    assert scans
    for i in scans:  # climbing from a scan of the state, a join comes before any exchange
        lines = plan.split("\n")
        depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
        for line in reversed(lines[:i]):
            d = len(line) - len(line.lstrip(" :+-"))
            if d < depth:
                depth = d
                assert "Exchange" not in line
                if "Join" in line or "Aggregate" in line:
                    break


def test_seen_titles_are_a_row_a_block(spark, tmpdir_path):
    """30 titles of 25 characters: no row for each of their grams."""
    state = DuplicateState(spark, f"{tmpdir_path}/state", buckets=2)
    texts = [f"{k:02d} " + "abcdefghijklmnopqrstuvwxyz"[k % 5:][:22].ljust(22, "z") for k in range(30)]
    state.store.commit({"blocks": [state.store.write(state._cells(spark.createDataFrame([(t,) for t in texts], "s string")), "blocks", ["cell"])]})
    assert [r["rows"] for r in state.store.runs("blocks")] == [1]
    got = {r["a"] for r in state.seen_titles(spark.createDataFrame([(texts[3] + "x",), ("nothing like it",)], "a string")).collect()}
    assert got == {texts[3] + "x"}


# ---------------------------------------------------------------------------- streams

def test_feed_stream_into_the_store(spark, tmpdir_path):
    """RSS, Atom and broken files land in two steps; the store equals the batch, also after a restart."""
    from feedlens.sources.feeds import read_entries, stream_entries
    from feedlens.streaming.ingest import start_article_store
    from .test_sources import mixed_folder

    land, store = f"{tmpdir_path}/land", ArticleStore(spark, f"{tmpdir_path}/store", buckets=2)
    for step in (0, 1):
        mixed_folder(land, step)
        q = start_article_store(stream_entries(spark, land, "2024-01-16 00:00:00"), store, f"{tmpdir_path}/ckpt", available_now=True)
        q.awaitTermination()
        batch = merge_by_key(read_entries(spark, land, "2024-01-16 00:00:00"))
        assert _all(store.articles()) == _all(batch)
    assert batch.count() > 3


def test_poll_queries_are_registered():
    import __spark_entry__

    assert {"merge_by_key_polls", "flag_duplicates_polls", "flag_duplicates_polls_pages"} <= set(QUERIES)
    assert "merge_by_key_polls" in __spark_entry__.oracle_sql()
