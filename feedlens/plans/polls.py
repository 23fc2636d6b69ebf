"""Queries over state that lives on between polls: every row of a table arrives in
one of several polls, and the answer is that of one run over all of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import table_path
from ..sources.adapters import documents_articles, pages_articles
from ..state.articles import ArticleStore
from ..state.duplicates import DuplicateState
from . import oracle as O
from .registry import DOCS, PAGES, UNIQ, _walk_sql, register

POLL_ROWS = 100  # feed_no // 100 is the poll of the documents adapter


@register("merge_by_key_polls", f"SELECT {UNIQ} FROM ({O.unique_sql(DOCS)}) u")
def q_merge_by_key_polls(spark, sf_dir):
    """E1 / M1 as an upsert: one poll after the other into the article store, the later one first."""
    store = ArticleStore(spark, table_path(spark, "article-store"))
    rows = documents_articles(spark, sf_dir)
    late = F.col("feed_no") >= POLL_ROWS
    store.upsert(rows.where(late), "poll-1")
    store.upsert(rows.where(~late), "poll-0")
    return store.articles()


def _flagged(spark, rows, polls, similar):
    state = DuplicateState(spark, table_path(spark, "duplicate-state"), similar=similar)
    flags = None
    for k, rule in enumerate(polls):
        now = state.flag(rows.where(rule), f"poll-{k}")
        flags = now if flags is None else flags.unionAll(now)
    return flags


@register("flag_duplicates_polls", _walk_sql(DOCS))
def q_flag_duplicates_polls(spark, sf_dir):
    """J2 over two polls, seen keys kept between them."""
    late = F.col("feed_no") >= POLL_ROWS
    return _flagged(spark, documents_articles(spark, sf_dir), [~late, late], similar=False)


@register("flag_duplicates_polls_pages", _walk_sql(PAGES, True))
def q_flag_duplicates_polls_pages(spark, sf_dir):
    """J3 over three polls of the pages, seen keys and the title index kept between them."""
    n = F.col("feed_no")
    return _flagged(spark, pages_articles(spark, sf_dir), [n < 4, (n >= 4) & (n < 9), n >= 9], similar=True)
