"""Registered queries against their DuckDB oracle SQL on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

from .conftest import SF001

FAST = ["articles_pages", "article_keys", "merge_by_key", "occurrence_histogram", "number_articles",
        "filter_date_range", "profile_period", "impact_scores_corpus", "selection", "render_script",
        "flag_duplicates_exact", "ingest_counters_exact", "link_post", "extract_script_titles",
        "top_sources", "peak_hour"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_a_callable_and_sql_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "position" in df.columns
