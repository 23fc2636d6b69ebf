"""Day summaries, the count index, pruned date queries, heavy hitters and the lexicon join."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedlens.functions.text import article_text
from feedlens.operators import days, profile
from feedlens.operators.dedup import merge_by_key
from feedlens.operators.filters import DAY_COLUMN
from feedlens.operators.lexicon_join import lexicon_matches, lexicon_scores
from feedlens.operators.ordering import number_articles, number_in_range
from feedlens.operators.scoring import prepare_reporting
from feedlens.plans.jobs import query_period
from feedlens.sources.sinks import write_articles

UNIQUE = "article_key string, feed_no int, entry_no long, title string, url string, published_date timestamp_ntz, content string, occurrences long"


def _articles(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(12 * 24 * 6) * 10) if rng.random() < 0.95 else None
        url = rng.choice([None, "", f"https://s{rng.randrange(9)}.com/{k}", f"http://S1.com:80/{k}", "not a url"])
        rows.append((f"k{k}", rng.choice([None, 1, 2, 3]), k // 2, f"t{k}", url, at, rng.choice([None, "", "x" * rng.randrange(900)]), rng.choice([1, 1, 1, 2, 5])))
    return spark.createDataFrame(rows, UNIQUE)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    write_articles(_articles(spark), path)
    return path


RANGES = [("2024-01-03", "2024-01-06"), ("2024-01-12", "2024-01-12"), ("2023-01-01", "2025-01-01")]


@pytest.mark.parametrize("period", RANGES)
def test_profile_from_days_equals_profile(spark, stored, period):
    queried = number_in_range(_articles(spark), *period)
    expected = profile.profile_articles(prepare_reporting(queried), *period).collect()
    found = days.profile_days(spark.read.parquet(f"{stored}/day_summary"), *period).collect()
    assert [r.asDict(True) for r in found] == [r.asDict(True) for r in expected] and len(found) == 1


def test_empty_range_has_no_profile(spark, stored):
    assert days.profile_days(spark.read.parquet(f"{stored}/day_summary"), "2020-01-01", "2020-01-02").count() == 0


def test_summaries_merge(spark):
    rows = _articles(spark).cache()
    whole = days.summarize_days(rows)
    halves = [days.summarize_days(rows.where(F.col("entry_no") % 2 == k)) for k in (0, 1)]
    merged = days.merge_summaries(*halves)
    key = lambda df: sorted(map(repr, df.drop("sketch").collect()))
    assert key(whole) == key(merged)
    estimate = days.unique_sources_days(merged, "2024-01-01", "2024-01-20").first()[0]
    exact = profile.unique_sources(rows.where("published_date IS NOT NULL")).first()[0]
    assert estimate == exact  # few domains: the sketch is exact


@pytest.mark.parametrize("period", RANGES)
def test_numbers_from_the_count_index(spark, stored, period):
    full = {r.article_key: r.number for r in number_articles(_articles(spark)).collect()}
    articles = spark.read.parquet(f"{stored}/articles")
    found = days.number_days(articles, spark.read.parquet(f"{stored}/day_summary"), *period)
    rows = found.collect()
    assert rows and all(full[r.article_key] == r.number for r in rows)
    assert len(rows) == query_period(_articles(spark), *period).count()


def _partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("PartitionFilters: ")[1:] if not line.startswith("[]")]


def test_stored_period_reads_only_its_days(spark, stored, tmpdir_path):
    queried = query_period(spark.read.parquet(f"{stored}/articles"), "2024-01-03", "2024-01-05")
    assert _partition_filters(queried)
    assert {f.split(f"{DAY_COLUMN}=")[1].split("/")[0] for f in queried.inputFiles()} >= {"2024-01-03"}
    read = queried.select(F.input_file_name().alias("f")).distinct().collect()
    assert all("2024-01-03" <= r.f.split(f"{DAY_COLUMN}=")[1][:10] <= "2024-01-05" for r in read)
    numbered = days.number_days(spark.read.parquet(f"{stored}/articles"), spark.read.parquet(f"{stored}/day_summary"), "2024-01-03", "2024-01-05")
    assert numbered.count() == queried.count()


def test_run_digest_prunes(spark, tmpdir_path, monkeypatch):
    from feedlens.plans import run
    from feedlens.sources.adapters import documents_articles
    from .conftest import SF001

    seen = []
    monkeypatch.setattr(run, "query_period", lambda *a: seen.append(query_period(*a)) or seen[-1])
    run.run_digest(spark, documents_articles(spark, SF001), tmpdir_path, "2024-01-16 00:00:00", run_id="t", start="2024-01-03", end="2024-01-10")
    assert _partition_filters(seen[0])


def test_profile_reads_its_articles_once(spark):
    """Of the articles one scan, whatever the number of metrics (the record reads the merged metrics)."""
    from unittest import mock

    articles = number_in_range(_articles(spark), "2024-01-03", "2024-01-06")
    with mock.patch.object(days, "checkpoint", side_effect=lambda df, label: plans.append(df) or df):
        plans = []
        profile.profile_articles(prepare_reporting(articles), "2024-01-03", "2024-01-06")
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert len(plans) == 1 and count(plans[0]) == count(articles) <= 4


def test_merge_by_key_scans_once(spark):
    from feedlens.sources.adapters import documents_articles
    from .conftest import SF001

    plan = merge_by_key(documents_articles(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    adapter = documents_articles(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == adapter.count("FileScan")


# ---------------------------------------------------------------------------- heavy hitters

def _numbered(spark, domains):
    return spark.createDataFrame([(k + 1, f"https://{d}/x{k}") for k, d in enumerate(domains)], "number long, url string")


@pytest.mark.parametrize("shape", ["skewed", "tied", "few", "none"])
def test_heavy_hitters_equal_the_full_count(spark, shape):
    rng = random.Random(2)
    domains = {"skewed": [f"d{min(int(rng.paretovariate(0.6)), 5000)}.com" for _ in range(6000)], "tied": [f"d{k}.com" for k in range(3000)],
               "few": ["a.com", "b.com", "a.com", "c.com"], "none": []}[shape]
    rng.shuffle(domains)
    df = _numbered(spark, domains)
    assert profile.top_sources_bounded(df, 5, items=64).collect() == profile.top_sources(df, 5).collect()


def test_sketches_of_parts_merge(spark):
    rng = random.Random(5)
    df = _numbered(spark, [f"d{min(int(rng.paretovariate(0.6)), 900)}.com" for _ in range(4000)]).withColumn("part", F.col("number") % 3).cache()
    sketches = profile.source_sketch(df, ["part"], items=64)
    assert profile.top_sources_bounded(df, 5, items=64, sketches=sketches).collect() == profile.top_sources(df, 5).collect()


# ---------------------------------------------------------------------------- lexicon join

def test_large_lexicon_equals_contains(spark):
    """10,000 keywords of all lengths, against every text."""
    rng = random.Random(8)
    letters = "abcdefgh é"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(60)] + ["", None, "ab", "É é"]
    words = {"".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 9]))) for _ in range(14000)}
    words = sorted(words)[:9990] + ["", None, "not in any text at all", "ab", texts[0]]
    lexicon = spark.createDataFrame([(w, k % 7) for k, w in enumerate(words)], "keyword string, weight int")
    body = spark.createDataFrame(list(enumerate(texts)), "number int, body string")
    found = sorted((r.number, r.keyword) for r in lexicon_matches(body, lexicon, "number", "body").collect())
    assert found == sorted((n, w) for n, t in enumerate(texts) if t is not None for w in words if w and w in t)
    assert lexicon_matches(body, lexicon.limit(0), "number", "body").count() == 0


def test_lexicon_costs_a_long_text_by_its_length(spark):
    """One text of 400,000 two-byte characters: walking it from its start for every gram took minutes."""
    import time
    text = "".join(random.Random(3).choice("àéîõü ") for _ in range(400_000))
    lexicon = spark.createDataFrame([(text[-9:], 1), (text[200_000:200_004], 2), ("é", 3), ("not there", 4), ("\U0001f600é", 5)], "keyword string, weight int")
    body = spark.createDataFrame([(1, text), (2, "x\U0001f600é")], "number int, body string")
    start = time.monotonic()
    found = sorted((r.number, r.weight) for r in lexicon_matches(body, lexicon, "number", "body").collect())
    assert found == [(1, 1), (1, 2), (1, 3), (2, 3), (2, 5)]
    assert time.monotonic() - start < 60


def test_gram_numbers_tell_sizes_apart():
    from feedlens.operators.lexicon_join import gram_numbers
    texts = ["\x00", "\x00\x00", "\x00\x00\x00", "ab", "abc", "\U0010ffff" * 3, "\U0010ffff" * 2, "é"]
    numbers = [gram_numbers(t, len(t)).tolist() for t in texts]
    assert all(len(n) == 1 and n[0] > 0 for n in numbers) and len({n[0] for n in numbers}) == len(texts)
    assert gram_numbers("ab", 3).tolist() == [] and gram_numbers("abcd", 3).tolist()[1] == gram_numbers("bcd", 3)[0]


def test_lexicon_scores_equal_the_unrolled_form(spark):
    from feedlens.functions.lexicons import IMPACT_KEYWORDS
    from feedlens.operators.scoring import keyword_score

    rows = [(1, "FDA approval of gene therapy", "a breakthrough in cancer trial"), (2, None, None), (3, "crispr", "Microbiome microbiome")]
    df = spark.createDataFrame(rows, "number int, title string, content string")
    lexicon = spark.createDataFrame(list(IMPACT_KEYWORDS.items()), "keyword string, weight int")
    expected = {r.number: r.s for r in df.select("number", keyword_score(article_text("title", "content"), IMPACT_KEYWORDS).alias("s")).collect() if r.s}
    assert {r.number: r.keyword_score for r in lexicon_scores(df, lexicon).collect()} == expected
