"""Composed jobs (M1-M3): each is a chain of DataFrame operators.

``ingest_articles``   raw entries -> unique articles (+ counters)
``query_period``      unique articles -> numbered, date-filtered, profiled
``build_digest``      queried articles -> scored selection -> script / posts

``period`` (a list of column names, e.g. ``["week"]``) makes one digest per
period in a single job; the reference's single run is the one-period case.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..operators.dedup import merge_by_key
from ..operators.filters import filter_date_range
from ..operators.ordering import number_articles, number_in_range
from ..operators.profile import profile_articles
from ..operators.render import (attach_links, extract_script_titles, link_post, render_script,
                                title_url_map)
from ..operators.scoring import prepare_reporting, score_articles
from ..operators.selection import Quotas, select_stories


@dataclass(frozen=True)
class Lexicons:
    impact: dict = None
    topics: dict = None

    def resolved(self):
        return (self.impact or L.IMPACT_KEYWORDS, self.topics or L.TOPIC_KEYWORDS)


DEFAULT_LEXICONS = Lexicons()
CORPUS_LEXICONS = Lexicons(L.CORPUS_IMPACT_KEYWORDS, L.CORPUS_TOPIC_KEYWORDS)


def ingest_articles(raw: DataFrame) -> DataFrame:
    """M1: unique articles (E1) numbered newest-first (F1)."""
    return number_articles(merge_by_key(raw))


def query_period(numbered: DataFrame, start, end) -> DataFrame:
    """M2: the articles of a date range (C1), numbers kept."""
    return filter_date_range(numbered, start, end)


def query_period_unique(unique: DataFrame, start, end) -> DataFrame:
    """M2 straight from unique articles: numbers as in the global numbering,
    computed for the range only (see ``number_in_range``)."""
    return number_in_range(unique, start, end)


def period_profile(queried: DataFrame, start, end, as_of=None) -> DataFrame:
    """M2 metadata: profile of the reporting view."""
    return profile_articles(prepare_reporting(queried), start, end, generated_at=as_of)


def with_week(df: DataFrame) -> DataFrame:
    return df.withColumn("week", F.to_date(F.date_trunc("week", "published_date")))


def build_digest(queried: DataFrame, as_of, lexicons: Lexicons = DEFAULT_LEXICONS,
                 period: list[str] | None = None, quotas: Quotas = Quotas()) -> DataFrame:
    """M3: the selection table (scored, quota-selected, positioned)."""
    impact, topics = lexicons.resolved()
    scored = score_articles(prepare_reporting(queried), as_of, impact, topics)
    return select_stories(scored, period, quotas)


def digest_documents(queried: DataFrame, as_of, lexicons: Lexicons = DEFAULT_LEXICONS,
                     period: list[str] | None = None) -> dict[str, DataFrame]:
    """M3 + R4: script, link posts and the selection, per period."""
    p = list(period or [])
    sel = build_digest(queried, as_of, lexicons, p)
    periods = queried.select(*p).distinct() if p else queried
    script = render_script(sel, p)
    titles = extract_script_titles(script, p)
    url_map = title_url_map(queried, p)
    linked = attach_links(titles, url_map, p)
    have_map = url_map.select(*p).distinct() if p else url_map
    return {
        "selection": sel,
        # every period with articles gets a document (sentinel text if nothing
        # was selected / named), matching the reference's outputs
        "script": render_script(sel, p, periods=periods),
        "post": link_post(linked, p, compact=False, have_map=have_map, periods=periods),
        "post_compact": link_post(linked, p, compact=True, have_map=have_map, periods=periods),
    }
