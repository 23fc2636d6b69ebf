import random

from feedlens.operators.selection import select_stories

from .pyref import walked_selection


def test_quota_selection_matches_greedy_walk(spark):
    rng = random.Random(1)
    for n in (0, 5, 10, 21, 40):
        rows = [(i + 1, float(rng.choice([1, 2, 3, 4, 5, 6])), rng.choice(["a", "b", "c", "general"])) for i in range(n)]
        if not rows:
            continue
        df = spark.createDataFrame(rows, "number long, impact_score double, topic string")
        got = [(r.number, r.slot) for r in select_stories(df).orderBy("position").collect()]
        assert got == walked_selection(rows)


def test_sections_follow_position(spark):
    arts = [(i + 1, float(10 - i), "same" if i < 8 else f"t{i}") for i in range(20)]
    df = spark.createDataFrame(arts, "number long, impact_score double, topic string")
    rows = select_stories(df).orderBy("position").collect()
    assert [r.section for r in rows][:6] == ["story"] * 6
    # two main stories of the dominant topic, then quick hits fill the first six positions
    assert rows[2].slot == "main" and all(r.position == i + 1 for i, r in enumerate(rows))


def test_per_period_selection(spark):
    rows = [(i + 1, float(i % 7), "t", "w1" if i < 30 else "w2") for i in range(60)]
    df = spark.createDataFrame(rows, "number long, impact_score double, topic string, week string")
    got = select_stories(df, ["week"]).groupBy("week").count().collect()
    assert {r.week: r["count"] for r in got} == {"w1": 3, "w2": 3}


def test_sentinels_for_empty_periods(spark):
    from feedlens.operators.render import (NO_SELECTION, POST_NO_TITLES, attach_links, extract_script_titles,
                                           link_post, render_script, title_url_map)
    rows = [(1, 5.0, "t", "w1", "T1", "https://a/1", "x. y. z", "a.com")]
    sel = select_stories(spark.createDataFrame(
        rows, "number long, impact_score double, topic string, week string, title string, url string, "
              "content string, source string"), ["week"])
    periods = spark.createDataFrame([("w1",), ("w2",)], "week string")
    scripts = {r.week: r.script for r in render_script(sel, ["week"], periods).collect()}
    assert scripts["w2"] == NO_SELECTION and scripts["w1"].startswith("=== BIOTECH")
    titles = extract_script_titles(render_script(sel, ["week"]), ["week"])
    url_map = title_url_map(sel, ["week"])
    posts = {r.week: r.post for r in link_post(attach_links(titles, url_map, ["week"]), ["week"],
                                               periods=periods).collect()}
    assert posts["w2"] == POST_NO_TITLES and "1. [T1](https://a/1)" in posts["w1"]
