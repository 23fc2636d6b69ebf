"""DuckDB SQL for every registered query: the correctness oracle.

The SQL restates each operator's semantics directly (window functions,
recursive CTEs) over the same test tables; it is never used by the Spark jobs.
Helpers below build the scalar expressions; their regexes are the same strings
the Spark functions use (valid for both Java regex and RE2).
"""

from __future__ import annotations

from ..functions import lexicons as L
from ..functions import text as TX
from ..operators import render as R

AS_OF = "2024-01-16 00:00:00"
PERIOD = ("2024-01-03", "2024-01-10")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS_RUN = TX.WS_RUN


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS_RUN + '|' + WS_RUN + chr(92) + 'z')}, '', 'g')"


def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(WS_RUN)}, ' ', 'g'))"


def unescape_known(x: str) -> str:
    for ent, ch in TX.ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def clean_content(x: str) -> str:
    return collapse_ws(unescape_known(f"regexp_replace({x}, {q(TX.TAG_PATTERN)}, '', 'g')"))


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, {q(TX.TAG_PATTERN)}, '', 'g')"


def normalize_url(x: str) -> str:
    return (f"nullif(lower(regexp_replace(split_part(split_part({x}, '?', 1), '#', 1), "
            f"{q('/+' + chr(92) + 'z')}, '')), '')")


def normalize_title(x: str) -> str:
    s = strip_ws(f"lower({x})")
    for p in TX.TITLE_NOISE:
        s = f"replace({s}, {q(p)}, '')"
    return f"nullif({s}, '')"


def content_hash(x: str) -> str:
    return f"CASE WHEN {x} <> '' THEN md5({collapse_ws(f'lower({x})')}) END"


def article_key(t="title", u="url", c="content", p="published_date") -> str:
    fb = (f"md5(concat_ws(chr(31), coalesce({t}, ''), coalesce({u}, ''), "
          f"coalesce(CAST({p} AS VARCHAR), ''), coalesce({c}, '')))")
    return (f"coalesce('url:' || {normalize_url(u)}, 'title:' || {normalize_title(t)}, "
            f"'content:' || {content_hash(c)}, 'fallback:' || {fb})")


def extract_domain(x: str) -> str:
    c = f"regexp_replace(regexp_replace({x}, '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+', '')"
    d = f"lower(regexp_extract({c}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))"
    return (f"(CASE WHEN (strpos({d}, '[') > 0) <> (strpos({d}, ']') > 0) THEN 'unknown' "
            f"ELSE {d} END)")


def preview(x: str, n: int = 500) -> str:
    return f"(CASE WHEN length({x}) > {n} THEN left({x}, {n}) || '...' ELSE {x} END)"


def article_text(t="title", c="content") -> str:
    return f"lower(coalesce({t}, '') || ' ' || coalesce({c}, ''))"


def _ends_punct(x: str) -> str:
    return f"(right({x}, 1) IN ('.', '!', '?'))"


def _add_period(x: str) -> str:
    return f"(CASE WHEN {_ends_punct(x)} THEN {x} ELSE {x} || '.' END)"


def summary_detailed(x: str) -> str:
    c = f"coalesce({x}, '')"
    parts = f"string_split({c}, '. ')"
    return (f"(CASE WHEN len({parts}) > 2 THEN {parts}[1] || '. ' || {parts}[2] || '.' "
            f"WHEN len({parts}) > 1 THEN {parts}[1] || '.' ELSE {preview(c, 200)} END)")


def summary_brief(x: str) -> str:
    c = f"coalesce({x}, '')"
    parts = f"string_split({c}, '. ')"
    first_raw = strip_ws(f"{parts}[1]")
    first = _add_period(first_raw)
    second_raw = strip_ws(f"{parts}[2]")
    second_ok = f"(len({parts}) >= 2 AND {second_raw} <> '' AND length({second_raw}) <= 200)"
    brk = " ".join(
        f"WHEN strpos({first}, {q(w)}) > 0 AND strpos({first}, {q(w)}) - 1 <= 200 "
        f"THEN left({first}, strpos({first}, {q(w)}) - 1) || '.'" for w in TX.BREAK_WORDS)
    long_first = f"(CASE WHEN {second_ok} THEN {_add_period(second_raw)} {brk} END)"
    from_first = (f"(CASE WHEN {first_raw} = '' THEN NULL WHEN length({first}) > 200 THEN {long_first} "
                  f"ELSE {first} END)")
    head = strip_ws(f"left({c}, 150)")
    words = f"(CASE WHEN {head} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({head}, {q(WS_RUN)}) END)"
    by_words = (f"(CASE WHEN length({c}) > 150 AND len({words}) > 3 THEN "
                f"{_add_period(f'array_to_string({words}[1:len({words}) - 1], {q(chr(32))})')} END)")
    return f"coalesce({from_first}, {by_words}, {_add_period(strip_ws(c))})"


# --------------------------------------------------------------------------- adapters

DOCS = f"""
SELECT CAST(CAST(substr(d.source, 4) AS INTEGER) + p.poll * 100 AS INTEGER) AS feed_no,
       d.doc_id AS entry_no,
       CASE WHEN p.poll <> 2 THEN trim(split_part(d.text, chr(10), 1)) END AS title,
       CASE WHEN p.poll < 2 THEN 'https://' || d.source || '.example.com/' || CAST(d.doc_id AS VARCHAR)
            || CASE WHEN p.poll = 1 THEN '/?utm_source=rss' ELSE '' END END AS url,
       CAST(date_trunc('second', e.ts) AS TIMESTAMP) AS published_date,
       {clean_content('d.text')} AS content
FROM documents d
LEFT JOIN events e ON e.event_id = d.doc_id * 5
JOIN (SELECT 0 AS poll, NULL AS tenth UNION ALL SELECT 1, 0 UNION ALL SELECT 2, 3 UNION ALL SELECT 3, 6) p
  ON p.poll = 0 OR d.doc_id % 10 = p.tenth
"""

PAGES = f"""
SELECT CAST(pg.page_id % 13 AS INTEGER) AS feed_no,
       pg.page_id AS entry_no,
       nullif(regexp_extract(pg.html, '<title>(.*?)</title>', 1), '') AS title,
       pg.url,
       CAST(date_trunc('second', e.ts) AS TIMESTAMP) AS published_date,
       {clean_content('pg.html')} AS content
FROM pages pg
LEFT JOIN events e ON e.event_id = pg.page_id * 20
"""


def unique_sql(adapter: str) -> str:
    return f"""
SELECT article_key, feed_no, entry_no, title, url, published_date, content, occurrences FROM (
  SELECT *, row_number() OVER (PARTITION BY article_key ORDER BY feed_no, entry_no) AS rn,
         count(*) OVER (PARTITION BY article_key) AS occurrences
  FROM (SELECT *, {article_key()} AS article_key FROM ({adapter}) raw) k
) WHERE rn = 1
"""


def numbered_sql(adapter: str) -> str:
    return f"""
SELECT *, row_number() OVER (ORDER BY published_date DESC NULLS LAST, feed_no, entry_no) AS number
FROM ({unique_sql(adapter)}) u
"""


def range_sql(adapter: str, start: str = PERIOD[0], end: str = PERIOD[1]) -> str:
    return f"""
SELECT * FROM ({numbered_sql(adapter)}) n
WHERE published_date >= TIMESTAMP '{start} 00:00:00'
  AND published_date < TIMESTAMP '{end} 00:00:00' + INTERVAL 1 DAY
"""


def reporting_sql(adapter: str, start: str = PERIOD[0], end: str = PERIOD[1]) -> str:
    return f"""
SELECT *, coalesce({extract_domain('url')}, '') AS source,
       CAST(coalesce(length(content), 0) AS INTEGER) AS content_length
FROM ({range_sql(adapter, start, end)}) r
"""


def _sum(parts: list[str]) -> str:
    return " + ".join(parts) if parts else "0"


def impact_sql(text: str, impact: dict, as_of: str = AS_OF) -> str:
    kw = _sum([f"(CASE WHEN strpos({text}, {q(k)}) > 0 THEN {w} ELSE 0 END)" for k, w in impact.items()])
    age = f"floor((epoch(TIMESTAMP '{as_of}') - epoch(published_date)) / 86400)"
    return (f"CAST({kw} + coalesce(occurrences, 1) * 2 + (CASE WHEN coalesce(content_length, 0) > 300 "
            f"THEN 1 ELSE 0 END) + (CASE WHEN {age} <= 1 THEN 2 WHEN {age} <= 3 THEN 1 ELSE 0 END) AS DOUBLE)")


def topic_sql(text: str, topics: dict) -> str:
    hits = []
    for prio, (topic, words) in enumerate(topics.items()):
        h = _sum([f"(CASE WHEN strpos({text}, {q(w)}) > 0 THEN 1 ELSE 0 END)" for w in words])
        hits.append((prio, topic, h))
    # argmax with ties -> earlier topic: compare (hits, -priority)
    best = f"greatest({', '.join(f'({h}) * 100 + {99 - prio}' for prio, _, h in hits)})"
    case = " ".join(f"WHEN {best} = ({h}) * 100 + {99 - prio} THEN {q(topic)}" for prio, topic, h in hits)
    return f"(CASE WHEN {best} < 100 THEN {q(L.DEFAULT_TOPIC)} {case} END)"


def scored_sql(adapter: str, impact: dict, topics: dict, start=PERIOD[0], end=PERIOD[1],
               week: bool = False) -> str:
    text = article_text()
    wk = ", CAST(date_trunc('week', published_date) AS DATE) AS week" if week else ""
    return f"""
SELECT *, {impact_sql(text, impact)} AS impact_score, {topic_sql(text, topics)} AS topic{wk}
FROM ({reporting_sql(adapter, start, end)}) rp
"""


def selection_sql(scored: str, period: list[str]) -> str:
    """The selection as a walk down the ranked articles with caps: a main story
    while fewer than 6 are taken and fewer than 2 of its topic, among the 10
    best; then, among the next 15, a quick hit while fewer than 12 are taken
    and fewer than 3 of its topic in all."""
    pp = "".join(f"{x}, " for x in period)
    by = f"PARTITION BY {', '.join(period)}" if period else ""
    same = lambda a, b: "".join(f"{a}.{x} IS NOT DISTINCT FROM {b}.{x} AND " for x in period)
    cp = "".join(f"c.{x}, " for x in period)
    return f"""
WITH RECURSIVE cut AS (
  SELECT * FROM (SELECT *, row_number() OVER ({by} ORDER BY impact_score DESC, number) AS rank
                 FROM ({scored}) s) WHERE rank <= 25),
m AS (
  SELECT DISTINCT {pp} CAST(0 AS BIGINT) AS rank, CAST([] AS VARCHAR[]) AS seen, false AS take FROM cut
  UNION ALL
  SELECT {cp} c.rank, CASE WHEN x.ok THEN list_append(m.seen, c.topic) ELSE m.seen END, x.ok
  FROM m JOIN cut c ON {same('c', 'm')} c.rank = m.rank + 1 AND c.rank <= 10,
  LATERAL (SELECT len(m.seen) < 6 AND len(list_filter(m.seen, lambda t: t = c.topic)) < 2 AS ok) x),
rest AS (
  SELECT *, row_number() OVER ({by} ORDER BY rank) AS pos FROM cut c
  WHERE NOT EXISTS (SELECT 1 FROM m WHERE {same('m', 'c')} m.rank = c.rank AND m.take)),
w AS (
  SELECT {pp} CAST(0 AS BIGINT) AS pos, arg_max(seen, rank) AS seen, CAST(0 AS BIGINT) AS n, false AS take,
         CAST(NULL AS BIGINT) AS rank FROM m {'GROUP BY ' + ', '.join(period) if period else ''}
  UNION ALL
  SELECT {cp} c.pos, CASE WHEN x.ok THEN list_append(w.seen, c.topic) ELSE w.seen END,
         w.n + CASE WHEN x.ok THEN 1 ELSE 0 END, x.ok, c.rank
  FROM w JOIN rest c ON {same('c', 'w')} c.pos = w.pos + 1 AND c.pos <= 15,
  LATERAL (SELECT w.n < 12 AND len(list_filter(w.seen, lambda t: t = c.topic)) < 3 AS ok) x),
took AS (
  SELECT {pp} rank, 'main' AS slot FROM m WHERE take UNION ALL SELECT {pp} rank, 'quick' AS slot FROM w WHERE take),
sel AS (
  SELECT c.*, t.slot, CAST(row_number() OVER ({by.replace('BY ', 'BY c.') if period else ''} ORDER BY t.slot, c.rank) AS INTEGER) AS position
  FROM cut c JOIN took t ON {same('t', 'c')} t.rank = c.rank)
SELECT *, CASE WHEN position <= 6 THEN 'story' ELSE 'quick_hit' END AS section FROM sel
"""


def similar_sql(rules: str, threshold: float = 0.85) -> str:
    """Pairs (a, b) of equal or similar strings.  Similarity adds up the longest
    common substring (the earliest in a, then in b) and, again and again,
    those of what is left of it and right of it on both sides.  For strings
    under 200 characters."""
    longest = ("list_transform(range(1, length(sa) + 1), lambda i: "
               "len(list_filter(range(1, length(sa) - i + 2), lambda k: contains(sb, substr(sa, i, k)))))")
    return f"""
WITH RECURSIVE k AS ({rules}),
x AS (SELECT DISTINCT a FROM k WHERE a IS NOT NULL), y AS (SELECT DISTINCT b FROM k WHERE b IS NOT NULL),
p AS (SELECT a, b, length(a) + length(b) AS s FROM x, y
      WHERE a <> b AND 2.0 * least(length(a), length(b)) >= {threshold} * (length(a) + length(b)) - 1e-9),
seg AS (
  SELECT a, b, s, a AS sa, b AS sb, CAST(0 AS BIGINT) AS m FROM p
  UNION ALL
  SELECT a, b, s, unnest([substr(sa, 1, i - 1), substr(sa, i + n)]), unnest([substr(sb, 1, j - 1), substr(sb, j + n)]),
         unnest([n, 0])
  FROM (SELECT *, strpos(sb, substr(sa, i, n)) AS j
        FROM (SELECT *, list_position(ks, n) AS i
              FROM (SELECT *, list_max(ks) AS n FROM (SELECT *, {longest} AS ks FROM seg WHERE sa <> '' AND sb <> '') l1) l2) l3
        WHERE n > 0) l4)
SELECT a, b FROM seg GROUP BY a, b, s HAVING 2.0 * sum(m) / s >= {threshold}
UNION ALL SELECT a, b FROM x JOIN y ON a = b
"""
