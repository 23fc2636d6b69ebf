"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from feedlens.llm.quality_rules import STOP_WORDS

WS = r"[\x20\x09-\x0D]"

#: CRC-32 (reflected polynomial 0xEDB88320) over the bytes of the text.
SHARDING = """
WITH RECURSIVE poly(i, k, v) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(3988292384, v // 2) ELSE v // 2 END FROM poly WHERE k < 8
), crc(tab) AS (SELECT list(v ORDER BY i) FROM poly WHERE k = 8
), d AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
           xor(list_reduce(list_prepend(4294967295::BIGINT,
                   list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT)),
               lambda a, b: xor(a // 256, tab[(xor(a, b) % 256) + 1])), 4294967295::BIGINT) AS text_crc32
    FROM documents, crc
), p AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS start_byte,
           sum(size) OVER () AS total
    FROM d
), s AS (
    SELECT *, least(15, (2 * start_byte + size) * 16 // (2 * total))::INT AS shard FROM p
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY start_byte) - 1 AS slot,
       NULL::INT AS grown_shard, start_byte::BIGINT AS start_byte
FROM s
"""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
    SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)
), r(node, c) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.node
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(c) AS component_id FROM r GROUP BY node) m USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)
), f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g
), r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN f USING (g) WHERE first < doc_id
), t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w
), k AS (
    SELECT t.doc_id, count(r.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE r.p IS NULL) AS kept
    FROM t LEFT JOIN r USING (doc_id, p) GROUP BY t.doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

LINE_DEDUP = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM t),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.*, coalesce(o.owner < k.doc_id, false) AS gone FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

EXACT_DEDUP = rf"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{WS}+', ' ', 'g') AS n FROM documents),
g AS (SELECT n, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM t JOIN g USING (n)
"""

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

QUALITY_RULES = rf"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)
), r AS (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1
), n AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM r GROUP BY doc_id
), m AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln,
           len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
           length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper
    FROM t
), c AS (
    SELECT m.*, len(ln) - len(list_distinct(ln)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM m LEFT JOIN n USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 14 * n_words AND n_symbols / n_words <= 0.2
       AND n_stop / n_words >= 0.01 AND n_repeat_words / n_words <= 0.3
       AND (len(ln) = 0 OR n_dup_lines / len(ln) <= 0.5) AND n_upper / word_chars <= 0.5 AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
"""

SOURCE_AUDIT = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang
), g AS (SELECT DISTINCT lang, source FROM d
), c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY lang, source, term
), n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
           1 + (1000000000 * (coalesce(c, 0)::HUGEINT + 5)) // (coalesce(n, 0) + 5 * v) AS p
    FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN n USING (lang, source)
), q AS (
    SELECT lang, term, 1 + (1000000000 * (sum(c)::HUGEINT + 5)) // (sum(sum(c)) OVER (PARTITION BY lang) + 5 * any_value(v)) AS q
    FROM p JOIN v USING (lang) GROUP BY lang, term
), f AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), o AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q
)
SELECT * FROM (
    SELECT lang, source, part, item, value::BIGINT AS value,
           row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM o)
WHERE part = 'pair' OR rank <= 50
"""

#: Rows are walked in order with the least (cost, audit) and the repaired text per state; a path's audit
#: and the state it leaves by name each other, so the least prefix is part of the least audit.
_STATES = ("s0", "s1", "s2", "s3")


def _steps() -> str:
    """The next row's edit from every state, then the inserts that may follow it."""
    keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    nexts, role = (2, 2, 3, 2), ("user", "user", "assistant", "user")
    add = lambda q, cost, letter, line: (  # noqa: E731
        f"{{'c': w.s{q}.c + {cost}, 'a': w.s{q}.a || '{letter}', 't': list_append(w.s{q}.t, {line})}}")
    into = [[f"CASE WHEN w.s{q}.c IS NOT NULL THEN {{'c': w.s{q}.c + 2, 'a': w.s{q}.a || 'D', 't': w.s{q}.t}} END"] for q in range(4)]
    for q in range(4):
        into[nexts[q]].append(f"CASE WHEN NOT r.gone AND w.s{q}.c IS NOT NULL THEN " + add(q, "1 + r.extra", "R", f"'{role[q]}:' || r.text") + " END")
    for (initial, q), to in keep.items():
        into[to].append(f"CASE WHEN NOT r.gone AND r.initial = '{initial}' AND w.s{q}.c IS NOT NULL THEN "
                        + add(q, "r.extra", "K", "r.role || ':' || r.text") + " END")
    return ", ".join(f"list_sort(list_filter([{', '.join(x)}], lambda x: x IS NOT NULL))[1] AS s{q}" for q, x in enumerate(into))


def _inserted(w: str) -> str:
    """The same states after up to three inserts, taken where they are cheaper or ASCII-less."""
    def put(q: str, role: str) -> str:
        return f"CASE WHEN {q}.c IS NOT NULL THEN {{'c': {q}.c + 5, 'a': {q}.a || 'I', 't': list_append({q}.t, '{role}:')}} END"
    least = lambda *x: f"list_sort(list_filter([{', '.join(x)}], lambda x: x IS NOT NULL))[1]"  # noqa: E731
    two = f"(SELECT *, {least('s2', put('s0', 'user'), put('s1', 'user'), put('s3', 'user'))} AS n2 FROM {w})"
    three = f"(SELECT *, {least('s3', put('n2', 'assistant'))} AS n3 FROM {two})"
    return f"(SELECT * EXCLUDE (s2, s3, n2, n3), {least('n2', put('n3', 'user'))} AS s2, n3 AS s3 FROM {three})"


_NONE = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])"

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE poly(i, k, v) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(3988292384, v // 2) ELSE v // 2 END FROM poly WHERE k < 8
), crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS tab FROM poly WHERE k = 8
), d AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(list_prepend(4294967295::BIGINT,
                   list_transform(regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'),
                                  lambda b: ('0x' || b)::BIGINT)),
               lambda a, b: xor(a // 256, tab[(xor(a, b) % 256) + 1])), 4294967295::BIGINT) % 20 AS kind
    FROM conversations, crc
), e AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM d, (SELECT 1 AS copy UNION ALL SELECT 2) x WHERE kind <> 0 AND (copy = 1 OR kind = 3)
), o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial FROM e
), f AS (
    SELECT *, NOT regexp_matches(text, '[^ 	-]') AS blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           regexp_matches(text, '[^.!? 	-][ 	-]*$') AS cut,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS two
    FROM o
), r AS MATERIALIZED (
    SELECT *, blank OR again AS gone, CASE WHEN cut AND NOT blank AND NOT again THEN 5 ELSE 0 END AS extra, conv_id IS NULL AS nil FROM f
), walk AS (
    SELECT * FROM {{start}}
    UNION ALL
    SELECT conv_id, nil, i, s0, s1, s2, s3 FROM {{next}}
), last AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), best AS (SELECT conv_id, list_sort(list_filter([s0, s3], lambda x: x IS NOT NULL))[1] AS b FROM last
), n AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
           count(*) FILTER (WHERE again AND NOT blank) AS duplicate, count(*) FILTER (WHERE extra > 0) AS truncated,
           count(*) FILTER (WHERE two NOT IN ('su', 'ua', 'au')) AS illegal
    FROM r GROUP BY conv_id
)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
       sha256(coalesce(array_to_string(b.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM g.conv_id
""".replace("{start}", _inserted(
    f"(SELECT DISTINCT conv_id, conv_id IS NULL AS nil, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS s0, "
    f"{_NONE} AS s1, {_NONE} AS s2, {_NONE} AS s3 FROM conversations)")).replace("{next}", _inserted(
        f"(SELECT w.conv_id, w.nil, w.i + 1 AS i, {_steps()} FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)"))
