"""Scalar column functions: cleaning, normalization, keys, previews, summaries.

All of them are built from JVM-side Spark expressions; no row goes to Python.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------

# Whitespace as Python's str.split()/str.strip()/re "\s" see it (Unicode).
# Spark's \s and trim() are ASCII-only, so the class is spelled out; the same
# text is valid for Java regex and RE2 (the DuckDB oracle).
WS_CLASS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
WS_RUN = WS_CLASS + "+"
# The same set for the JVM, in its faster form: Java's Unicode \s (the
# White_Space property) plus the four separators Python also counts.
WS_RUN_JVM = r"(?U)[\s\x1c-\x1f]+"
TAG_PATTERN = r"<[^>]+>"

# Prefixes removed from titles, in the order they are removed.
TITLE_NOISE = ["breaking:", "breaking news:", "exclusive:", "exclusive news:"]

# HTML entities decoded on the JVM path, with their characters.  "&amp;" is
# decoded last so "&amp;lt;" becomes "&lt;" as in a single-pass unescape.
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
    ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "©"),
    ("&reg;", "®"), ("&middot;", "·"), ("&ndash;", "–"),
    ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"),
    ("&ldquo;", "“"), ("&rdquo;", "”"), ("&hellip;", "…"),
    ("&amp;", "&"),
]

# Sentence punctuation that ends a summary, and the clause breaks tried (in
# this order) when a first sentence is longer than 200 characters.
END_PUNCT = [".", "!", "?"]
BREAK_WORDS = [" and ", " but ", " however, ", " although ", " while ", " though "]

# ---------------------------------------------------------------------------

_KNOWN = "|".join(e[1:-1].replace("#", "\\#") for e, _ in ENTITIES)
# An ampersand that starts something html.unescape would look at (a name or a
# '#') and is not one of the fixed entities above.
UNKNOWN_ENTITY = "&(?!(?:" + _KNOWN + ");)[^\\t\\n\\f <&;]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(_c(col), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def collapse_ws(col) -> Column:
    """Python ``' '.join(s.split())``: single spaces, no ends."""
    return F.trim(F.regexp_replace(_c(col), WS_RUN_JVM, " "))


def empty_to_null(col) -> Column:
    c = _c(col)
    return F.when(c != "", c)


def unescape_known(col) -> Column:
    """Decode the fixed entities in one pass: split on '&' and decode the head
    of every piece once (so "&amp;lt;" stays "&lt;")."""
    c = _c(col)
    pieces = F.split(c, "&", -1)

    def decode(p: Column) -> Column:
        out = None
        for ent, ch in ENTITIES:
            name = ent[1:]
            hit = F.concat(F.lit(ch), F.substring(p, len(name) + 1, 1 << 30))
            out = F.when(p.startswith(name), hit) if out is None else out.when(p.startswith(name), hit)
        return out.otherwise(F.concat(F.lit("&"), p))

    decoded = F.array_join(F.concat(F.slice(pieces, 1, 1),
                                    F.transform(F.slice(pieces, 2, F.size(pieces)), decode)), "")
    return F.when(F.instr(c, "&") > 0, decoded).otherwise(c)


# What may follow an ampersand: a decimal or hexadecimal number, or a name.
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names that need no semicolon, which therefore also end inside a longer word.
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)


def _named() -> Column:
    """The names of HTML 5 as a literal map, from the standard library's table."""
    return F.str_to_map(F.lit("\x01".join(f"{n}\x02{v}" for n, v in html5.items())), F.lit("\x01"), F.lit("\x02"))


def _character(code: Column) -> Column:
    """The character of a code point (a byte order mark would be lost in decoding)."""
    return F.when(code == 0xFEFF, F.lit("\ufeff")).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def _numbered(number: Column) -> Column:
    """A numeric reference as HTML 5 reads it: Windows-1252 for 128 to 159, U+FFFD
    for 0, surrogates and what is too large, nothing for the other non-characters."""
    digits = F.regexp_extract(number, r"^#[xX]?0*([0-9a-fA-F]*)", 1)
    value = F.when(F.length(digits) > 8, F.lit(1 << 40)).when(digits == "", F.lit(0)).otherwise(F.when(
        number.rlike("^#[xX]"), F.conv(digits, 16, 10).cast("long")).otherwise(digits.try_cast("long")))
    windows = F.split(F.lit("|".join(bytes([k]).decode("cp1252", "ignore") or chr(k) for k in range(128, 160))), "\\|")
    low = value.bitwiseAND(F.lit(0xFFFF))
    nothing = ((value < 9) | (value == 11) | value.between(14, 31) | (value == 127) | value.between(0xFDD0, 0xFDEF)
               | (low == 0xFFFE) | (low == 0xFFFF))
    return (F.when((value == 0) | value.between(0xD800, 0xDFFF) | (value > 0x10FFFF), F.lit("\ufffd"))
            .when(value.between(128, 159), F.get(windows, (value - 128).cast("int")))
            .when(nothing, F.lit("")).otherwise(_character(value)))


def _reference(text: Column) -> Column:
    """What follows an ampersand, with its reference decoded."""
    ref = F.regexp_extract(text, _REFERENCE, 1)
    rest = F.substring(text, F.length(ref) + 1, F.lit(1 << 30))
    whole = _named()[ref]
    bare = F.get(F.filter(F.split(F.lit("|".join(_BARE)), "\\|"), lambda n: ref.startswith(n)), 0)
    tail = F.substring(ref, F.length(bare) + 1, F.lit(40))
    name = F.when(whole.isNotNull(), whole).when(bare.isNotNull(), F.concat(_named()[bare], tail)).otherwise(F.concat(F.lit("&"), ref))
    return F.concat(F.when(ref == "", F.lit("&")).when(ref.startswith("#"), _numbered(ref)).otherwise(name), rest)


def unescape_html(col) -> Column:
    """``html.unescape``.  The fixed entities are decoded by a chain of comparisons, other
    references, which few rows hold, by the whole table of names."""
    c = _c(col)
    pieces = F.split(c, "&", -1)
    every = F.array_join(F.concat(F.slice(pieces, 1, 1), F.transform(F.slice(pieces, 2, F.size(pieces)), _reference)), "")
    return F.when(c.rlike(UNKNOWN_ENTITY), every).otherwise(unescape_known(c))


def strip_tags(col) -> Column:
    """Delete anything that looks like a tag (adjacent words join)."""
    return F.regexp_replace(_c(col), TAG_PATTERN, "")


def clean_content(col) -> Column:
    """B1: tags removed, then entities decoded, then whitespace collapsed."""
    return collapse_ws(unescape_html(strip_tags(col)))


def normalize_url(col) -> Column:
    """B2: cut at '?', then at '#', drop trailing '/', lower-case.  '' -> NULL."""
    c = _c(col)
    c = F.substring_index(c, "?", 1)
    c = F.substring_index(c, "#", 1)
    c = F.regexp_replace(c, r"/+\z", "")
    return empty_to_null(F.lower(c))


def normalize_title(col) -> Column:
    """Lower, strip, then delete the noise prefixes anywhere.  '' -> NULL.
    Not idempotent: the strip happens before the deletion."""
    c = strip_ws(F.lower(_c(col)))
    for p in TITLE_NOISE:
        c = F.replace(c, F.lit(p), F.lit(""))
    return empty_to_null(c)


def content_hash(col) -> Column:
    """md5 of lower-cased, whitespace-collapsed content.  Empty -> NULL."""
    c = _c(col)
    return F.when(c != "", F.md5(collapse_ws(F.lower(c))))


def article_key(title="title", url="url", content="content",
                published="published_date") -> Column:
    """Url:, else title:, else content:, else a deterministic fallback."""
    u, t, h = normalize_url(url), normalize_title(title), content_hash(content)
    fallback = F.md5(F.concat_ws(
        "\u001f", F.coalesce(_c(title), F.lit("")), F.coalesce(_c(url), F.lit("")),
        F.coalesce(_c(published).cast("string"), F.lit("")),
        F.coalesce(_c(content), F.lit(""))))
    return F.coalesce(F.concat(F.lit("url:"), u), F.concat(F.lit("title:"), t),
                      F.concat(F.lit("content:"), h), F.concat(F.lit("fallback:"), fallback))


def extract_domain(col) -> Column:
    """URL authority (user, port kept), lower-cased; '' without '//';
    'unknown' where the authority has unbalanced IPv6 brackets."""
    c = F.regexp_replace(_c(col), "[\\t\\r\\n]", "")
    c = F.regexp_replace(c, "^[\\x00-\\x20]+", "")
    dom = F.lower(F.regexp_extract(c, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    bad = F.instr(dom, "[") > 0
    bad2 = F.instr(dom, "]") > 0
    return F.when((bad & ~bad2) | (bad2 & ~bad), F.lit("unknown")).otherwise(dom)


def preview(col, n: int = 500) -> Column:
    """First n characters + '...' when longer than n."""
    c = _c(col)
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def article_text(title="title", content="content") -> Column:
    """lower(title + ' ' + content), absent parts as ''."""
    return F.lower(F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "),
                            F.coalesce(_c(content), F.lit(""))))


def _ends_punct(c: Column) -> Column:
    return F.right(c, F.lit(1)).isin(*END_PUNCT)


def _add_period(c: Column) -> Column:
    return F.when(_ends_punct(c), c).otherwise(F.concat(c, F.lit(".")))


def summary_detailed(col) -> Column:
    """First one or two '. '-sentences, else the text cut at 200 + '...'."""
    c = F.coalesce(_c(col), F.lit(""))
    parts = F.split(c, r"\. ", -1)
    n = F.size(parts)
    one = F.concat(F.get(parts, 0), F.lit("."))
    two = F.concat(one, F.lit(" "), F.get(parts, 1), F.lit("."))
    return (F.when(n > 2, two).when(n > 1, one)
            .otherwise(preview(c, 200)))


def summary_brief(col) -> Column:
    """The quick-hit sentence (decision list, see README)."""
    c = F.coalesce(_c(col), F.lit(""))
    parts = F.split(c, r"\. ", -1)
    first_raw = strip_ws(F.get(parts, 0))
    first = _add_period(first_raw)
    second_raw = strip_ws(F.get(parts, 1))
    second_ok = (F.size(parts) >= 2) & (second_raw != "") & (F.length(second_raw) <= 200)
    breaks = [F.when((F.instr(first, w) > 0) & (F.instr(first, w) - 1 <= 200),
                     F.concat(F.substring_index(first, w, 1), F.lit(".")))
              for w in BREAK_WORDS]
    long_first = F.when(second_ok, _add_period(second_raw)).otherwise(F.coalesce(*breaks))
    from_first = (F.when(first_raw == "", F.lit(None).cast("string"))
                  .when(F.length(first) > 200, long_first)
                  .otherwise(first))
    head = strip_ws(F.left(c, F.lit(150)))
    words = F.when(head == "", F.array().cast("array<string>")).otherwise(F.split(head, WS_RUN_JVM))
    nw = F.size(words)
    by_words = F.when((F.length(c) > 150) & (nw > 3),
                      _add_period(F.array_join(F.slice(words, 1, nw - 1), " ")))
    return F.coalesce(from_first, by_words, _add_period(strip_ws(c)))


def topic_label(col) -> Column:
    """Underscores read as spaces."""
    return F.replace(_c(col), F.lit("_"), F.lit(" "))


def link_line(position, title, url) -> Column:
    """B14: 'i. [title](url)' when the URL is known, else 'i. title'."""
    p, t, u = _c(position).cast("string"), _c(title), _c(url)
    return F.when(u.isNotNull(), F.concat(p, F.lit(". ["), t, F.lit("]("), u, F.lit(")"))) \
            .otherwise(F.concat(p, F.lit(". "), t))
