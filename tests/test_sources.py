import datetime as dt
import os

from feedlens.sources.feeds import (corrupt_feed_count, extract_entries, read_entries,
                                    read_feed_registry, read_feeds)
from feedlens.sources.reports import read_article_report

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
<title>Feed One</title><description>first</description>
<item><title>Two &lt;i&gt;it&lt;/i&gt;</title><link>https://a.example.com/x?utm=1</link>
<pubDate>Tue, 02 Jan 2024 10:00:00 +0000</pubDate>
<content:encoded><![CDATA[<p>Hello &amp; <b>world</b></p>]]></content:encoded><description>short</description></item>
<item><title>No date</title><link>https://a.example.com/y</link><description>Only description</description></item>
<item><link>https://a.example.com/z</link><pubDate>Wed, 03 Jan 2024 11:30:00 GMT</pubDate><description>u</description></item>
</channel></rss>"""

ATOM = """<?xml version="1.0" encoding="utf-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>Atom feed</title>
<entry><title type="text">Atom one</title><link rel="self" href="https://b.example.com/self"/>
<link rel="alternate" href="https://b.example.com/one"/><updated>2024-01-04T08:00:00Z</updated>
<summary>sum &amp; more</summary></entry>
<entry><title>Atom two</title><link href="https://b.example.com/two"/><published>2024-01-05T09:30:00Z</published>
<content type="html">&lt;p&gt;body&lt;/p&gt;</content></entry>
</feed>"""


def test_rss_and_malformed(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "00003-x.xml"), "w") as f:
        f.write(RSS)
    with open(os.path.join(tmpdir_path, "00004-bad.xml"), "w") as f:
        f.write('<?xml version="1.0"?><rss><channel><title>t</title><item><title>x')
    feeds = read_feeds(spark, f"{tmpdir_path}/*.xml")
    c = corrupt_feed_count(feeds).collect()[0]
    assert c.malformed_feeds == 1 and c.feed_documents == 2
    rows = extract_entries(feeds, "2024-01-16 00:00:00").orderBy("entry_no").collect()
    assert [(r.feed_no, r.entry_no) for r in rows] == [(3, 0), (3, 1), (3, 2)]
    assert rows[0].title == "Two <i>it</i>" and rows[0].content == "Hello & world"
    assert rows[0].published_date == dt.datetime(2024, 1, 2, 10, 0, 0)
    assert rows[1].published_date == dt.datetime(2024, 1, 16)        # as_of fallback
    assert rows[2].title == "No title available"
    assert rows[2].published_date == dt.datetime(2024, 1, 3, 11, 30)


def test_atom(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "00007-atom.xml"), "w") as f:
        f.write(ATOM)
    rows = extract_entries(read_feeds(spark, f"{tmpdir_path}/*.xml", fmt="atom"), "2024-01-16 00:00:00",
                           fmt="atom").orderBy("entry_no").collect()
    assert [r.url for r in rows] == ["https://b.example.com/one", "https://b.example.com/two"]
    assert rows[0].published_date == dt.datetime(2024, 1, 4, 8) and rows[0].content == "sum & more"
    assert rows[1].content == "body"


def mixed_folder(path, step=0):
    """RSS, Atom and files that are neither, as they land in two steps."""
    files = [{"00003-x.xml": RSS, "00004-bad.xml": '<?xml version="1.0"?><rss><channel><title>t</title><item><title>x', "00009-moved.html": "<html>moved</html>"},
             {"feed_no=7/a.xml": ATOM, "00008-again.xml": RSS, "empty.xml": ""}][step]
    for name, text in files.items():
        os.makedirs(os.path.dirname(os.path.join(path, name)), exist_ok=True)
        with open(os.path.join(path, name), "w") as f:
            f.write(text)


def test_mixed_folder(spark, tmpdir_path):
    mixed_folder(tmpdir_path, 0)
    mixed_folder(tmpdir_path, 1)
    rows = read_entries(spark, tmpdir_path, "2024-01-16 00:00:00").collect()
    one = extract_entries(read_feeds(spark, tmpdir_path), "2024-01-16 00:00:00").collect()
    two = extract_entries(read_feeds(spark, tmpdir_path, "atom"), "2024-01-16 00:00:00", "atom").collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, one + two))
    assert sorted((r.feed_no, r.entry_no) for r in rows) == [(3, 0), (3, 1), (3, 2), (7, 0), (7, 1), (8, 0), (8, 1), (8, 2)]


def test_filtered_report(spark, tmpdir_path):
    rule = "=" * 60
    text = (f"FILTERED\n{rule}\n\nArticle 12\n" + "-" * 30 + "\nTitle: First\nURL: https://x.com/1\nSource: x.com\nPublished: 2024-01-05 10:00:00\n"
            f"Occurrences: 2\nContent Length: 345 characters\nContent: Some text\n\n{rule}\n"
            "Article 13\n" + "-" * 30 + f"\nTitle: Second\nURL: \nSource: \nPublished: None\nOccurrences: x\nContent Length: many\nContent: {'=' * 70}\n\n{rule}\n")
    with open(os.path.join(tmpdir_path, "f.txt"), "w") as f:
        f.write(text)
    rows = {r.number: r for r in read_article_report(spark, tmpdir_path, filtered=True).collect()}
    assert (rows[12].source, rows[12].content_length, rows[12].occurrences, rows[12].content) == ("x.com", 345, 2, "Some text")
    assert (rows[13].source, rows[13].content_length, rows[13].occurrences, rows[13].published_date, rows[13].url) == (None, 0, None, None, None)


def test_entries_before_a_defect_are_kept(spark, tmpdir_path):
    good = "<item><title>good</title><link>https://a/1</link><dc:date>2024-01-07T10:00:00Z</dc:date></item>"
    with open(os.path.join(tmpdir_path, "unnumbered.xml"), "w") as f:
        f.write(f"<rss><channel><title>t</title>{good}<item><title>raw & sign</title></item></channel></rss>")
    feeds = read_feeds(spark, tmpdir_path)
    assert corrupt_feed_count(feeds).collect()[0].malformed_feeds == 1
    rows = extract_entries(feeds, "2024-01-16 00:00:00").collect()
    assert [(r.feed_no, r.title, r.published_date) for r in rows] == [(None, "good", dt.datetime(2024, 1, 7, 10))]


def test_registry(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "sources.txt")
    with open(p, "w") as f:
        f.write("# comment\nhttps://a/feed\n\n  #kept\n https://b/feed \n")
    rows = read_feed_registry(spark, p).orderBy("feed_no").collect()
    assert [(r.feed_no, r.feed_url) for r in rows] == [(1, "https://a/feed"), (2, "#kept"), (3, "https://b/feed")]


REPORT = ("RSS FEED ARTICLES SUMMARY (DUPLICATES REMOVED)\n" + "=" * 70 + "\n\nTotal unique articles: 2\n\n"
          + "=" * 70 + "\n\n"
          "Article 1\n" + "-" * 30 + "\nTitle: First one\nURL: https://x.com/1\nPublished: 2024-01-05 10:00:00\n"
          "Occurrences: 2\nContent: Some text here\nmore lines\n\n" + "=" * 70 + "\n\n"
          "Article 2\n" + "-" * 30 + "\nTitle: Second\nURL: https://x.com/2\nPublished: bad date\n"
          "Occurrences: 1\nContent: Other\n\n" + "=" * 70 + "\n\n")


def test_report_reader(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "articles_summary.txt")
    with open(p, "w") as f:
        f.write(REPORT)
    rows = read_article_report(spark, p).orderBy("number").collect()
    assert [(r.number, r.title, r.url, r.occurrences) for r in rows] == [
        (1, "First one", "https://x.com/1", 2), (2, "Second", "https://x.com/2", 1)]
    assert rows[0].content == "Some text here more lines"
    assert rows[0].published_date == dt.datetime(2024, 1, 5, 10) and rows[1].published_date is None


def test_report_rules_count_at_line_start_only(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "r.txt")
    with open(p, "w") as f:
        f.write(REPORT.replace("Some text here", "before " + "=" * 75 + " after the rule").replace("more lines", "more\n== end\nnot content")
                .replace("Article 2", "Article x"))
    rows = {r.title: r for r in read_article_report(spark, p).collect()}
    assert rows["First one"].content == "before " + "=" * 75 + " after the rule more"
    assert rows["Second"].number is None and rows["Second"].content == "Other"


def test_feeds_with_sparse_numbers_land_in_few_files(spark, tmpdir_path):
    """Files follow the entries of a feed, not the range of their numbers; every entry comes back."""
    import glob

    from feedlens.plans.files import FILE_ITEMS, write_atom, write_rss
    rows = [(f, n * 1000 + f, f"t {f} {n} <&", f"https://a.example.com/{f}/{n}", dt.datetime(2024, 1, 2), f"c{n}")
            for f in (1, 2) for n in range(FILE_ITEMS + 30)]
    articles = spark.createDataFrame(rows, "feed_no int, entry_no long, title string, url string, published_date timestamp_ntz, content string")
    for fmt, write in (("rss", write_rss), ("atom", write_atom)):
        path = os.path.join(tmpdir_path, fmt)
        write(articles, path)
        assert len(glob.glob(f"{path}/feed_no=*/file=*/*.txt")) == 4  # two a feed
        got = extract_entries(read_feeds(spark, path, fmt), "2024-01-16 00:00:00", fmt).select("feed_no", "title", "url", "content").collect()
        assert sorted(map(tuple, got)) == sorted((r[0], r[2], r[3], r[5]) for r in rows)
