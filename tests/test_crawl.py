"""Stored pages of a consultation site, exports and jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quern.operators import crawl
from quern.plans import jobs
from quern.sources import export

LIST = """<ul><li class="x"><a href="/yme/?p=9">Nine</a><span class="start">5 Μάιος, 2024</span></li>
<li><a href="http://www.x.gr/yme/?p=8"><b>Eight</b> </a> <span class="a start">1 Μάιος, 2024</span></li><li><a href="?p=7">Seven</a></li></ul>"""


def test_listing(spark):
    pages = spark.createDataFrame([(1, "http://www.x.gr/a/", LIST)], "n int, url string, html string")
    items = crawl.listing_items(pages, "n", "url", "html")
    got = items.orderBy("pos").collect()
    assert [(x.url, x.title, x.date) for x in got] == [("http://www.x.gr/yme/?p=9", "Nine", dt.date(2024, 5, 5)), ("http://www.x.gr/yme/?p=8", "Eight", dt.date(2024, 5, 1)), ("http://www.x.gr/a/?p=7", "Seven", None)]
    assert [x.title for x in crawl.until_known(items, F.lit("2024-05-01").cast("date")).collect()] == ["Nine"]
    assert crawl.until_known(items, F.lit(None).cast("date")).count() == 3
    known = spark.createDataFrame([("https://WWW.x.gr/yme/?p=9",)], "url string")
    assert {x.title for x in jobs.discover(items, known).collect()} == {"Eight", "Seven"}


def test_pages(spark):
    html = """<h3>Νόμος <i>για</i> κάτι</h3><p>από 3 Μαΐου 2024, 09:00 έως 7 Μαΐου 2024, 10:00</p><div class="sidespot">12 - Όλα τα Σχόλια</div>
    <div class="post_content">τ<b>ε</b></div><a class="page-numbers" href="#">2</a><span class="page-numbers current">3</span>"""
    pages = spark.createDataFrame([("http://x.gr/yme/?p=5", html)], "url string, html string")
    m = crawl.metadata(pages, "url", "html", now=F.lit("2024-05-06").cast("timestamp")).first()
    assert (m.post_id, m.title, m.start_date, m.end_date, m.is_finished, m.total_comments) == ("5", "Νόμος για κάτι", dt.datetime(2024, 5, 3, 9), dt.datetime(2024, 5, 7, 10), False, 12)
    a = crawl.article_pages(pages, "url", "html").first()
    assert (a.title, a.raw_html) == ("Νόμος για κάτι", "τ<b>ε</b>")
    urls = pages.select(crawl.comment_pages(F.col("url"), F.col("html")).alias("u")).first().u
    assert urls == ["http://x.gr/yme/?p=5"] + [f"http://x.gr/yme/?p=5&cpage={n}" for n in (1, 2, 3)]
    assert pages.select(crawl.comment_total(F.lit("<a href='/allcomments'>σε 7</a>")).alias("n")).first().n == 7
    t = spark.createDataFrame([("<table><tr><th>x</th></tr><tr><td>Ν</td><td>12</td><td>d</td><td><a href='f'>ΦΕΚ Α 1</a></td><td>1</td><td>2</td><td><a href='p.pdf'>pdf</a></td></tr></table>",)], "html string")
    assert tuple(crawl.gazette_rows(t, "html").first()) == ("Ν", "12", "d", "ΦΕΚ Α 1", "f", "1", "2", "p.pdf")


def test_redirects(spark):
    def factory():
        def resolve(url: str) -> str:
            if "bad" in url:
                raise ValueError("no")
            return url + "!"

        return resolve

    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "bad"), (4, None)], "id int, url string")
    got = {x.id: (x.redirected_url, x.error) for x in crawl.resolved(rows, "url", factory).collect()}
    assert got == {1: ("a!", None), 2: ("a!", None), 3: (None, "ValueError: no"), 4: (None, None)}


def test_jobs(spark, tmp_path):
    articles = spark.createDataFrame([("http://x.gr/?p=1", "old", "kept")], "url string, title string, content string")
    pages = spark.createDataFrame([(f"http://x.gr/?p={n}", f"<h2>T{n}</h2><div class='post_content'><p>Αβγ {n}</p></div>") for n in (1, 2, 3)], "url string, html string")
    listing = spark.createDataFrame([(1, k, f"http://x.gr/?p={k}", f"T{k}", None) for k in (1, 2)], "page_no int, pos int, url string, title string, date date")
    got = {x.url: (x.title, x.content, x.greek_percentage) for x in jobs.update(articles, pages, listing).collect()}
    assert got == {"http://x.gr/?p=1": ("old", "kept", None), "http://x.gr/?p=2": ("T2", "Αβγ 2", 75.0)}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.md").write_text("жжжжж x\n| a |\n|---|\n| 1 | 2 |\n")
    report = jobs.clean_tree(spark, str(tmp_path / "in"), str(tmp_path / "out")).first()
    assert report.malformed_tables == 1 and "table-removed" in spark.read.parquet(str(tmp_path / "out/texts")).first().text
    counts, same = jobs.verify_copy({"a": articles}, {"a": articles})
    assert counts.count() == 1 and same.first().all_match
    assert set(jobs.cleaning_stats(jobs.process_articles(pages))) == {"badness_score", "greek_percentage", "english_percentage", "methods"}


def test_exports(spark, tmp_path):
    c = spark.createDataFrame([(1, "C", "u", None, None), (2, "D", "v", None, None)], "id int, title string, url string, start_date timestamp, end_date timestamp")
    a = spark.createDataFrame([(9, 1, "A9", "x"), (3, 1, "A3", None)], "id int, consultation_id int, title string, content string")
    got = {x.id: x.text for x in export.consultation_texts(c, a).collect()}
    assert got == {1: "C\n\nu\n\nA3\n\n\nA9\nx", 2: "D\n\nv"}
    assert export.consultation_texts(c, a, 1).count() == 1
    ch = spark.createDataFrame([(1, "changed", "title"), (2, "new", "")], "id int, kind string, columns string")
    assert {x.line for x in export.change_report(ch, "id").collect()} == {"1 changed: title", "2 new"}
    export.write_texts(spark.createDataFrame([("a.md", "x\ny")], "n string, t string"), str(tmp_path / "t"), "n", "t")
    assert spark.read.text(str(tmp_path / "t")).count() == 2
    export.write_trace(ch, str(tmp_path / "trace"))
    export.write_trace(ch, str(tmp_path / "trace"))
    assert spark.read.json(str(tmp_path / "trace")).count() == 4
