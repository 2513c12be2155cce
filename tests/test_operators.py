"""Operators against plain loops: cleaning, tables, islands, sections, merges, structure, HTML, generation, sources and streams."""

from __future__ import annotations

import html
import random
import time
import re
import sqlite3

import pytest
from pyspark.sql import functions as F

from quern.operators import clean, html as pages, islands, relational, reports, sections, structure, tables, topics, upsert

MISSING, REMOVED = "<!-- text-missing -->", "<!-- table-removed -->"


def clean_by_loop(t: str, scripts) -> tuple[str, int, int]:
    """The rules of cleaning, line by line."""
    drop, out, orig, kept = set(clean.removable(scripts)), [], 0, 0
    lines = [x.removesuffix("\r") for x in (t[:-1] if t.endswith("\n") else t).split("\n")] if t else []
    for line in lines:
        if any(a in line for a in clean.ARTEFACTS):
            out.append(MISSING)
            continue
        orig += len(line)
        text, bare, at, lost = html.unescape(line), "", 0, 0
        while at < len(text):
            if text.startswith("<!--", at) and "-->" in text[at + 4 :]:
                end = text.index("-->", at + 4) + 3
                bare += text[at:end]
                at = end
            elif text[at] == "<" and not text.startswith("<!--", at) and ">" in text[at:]:
                end = text.index(">", at)
                lost += sum(not c.isspace() for c in text[at + 1 : end])
                at = end + 1
            else:
                bare += text[at]
                at += 1
        lost += sum(c in drop and not c.isspace() for c in bare)
        bare = "".join(c for c in bare if c not in drop)
        core = bare.strip()
        whole = core.startswith("<!--") and core.find("-->") == len(core) - 3 and len(core) >= 7
        extra = 0
        if lost >= 5 and not whole and core:
            bare, extra = f"{bare.rstrip()} {MISSING}", 22
        elif lost >= 5 and not whole and line.strip():
            bare, extra = MISSING, 21
        out.append(bare)
        kept += len(bare) - extra - (22 if bare == REMOVED and not extra else 0)
    text = "\n".join(out) + ("\n" if t.endswith("\n") and out else "")
    return text, orig, max(kept, 0)


CASES = ["", "\n", "abc", "abc\n", "a\r\nb", "x font=/y z", "<b>bold text</b>", "<i>a</i>", "<!-- open", "<!-- all -->", "  <!-- all -->  ", "a b", "10 µm", "ä ö ß é ñ «»", "жжжжж", "жжжжж x", "😀 中文", REMOVED, "a < b", "a <b c", "&lt;b&gt;bold&lt;/b&gt; &amp; &eacute; &#233; &#x17D;", "<p>" + "x" * 9 + "</p><!-- c --> y", "a\n\n" + MISSING, "&nope; &amp"]


@pytest.mark.parametrize("scripts", [["latin"], ["latin", "greek", "french", "spanish"]])
def test_cleaning(spark, scripts):
    r = random.Random(1)
    bits = ["a", " ", "\n", "é", "ä", "ж", "µ", "<b>", "</i>", "<!-- c -->", "<!--", "-->", "<", ">", "&amp;", "&#233;", " ", "glyph<c=", REMOVED, "ααα", "\r\n"]
    texts = CASES[:-1] + ["".join(r.choice(bits) for _ in range(r.randrange(14))) for _ in range(400)]
    rows = clean.with_clean(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t", scripts).collect()
    for x in rows:
        assert (x.cleaned, x.orig_chars, x.kept_chars) == clean_by_loop(x.t, scripts), repr(x.t)


def test_scores(spark):
    df = spark.createDataFrame([(1, "αβγ abc"), (2, ""), (3, None), (4, "жжжж")], "i int, t string")
    got = {x.i: x for x in clean.with_quality(df, "t", ["lat", "grc"]).collect()}
    assert got[1].greek_pct == 50.0 and got[1].latin_pct == 50.0 and got[1].badness == 0
    assert got[2].badness == got[3].badness == 0 and got[4].badness == 1.0
    stored = {x.i: x for x in clean.stored_scores(df, "t").collect()}
    assert stored[2].badness_score == stored[3].badness_score == 1.0 and stored[3].content_cleaned == ""


def tables_by_loop(lines):
    """Tables and issues as a scan from top to bottom finds them."""
    sep, row = re.compile(r"^\s*\|\s*[-:]+\s*\|"), re.compile(r"^\s*\|.*\|\s*$")

    def cols(x):
        x = x.strip()
        return 0 if not (x.startswith("|") and x.endswith("|")) or len(x) <= 1 else x[1:-1].count("|") + 1

    total, issues, i = 0, [], 0
    while i < len(lines):
        if sep.match(lines[i]):
            total += 1
            end = i
            while end + 1 < len(lines) and row.match(lines[end + 1]):
                end += 1
            head = i > 0 and row.match(lines[i - 1])
            start, n = (i - 1 if head else i), cols(lines[i])
            if not head:
                issues.append((i + 1, tables.NO_HEADER, None, n, start, end))
            elif cols(lines[i - 1]) != n:
                issues.append((i + 1, tables.HEADER_MISMATCH, cols(lines[i - 1]), n, start, end))
            issues += [(j + 1, tables.ROW_MISMATCH, n, cols(lines[j]), start, end) for j in range(i + 1, end + 1) if n > 0 and cols(lines[j]) != n]
            i = end
        i += 1
    return total, issues


def test_malformed_tables(spark):
    r = random.Random(2)
    kinds = ["| a | b |", "| a |", "|---|---|", "|---|", "| --- | x", "text", "", "|", "| a | b | c |", "  |:-:|--|  "]
    docs = [(i, "\n".join(r.choice(kinds) for _ in range(r.randrange(9)))) for i in range(300)]
    df = spark.createDataFrame(docs, "i int, t string")
    want_issues, want_counts, removed = set(), {}, {}
    for i, t in docs:
        lines = (t[:-1] if t.endswith("\n") else t).split("\n") if t else []
        total, issues = tables_by_loop(lines)
        want_counts[i] = (total, len(issues))
        want_issues |= {(i, *x) for x in issues}
        gone = {k for x in issues for k in range(x[4], x[5] + 1)}
        kept = [REMOVED if k in gone else x for k, x in enumerate(lines) if k not in gone or k - 1 not in gone]
        body = "\n".join(kept)
        if gone:
            body = body + "\n" if t.endswith("\n") and body != REMOVED and not body.endswith("\n") else body
            body = body.removesuffix("\n") if not t.endswith("\n") else body
        removed[i] = body if gone else t
    assert {tuple(x) for x in tables.table_issues(df, "i", "t").collect()} == want_issues
    assert {x.doc: (x.total_tables, x.malformed_tables) for x in tables.table_summary(df, "i", "t").collect()} == want_counts
    assert {x.i: x.t for x in tables.remove_malformed(df, "i", "t").collect()} == removed
    report = tables.clean_and_report(df, "i", "t")
    assert {x.i: (x.total_tables, x.malformed_tables) for x in report.collect()} == want_counts


@pytest.mark.parametrize(
    ("text", "ranges", "want"),
    [
        ("a\nb\nc", [], "a\nb\nc"),
        ("a\nb\nc", [(1, 1)], f"a\n{REMOVED}\nc"),
        ("a\nb\nc\n", [(2, 2)], f"a\nb\n{REMOVED}\n"),
        ("a\nb\nc\nd", [(0, 0), (2, 3)], f"{REMOVED}\nb\n{REMOVED}"),
        ("a\nb\nc\nd", [(0, 1), (1, 2)], f"{REMOVED}\nd"),
        ("a\nb\n", [(0, 1)], REMOVED),
        ("a\nb", [(0, 99)], REMOVED),
        ("", [(0, 0)], ""),
        ("a", [(5, 9)], "a"),
    ],
)
def test_removal(spark, text, ranges, want):
    df = spark.createDataFrame([(text, [{"start_line": a, "end_line": b} for a, b in ranges])], "t string, r array<struct<start_line:int,end_line:int>>")
    assert df.select(tables.remove_ranges(F.col("t"), F.col("r")).alias("x")).first().x == want


def test_runs(spark):
    """Running counts of breaks against the loop that carries the last number along."""
    r = random.Random(3)
    rows = [(d, k, r.randrange(-1, 8), r.choice(["arabic", "arabic", "word"])) for d in range(80) for k in range(r.randrange(12))]
    want = set()
    for d in range(80):
        runs, last, kind = [], -1, None
        for _, k, n, t in sorted(x for x in rows if x[0] == d):
            if runs and runs[-1] and t == kind and last < n <= last + 2:
                runs[-1].append(k)
            elif n >= 1:
                runs.append([k])
            else:
                runs.append([])
                last, kind = -1, None
                continue
            last, kind = n, t
        named = [x for x in runs if len(x) >= 2]
        want |= {(d, k, chr(65 + i)) for i, x in enumerate(named) for k in x}
    df = spark.createDataFrame(rows, "doc int, line_no int, number int, type string")
    assert {(x.doc, x.line_no, x.sequence) for x in islands.sequences(df).collect()} == want


def test_segments(spark):
    text = ["intro", "Άρθρο 1", "a", "", "Άρθρο 2", "b", "Άρθρο 9"]
    lines = spark.createDataFrame([(1, k, x) for k, x in enumerate(text)], "doc int, line_no int, line string")
    docs = spark.createDataFrame([(1, text), (2, ["x", "## ΠΙΝΑΚΑΣ ΠΕΡΙΕΧΟΜΕΝΩΝ ", "Άρθρο 1", "Άρθρο 2", " ", "Άρθρο 1", "a", "Άρθρο 2"]), (3, ["none"])], "doc int, lines array<string>")
    more = spark.createDataFrame([(2, 5, "Άρθρο 1", 1, "A"), (2, 7, "Άρθρο 2", 2, "A")], "doc int, line_no int, text string, number int, sequence string")
    accepted = islands.sequences(islands.headings(lines)).select(more.columns).unionByName(more)
    index = spark.createDataFrame([(2, 2), (2, 3)], "doc int, line_no int")
    got = islands.segments(docs, accepted, index).orderBy("doc", "start_line").collect()
    assert [(x.title, x.content, x.article_num, x.sequence) for x in got] == [
        ("Introduction", "intro", None, None),
        ("Άρθρο 1", "a\n", 1, "A"),
        ("Άρθρο 2", "b\nΆρθρο 9", 2, "A"),
        ("## ΠΙΝΑΚΑΣ ΠΕΡΙΕΧΟΜΕΝΩΝ", "## ΠΙΝΑΚΑΣ ΠΕΡΙΕΧΟΜΕΝΩΝ \nΆρθρο 1\nΆρθρο 2", None, "INDEX"),
        ("Άρθρο 1", "a", 1, "A"),
        ("Άρθρο 2", "", 2, "A"),
    ]
    assert spark.range(1).select(islands.title_range(F.lit("Άρθρα ( 3 – 6 )")).alias("x")).first().x == [3, 4, 5, 6]
    m = spark.createDataFrame([(1, 2, 5, False, False), (1, 2, 9, True, True), (1, 2, 12, True, False), (1, 3, 1, True, False)], "doc int, number int, pos int, line_start boolean, quoted boolean")
    assert [(x.number, x.pos) for x in islands.best_mentions(m, spark.createDataFrame([(1, 2)], "doc int, number int")).collect()] == [(2, 12)]


def test_sections(spark):
    titles = [(1, 1, "ΜΕΡΟΣ Α΄ ΓΕΝΙΚΑ"), (1, 2, "Άρθρο 1 – Σκοπός"), (1, 3, "ΚΕΦΑΛΑΙΟ Α΄ – Ορισμοί"), (1, 4, "ΜΕPOΣ Β' ΚΕΦΑΛΑΙΟ Α' x"), (1, 5, "Άρθρο 7 ΜΕΡΟ Γ"), (1, 6, "στο Μέρος Δ του ν."), (2, 1, "Άρθρο"), (2, 2, "Κεφάλαιο ΣΤ΄ – x"), (3, 1, "ΜΕΡΟΣ ΠΡΩΤΟ Γενικά"), (3, 2, "Κεφάλαιο δέκατο τρίτο: x"), (3, 3, "ΜΕΡΟΣ ΔΕΥΤΕΡΟ ΚΕΦΑΛΑΙΟ ΠΡΩΤΟ")]
    df = spark.createDataFrame(titles, "consultation_id int, id int, title string")
    got = [(x.consultation_id, x.id, x.part, x.chapter) for x in sections.parse_titles(df).orderBy("consultation_id", "id").collect()]
    assert got == [(1, 1, "Α'", None), (1, 2, "Α'", None), (1, 3, "Α'", "Α'"), (1, 4, "Β'", "Α'"), (1, 5, "Γ'", None), (1, 6, "Γ'", None), (2, 1, None, None), (2, 2, None, "ΣΤ'"), (3, 1, "Α'", None), (3, 2, "Α'", "ΙΓ'"), (3, 3, "Β'", "Α'")]
    numbers = spark.createDataFrame([(1, 1, 2, 1), (1, 2, 2, 1), (1, 3, 3, 2), (1, 4, 5, None), (2, 1, 1, 1), (2, 2, 1, 2)], "g int, o int, p int, c int")
    assert [x.problem for x in sections.continuity(numbers, "g", "o", "p", "c").orderBy("o", "problem").collect()] == ["parts start with 2", "chapters start with 2", "part 3 is followed by 5"]
    assert {x.g: x.status for x in sections.continuity_summary(numbers, "g", "o", "p", "c").collect()} == {1: "issues", 2: "ok"}


def test_matching(spark):
    refs = spark.createDataFrame([(1, " A1 ", 2001, None), (2, "a1", None, "X"), (3, "b", 1, "y"), (4, "zz", None, None)], "ref_id int, id string, year int, series string")
    cat = spark.createDataFrame([(10, "a1", 2001, "x"), (11, "A1 ", 2002, "q"), (12, "b", 2, "y")], "cat_id int, id string, year int, series string")
    assert {tuple(x) for x in relational.match_decisions(refs, cat).collect()} == {(1, 10), (2, 10)}
    q = spark.createDataFrame([(1, "u1"), (2, "x")], "k int, term string")
    c = spark.createDataFrame([(5, "u1"), (6, "axb"), (7, "xx")], "id int, url string")
    got = relational.cascade(q, "k", "term", [(c, F.col("url"), "exact"), (c, "contains(c.url, q.term)", "part")], "id").collect()
    assert {(x.k, x.match_id, x.tier_name) for x in got} == {(1, 5, "exact"), (2, 6, "part")}


def test_merges(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", None)], "k int, v string, done boolean")
    new = spark.createDataFrame([(1, "z", True), (2, None, True), (3, "d", False), (4, "n", False)], "k int, v string, done boolean")
    assert {tuple(x) for x in upsert.merge(old, new, "k", "done").collect()} == {(1, "a", True), (2, "b", True), (3, "d", False), (4, "n", False)}
    assert {tuple(x) for x in upsert.changes(old, new, "k", ["v", "done"], "done").collect()} == {(2, "changed", "v,done"), (3, "changed", "v,done"), (4, "new", "")}
    assert tuple(upsert.change_summary(old, new, "k").first()) == (1, 3, 0)
    assert {x.k for x in upsert.above_mark(new, old.where("k < 0"), "k").collect()} == {1, 2, 3, 4} and {x.k for x in upsert.above_mark(new, old, "k").collect()} == {4}
    path = str(tmp_path / "t")
    upsert.write_merge(spark, path, old, "k", buckets=3)
    first = upsert._latest(spark, path)[1]
    upsert.write_merge(spark, path, new.where("k = 4"), "k", "done")
    second = upsert._latest(spark, path)[1]
    assert sum(first.get(k) != second[k] for k in second) == 1 and second["buckets"] == 3  # the other buckets are as they were
    assert {x.k: x.v for x in upsert.read_merged(spark, path).collect()} == {1: "a", 2: "b", 3: "c", 4: "n"}
    upsert.write_merge(spark, path, new, "k", "done")
    upsert.write_merge(spark, path, new.limit(0), "k", "done")
    assert {x.k: x.v for x in upsert.read_merged(spark, path).collect()} == {1: "a", 2: "b", 3: "d", 4: "n"}
    (tmp_path / "t/v99-crashed").mkdir()  # what a run that didn't come to its end leaves
    assert upsert.read_merged(spark, path).count() == 4


def test_reports(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, "d")], "k int, v string")
    got = {x.field: x for x in reports.completeness(df, "t", {"v": "d"}).collect()}
    assert (got["v"].nulls, got["v"].empties, got["v"].defaults, got["v"].populated, got["v"].rate) == (1, 1, 1, 1, 25.0)
    h = reports.histogram(spark.createDataFrame([(0.05,), (0.31,), (None,)], "x double"), "x").orderBy("bin").collect()
    assert [x.n for x in h] == [1, 0, 0, 1]
    assert topics.stop_words(spark.createDataFrame([("a a b",)], "t string"), "t", 1).collect()[0].word == "a"


def test_structure(spark):
    body = 'before\n## Άρθρο 1 Τίτλος\nα\n**ΑΡΘΡΟ 2**\nβ'
    df = spark.createDataFrame([(body, "T"), ("no header", "Άρθρο 7"), (" ", "x"), (None, "x")], "c string, t string")
    got = [[(x.content, x.article_number) for x in r.x] for r in df.select(structure.article_chunks(F.col("c"), F.col("t")).alias("x")).collect()]
    assert got == [[("Τίτλος\nα", 1), ("**\nβ", 2)], [("no header", 7)], [], []]
    items = list("abcdefg")
    rows = spark.createDataFrame([(items, [3, 3, 3, 9, 1, 1, 1])], "i array<string>, c array<int>")
    assert rows.select(structure.chunks(F.col("i"), F.col("c"), 6).alias("x")).first().x == [["a", "b"], ["b", "c"], ["c", "d"], ["d", "e", "f", "g"]]
    one = structure.pairwise_reduce(spark.createDataFrame([(1, k, str(k)) for k in range(5)], "g int, o int, v string"), "g", "o", "v", lambda a, b: f"({a}{b})").first()
    assert (one.v, one.rounds) == ("(((01)(23))4)", 3)


def test_html(spark):
    page = "<head><title> T </title></head><h2>Head</h2><p>One <b>two</b></p><ul><li>x<li>y</ul><a href='/z?p=12'>Link it</a><script>no</script>"
    assert pages.to_markdown(page) == "## Head\n\nOne two\n\n* x\n* y\n\n[Link it](/z?p=12)" and pages.to_markdown(None) == ""
    df = spark.createDataFrame([(1, page), (2, None)], "i int, h string")
    got = df.select(pages.page_title(F.col("h")).alias("t"), pages.article_links(F.col("h")).alias("l"), pages.paragraphs(F.col("h")).alias("p")).first()
    assert got.t == "T" and got.l[0].post_id == "12" and got.p == ["One two"]
    listed = "<li id='comment-5'><cite class='fn'>Ann</cite><div class='date'>1 May</div><p>Hi</p><p>there</p></li><li id='comment-5'>again</li><li id='comment-6'><p>x</p></li>"
    c = pages.comments(spark.createDataFrame([(1, listed)], "i int, h string"), "i", "h").collect()
    assert [(x.comment_id, x.username, x.date, x.content) for x in c] == [("5", "anonymous", "1 May", "Hi\n\nthere"), ("6", "anonymous", "", "x")]
    assert pages.parse_comments(listed, keep_names=True)[0]["username"] == "Ann"
    todo = spark.createDataFrame([(1, "", "<p>a</p>"), (2, "kept", "<p>b</p>"), (3, None, None)], "id int, content string, raw_html string")
    assert {x.id: (x.content, x.extraction_method) for x in pages.convert_blank(todo).collect()} == {1: ("a", "html"), 2: ("kept", None), 3: (None, None)}


def test_generation(spark):
    from quern.operators import generate as g

    tries = []
    assert g.with_retries(lambda p, n: tries.append(n) or "x", "p", 100, lambda a: False) == ("x", 3) and tries == [100, 70, 49]
    assert g.continued(lambda p, n: "and so on." if "half" in p else "half", "p", 9) == "half and so on."
    with pytest.raises(KeyError):
        g.prompt("none")
    rows = [(1, "Σκοπός", "κείμενο", 1), (2, "x", "Στον ν. 1/2020:\n«α\nβ» " + "w " * 90, 3), (3, "x", "", 4)]
    got = {x.id: x for x in g.stage_one(spark.createDataFrame(rows, "id int, title string, content string, article_number int")).collect()}
    assert (got[1].route, got[2].route, got[3].route) == ("purpose", "summarise", "skip") and got[2].decision == "modifies" and got[2].bullet.startswith("•")
    parts = spark.createDataFrame([("A", "i", "s1"), ("A", "ii", "s2"), ("B", "i", "s3")], "part string, chapter string, summary string")
    assert {x.part: x.paragraphs for x in g.part_summaries(parts, "part", "chapter").collect()} == {"A": 2, "B": 1}
    assert spark.range(1).select(g.theme_lines(F.lit("- a\n\n• b ")).alias("x")).first().x == ["a", "b"]
    shown = g.usable(spark.createDataFrame([("ok",), ("[ERROR x",), (None,)], "t string"), "t").collect()
    assert [x.t for x in shown] == ["ok"]


def test_sources(spark, tmp_path):
    from quern.sources import files

    (tmp_path / "md/sub").mkdir(parents=True)
    (tmp_path / "md/a.md").write_text("# A\n")
    (tmp_path / "md/sub/b.md").write_text("B")
    (tmp_path / "md/c.txt").write_text("C")
    assert {(x.name, x.text) for x in files.read_markdown(spark, str(tmp_path / "md")).collect()} == {("a.md", "# A\n"), ("b.md", "B")}
    with sqlite3.connect(tmp_path / "x.db") as db:
        db.execute("create table t (id integer primary key, name varchar(9), score real)")
        db.executemany("insert into t values (?, ?, ?)", [(i, f"n{i}", i / 2) for i in range(1, 11)])
    for n in (1, 3):
        got = files.read_sqlite(spark, str(tmp_path / "x.db"), "t", "id", n)
        assert got.dtypes == [("id", "bigint"), ("name", "string"), ("score", "double")] and sorted(x.id for x in got.collect()) == list(range(1, 11))
    issues = spark.createDataFrame([("f", 'a "b", c', 3, 4), ("f", "x", 0, 1), ("f", "y", 0, 1)], "file_path string, issue_description string, table_start_line int, table_end_line int")
    files.write_csv(issues, str(tmp_path / "csv"), ["table_start_line"])
    assert [tuple(r) for r in files.read_table_ranges(spark, str(tmp_path / "csv")).first().ranges] == [(0, 1), (3, 4)]
    files.write_split(issues, F.col("table_start_line") > 0, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1 and spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_stream_upserts(spark, tmp_path):
    from quern.streaming.incremental import read_events, upsert_into

    source, target = str(tmp_path / "in"), str(tmp_path / "table")
    for n in range(3):
        spark.createDataFrame([(k, f"v{n}", n) for k in range(n, n + 3)], "k int, v string, n int").coalesce(1).write.mode("append").parquet(source)
    stream = read_events(spark, source, spark.read.parquet(source).schema)
    query = stream.writeStream.foreachBatch(upsert_into(target, "k", order="n")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert {x.k: x.v for x in upsert.read_merged(spark, target).collect()} == {0: "v0", 1: "v1", 2: "v2", 3: "v2", 4: "v2"}


def test_streams_over_several_batches(spark, tmp_path):
    """State goes on from batch to batch, and what is later than the watermark allows is dropped."""
    from quern.streaming.incremental import drained, joined, read_events, tumbling

    times = [["2024-01-01 00:10", "2024-01-01 02:30"], ["2024-01-01 00:50", "2024-01-03 00:00"], ["2024-01-01 00:20", "2024-01-03 00:30"]]
    source = str(tmp_path / "in")
    for n, batch in enumerate(times):
        rows = spark.createDataFrame([("a", t, 10 * n + k) for k, t in enumerate(batch)], "user string, t string, id int").selectExpr("user", "cast(t as timestamp) as ts", "id")
        rows.coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)  # files are read in the order of their times
    schema = spark.read.parquet(source).schema
    read = lambda: read_events(spark, source, schema)
    got = drained(tumbling(read(), "ts", ["user"], "1 hour", "1 hour", "id"), str(tmp_path / "s1"))
    assert {(x.start.hour, x.start.day): (x.n, x.total) for x in got.collect()} == {(0, 1): (2, 10), (2, 1): (1, 1)}
    pairs = drained(joined(read(), read(), "user", "ts", "3 hours", "10 days").select("id", "next_id"), str(tmp_path / "s2"))
    assert {(x.id, x.next_id) for x in pairs.collect() if x.id != x.next_id} == {(0, 1), (0, 10), (10, 1), (20, 1), (0, 20), (20, 10), (11, 21)}


def test_generation_reads_all_documents(spark, tmp_path):
    from quern.plans import incremental as i

    docs = spark.range(600).selectExpr("id as doc_id", "concat('text ', id) as text", "if(id % 10 < 9, 'hot', 'b') as source", "if(id % 2 = 0, 'en', 'el') as lang")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    routed = i.stage_one_routing(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in routed} == set(range(600)) and len(routed) == 600
    prompts = {(x.part, x.chapter): x.prompt.split("\n") for x in i.chapter_bullets(spark, str(tmp_path)).collect()}
    assert {k: len(v) for k, v in prompts.items()} == {("hot", "en"): 300, ("hot", "el"): 240, ("b", "el"): 60}
    assert {x.part: x.paragraphs for x in i.part_narratives(spark, str(tmp_path)).collect()} == {"hot": 2, "b": 1}


def test_chapter_prompts_are_in_order(spark):
    from quern.operators.generate import chapter_prompts

    rows = spark.range(500).selectExpr("'A' as part", "'i' as chapter", "499 - id as n", "concat('b', 499 - id) as bullet").repartition(7)
    assert chapter_prompts(rows, "part", "chapter", "n").first().prompt == "\n".join(f"b{k}" for k in range(500))


def test_text_queries_read_whole_tables(spark, tmp_path):
    from quern.plans import text

    spark.range(6000).selectExpr("id as o_orderkey", "id % 99 as o_custkey", "date '1995-01-31' as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(2500).selectExpr("id as event_id", "'click' as event_type").write.parquet(f"{tmp_path}/events.parquet")
    spark.range(400).selectExpr("id as c_custkey", "concat('C', id) as c_name").write.parquet(f"{tmp_path}/customer.parquet")
    for name, key, n in (("extract_year", "o_orderkey", 6000), ("parse_dates", "o_orderkey", 6000), ("citation_extract", "o_orderkey", 6000), ("json_validated_parse", "event_id", 2500), ("plan_validation", "c_custkey", 400), ("scope_detect", "c_custkey", 400)):
        assert text.QUERIES[name](spark, str(tmp_path)).select(key).distinct().count() == n, name
    last = {x.o_orderkey: x.at for x in text.parse_dates(spark, str(tmp_path)).where("o_orderkey > 5997").collect()}
    assert [str(last[k]) for k in (5998, 5999)] == ["1995-01-31 22:15:00", "1995-01-31 23:15:00"]
    assert text.citation_extract(spark, str(tmp_path)).where("o_orderkey = 5998 and pos = 1").first().number == "5998"


def test_answers_that_break_off():
    from quern.operators.generate import shortened

    asked = []

    def model(answers):
        left = iter(answers)

        def answer(text, most):
            asked.append((text, most))
            return next(left)

        return answer

    assert shortened(model(["Done."]), "x", 10) == "Done." and asked == [("x", 10)]
    assert shortened(model(["It goes on and", "Short."]), "x", 10) == "Short." and asked[-1][1] == 8 and "It goes on and" in asked[-1][0]
    assert shortened(model(["It goes on and", "It"]), "x", 10) == "It goes on and"
    assert shortened(model(["It", "It goes on and"]), "x", 10) == "It goes on and"


def test_jobs_and_sinks(spark, tmp_path):
    from quern.operators.clean import BASE_SCRIPTS, script_list
    from quern.plans import jobs
    from quern.sources import files

    (tmp_path / "in/deep").mkdir(parents=True)
    (tmp_path / "in/a.md").write_text("Some text\n| a | b |\n|---|\n| c | d |\nmore\n")
    (tmp_path / "in/deep/b.md").write_text("plain ελληνικά\n")
    source = str(tmp_path / "in")
    jobs.score_tree(spark, source, str(tmp_path / "scores"))
    assert sorted(r["File Name"] for r in spark.read.csv(str(tmp_path / "scores"), header=True).collect()) == ["a.md", "b.md"]
    assert sorted((x.total_tables, x.malformed_tables) for x in jobs.tables_of_tree(spark, source, str(tmp_path / "tables")).collect()) == [(0, 0), (1, 2)]
    assert spark.read.csv(str(tmp_path / "tables/issues"), header=True).count() == 2
    jobs.without_tables(spark, source, str(tmp_path / "bare"))
    assert {r.text for r in spark.read.parquet(str(tmp_path / "bare")).collect()} == {f"Some text\n{REMOVED}\nmore\n", "plain ελληνικά\n"}
    titles = spark.createDataFrame([(1, 1, "ΜΕΡΟΣ Α"), (1, 2, "ΜΕΡΟΣ Γ")], "consultation_id int, id int, title string")
    titles.write.parquet(str(tmp_path / "titles"))
    assert [(x.status, x.articles) for x in jobs.sections_of(spark, str(tmp_path / "titles"), str(tmp_path / "out")).collect()] == [("issues", 2)]
    assert spark.read.json(str(tmp_path / "out/summary")).first().problems == ["part 1 is followed by 3"]
    comments = spark.createDataFrame([(2, "β"), (1, "a,b")], "id int, text string")
    files.write_comments_csv(comments, str(tmp_path / "comments"), ["id"])
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "comments").glob("part*")))
    assert raw.decode("utf-8-sig").split("\n")[:2] == ["id,text", '1,"a,b"'] and raw.startswith(b"\xef\xbb\xbf")
    files.write_matches_json(comments, spark.createDataFrame([(1, "x"), (1, "y")], "id int, law string"), "id", str(tmp_path / "json"))
    assert [(r.id, sorted(m.law for m in r.matched_data)) for r in spark.read.json(str(tmp_path / "json")).collect()] == [(1, ["x", "y"])]
    schema = spark.createDataFrame([], "id long, text string, status string").schema
    files.copy_table(comments, str(tmp_path / "copy"), schema, {"status": "pending"})
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "copy")).collect()} == {(1, "a,b", "pending"), (2, "β", "pending")}
    assert script_list(["greek", "numbers"]) == ["greek", "numbers", *(s for s in BASE_SCRIPTS if s != "numbers")]


def test_nested_content(spark):
    from quern.operators.crawl import div_content

    pages = ["<div class='post_content'>a<div>b</div>c</div>d", "<p>x</p><DIV id=1 class=\"m post_content\">a<b>y</b>", "<div class='post_content-2'>x</div>", "", None, "<div class='post_content'></div>"]
    df = spark.createDataFrame([(p,) for p in pages], "h string")
    assert [r.x for r in df.select(div_content(F.col("h"), "post_content").alias("x")).collect()] == ["a<div>b</div>c", "a<b>y</b>", None, None, None, ""]
