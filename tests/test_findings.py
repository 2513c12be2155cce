"""Cases of the third review's findings."""

from __future__ import annotations

from pyspark.sql import functions as F


def test_cleaning_leaves_names_without_semicolon(spark):
    from quern.operators.clean import clean_text

    rows = spark.createDataFrame([("a &amp b &amp; c &copy&copy; &amp",)], "t string")
    assert rows.select(clean_text(F.col("t"), ["latin"]).alias("c")).first().c == "a &amp b & c &copy© &amp"


def test_links_that_repeat_are_listed_once(spark):
    from quern.operators.html import article_links

    twice = "<a href='/x/?p=1'>first</a><a href='/x/?p=2'>second</a><a href='/x/?p=1'>first</a><a href='/x/?p=1'>other</a>"
    rows = spark.createDataFrame([(1, twice), (2, None)], "k int, h string").select("k", article_links(F.col("h")).alias("l"))
    assert {r.k: [x.title for x in r.l] for r in rows.collect()} == {1: ["first", "second"], 2: []}


def test_forms_work_out_each_state_once(monkeypatch):
    from quern.functions.forms import PROVISION, Automaton

    machine, asked, inner = Automaton(PROVISION), [], Automaton.next
    monkeypatch.setattr(Automaton, "next", lambda self, state: asked.append(state) or inner(self, state))
    answer = '{"article_title": "' + "x" * 1000 + '", "provision_type": "ρύθμιση", "core_provision_summary": "s", "key_themes": ["a_1"]}'
    for _ in range(3):
        n, state = machine.reach(answer)
        assert n == len(answer) and machine.complete(state)
    assert len(asked) < 200


def test_plain_pages_are_read_as_the_parser_reads_them(monkeypatch):
    import random

    from quern.operators.elements import Page, linked_articles

    class Parsed(Page):
        def _tokens(self, html):
            return None

    bits = ["<p>", "</p>", "<div class=a b='x &amp; y'>", "</DIV>", "<LI>", "<br>", "<br/>", "<a href='?a=1&b=2'>", "</a>", "text", "&amp;", "&copy 1", "<!-- c -->", "<!-->", "<!--", "<script>x<y</script>"]
    bits += ["<script>1 && 2</script>", "</script>", "<", "> ", "</ p>", "<title>t</title>", "<template>", "</template>", "<p x>", "<p X=1 x=2>", "&notit;", "<a b='&notit;'>", "<p\x0bx>"]
    r = random.Random(6)
    for _ in range(3000):
        page = "".join(r.choice(bits) for _ in range(r.randrange(9)))
        read = [(p.tags, p.attributes, p.parents, p.ends, p.first, p.last, p.strings) for p in (Page(page), Parsed(page))]
        assert read[0] == read[1], repr(page)
    plain = "<div id=consnav><ul class='articlesList'>" + "<li><a href='?p=1&amp;x=2'>one</a></li>" * 3 + "</ul></div>"
    monkeypatch.setattr(Page, "feed", lambda self, html: 1 / 0)
    assert linked_articles(plain) == [("list", "one", "?p=1&x=2")] * 3


def test_tables_of_many_rows_are_dealt_over_more_tasks(spark, tmp_path, monkeypatch):
    from quern.plans import base

    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    monkeypatch.setattr(base, "TASK_ROWS", 50)
    assert base.spread_table(spark, str(tmp_path), "t").rdd.getNumPartitions() == 20


def test_answers_are_parsed_once_a_form(spark):
    from quern.functions.json import bullet

    rows = spark.createDataFrame([("modifies", '{"a": 1}')], "d string, r string").select(bullet(F.col("d"), F.col("r")).alias("b"))
    assert rows._jdf.queryExecution().analyzed().toString().count("from_json") == 2
    assert rows.first().b is None


def test_a_term_s_trigrams_are_hashed_once(spark):
    from quern.operators.keywords import trigram_vector

    rows = spark.createDataFrame([("abab",), ("a",)], "t string").select(trigram_vector(F.col("t"), 8).alias("v"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("md5") < plan.index("array_remove")  # outside of what is done for each place
    assert [sum(r.v) for r in rows.collect()] == [4.0, 1.0]


def _orders(spark, tmp_path):
    spark.range(1, 13).withColumnRenamed("id", "o_orderkey").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_a_record_reads_no_article_s_content(spark, tmp_path, monkeypatch):
    from quern.plans import refresh

    monkeypatch.setattr(refresh, "html_to_markdown", lambda page: 1 / 0)
    rows = {r.url: r for r in refresh.site_refresh(spark, _orders(spark, tmp_path)).collect()}
    assert len(rows) == 12
    assert tuple(rows["http://site.gr/m/?p=3"])[1:] == ("new", 2, 2, 2) and tuple(rows["https://SITE.gr/m/?p=7#x"])[1:] == ("refreshed", 2, 1, 1)


def test_addresses_are_worked_out_once(spark):
    import re

    from quern.functions.convert import normalized_url

    urls = [" HTTPS://A.b:1/X//?q=/#f ", "//H", "x:y?", "a#b?c", "http://h?", "http://h?a?b", "/p/", "/", "//", "///", "mailto:Me@X", "1:2/", "http:///p/?x", "?a", "#", "http://Ü.gr/Ü/"]

    def expected(url):
        host, path, query = re.match(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?", url.strip()).groups()
        return (host or "").lower() + ("/" if path == "/" else path.rstrip("/")) + (f"?{query}" if query else "")

    rows = spark.createDataFrame([(u,) for u in [*urls, " ", None]], "u string").select("u", normalized_url(F.col("u")).alias("n"))
    assert {r.u: r.n for r in rows.collect()} == {u: expected(u) for u in urls} | {" ": None, None: None}
    assert rows._jdf.queryExecution().analyzed().toString().count("regexp_") == 2  # blanks and the scheme


def test_keys_with_a_null_match_nothing(spark):
    from quern.operators.matching import Tier, resolve

    asked = spark.createDataFrame([(1, "a", None), (2, "a", "b"), (3, None, None)], "q int, x string, y string")
    known = spark.createDataFrame([(1, "a", None), (2, "a", "b"), (3, None, None)], "k int, x string, y string")
    tier = Tier("both", (asked["x"], asked["y"]), (known["x"], known["y"]), (known["k"],))
    out = resolve(asked, known, [tier])
    assert {r.q: r.match and r.match.k for r in out.collect()} == {1: None, 2: 2, 3: None}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(x" not in plan and "isnotnull(y" not in plan


def test_comments_of_plain_pages_are_read_by_tokens(monkeypatch):
    import random

    from quern.operators import html as pages

    bits = ["<p>", "</p>", "<li id='comment-1'>", "<li id=li-comment-2>", "<li id='&#99;omment-3'>", "<cite>", "</cite>", "<time class='date x'>", "</time>", "a b", "&amp;", "<br/>", "<!-- comment-4 -->", "<script>", "</script>", "<title>", "<", "<h2>", "<ul>"]
    r, seen = random.Random(4), []
    tokens = pages.plain_tokens
    for _ in range(3000):
        page = "".join(r.choice(bits) for _ in range(r.randrange(12)))
        own = pages.parse_comments(page, True)
        with monkeypatch.context() as m:
            m.setattr("quern.operators.elements.plain_tokens", lambda html: None)
            m.setattr(pages, "plain_tokens", lambda html: None)
            assert own == pages.parse_comments(page, True), repr(page)
        seen.append(tokens(page) is not None and own)
    assert any(seen)
    monkeypatch.setattr(pages._Comments, "feed", lambda self, html: 1 / 0)
    assert [c["content"] for c in pages.parse_comments("<div><p>x</p></div><li id='comment-5'><p>one</p></li>")] == ["one"]


def test_articles_need_no_comments_and_plain_contents_no_parser(spark, tmp_path, monkeypatch):
    from quern.operators import html as pages
    from quern.plans import refresh

    monkeypatch.setattr(refresh, "comments", lambda *a: 1 / 0)
    rows = refresh.refreshed_articles(spark, _orders(spark, tmp_path)).collect()
    assert len(rows) == 16 and ("http://site.gr/m/?p=x31", "http://site.gr/m/?p=3", "x31", "Άρθρο 3", "text 3") in map(tuple, rows)
    monkeypatch.setattr(pages._Markdown, "feed", lambda self, html: 1 / 0)
    assert pages.to_markdown("<h2>Head</h2><ul><li>x &amp; <b>y</b></ul>") == "## Head\n\n* x & y"


def test_a_model_without_its_terms_counts_words_within_rows(spark, monkeypatch):
    from zlib import crc32

    from quern.operators import topic_model

    texts = [(1, "a b  B 1a"), (1, "c\na"), (2, None), (3, " "), (None, "x y"), (4, "a b c d e" * 5)]
    docs = spark.createDataFrame(texts, "k int, t string")
    vectors = topic_model.text_vectors(docs, "k", "t", 8)
    assert "Generate" not in vectors._jdf.queryExecution().optimizedPlan().toString()
    own = {}
    for k, t in texts:
        own.setdefault(k, []).extend((t or "").lower().replace("1", "").split())
    expected = {k: [sum(crc32(w.encode()) % 8 == d for w in words) * 1000 // max(len(words), 1) for d in range(8)] for k, words in own.items()}
    assert {r.k: r.vector for r in vectors.collect()} == expected
    monkeypatch.setattr(topic_model, "class_tfidf", lambda *a, **b: 1 / 0)
    model = topic_model.fit(docs, "k", "t", topics=2, rounds=1, dims=8, least=1)
    assert model.transform(docs, "k", "t").count() == 5


def test_requests_sort_keys_without_their_places(monkeypatch):
    import numpy as np

    from quern.llm import ngrams

    r = np.random.default_rng(3)
    for n_words, sizes in ((5, [0, 7, 0, 30, 1]), (200, [500, 0, 3]), (1, [0]), (1, [])):
        word = np.sort(r.integers(1, 2**63, n_words).astype(np.uint64))
        place = r.integers(0, n_words, sum(sizes)).astype(np.uint64)
        body = ngrams.dump([np.array(sizes, np.uint64)], False), ngrams.dump([word, np.zeros(n_words, np.uint64)]), ngrams.dump([place], False)
        block = ngrams._Block(*body)
        with monkeypatch.context() as m:
            m.setattr(ngrams, "_Block", None)
            found = ngrams.different(*body)
        assert all(np.array_equal(a, b) for a, b in zip(found, (block.trigrams, block.bigrams, block.words), strict=True))


def test_hashes_are_ordered_as_numbers(monkeypatch):
    import numpy as np

    from quern.llm import ngrams

    r = np.random.default_rng(5)
    cases = [r.integers(0, 2**64, 5000, np.uint64), r.integers(0, 40, 300, np.uint64), r.integers(0, 9, 50, np.uint64) << np.uint64(60), np.zeros(0, np.uint64), np.array([2**64 - 1, 0, 2**64 - 1], np.uint64)]
    for key in cases:
        keys, at = np.unique(key, return_inverse=True)
        found = ngrams.placed(key)
        assert np.array_equal(ngrams.order_of(key), np.argsort(key, kind="stable")) and np.array_equal(found[0], keys) and np.array_equal(found[1], at)
    monkeypatch.setattr(np, "argsort", lambda *a, **b: 1 / 0)
    ngrams.order_of(cases[0])
    ngrams.order_of(cases[2])


def test_stage_one_rows_ask_for_nothing_that_they_do_not_show(spark, tmp_path, monkeypatch):
    from quern.plans import summaries

    spark.range(1, 13).selectExpr("id as o_orderkey", "id % 2 as o_custkey").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(summaries, "stored", lambda *a: 1 / 0)
    rows = summaries.stage_one_rows(spark, str(tmp_path))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("EvalPython") == 1  # summaries; no JSON answers
    assert rows.count() == 28 and tuple(rows.where("id = 3 and nth = 2").first()) == (1, 3, 2, 3, "-", "Γ'", "summarise", "new_provision", 20)


def test_a_text_is_searched_for_headers_once(spark):
    from quern.operators.structure import article_chunks

    texts = ["x\n Άρθρο 1 a\n\n# article 22\nb Άρθρο 3\r\nΑΡΘΡΟ 4", " \xa0\n", "none", None, "Άρθρο 99999999999\x85Άρθρο 5　"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", article_chunks(F.col("t"), F.lit("Άρθρο 9 ")).alias("c"))
    assert rows._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") == 1
    assert {r.i: [tuple(x) for x in r.c] for r in rows.collect()} == {
        0: [("Άρθρο 1", "a", 1), ("# article 22", "b Άρθρο 3", 22), ("ΑΡΘΡΟ 4", "", 4)],
        1: [],
        2: [("Άρθρο 9", "none", 9)],
        3: [],
        4: [("Άρθρο 99999999999", "", None), ("Άρθρο 5", "", 5)],
    }


def test_numerals_are_known_by_a_list(spark):
    from quern.functions.numerals import greek_to_int, int_to_greek
    from quern.operators.sections import KNOWN_NUMERALS, detect_part

    names = spark.range(0, 1000).select(int_to_greek(F.col("id")).alias("n")).where("n is not null").distinct()
    both = names.select("n", greek_to_int(F.col("n")).alias("k")).where(F.col("k").between(1, 300) & (int_to_greek(F.col("k")) == F.col("n")))
    assert {r.n for r in both.collect()} == set(KNOWN_NUMERALS)
    titles = spark.createDataFrame([("ΜΕΡΟΣ ΙΒ΄",), ("Άρθρο 4 ΜΕΡΑΣ Γ",), ("Άρθρο 4",), ("ΜΡΟΣ Β",), ("ΜΕΡΟΣ ΤΤ",), (None,)], "t string").select("t", detect_part(F.col("t")).alias("p"))
    assert [r.p for r in titles.collect()] == ["ΙΒ", "Γ", None, "Β", None, None]
    assert "aggregate(" not in titles._jdf.queryExecution().analyzed().toString()


def test_blanks_are_trimmed_by_their_characters(spark):
    from quern.functions.text import SPACES, first_nonblank_lines, is_purpose, n_words, trim

    other = "\x1c\x1f᠎​﻿"
    rows = spark.createDataFrame([(f"{a}x{SPACES}y{a}",) for a in [*SPACES, SPACES, *other]] + [("",), (SPACES,), (None,)], "t string").select("t", trim(F.col("t")).alias("s"), n_words(F.col("t")).alias("n"))
    assert rows._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 0
    for r in rows.collect():
        assert r.s == (r.t and r.t.strip(SPACES)), repr(r.t)
        assert r.n == (None if r.t is None else 2 if "x" in r.t else 0)
    lines = spark.createDataFrame([("\n a \r\n\n b\nc",), (" ",), (None,)], "t string").select(first_nonblank_lines(F.col("t")).alias("f"), is_purpose(F.lit("ασκοπος"), F.col("t")).alias("p"))
    assert [tuple(r) for r in lines.collect()] == [("a\nb", False), ("", False), (None, None)]


def test_tags_that_repeat_are_read_once():
    from quern.operators import elements

    pages = [f"<div id='again'><p class=\"a b\">{i}</p><a href='?p={i}'>x</a></div><!-- again -->" for i in range(50)]
    seen = elements._known_tag.cache_info().misses
    assert all(elements.plain_tokens(p)[-1] == ("", "", (), "") for p in pages)
    assert elements._known_tag.cache_info().misses - seen <= 7 + 50
    seen = elements._known_tag.cache_info().currsize
    assert elements.plain_tokens(f"<p x='{'y' * 200}'>")[0][2] == (("x", "y" * 200),) and elements._known_tag.cache_info().currsize == seen  # long ones aren't kept
