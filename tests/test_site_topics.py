"""Elements, tiers of lookups, keywords, the topic model and stems against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter
from html.parser import HTMLParser

import pytest
from conftest import SF_DIR

# elements


class Tree(HTMLParser):
    """Nested nodes of well-formed pages, without any of the library's rules."""

    VOID = {"br", "img", "hr", "meta", "link", "input"}

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.root = {"tag": "", "attrs": {}, "kids": []}
        self.path = [self.root]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "attrs": dict(attrs), "kids": []}
        self.path[-1]["kids"].append(node)
        if tag not in self.VOID:
            self.path.append(node)

    def handle_endtag(self, tag):
        if tag not in self.VOID and any(n["tag"] == tag for n in self.path):
            while self.path.pop()["tag"] != tag:
                pass

    def handle_data(self, data):
        if self.path[-1]["kids"] and isinstance(self.path[-1]["kids"][-1], str):
            self.path[-1]["kids"][-1] += data
        else:
            self.path[-1]["kids"].append(data)

    def handle_comment(self, data):
        self.path[-1]["kids"].append({"tag": "#comment", "attrs": {}, "kids": []})


def nodes_of(node, above=()):
    for kid in node["kids"]:
        if isinstance(kid, dict):
            yield kid, above
            yield from nodes_of(kid, (*above, kid))


def text_of(node):
    if node["tag"] in ("script", "style", "template"):
        return ""
    return "".join(k.strip() if isinstance(k, str) else text_of(k) for k in node["kids"])


def content_of(node):
    inside = [n for n, _ in nodes_of(node)]
    parts = [text_of(n) for n in inside if n["tag"] == "p"]
    for lst in (n for n in inside if n["tag"] in ("ul", "ol")):
        parts += [("• " if lst["tag"] == "ul" else "- ") + text_of(n) for n, _ in nodes_of(lst) if n["tag"] == "li"]
    parts += [text_of(n) for n in inside if n["tag"] in ("h1", "h2", "h3", "h4", "h5", "h6")]
    return "\n\n".join(parts) if parts else text_of(node)


def matches(node, above, selector):
    """Selectors of the test: parts of tag, .class or #id, joined by blanks."""
    *before, last = selector
    tag, _, klass = last.partition(".")
    tag, _, own_id = tag.partition("#")
    fits = (not tag or node["tag"] == tag) and (not klass or klass in (node["attrs"].get("class") or "").split()) and (not own_id or node["attrs"].get("id") == own_id)
    return fits and (not before or any(matches(n, above[:i], before) for i, n in enumerate(above)))


def test_content_of_whole_pages(spark):
    from pyspark.sql import functions as F

    from quern.operators.elements import element_text

    chain = ("div.post_content", "article div.entry", "article", "main", "div#content", "body")
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html")
    made = [(-k, f"<main><div class='a b'>{'<div>' * k}<article><p>x{k}</p><ul><li>one<ol><li>in</li></ol></li></ul></article>{'</div>' * k}</div><style>s</style>t<!-- c -->u</main>") for k in range(1, 30)]
    made += [(-200, "<main><p>m</p></main>"), (-201, "<div id='content'><h2>i</h2>x</div>"), (-202, "<p>a</p><div class='post_content'>p</div>")]
    made += [(-100, None), (-101, ""), (-102, "no tags"), (-103, "<body></body>"), (-104, "<body>a<br>b &amp; <b> c </b></body>")]
    pages = pages.unionByName(spark.createDataFrame(made, pages.schema))
    got = {x.page_id: (x.e.tier, x.e.text) for x in pages.select("page_id", element_text(F.col("html"), chain).alias("e")).collect()}
    seen = Counter()
    for page_id, html in pages.collect():
        found = list(nodes_of(Tree(html or "").root))
        want = (None, "")
        for n, selector in enumerate(chain, 1):
            hits = [node for node, above in found if matches(node, above, selector.split())]
            if hits:
                want = (n, content_of(hits[0]))
                break
        assert got[page_id] == want, page_id
        seen[want[0]] += 1
    assert len(seen) >= 4


@pytest.mark.parametrize("selector,want", [("div > p", "2 4"), ("div p", "2 4 6 7"), (".a.b", "1"), ("[data-x]", "4 6"), ("[data-x=1]", "6"), ("div.a > section p[data-x='1']", "6"), ("*", "0 1 2 3 4 5 6 7"), ("#k p", "4"), ("section > div", ""), ("DIV", "1 3")])
def test_selectors(selector, want):
    from quern.operators.elements import Page

    page = Page("<body><div class='b a'><p>1</p></div><div id=k><p data-x>2</p></div></body>".replace("</div><div", "<div", 1).replace("</div></body>", "</div><section><p data-x=1>3<p>4</section></div></body>"))
    assert page.tags == ["body", "div", "p", "div", "p", "section", "p", "p"]
    assert " ".join(map(str, page.select(selector))) == want


def test_selectors_that_cannot_be_read():
    from quern.operators.elements import selector

    for bad in ("", " ", "> p", "p + q", "p:first-child", "a,b", "p >"):
        with pytest.raises(ValueError):
            selector(bad)


def test_long_pages_take_linear_time():
    import time

    from quern.operators.elements import Page

    for html in ("<div>" * 100_000 + "</p>" * 100_000, "<p>a" * 100_000, "<div><p>x</div>" * 50_000, "<ul><li>a" * 2_000):
        began = time.time()
        page = Page(html)
        next(page.select("div p b"), None)
        assert time.time() - began < 10


def test_links_of_consultations():
    from quern.operators.elements import linked_articles

    assert linked_articles(None) == []
    nav = "<div id='consnav'><ul class='other_posts'><li><a href='a'>A</a><li>none<li><b><a class='list_comments_link' href='b'> B </a></b></ul></div>"
    assert linked_articles(nav) == [("list", "A", "a"), ("list", "B", "b")]
    assert linked_articles("<div class='post_content'><div class='post_content'><a href='?p=1'>long</a></div></div>") == [("content", "long", "?p=1")] * 2
    assert linked_articles("<div class='post_content'><a href='?p=1'>ab</a><a>abc</a><a href='/x'>abc</a><a href='?p=2'>HTTP no</a></div>") == []


# tiers


def test_tiers_and_their_ties(spark):
    from quern.operators.matching import Tier, resolve

    r = random.Random(4)
    queries = [(i, r.choice([None, "a", "b", "c", "z"]), r.choice([None, 1, 2, 3]), "m", 0) for i in range(200)] + [(7, "a", 1, "m", 0)] * 3
    stored = [(i, r.choice([None, "a", "b", "d"]), r.choice([None, 1, 2, 4])) for i in range(40)] + [(50, "e", 9)]
    q = spark.createDataFrame(queries, "id long, name string, n int, match_name string, tier_no int")
    c = spark.createDataFrame(stored, "cid long, cname string, cn int")
    tiers = [
        Tier("both", (q["name"], q["n"]), (c["cname"], c["cn"]), (-c["cid"],)),
        Tier("alone", (q["n"],), (c["cn"],), (c["cid"],), alone=True),
        Tier("name", (q["name"],), (c["cname"],), (c["cid"],)),
    ]

    def want(name, n):
        both = [x for x in stored if None not in (name, n) and x[1] == name and x[2] == n]
        one = [x for x in stored if n is not None and x[2] == n]
        named = [x for x in stored if name is not None and x[1] == name]
        if both:
            return max(x[0] for x in both), 1, "both"
        if len(one) == 1:
            return one[0][0], 2, "alone"
        return (min(x[0] for x in named), 3, "name") if named else (None, None, None)

    got = Counter((x.id, x.name, x.n, x.match and x.match.cid, x.tier, x.tier_name) for x in resolve(q, c, tiers).collect())
    assert got == Counter((i, a, n, *want(a, n)) for i, a, n, *_ in queries)
    assert resolve(q, c.limit(0), tiers).where("match is not null").count() == 0


# keywords


def cosine(a, b):
    size = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b, strict=True)) / size if size else 0.0


def chosen_by_hand(rows, k, diversity):
    """rows: (term, vector, relevance); the greedy choice."""
    left, out = list(rows), []
    while left and len(out) < k:
        score = lambda t: t[2] if not out else (1 - diversity) * t[2] - diversity * max(cosine(t[1], c[1]) for c in out)
        best = min(left, key=lambda t: (-score(t), t[0]))
        left.remove(best)
        out.append(best)
    return [(t[0], t[2]) for t in out]


def test_keywords(spark):
    from quern.operators.keywords import keywords

    r, dims = random.Random(8), 16
    vocabulary = ["".join(r.choice("abcde") for _ in range(r.randrange(1, 7))) for _ in range(40)]
    docs = [(r.choice(["x", "y", None]), " ".join(r.choice(vocabulary) for _ in range(r.randrange(0, 12)))) for _ in range(80)] + [("x", None), ("void", ""), ("void", None), ("y", "1 22")]
    got = keywords(spark.createDataFrame(docs, "label string, words string"), "label", "words", k=4, diversity=0.4, sizes=(1, 2), least=2, dims=dims).collect()
    counts = {}
    for label, text in docs:
        words = [w for w in "".join(c for c in (text or "").lower() if not c.isdigit()).split() if w]
        for n in (1, 2):
            for i in range(len(words) - n + 1):
                counts.setdefault(label, Counter())[" ".join(words[i : i + n])] += 1

    def vector(term):
        out, marked = [0.0] * dims, f"^{term}$"
        for i in range(max(len(marked) - 2, 1)):
            out[int(hashlib.md5(marked[i : i + 3].encode()).hexdigest()[:8], 16) % dims] += 1
        return out

    for label, found in counts.items():
        rows = [(t, vector(t), n) for t, n in found.items() if n >= 2]
        about = [sum(n * v[d] for _, v, n in rows) for d in range(dims)]
        want = chosen_by_hand([(t, v, cosine(v, about)) for t, v, _ in rows], 4, 0.4)
        own = sorted((x["rank"], x.term, x.relevance) for x in got if x.label == label)
        assert [x[1] for x in own] == [t for t, _ in want] and all(abs(a[2] - b[1]) < 1e-12 for a, b in zip(own, want, strict=True))
    assert {x.label for x in got} == set(counts)


def test_marginal_relevance_of_vectors(spark):
    from quern.operators.keywords import mmr

    r = random.Random(3)
    rows = [(g, i, [r.gauss(0, 1) for _ in range(4)]) for g in ("a", "b") for i in range(12)] + [("zero", 1, [0.0] * 4), ("a", 99, [0.0] * 4)]
    got = mmr(spark.createDataFrame(rows, "g string, i long, v array<double>"), "g", "i", "v", k=5, diversity=0.3).collect()
    for g in ("a", "b", "zero"):
        unit = [(i, [x / max(math.sqrt(sum(y * y for y in v)), 1e-12) for x in v]) for h, i, v in rows if h == g]
        mean = [sum(v[d] for _, v in unit) / len(unit) for d in range(4)]
        size = max(math.sqrt(sum(x * x for x in mean)), 1e-12)
        want = chosen_by_hand([(i, v, sum(x * y for x, y in zip(v, mean, strict=True)) / size) for i, v in unit], 5, 0.3)
        assert [x.i for x in sorted(got, key=lambda x: x["rank"]) if x.g == g] == [i for i, _ in want]


# the topic model


def test_topic_model_is_the_same_after_reloading(spark, tmp_path):
    from quern.operators.topic_model import TopicModel, fit

    r = random.Random(6)
    themes = [["tax", "law", "budget", "income"], ["forest", "river", "water", "air"], ["school", "pupil", "teacher", "class"]]
    texts = [(i, " ".join(r.choice(themes[i % 3]) for _ in range(30))) for i in range(60)] + [(900, None), (901, ""), (902, "quite another thing")]
    docs = spark.createDataFrame(texts, "id long, body string").repartition(3)
    model = fit(docs, "id", "body", topics=5, rounds=4, least=3)
    model.save(str(tmp_path / "model"))
    unseen = spark.createDataFrame([(1, "river forest air"), (2, "tax law income"), (3, "school class teacher pupil"), (4, None), (2, "tax")], "id long, body string")
    again = TopicModel.load(spark, str(tmp_path / "model"))
    for table in (docs, unseen):
        assert Counter(map(tuple, model.transform(table, "id", "body").collect())) == Counter(map(tuple, again.transform(table, "id", "body").collect()))
    by_id = {x.id: x.topic for x in again.transform(docs, "id", "body").collect()}
    own = [{by_id[i] for i in range(60) if i % 3 == k} for k in range(3)]
    assert not (own[0] & own[1] or own[0] & own[2] or own[1] & own[2])
    of = {x.id: x.topic for x in again.transform(unseen, "id", "body").collect()}
    assert of[1] in own[1] and of[2] in own[0] and of[3] in own[2]
    terms = {}
    for x in again.terms.collect():
        terms.setdefault(x.topic, set()).add(x.word)
    assert all(set.union(*(terms.get(t, set()) for t in own[k])) >= set(themes[k]) for k in range(3))
    sizes = [(x.topic, x["size"]) for x in again.centres.orderBy("topic").collect() if x.topic >= 0]
    assert [n for _, n in sizes] == sorted((n for _, n in sizes), reverse=True) and all(n >= 3 for _, n in sizes)


def test_text_vectors_and_an_empty_model(spark):
    from quern.operators.topic_model import fit, text_vectors

    docs = spark.createDataFrame([(1, "a b a 1"), (2, None), (3, "a"), (3, "b")], "id long, body string")
    at = lambda w: zlib.crc32(w.encode()) % 8
    got = {x.id: list(x.vector) for x in text_vectors(docs, "id", "body", 8).collect()}
    want = {1: [0] * 8, 2: [0] * 8, 3: [0] * 8}
    want[1][at("a")] += 666
    want[1][at("b")] += 333
    want[3][at("a")] += 500
    want[3][at("b")] += 500
    assert got == want
    model = fit(docs.limit(0), "id", "body")
    assert {(x.id, x.topic) for x in model.transform(docs, "id", "body").collect()} == {(1, -1), (2, -1), (3, -1)}


# stems


def test_stems(spark):
    from pyspark.sql import functions as F

    from quern.functions.stems import ENDINGS, IRREGULAR, stem, stems

    def by_hand(word, language):
        if word in IRREGULAR[language]:
            return IRREGULAR[language][word]
        for size in range(len(word) - 3, 0, -1):
            if word[-size:] in ENDINGS[language]:
                return word[:-size] + ENDINGS[language][word[-size:]]
        return word

    words = {"en": "cities city running runs run was children happiness as nation nations being a flies".split(), "fr": "chevaux nationale parlement étaient est".split(), "de": "freiheiten häuser ist schöne".split(), "es": "rápidamente canciones son hablando".split(), "el": "νόμους νόμων είναι άρθρο άρθρα".split()}
    for language, own in words.items():
        got = spark.createDataFrame([(own,)], "w array<string>").select(stems("w", language).alias("s")).first().s
        bare = [w.translate(str.maketrans("άέήίόύώ", "αεηιουω")) if language == "el" else w for w in own]
        assert got == [by_hand(w, language) for w in bare]
    assert spark.range(1).select(stem(F.lit("xy.z"), {".z": "!"}, least=1).alias("s")).first().s == "xy!"
    assert spark.range(1).select(stems(F.array(F.lit("abc")), "xx").alias("s")).first().s == ["abc"]
