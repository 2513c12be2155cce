"""Every query of the library against its SQL, and those without SQL for their shape."""

from __future__ import annotations

import hashlib
import re
from html.parser import HTMLParser

import pytest
from conftest import SF_DIR, same_rows

from quern.plans import catalogue

WITHOUT = sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, name):
    same_rows(spark, duck, catalogue.QUERIES[name], catalogue.ORACLES[name])


def plain_words(page):
    """The words of a page outside of scripts and the like, in page order."""

    class Text(HTMLParser):
        out, silent = "", 0

        def handle_starttag(self, tag, attrs):
            self.silent += tag in ("script", "style", "head", "noscript")
            self.out += " " if tag not in ("b", "i", "em", "strong", "a", "span", "u", "small") else ""

        def handle_endtag(self, tag):
            self.silent -= tag in ("script", "style", "head", "noscript") and self.silent > 0
            self.out += " " if tag not in ("b", "i", "em", "strong", "a", "span", "u", "small") else ""

        def handle_data(self, data):
            self.out += "" if self.silent else data

    text = Text(convert_charrefs=True)
    text.feed(page or "")
    text.close()
    return re.findall(r"[^\W_]+", text.out)


def markdown_has_the_words(spark, rows):
    pages = {x.page_id: x.html for x in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for x in rows:
        bare = re.sub(r"\]\([^)]*\)", "", re.sub(r"(?m)^ *\d+\. ", "", x.markdown))
        assert re.findall(r"[^\W_]+", bare) == plain_words(pages[x.page_id])
    assert len(rows) == len(pages)


def elements_have_tiers(spark, rows):
    """By the tree of tests/test_site_topics.py."""
    from test_site_topics import Tree, content_of, nodes_of

    pages = {x.page_id: x.html for x in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for x in rows:
        found = list(nodes_of(Tree(pages[x.page_id] or "").root))
        hit = next((n for n, _ in found if n["tag"] == "article"), None) or next((n for n, _ in found if n["tag"] == "body"), None)
        if not any(k in (pages[x.page_id] or "") for k in ("<main", "post_content", 'id="content"', 'class="content', 'class="entry')):
            assert x.digest == hashlib.md5((content_of(hit) if hit else "").encode()).hexdigest()
    assert {x.page_id for x in rows} == set(pages)


def tokens_are_those_of_the_library(spark, rows):
    import base64

    import tiktoken

    from quern.functions.tokens import PIECES
    from quern.plans.answers import RANKS

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert {x.doc_id: x.n_tokens for x in rows} == {i: len(coder.encode_ordinary(t or "")) for i, t in texts.items()}


BY_HAND = {"html_to_markdown": markdown_has_the_words, "element_text": elements_have_tiers, "token_counts": tokens_are_those_of_the_library}


@pytest.mark.parametrize("name", WITHOUT)
def test_query_without_sql(spark, name):
    BY_HAND[name](spark, catalogue.QUERIES[name](spark, SF_DIR).collect())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
