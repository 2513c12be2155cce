"""HTML pages: links, titles, paragraphs, comments, and markdown.

Regular patterns are native expressions. What needs the tree of elements is
read by the standard library's parser in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.elements import is_plain, plain_tokens, read_page

LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
PARAGRAPH = r"(?is)<p(?:\s[^>]*)?>(.*?)(?=</p>|<p[\s>]|$)"
DEFAULT_AUTHOR = "anonymous"


def without_tags(col: Column) -> Column:
    return F.regexp_replace(col, r"<[^>]*>", "")


def links(page: Column) -> Column:
    """ARRAY of STRUCT(href, label), labels without tags and trimmed; none for null."""
    page = F.coalesce(page, F.lit(""))
    both = F.arrays_zip(F.regexp_extract_all(page, F.lit(LINK), F.lit(1)).alias("href"), F.regexp_extract_all(page, F.lit(LINK), F.lit(2)).alias("label"))
    return F.transform(both, lambda x: F.struct(x["href"].alias("href"), F.trim(without_tags(x["label"])).alias("label")))


def article_links(page: Column) -> Column:
    """Links to articles, by their query parameter p: labels of three characters or more that aren't addresses; the first of each address."""
    found = F.filter(links(page), lambda x: x["href"].rlike(r"[?&]p=\d+") & (F.length(x["label"]) >= 3) & ~x["label"].contains("http"))
    out = F.transform(found, lambda x: F.struct(F.regexp_extract(x["href"], r"[?&]p=(\d+)", 1).alias("post_id"), x["label"].alias("title"), x["href"].alias("url")))
    return F.filter(out, lambda x, i: F.array_position(F.transform(out, lambda y: y["url"]), x["url"]) == i + 1)


def page_title(page: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(page, TITLE, 1)), F.lit(""))


def paragraphs(page: Column) -> Column:
    """ARRAY of the texts of paragraphs, without tags, white space collapsed, blank ones left out."""
    found = F.regexp_extract_all(page, F.lit(PARAGRAPH), F.lit(1))
    return F.filter(F.transform(found, lambda x: F.trim(F.regexp_replace(without_tags(x), r"[ \t\r\n]+", " "))), lambda x: x != "")


class _Markdown(HTMLParser):
    """Markdown with # headings, * bullets and line breaks; inline emphasis is dropped, scripts are skipped."""

    SKIP = frozenset(("script", "style", "head", "noscript"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.lists: list[list] = []
        self.skip, self.href, self.pre = 0, None, 0

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skip += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("p", "div", "section", "article", "table", "blockquote"):
            self.out.append("\n\n")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n" if len(self.lists) > 1 else "\n\n")
        elif tag == "li":
            depth = max(0, len(self.lists) - 1)
            mark = "*"
            if self.lists and self.lists[-1][0] == "ol":
                self.lists[-1][1] += 1
                mark = f"{self.lists[-1][1]}."
            self.out.append(f"\n{'  ' * depth}{mark} ")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "hr":
            self.out.append("\n\n---\n\n")
        elif tag == "tr":
            self.out.append("\n|")
        elif tag in ("td", "th"):
            self.out.append(" ")
        elif tag == "a":
            self.href = dict(attrs).get("href")
            self.out.append("[")

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif re.fullmatch("h[1-6]|p|div|section|article|table|blockquote", tag):
            self.out.append("\n\n")
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self.out.append("\n\n" if not self.lists else "")
        elif tag in ("td", "th"):
            self.out.append(" |")
        elif tag == "a":
            self.out.append(f"]({self.href or ''})")
            self.href = None

    def handle_data(self, data):
        if not self.skip:
            self.out.append(re.sub(r"\s+", " ", data))


def to_markdown(page: str | None, collapse: bool = True) -> str:
    """A page as markdown; null and blank give an empty text."""
    if not page or not page.strip():
        return ""
    parser = _Markdown()
    read_page(parser, page)
    text = "\n".join(line.rstrip() for line in re.sub(r"\n[ \t]+(?![*\d ])", "\n", "".join(parser.out)).split("\n"))
    return (re.sub(r"\n{3,}", "\n\n", text) if collapse else text).strip()


def _markdown_batch(pages: pd.Series) -> pd.Series:
    return pages.map(to_markdown)


def html_to_markdown(page: Column) -> Column:
    """``to_markdown`` on a column, in Arrow batches."""
    return F.pandas_udf(_markdown_batch, "string")(page)


#: The first tag of a plain page that may have a comment's id.
_FIRST_ID = re.compile(r"<[^<>]*comment-\d")
_ID = re.compile(r"(?:li-)?comment-(\d+)")


class _Comments(HTMLParser):
    """Comments as list items with an id like comment-12: author, date and paragraphs."""

    NAMES = frozenset(("fn", "author", "comment-author"))
    DATES = frozenset(("date", "comment-date", "comment-meta", "metadata"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.at: str | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs) if attrs else {}
        m = _ID.fullmatch(a["id"]) if a.get("id") else None
        if m and not any(c["comment_id"] == m[1] for c in self.found):
            self.found.append({"comment_id": m[1], "username": "", "date": "", "content": ""})
        if not self.found:
            return
        classes = a["class"].split() if a.get("class") else ()
        if tag == "cite" or not self.NAMES.isdisjoint(classes):
            self.at = "username"
        elif tag == "time" or not self.DATES.isdisjoint(classes):
            self.at = "date"
        elif tag == "p":
            self.at = "content"
            self.found[-1]["content"] += "\n\n" if self.found[-1]["content"] else ""

    def handle_endtag(self, tag):
        if tag in ("p", "cite", "time", "div", "li", "span"):
            self.at = None

    def handle_data(self, data):
        if self.found and self.at:
            self.found[-1][self.at] += data


def parse_comments(page: str | None, keep_names: bool = False) -> list[dict]:
    """The comments of a page, each id once; names are anonymised unless asked for."""
    if not page or ("comment-" not in page and "&" not in page):  # no id can be one
        return []
    parser = _Comments()
    # nothing counts before the first id; a plain page may be read from its tag on
    at = _FIRST_ID.search(page)
    tokens = plain_tokens(page[at.start() :]) if at and "&" not in page[: at.start()] and is_plain(page[: at.start()]) else None
    read_page(parser, page, tokens)
    out = [{k: v.strip() for k, v in c.items()} for c in parser.found]
    return out if keep_names else [c | {"username": DEFAULT_AUTHOR} for c in out]


def comments(pages: DataFrame, id_col: str, html_col: str, keep_names: bool = False) -> DataFrame:
    """One row per comment: page, comment_id, username, date and content."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, c) for i, h in enumerate(batch["h"].to_pylist()) for c in parse_comments(h, keep_names)]
            columns = [pa.array([c[name] for _, c in found], pa.string()) for name in names]
            yield pa.RecordBatch.from_arrays([batch["k"].take(pa.array([i for i, _ in found], pa.int32())), *columns], names=["page", *names])

    names = ["comment_id", "username", "date", "content"]
    some = pages.where(F.col(html_col).contains("comment-") | F.col(html_col).contains("&"))  # others have none
    return some.select(F.col(id_col).alias("k"), F.col(html_col).alias("h")).mapInArrow(run, f"page {kind}, comment_id string, username string, date string, content string")


def convert_blank(articles: DataFrame, content: str = "content", raw: str = "raw_html") -> DataFrame:
    """Fills blank contents from raw HTML; extraction_method says so where it worked."""
    todo = (F.col(content).isNull() | (F.col(content) == "")) & ~(F.col(raw).isNull() | (F.col(raw) == ""))
    out = articles.withColumn("__md", F.when(todo, html_to_markdown(F.col(raw))))
    made = F.coalesce(F.col("__md"), F.lit("")) != ""
    out = out.withColumn(content, F.when(made, F.col("__md")).otherwise(F.col(content)))
    return out.withColumn("extraction_method", F.when(made, "html").otherwise(F.col("extraction_method") if "extraction_method" in articles.columns else F.lit(None).cast("string"))).drop("__md")
