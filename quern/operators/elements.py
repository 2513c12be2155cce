"""Elements of HTML pages by CSS selectors, and their text.

A page is read once into flat lists, an entry per element in page order with
its parent and the end of its subtree, so that an element's descendants and
strings are ranges. Selectors are matched from the root down: each element
holds, as bits, how far a selector is matched by it and by those around it, so
a selector costs a step per element however deep the page is.

Selectors are compounds of a tag or *, #id, .class, [name] and [name=value],
joined by descendant (blank) and child (>) combinators. A chain of fallbacks is
a list of selectors: the first that has any element gives its first one.

Ends of elements: a void element has no content; an end tag closes the nearest
open element of its name and what is open inside; without such an element it
counts nothing. Paragraphs, list items, terms, rows, cells and options end
where the next one of their kind begins; a paragraph ends at block elements,
too. Comments, scripts, styles and templates are no text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
BLOCKS = frozenset("address article aside blockquote dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table ul".split())
#: Open elements that end where one of these begins, and the elements beyond which they are out of reach.
ENDS = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_PART = re.compile(r"\s*(>)?\s*((?:[\w*-]|[.#][\w-]+|\[[^\]]*\])+)")
_SIMPLE = re.compile(r"(?P<tag>^[\w*-]+)|#(?P<id>[\w-]+)|\.(?P<klass>[\w-]+)|\[\s*(?P<name>[\w-]+)\s*(?:=\s*[\"']?(?P<value>[^\"'\]]*)[\"']?\s*)?\]")


class Compound:
    """Conditions on one element, and whether it has to be a child of the part before."""

    __slots__ = ("attributes", "bare", "child", "classes", "tag")

    def __init__(self, text: str, child: bool):
        self.tag, self.classes, self.attributes, self.child = "", set(), [], child
        if "".join(m[0] for m in _SIMPLE.finditer(text)) != text:
            raise ValueError(f"can't read the selector {text!r}")
        for m in _SIMPLE.finditer(text):
            if m["tag"]:
                self.tag = "" if m["tag"] == "*" else m["tag"].lower()
            elif m["klass"]:
                self.classes.add(m["klass"])
            else:
                self.attributes.append(("id", m["id"]) if m["id"] else (m["name"].lower(), m["value"]))
        self.bare = bool(self.tag) and not self.classes and not self.attributes

    def fits(self, tag: str, attributes: dict[str, str]) -> bool:
        if self.bare:
            return tag == self.tag
        return (
            (not self.tag or tag == self.tag)
            and (not self.classes or "class" in attributes and self.classes <= set(attributes["class"].split()))
            and all(name in attributes and (value is None or attributes[name] == value) for name, value in self.attributes)
        )


@lru_cache(256)
def selector(text: str) -> tuple[Compound, ...]:
    """The parts of a selector."""
    out, at = [], 0
    while at < len(text.rstrip()):
        m = _PART.match(text, at)
        if not m or (m[1] and not out):
            raise ValueError(f"can't read the selector {text!r}")
        out.append(Compound(m[2], bool(m[1])))
        at = m.end()
    if not out:
        raise ValueError("a selector is empty")
    return tuple(out)


#: Pages of these tokens alone are read by them, which gives what the parser gives in a part of the time: text, plain tags, short comments, and scripts without a mark.
_BLANK, _VALUE = r"[ \t\n\r\f]", r"""(?:"[^"<>]*"|'[^'<>]*'|[a-zA-Z0-9_.:#-]+)"""
_BEGIN = re.compile(rf"([a-zA-Z][a-zA-Z0-9]*)((?:{_BLANK}+[a-zA-Z_][a-zA-Z0-9_-]*(?:={_VALUE})?)*){_BLANK}*")
_END = re.compile(r"/([a-zA-Z][a-zA-Z0-9]*)")
_COMMENT = re.compile(r"!--[^<>-]+--")
#: Such tokens, without scripts and the like.
_PLAIN = re.compile(rf"(?:[^<]+|<(?!(?i:script|style|iframe|math|noembed|noframes|noscript|plaintext|svg|textarea|title|xmp)\b)[a-zA-Z][a-zA-Z0-9]*(?:{_BLANK}+[a-zA-Z_][a-zA-Z0-9_-]*(?:={_VALUE})?)*{_BLANK}*>|</[a-zA-Z][a-zA-Z0-9]*>|<!--[^<>-]+-->)*+")
_ATTRIBUTE = re.compile(rf"""([a-zA-Z_][a-zA-Z0-9_-]*)(?:=({_VALUE}))?""")
#: Elements whose content has rules of its own.
_OWN_RULES = frozenset("iframe math noembed noframes noscript plaintext svg textarea title xmp".split())
_OPEN_REFERENCE = re.compile(r"&(?![a-zA-Z]+;)")


def _tag(tag: str) -> tuple[str, str, tuple[tuple[str, str], ...], str] | None:
    """The token of what stands between a tag's marks; None if it isn't plain."""
    if m := _BEGIN.fullmatch(tag):
        name, attributes = m[1].lower(), []
        if name in _OWN_RULES:
            return None
        for key, value in _ATTRIBUTE.findall(m[2]) if m[2] else ():
            value = value[1:-1] if value[:1] in ("'", '"') else value
            if "&" in value:
                if _OPEN_REFERENCE.search(value):
                    return None
                value = entities.unescape(value)
            attributes.append((key.lower(), value))
        return "", name, tuple(attributes), ""
    if m := _END.fullmatch(tag):
        return "", "", (), m[1].lower()
    return ("", "", (), "") if _COMMENT.fullmatch(tag) else None


#: A site's pages repeat their tags: short ones are read once.
_known_tag, SHORT_TAG = lru_cache(8192)(_tag), 100


def plain_tokens(html: str) -> list[tuple[str, str, tuple[tuple[str, str], ...], str]] | None:
    """(text, tag that begins, its attributes, tag that ends) of each token of a plain page, all empty for a comment; None if the page has anything else."""
    if "/>" in html or "<!D" in html or "<!d" in html:  # most pages that aren't plain
        return None
    pieces = html.split("<")  # all but the first begin with a tag
    out, raw = [], ""  # the script or style that is open: its text is taken as it stands
    for n, piece in enumerate(pieces):
        text = piece
        if n:
            tag, closed, text = piece.partition(">")
            token = (_known_tag(tag) if len(tag) <= SHORT_TAG else _tag(tag)) if closed else None
            if token is None or raw and token[3] != raw:
                return None
            raw = token[1] if token[1] in ("script", "style") else ""
            out.append(token)
        if text:
            out.append((entities.unescape(text) if "&" in text and not raw else text, "", (), ""))
    return None if raw else out


def is_plain(html: str) -> bool:
    """Whether a beginning of a page has plain tokens only, none of them with rules of its own; it ends where a tag begins."""
    return _PLAIN.fullmatch(html) is not None


def read_page(parser: HTMLParser, html: str, tokens: list | None = None) -> None:
    """``html`` given to a parser that takes tags and data, and no comments: a plain page by its tokens, or by those that are given."""
    tokens = tokens or plain_tokens(html)
    if tokens is None:
        parser.feed(html)
        parser.close()
        return
    for text, begun, attributes, ended in tokens:
        if text:
            parser.handle_data(text)
        elif begun:
            parser.handle_starttag(begun, attributes)
        elif ended:
            parser.handle_endtag(ended)


class Page(HTMLParser):
    """The elements of a page in page order: tags, attributes, parents (-1 at the root), ends of subtrees, and ranges of strings."""

    def __init__(self, html: str | None):
        self.tags: list[str] = []
        self.attributes: list[dict[str, str]] = []
        self.parents: list[int] = []
        self.ends: list[int] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.strings: list[str] = []  # stripped, none of them empty
        self._data: list[str] = []
        self._open: list[int] = []
        self._names: dict[str, int] = {}
        self._silent = 0
        tokens = self._tokens(html or "")
        if tokens is None:
            super().__init__(convert_charrefs=True)
            self.feed(html or "")
            self.close()
        else:
            self._plain(tokens)
        self._flush()
        self._kinds = set(self.tags)
        while self._open:
            self._end_last()

    def _tokens(self, html: str) -> list[tuple[str, str, tuple[tuple[str, str], ...], str]] | None:
        return plain_tokens(html)

    def _plain(self, tokens: list[tuple[str, str, tuple[tuple[str, str], ...], str]]) -> None:
        """Plain tokens as the handlers take them; each text is a string of its own."""
        strings, start, end = self.strings, self._begin, self._finish
        for text, begun, attributes, ended in tokens:
            if text:
                text = text.strip()
                if text and not self._silent:
                    strings.append(text)
            elif begun:
                start(begun, attributes)
            elif ended:
                end(ended)

    def _flush(self) -> None:
        if not self._data:
            return
        text = "".join(self._data).strip()
        self._data.clear()
        if text and not self._silent:
            self.strings.append(text)

    def _end_last(self) -> None:
        k = self._open.pop()
        tag = self.tags[k]
        self._names[tag] -= 1
        self._silent -= tag in SILENT
        self.ends[k], self.last[k] = len(self.tags), len(self.strings)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._flush()
        self._begin(tag, attrs)

    def _begin(self, tag: str, attrs: Iterable[tuple[str, str | None]]) -> None:
        while self._open and tag in ENDS.get(self.tags[self._open[-1]], ()):
            self._end_last()
        attributes: dict[str, str] = {}
        for name, value in attrs:
            attributes.setdefault(name, value or "")
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.parents.append(self._open[-1] if self._open else -1)
        self.ends.append(0)
        self.first.append(len(self.strings))
        self.last.append(0)
        self._open.append(len(self.tags) - 1)
        self._names[tag] = self._names.get(tag, 0) + 1
        self._silent += tag in SILENT
        if tag in VOID:
            self._end_last()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        self._finish(tag)

    def _finish(self, tag: str) -> None:
        if tag not in VOID and self._names.get(tag):
            while self.tags[self._open[-1]] != tag:
                self._end_last()
            self._end_last()

    def handle_data(self, data: str) -> None:
        self._data.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()

    def select(self, text: str, within: int | None = None) -> Iterator[int]:
        """The elements that a selector matches, in page order; ``within`` an element, below it."""
        parts = selector(text)
        if not all(part.tag in self._kinds for part in parts if part.tag):
            return
        a, b = (0, len(self.tags)) if within is None else (within + 1, self.ends[within])
        if len(parts) == 1:  # what is around doesn't matter
            part, k = parts[0], a
            while k < b:
                if part.tag:
                    try:
                        k = self.tags.index(part.tag, k, b)
                    except ValueError:
                        return
                if part.fits(self.tags[k], self.attributes[k]):
                    yield k
                k += 1
            return
        own, around = [0] * len(self.tags), [0] * len(self.tags)  # bit i: parts up to i are matched here; here or above
        for k in range(b):
            up = self.parents[k]
            near, far = (own[up], around[up]) if up >= 0 else (0, 0)
            bits = 0
            for i, part in enumerate(parts):
                if (i == 0 or (near if part.child else far) >> (i - 1) & 1) and part.fits(self.tags[k], self.attributes[k]):
                    bits |= 1 << i
            own[k], around[k] = bits, far | bits
            if k >= a and bits >> (len(parts) - 1) & 1:
                yield k

    def first_of(self, chain: list[str] | tuple[str, ...], within: int | None = None) -> tuple[int, int] | None:
        """(number of the selector from 1, element) of the first selector that has an element."""
        for n, text in enumerate(chain, 1):
            k = self._first(text, within)
            if k is not None:
                return n, k
        return None

    def _first(self, text: str, within: int | None) -> int | None:
        """The first element that a selector matches."""
        parts = selector(text)
        part = parts[0]
        if len(parts) > 1 or not part.tag:
            return next(self.select(text, within), None)
        if part.tag not in self._kinds:
            return None
        k, b = (-1, len(self.tags)) if within is None else (within, self.ends[within])
        for k in range(k + 1, b):
            if self.tags[k] == part.tag and (part.bare or part.fits(part.tag, self.attributes[k])):
                return k
        return None

    def below(self, k: int, tags: frozenset[str] | set[str]) -> list[int]:
        return [i for i in range(k + 1, self.ends[k]) if self.tags[i] in tags]

    def plain(self, k: int) -> str:
        """All strings of an element, one after the other."""
        return "".join(self.strings[self.first[k] : self.last[k]])

    def content(self, k: int) -> str:
        """The paragraphs of an element, then the items of each list with a bullet, then its headings; all its text if it has none of these."""
        parts = [self.plain(i) for i in self.below(k, {"p"})]
        for i in self.below(k, {"ul", "ol"}):
            mark = "• " if self.tags[i] == "ul" else "- "
            parts += [mark + self.plain(j) for j in self.below(i, {"li"})]
        parts += [self.plain(i) for i in self.below(k, HEADINGS)]
        return "\n\n".join(parts) if parts else self.plain(k)


def element_text(page: Column, chain: list[str] | tuple[str, ...]) -> Column:
    """STRUCT(tier, text): which selector of the chain matched first, and its element's content; null and an empty text if none did."""
    for text in chain:
        selector(text)

    def run(pages: pd.Series) -> pd.DataFrame:
        out = []
        for html in pages:
            parsed = Page(html)
            hit = parsed.first_of(chain)
            out.append((hit[0], parsed.content(hit[1])) if hit else (None, ""))
        return pd.DataFrame(out, columns=["tier", "text"]).astype({"tier": "Int32"})

    return F.pandas_udf(run, "tier int, text string")(page)


#: Where a site lists the articles of a consultation, and the links of its items.
NAVIGATION = ("div#consnav", "div.navigation")
LISTS = ("ul.other_posts", "ul.articlesList")
ITEM_LINKS = ("a.list_comments_link", "a")
CONTENT = "div.post_content"


def linked_articles(html: str | None) -> list[tuple[str, str, str]]:
    """(source, title, href) of a page's articles: those of the navigation's list; if it has none, the content's links with ?p= and a title."""
    page = Page(html)
    out = []
    nav = page.first_of(NAVIGATION)
    listed = page.first_of(LISTS, nav[1]) if nav else None
    for item in page.below(listed[1], {"li"}) if listed else ():
        link = page.first_of(ITEM_LINKS, item)
        if link and "href" in page.attributes[link[1]]:
            out.append(("list", page.plain(link[1]), page.attributes[link[1]]["href"]))
    if not out:
        for box in page.select(CONTENT):
            for k in page.below(box, {"a"}):
                href, title = page.attributes[k].get("href", ""), page.plain(k)
                if "?p=" in href and len(title) >= 3 and "http" not in title.lower():
                    out.append(("content", title, href))
    return out


def article_list(page: Column) -> Column:
    """ARRAY of STRUCT(source, title, href), see ``linked_articles``."""
    names = ("source", "title", "href")

    def run(pages: pa.Array) -> pa.Array:
        found = [linked_articles(html) for html in pages.to_pylist()]
        flat = [x for rows in found for x in rows]
        items = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], pa.string()) for i in range(len(names))], names)
        return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, found))], pa.int32()), items)

    return F.arrow_udf(run, "array<struct<source:string,title:string,href:string>>")(page)
