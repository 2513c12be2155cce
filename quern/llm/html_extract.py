"""Main text of HTML pages by block rules in two passes.

A page is cut into blocks at block elements. The first pass judges each block
by itself: link density, length and stop-word density make it good, near good,
short or bad; the element around it may say that it is boilerplate (menus,
footers, forms, adverts and the like) or that it is in the article.
The second pass gives short and near-good blocks the label of their nearest
decided neighbours.

What an element's tag, role, class or id says is weighed with what is in it. An
element under suspicion that holds the page's main article (the one with most
prose, if that is more than all prose outside of suspects) is cleared; so is a
form with most of the page's prose (within an article: if that has no other), and
an element with most of it that is suspected for its name only, on a page whose
articles, if it has any, are empty. What is suspected
inside of these stays so. Reader comments
are out wherever they are, in articles, too, unless the element that is named
for them has the page's main element or first heading in it. In an article
other composed names, such as related-posts, only hint at boilerplate: long
prose without links stays. What follows has, no, with or without in a name
isn't what the element is.

Within an article (or main) element, neighbours are looked for in the article
only. Outside, an ambiguous block between neighbours of different labels is
kept only if it is near good. A block without any decided neighbour is kept. On
a page without any good block near good ones count as good.

Defined cases: null and empty html give an empty text. Elements and comments
that never end, tags cut off by the end of the page and unknown entities are
coped with; no block is dropped for its position or length alone. A page in a
language without stop words here is judged by length and links. A page takes
time in proportion to its length, however its tags are nested. Further columns
are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_of

#: Thresholds of the first pass: characters, shares of words, share of characters in links.
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.30, 0.32
MAX_LINKS = 0.2
#: A page of which a smaller share of words are stop words is in another language.
LEAST_KNOWN = 0.05

#: Frequent function words.
STOP_WORDS = frozenset(
    # English
    "a about after all also an and any are as at be because been but by can could did do for from had has have he her him his how i if in into is it its "
    "just like more most no not of on one only or other our out over she so some than that the their them then there these they this to up was we were "
    "what when which who will with would you your "
    # French
    "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui ma mais me même mes moi mon ne nos notre nous on ou où par pas "
    "plus pour qu que qui sa sans se ses son sont sur ta te tu un une vos votre vous à été être "
    # German
    "aber als am an auch auf aus bei bin bis da das dass dem den der des die dies diese ein eine einem einen einer er es für hat hatte ich ihr im in ist ja "
    "kein mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn wie wir wird zu zum zur "
    # Spanish
    "al como con de del desde donde el ella en entre era es esta este ha hay la las lo los más me mi muy no nos o para pero por porque que se ser si sin "
    "sobre su sus también te tiene todo un una uno y ya".split()
)
#: Elements that begin and end blocks.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is no text of the page.
SKIPPED = frozenset("script style noscript template head title svg math iframe object embed audio video canvas map select textarea button noframes".split())
RAW = frozenset("script style textarea title noscript iframe noframes template".split())
#: Elements without an end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Class names and ids of boilerplate: alone, as the last part of a name, or before a part that names a box.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus "
    "footer header login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promoted promotion "
    "recommended related respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Names of reader comments; alone, as the last part, or before a part that names a box.
COMMENTS = frozenset("comment comments commentlist commentarea commentsection discussion discussions disqus replies reply respond".split())
#: After these parts a name says what an element has or lacks.
HAVING = frozenset("has no with without".split())
#: Last parts of names that say what kind of box it is.
BOXES = frozenset(
    "area author bar block body box btn button buttons card cell column container content cta feed form frame group holder icon icons inner item items label left link "
    "links list main message module nav notice outer overlay panel placement post posts right row section slot strip text title top thread unit widget wrap wrapper zone".split()
)
CLOSED_BY = {"p": BLOCKS - {"html", "body"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}
#: A quotation in a tag begins after "=" only; one without end counts as plain characters.
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_NAME_PART = re.compile(r"[a-z]+|[0-9]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
GOOD, NEAR, SHORT_BLOCK, BAD = "good", "near", "short", "bad"


#: What an element is suspected of.
BY_COMMENTS, BY_FORM, BY_NAME, BY_TAG = "comments", "form", "name", "tag"


@lru_cache(1 << 14)
def _named(name: str) -> str | bool | None:
    """Whether a class name or id says boilerplate by itself, or comments; None if it only hints at boilerplate."""
    parts = _NAME_PART.findall(_HUMP.sub("-", name).lower())
    parts = parts[: next((k for k, part in enumerate(parts) if part in HAVING), len(parts))]
    while len(parts) > 1 and parts[-1].isdigit():
        parts.pop()
    if not parts:
        return False
    if parts[-1] in COMMENTS or (parts[0] in COMMENTS and parts[-1] in BOXES):
        return BY_COMMENTS
    if len(parts) == 1:
        return parts[0] in NAMES
    if parts[-1] in NAMES or (parts[0] in NAMES and parts[-1] in BOXES):
        return None
    return False


def _suspected(tag: str, attributes: str, in_article: bool) -> tuple[str | None, bool]:
    """What an element is suspected of, and whether its name hints at boilerplate; outside of articles a hint is enough."""
    by_tag = None
    if tag in BOILERPLATE or (tag == "header" and not in_article):
        by_tag = BY_FORM if tag in ("form", "fieldset") else BY_TAG
    if not attributes or tag in ("html", "body", "main"):
        return by_tag, False
    hint = by_name = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "role" and value.lower() in ROLES):
            by_tag = BY_TAG
        elif name in ("class", "id"):
            for token in value.split():
                named = _named(token)
                if named == BY_COMMENTS:
                    return BY_COMMENTS, False
                if tag == "article":
                    continue
                by_name = by_name or named is True or (named is None and not in_article)
                hint = hint or named is None
    return by_tag or (BY_NAME if by_name else None), hint and not by_name


class Suspect:
    """An element that may be boilerplate, and how much prose is in it."""

    __slots__ = ("article", "bad", "by_tag", "cleared", "in_comments", "kind", "parent", "prose")

    def __init__(self, kind: str, parent: Suspect | None, article: int):
        self.kind, self.parent, self.article, self.prose = kind, parent, article, 0
        self.cleared = self.bad = self.in_comments = self.by_tag = False


def _end_of(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I)


class Block:
    __slots__ = ("article", "boilerplate", "counts", "hint", "label", "linked", "parts", "suspect", "text")

    def __init__(self, suspect: Suspect | None = None, article: int = 0, hint: bool = False):
        self.suspect, self.article, self.hint, self.parts, self.linked, self.boilerplate = suspect, article, hint, [], 0, False
        self.counts: tuple[int, int] | None = None


def cut(page: str) -> list[Block]:
    """The blocks of a page that hold text, in page order; text has its white space collapsed."""
    blocks: list[Block] = []
    stack: list[tuple[str, Suspect | None, int, bool]] = []  # element, suspect around or at it, number of the article around it, hint of boilerplate
    opened: Counter[str] = Counter()  # how often an element is in the stack
    suspects: list[Suspect] = []
    around: list[Suspect | None] = [None]  # by article
    skip: str | None = None
    inner: Counter[str] = Counter()  # open blocks within the skipped element
    endless: set[str] = set()  # RAW elements that have no end tag from here on
    depth = links = breaks = 0
    block = Block()

    def end_block() -> None:
        nonlocal block
        if block.parts:
            blocks.append(block)
        block = Block(*stack[-1][1:]) if stack else Block()

    def text(a: int, b: int) -> None:
        nonlocal breaks
        if a < b and skip is None:
            piece = html.unescape(page[a:b])
            block.parts.append(piece)
            if not piece.isspace():
                breaks = 0
                if links:
                    block.linked += len(" ".join(piece.split()))

    def close(tag: str) -> None:
        while True:
            last = stack.pop()[0]
            opened[last] -= 1
            if last == tag:
                return

    at, scan, end = 0, 0, len(page)
    while (m := _TOKEN.search(page, scan)) is not None:
        text(at, m.start())
        at = scan = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m[1])
        if skip is not None:
            if tag == skip:
                depth += -1 if closing else (not m[3].endswith("/"))
                if depth <= 0:
                    skip = None
                continue
            if tag in RAW and not closing and not m[3].endswith("/") and tag not in endless:
                ending = _end_of(tag).search(page, at)
                if ending:
                    at = scan = ending.end()
                else:
                    endless.add(tag)
                continue
            if tag not in BLOCKS:
                continue
            if skip == "head":  # a block ends it, <body> too
                if closing:
                    continue
            elif not closing:
                inner[tag] += tag not in VOID
                continue
            elif inner[tag]:
                inner[tag] -= 1
                continue
            elif not opened[tag]:
                continue
            skip = None  # the block around it ends
        if tag == "br":
            breaks += 1
            block.parts.append(" ")
            if breaks == 2:
                end_block()
            continue
        if tag in SKIPPED and tag not in VOID:
            if not closing and not m[3].endswith("/"):
                if tag in RAW:
                    ending = _end_of(tag).search(page, at)
                    at = scan = ending.end() if ending else end
                else:
                    skip, depth = tag, 1
                    inner.clear()
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag not in BLOCKS:
            continue
        breaks = 0
        if closing:
            if opened[tag]:
                close(tag)
        else:
            while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                opened[stack.pop()[0]] -= 1
            if tag not in VOID:
                suspect, article, hint = stack[-1][1:] if stack else (None, 0, False)
                if tag in ("h1", "main"):
                    _no_comments(suspect)
                if tag in ("article", "main") and not article:
                    article = len(around)
                    around.append(suspect)
                kind, hints = _suspected(tag, m[3], article > 0)
                if kind:
                    suspect = Suspect(kind, suspect, article)
                    suspects.append(suspect)
                stack.append((tag, suspect, article, hint or hints))
                opened[tag] += 1
            links = 0
        end_block()
    text(at, end)
    end_block()
    out = []
    for b in blocks:
        b.text = " ".join("".join(b.parts).split())
        if b.text:
            out.append(b)
    _weigh(out, suspects, around)
    return out


def _no_comments(suspect: Suspect | None) -> None:
    """Elements named for comments that have the page's main element or first heading in them are cleared."""
    while suspect is not None and not suspect.in_comments:
        suspect.in_comments = True  # seen, up to the root; _weigh sets what it means
        suspect.cleared = suspect.kind == BY_COMMENTS
        suspect = suspect.parent


def _weigh(blocks: list[Block], suspects: list[Suspect], around: list[Suspect | None]) -> None:
    """Sets which blocks are boilerplate, by what their suspects hold. Parents come before their children in ``suspects``."""
    for s in suspects:
        s.in_comments = (s.kind == BY_COMMENTS and not s.cleared) or (s.parent is not None and s.parent.in_comments)
        s.by_tag = s.in_comments or s.kind == BY_TAG or (s.parent is not None and s.parent.by_tag)
    total = 0  # prose that is outside of what tags and comments say
    by_article: Counter[int] = Counter()
    clean: Counter[int] = Counter()  # by article
    worded = False  # whether an article has any text
    for b in blocks:
        size = len(b.text)
        worded = worded or (b.article > 0 and (b.suspect is None or not b.suspect.in_comments))
        if size < SHORT or b.linked > MAX_LINKS * size or (b.suspect is not None and b.suspect.in_comments):
            continue
        by_article[b.article] += size
        if b.suspect is None:
            clean[b.article] += size
        elif not b.suspect.by_tag:
            b.suspect.prose += size
        total += size if b.suspect is None or not b.suspect.by_tag else 0
    for s in reversed(suspects):
        if s.parent is not None and not s.by_tag:
            s.parent.prose += s.prose
    articles = [k for k in range(1, len(around)) if around[k] is None or not around[k].in_comments]
    best = max(articles, key=lambda k: (by_article[k], -k), default=0)
    if best and by_article[best] > clean.total():
        s = around[best]
        while s is not None:
            s.cleared = True
            s = s.parent
    for s in suspects:
        if 2 * s.prose > total and s.prose >= LONG:
            s.cleared = s.cleared or (s.kind == BY_FORM and (not s.article or clean[s.article] < SHORT)) or (s.kind == BY_NAME and not worded)
        s.bad = not s.cleared or (s.parent is not None and s.parent.bad)
    for b in blocks:
        b.boilerplate = b.suspect is not None and b.suspect.bad


def _counts(block: Block) -> tuple[int, int]:
    """Words and stop words of a block."""
    if block.counts is None:
        words = _WORD.findall(block.text.lower())
        block.counts = len(words), sum(w in STOP_WORDS for w in words)
    return block.counts


def _density(block: Block) -> float:
    words, stops = _counts(block)
    return stops / words if words else 0.0


def judge(block: Block, known: bool = True) -> str:
    """First pass: the label of a block by itself; ``known`` is whether the page's language has stop words here."""
    size = len(block.text)
    if block.boilerplate or block.linked > MAX_LINKS * size and not (block.article and size >= LONG and not block.hint):
        return BAD
    if size < LONG and "©" in block.text and not block.article and (block.text.startswith("©") or _density(block) < STOP_LOW):
        return BAD
    if size < SHORT:
        return BAD if block.hint or (block.linked and not block.article) else SHORT_BLOCK
    density = _density(block) if known else STOP_HIGH
    if block.hint and (size < LONG or density < STOP_LOW):
        return BAD
    if density >= STOP_HIGH:
        return GOOD if size > LONG else NEAR
    if density >= STOP_LOW or block.article:
        return NEAR
    return BAD


def _knows(blocks: list[Block]) -> bool:
    """Whether the page's longer blocks are in a language with stop words here; if not, length and links alone decide."""
    found = [_counts(b) for b in blocks if not b.boilerplate and len(b.text) >= SHORT and b.linked <= MAX_LINKS * len(b.text)]
    words = sum(n for n, _ in found)
    return not words or sum(n for _, n in found) >= LEAST_KNOWN * words


def settle(blocks: list[Block]) -> list[bool]:
    """Second pass: whether each block is kept, ambiguous ones as their nearest decided neighbours are."""
    known = _knows(blocks)
    first = [judge(b, known) for b in blocks]
    if GOOD not in first:  # all paragraphs are short
        first = [GOOD if x == NEAR else x for x in first]
    n = len(blocks)

    def nearest(order: range, decided: frozenset[str]) -> list[str | None]:
        out: list[str | None] = [None] * n
        seen: dict[int, str] = {}  # by article; 0 outside of any
        last: str | None = None
        for i in order:
            b = blocks[i]
            out[i] = seen.get(b.article) if b.article else last
            if first[i] in decided:
                last = first[i]
                if not b.boilerplate:
                    seen[b.article] = first[i]
        return out

    strong = frozenset([GOOD, BAD])
    before, after = nearest(range(n), strong), nearest(range(n - 1, -1, -1), strong)
    kept = []
    for i, b in enumerate(blocks):
        if first[i] in strong:
            kept.append(first[i] == GOOD)
            continue
        around = {before[i], after[i]} - {None}
        if b.article:
            kept.append(GOOD in around or not around or first[i] == NEAR)
        elif around == {GOOD} or not around:
            kept.append(True)
        else:
            kept.append(first[i] == NEAR and GOOD in around)
    return kept


def main_text(page: str) -> str:
    """The text of a page's kept blocks, joined by two line ends."""
    blocks = cut(page)
    return "\n\n".join(b.text for b, keep in zip(blocks, settle(blocks), strict=True) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text and n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"), text_of(pages, html_col).alias("html"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, url string, text string, n_chars long")
