"""Records out of stored pages of a consultation site: listings, metadata, articles, comment pages, gazette tables, redirects.

Fetching is someone else's work; pages come as rows (url, html). What is read
is native expressions on regular patterns of the markup.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.convert import greek_date, greek_timestamp, post_id, with_parameter
from quern.functions.text import collapse, once, trim
from quern.operators.html import links, without_tags

ITEM = r"""(?is)<li[^>]*>(?:(?!</li>).)*?<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>((?:(?!</li>).)*)</li>"""
START = r"""(?is)class\s*=\s*["'][^"']*\bstart\b[^"']*["'][^>]*>(.*?)<"""
#: The class of the element with an article's content.
CONTENT = "post_content"
ROW, CELL = r"(?is)<tr[^>]*>(.*?)</tr>", r"(?is)<td[^>]*>(.*?)</td>"
#: Phrases with the total of comments, as sites report it, in order.
TOTALS = (r"(?iu)(\d+)\s+-\s+Όλα\s+τα\s+Σχόλια", r"(?iu)(\d+)\s+σχόλια\s+συνολικά", r"(?iu)συνολικά\s+(\d+)\s+σχόλια")
LABELS = r"(?iu)(\d+)\s+Σχόλια"


def absolute(href: Column, base: Column) -> Column:
    """An address relative to a page's: absolute, without scheme, from the root, of the same path, or with a query only."""
    host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    path = F.regexp_extract(base, r"^([^?#]*)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(host, href))
        .when(href.startswith("?"), F.concat(path, href))
        .when(href.startswith("#") | (href == ""), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .otherwise(F.concat(F.when(path == host, F.concat(host, F.lit("/"))).otherwise(F.regexp_replace(path, r"[^/]*$", "")), href))
    )


def listing_items(pages: DataFrame, number: str, url: str, html: str) -> DataFrame:
    """(page_no, pos, url, title, date) of the items of listing pages; date is null where it can't be read."""
    part = lambda i: F.regexp_extract_all(html, F.lit(ITEM), F.lit(i))
    zipped = F.arrays_zip(part(1).alias("href"), part(2).alias("label"), part(3).alias("rest"))
    rows = pages.select(F.col(number).alias("page_no"), F.col(url).alias("base"), F.posexplode(zipped).alias("pos", "i"))
    date = F.regexp_extract("i.rest", START, 1)
    return rows.select("page_no", "pos", absolute(F.col("i.href"), F.col("base")).alias("url"), collapse(without_tags(F.col("i.label"))).alias("title"), F.coalesce(greek_date(date), greek_timestamp(date).cast("date")).alias("date"))


def until_known(items: DataFrame, mark) -> DataFrame:
    """Items before the first one, in page order, that isn't newer than ``mark``; all if ``mark`` is null. Undated items don't stop."""
    mark = mark if isinstance(mark, Column) else F.lit(mark)
    old = F.coalesce(F.col("date") <= mark, F.lit(False))
    # one place is enough to cut at: an aggregate, then a filter, instead of a window over all items
    first = items.where(old).agg(F.min(F.struct("page_no", "pos"))).scalar()
    return items.where(first.isNull() | (F.struct("page_no", "pos") < first))


def comment_total(html: Column) -> Column:
    """The number of comments a page reports: a phrase, else the greatest label, else the link to all comments; 0 if there is none."""
    phrase = F.coalesce(*(F.regexp_extract(without_tags(html), p, 1).try_cast("int") for p in TOTALS))
    label = F.array_max(F.transform(F.regexp_extract_all(html, F.lit(LABELS), F.lit(1)), lambda x: x.cast("int")))
    link = F.filter(links(html), lambda x: x["href"].contains("allcomments") & x["label"].rlike(r"\d"))
    return F.coalesce(phrase, label, F.regexp_extract(F.try_element_at(link, F.lit(1))["label"], r"(\d+)", 1).try_cast("int"), F.lit(0))


def metadata(pages: DataFrame, url: str, html: str, finished: str = "Ολοκληρώθηκε", now: Column | None = None) -> DataFrame:
    """(url, post_id, title, start_date, end_date, is_finished, total_comments) of consultation pages."""
    dates = F.regexp_extract_all(html, F.lit(r"(?iu)(\d{1,2}\s+\p{L}+\s+\d{4}(?:,\s*\d{1,2}:\d{2})?)"), F.lit(1))
    at = lambda i: greek_timestamp(F.try_element_at(dates, F.lit(i)))
    heading = F.regexp_extract(html, r"(?is)<h[13][^>]*>(.*?)</h[13]>", 1)
    end = at(2)
    is_finished = F.when(F.col(html).contains(finished), True).otherwise((F.current_timestamp() if now is None else now) > end.cast("timestamp"))
    return pages.select(F.col(url).alias("url"), post_id(F.col(url)).alias("post_id"), collapse(without_tags(heading)).alias("title"), at(1).alias("start_date"), end.alias("end_date"), is_finished.alias("is_finished"), comment_total(F.col(html)).alias("total_comments"))


def div_content(html: Column, name: str) -> Column:
    """The markup inside the first div of a class, up to its own end; to the end of the page if it has none; null without such a div."""
    opening = rf"""(?is)^.*?<div\b[^>]*class\s*=\s*["'][^"']*(?<![\w-]){name}(?![\w-])[^"']*["'][^>]*>"""
    rest = F.regexp_replace(html, opening, "")
    pieces = F.split(rest, r"(?i)(?=<div[\s>])|(?=</div[\s>])")  # all but the first begin with a tag
    steps = F.transform(pieces, lambda x: F.when(F.lower(x).rlike(r"^<div[\s>]"), 1).when(F.lower(x).rlike(r"^</div[\s>]"), -1).otherwise(0))
    state = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("end"))
    walk = lambda s, step: F.struct((s["depth"] + step).alias("depth"), (s["at"] + 1).alias("at"), F.coalesce(s["end"], F.when(s["depth"] + step < 0, s["at"])).alias("end"))
    end = F.aggregate(steps, state, walk, lambda s: F.coalesce(s["end"], s["at"]))
    return F.when(html.rlike(opening), F.array_join(F.slice(pieces, F.lit(1), end), ""))


def article_pages(pages: DataFrame, url: str, html: str, *kept: str) -> DataFrame:
    """(url, post_id, title, raw_html) of article pages, and columns that are kept: the heading and the content's markup."""
    heading = F.regexp_extract(html, r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>", 1)
    raw = F.nullif(div_content(F.col(html), CONTENT), F.lit(""))
    return pages.select(F.col(url).alias("url"), post_id(F.col(url)).alias("post_id"), collapse(without_tags(heading)).alias("title"), raw.alias("raw_html"), *kept)


def comment_pages(url: Column, html: Column) -> Column:
    """ARRAY of the addresses of an article's comment pages: itself, and one per page if it says there are several."""
    numbers = F.regexp_extract_all(html, F.lit(r"""(?is)class\s*=\s*["'][^"']*page-numbers[^"']*["'][^>]*>\s*(\d+)\s*<"""), F.lit(1))
    more = lambda last: F.transform(F.sequence(F.lit(1), last), lambda n: with_parameter(url, "cpage", n))
    return once(F.array_max(F.transform(numbers, lambda x: x.cast("int"))), lambda last: F.when(last > 1, F.array_distinct(F.concat(F.array(url), more(last)))).otherwise(F.array(url)))


def gazette_rows(pages: DataFrame, html: str) -> DataFrame:
    """Rows of gazette listings: law_type, law_number, description, fek_title, fek_url, date, pages and pdf_url; rows with fewer than 7 cells are left out."""
    rows = pages.select(F.explode(F.regexp_extract_all(html, F.lit(ROW), F.lit(1))).alias("r")).select(F.regexp_extract_all("r", F.lit(CELL), F.lit(1)).alias("c")).where(F.size("c") >= 7)
    text = lambda i: trim(without_tags(F.col("c")[i]))
    link = lambda i, part: F.coalesce(F.try_element_at(links(F.col("c")[i]), F.lit(1))[part], F.lit(""))
    return rows.select(text(0).alias("law_type"), text(1).alias("law_number"), text(2).alias("description"), link(3, "label").alias("fek_title"), link(3, "href").alias("fek_url"), text(4).alias("date"), text(5).alias("pages"), link(6, "href").alias("pdf_url"))


def resolved(rows: DataFrame, url: str, factory: Callable[[], Callable[[str], str]], tries: int = 3) -> DataFrame:
    """``rows`` with redirected_url and error: each distinct address is resolved once, with retries; what fails keeps its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resolve = factory()
        for batch in batches:
            out = []
            for address in batch["u"]:
                target = error = None
                for _ in range(tries):
                    try:
                        target, error = resolve(address), None
                        break
                    except Exception as e:  # noqa: BLE001  any failure of the caller's resolver is a result here
                        error = f"{type(e).__name__}: {e}"
                out.append((address, target, error))
            yield pd.DataFrame(out, columns=["u", "redirected_url", "error"])

    distinct = rows.where(F.col(url).isNotNull()).select(F.col(url).alias("u")).distinct()
    return rows.join(distinct.mapInPandas(run, "u string, redirected_url string, error string"), F.col(url) == F.col("u"), "left").drop("u")
