"""Lenient casts, dates, URLs and categories of status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACES, collapse, once, trim

#: Greek month names, genitive and nominative, January first.
MONTHS_OF = ("Ιανουαρίου", "Φεβρουαρίου", "Μαρτίου", "Απριλίου", "Μαΐου", "Ιουνίου", "Ιουλίου", "Αυγούστου", "Σεπτεμβρίου", "Οκτωβρίου", "Νοεμβρίου", "Δεκεμβρίου")
MONTHS = ("Ιανουάριος", "Φεβρουάριος", "Μάρτιος", "Απρίλιος", "Μάιος", "Ιούνιος", "Ιούλιος", "Αύγουστος", "Σεπτέμβριος", "Οκτώβριος", "Νοέμβριος", "Δεκέμβριος")


def lenient_double(col: Column) -> Column:
    """Numbers, also with a percent sign or written as Some(x); null for blanks, words and the rest."""
    text = F.regexp_replace(trim(col.cast("string")), r"^Some\((.*)\)$", "$1")
    return F.regexp_replace(text, "%", "").try_cast("double")


def lenient_int(col: Column) -> Column:
    return F.coalesce(trim(col.cast("string")).try_cast("bigint"), lenient_double(col).try_cast("bigint"))


def lenient_bool(col: Column) -> Column:
    text = F.lower(trim(col.cast("string")))
    return F.when(text.isin("true", "1", "1.0", "yes", "t", "y"), True).when(text.isin("false", "0", "0.0", "no", "f", "n"), False)


def _with_month_numbers(col: Column, names: tuple[str, ...]) -> Column:
    for n, name in enumerate(names, 1):
        col = F.replace(col, F.lit(name), F.lit(f"{n:02d}"))
    return col


def greek_timestamp(col: Column) -> Column:
    """``DD month YYYY[, HH:MM]`` with the month in the genitive; null on failure."""
    text = collapse(_with_month_numbers(col, MONTHS_OF))
    full = F.when(text.contains(","), text).otherwise(F.concat(text, F.lit(", 00:00")))
    return F.try_to_timestamp(full, F.lit("d MM yyyy, H:mm")).cast("timestamp_ntz")


def greek_date(col: Column) -> Column:
    """``DD month, YYYY`` with the month in the nominative; null on failure."""
    text = collapse(_with_month_numbers(col, MONTHS))
    return F.try_to_timestamp(F.replace(text, F.lit(","), F.lit("")), F.lit("d MM yyyy")).cast("date")


def year_of(col: Column) -> Column:
    """The year of an ISO date, or else the first number of four digits."""
    text = col.cast("string")
    found = F.regexp_extract(text, r"\b(\d{4})\b", 1).try_cast("int")
    return F.coalesce(F.year(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd"))), found)


def is_finished(page: Column, marker: str, end: Column, now: Column | None = None) -> Column:
    """Finished if the page says so, or else if its end has passed."""
    return F.when(page.contains(marker), True).otherwise((F.current_timestamp() if now is None else now) > end)


def post_id(url: Column) -> Column:
    """The query parameter p."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit("p"))


def normalized_url(url: Column) -> Column:
    """Without scheme, fragment and closing slash, host in lower case; null and blank give null."""

    def joined(bare: Column) -> Column:
        head = F.substring_index(bare, "?", 1)
        host = F.when(head.startswith("//"), F.substring_index(F.substr(head, F.lit(3)), "/", 1)).otherwise("")
        path = F.when(head.startswith("//"), F.substr(head, F.length(host) + 3)).otherwise(head)
        query = F.substr(bare, F.length(head) + 1)  # with its mark
        return F.concat(F.lower(host), F.when(path == "/", path).otherwise(F.rtrim(path, F.lit("/"))), F.when(F.length(query) > 1, query).otherwise(""))

    def bare(text: Column) -> Column:
        """Without scheme; that of most addresses needs no pattern."""
        common = lambda s: F.substr(text, F.lit(len(s) + 1))
        return F.when(text.startswith("http:"), common("http:")).when(text.startswith("https:"), common("https:")).otherwise(F.regexp_replace(text, "^[A-Za-z][A-Za-z0-9+.-]*:", ""))

    whole = lambda text: F.when(text != "", once(once(F.substring_index(text, "#", 1), bare), joined))
    # most addresses have no blanks at their ends, and need no pattern for these either
    return once(F.when(F.btrim(url, F.lit(SPACES)) == url, url).otherwise(F.regexp_replace(url, r"(?U)^\s+|\s+$", "")), whole)


def url_host(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def ministry_code(url: Column) -> Column:
    """The first part of the path, in lower case; null if there is none."""
    return F.lower(F.nullif(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?/*([^/?#]+)", 1), F.lit("")))


def with_parameter(url: Column, name: str, value: Column, fragment: str = "") -> Column:
    """The URL with a query parameter set to a value, and with a fragment."""
    bare = F.regexp_replace(url, r"#.*$", "")
    pair = F.concat(F.lit(f"{name}="), value.cast("string"))
    there = bare.rlike(rf"[?&]{name}=")
    added = F.concat(bare, F.when(bare.contains("?"), "&").otherwise("?"), pair)
    replaced = F.regexp_replace(bare, F.lit(rf"([?&]){name}=[^&]*"), F.concat(F.lit("$1"), pair))
    return F.concat(F.when(there, replaced).otherwise(added), F.lit(f"#{fragment}" if fragment else ""))


def is_pdf_url(url: Column) -> Column:
    return F.lower(url).endswith(".pdf") | url.contains("download-monitor")


def pdf_filename(url: Column) -> Column:
    """A name from the first eight digits of the URL's MD5."""
    return F.concat(F.substring(F.md5(url), 1, 8), F.lit(".pdf"))


def extraction_quality(rating: Column, error: Column) -> Column:
    """good or bad; else the error, or unknown."""
    return F.when(rating.isin("good", "bad"), rating).otherwise(F.coalesce(F.nullif(error, F.lit("")), F.lit("unknown")))


def new_status(legacy: Column) -> Column:
    """The document state that a legacy status stands for."""
    old = F.lower(legacy)
    return F.when(old.isin("good", "bad", "processed", "success"), "processed").when(old.isin("failed", "error"), "processing_failed").when(old == "downloaded", "downloaded").otherwise("pending")


def total_from_phrases(text: Column, phrases: tuple[str, ...]) -> Column:
    """The number that stands in the first of several phrases (patterns with one group) to be found."""
    return F.coalesce(*(F.regexp_extract(text, p, 1).try_cast("int") for p in phrases))
