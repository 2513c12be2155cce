"""Citations of laws, decrees and decisions.

A citation of a law or decree is found from its number and year: the text is
split at every number over a year, the words before each are looked up in a
table of names, and what follows is read as a gazette. Decrees that are cited by
their date are found from the date. Names count as whole words only.

Decisions have no such anchor and are found by a pattern. Greek needs the flags
iu: without u, Java ignores the case of ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .convert import MONTHS_OF
from .text import fold_lower, once, trim

LAW, LEGISLATIVE, PRESIDENTIAL = "law", "legislative decree", "presidential decree"
#: Names before a number and year, without accents and in lower case; the last v is Latin.
NAMES = {
    "ν.": LAW,
    "νομου": LAW,
    "νομο": LAW,
    "α.ν.": LAW,
    "κ.ν.": LAW,
    "v.": LAW,
    "ν.δ.": LEGISLATIVE,
    "π.δ.": PRESIDENTIAL,
    "π.δ": PRESIDENTIAL,
    "πδ": PRESIDENTIAL,
    "προεδρικο διαταγμα": PRESIDENTIAL,
}
#: The short forms that a plain search for laws goes by.
SHORT = ("ν.", "νομου", "νομο")
NUMBERED = r"(\d+)\s*/\s*(\d{4})"
DATED = r"(?iu)(?<=\s)της\s+(\d{1,2})(?:ης|η)?\s+(\p{L}+)\.?\s+(\d{4})"
#: A name is looked for in so many characters before a number.
REACH = 60


def _names(before: Column) -> Column:
    """STRUCT(name, kind) of the name that a text ends with; two words go before one. A law may have a name of Greek capitals after its sign."""
    tail = F.substring(before, -REACH, REACH)
    table = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    last = lambda n: F.regexp_extract(tail, r"(?<![\p{L}.])([\p{L}.]+" + r"\s+[\p{L}.]+" * (n - 1) + r")\s*$", 1)
    plain = lambda x: F.regexp_replace(fold_lower(x), r"\s+", " ")
    kind = lambda x, p: F.coalesce(F.try_element_at(table, p), F.when(x.rlike(r"^[νΝ]\.?\s+[Α-Ω]+$|^[νΝ]\.[Α-Ω]+$"), LAW))

    def found(name: Column) -> Column:
        folded = once(name, lambda y: F.when(y != "", F.struct(y.alias("name"), plain(y).alias("plain"))))
        known = once(folded, lambda s: F.struct(s["name"].alias("name"), s["plain"].alias("plain"), kind(s["name"], s["plain"]).alias("kind")))
        return once(known, lambda s: F.when(s["kind"].isNotNull(), s))

    return F.coalesce(found(last(2)), found(last(1)))


def gazette_after(text: Column) -> Column:
    """STRUCT(series, gazette) of the first series that a text begins with, in brackets or not; both null if it doesn't."""
    bare = F.regexp_replace(text, r"^[\s,(]+", "")
    number = F.regexp_extract(F.substring(bare, 2, REACH), r"^(?:['`’΄]{0,2})\s*(\d+)", 1)
    here = F.substring(bare, 1, 1).isin("Α", "A") & (number != "")
    return F.struct(F.when(here, F.regexp_extract(bare, r"^(.['`’΄]{0,2})", 1)).alias("series"), F.when(here, number).alias("gazette"))


def _anchored(text: Column, anchor: str, groups: dict[str, int]) -> Column:
    """ARRAY of STRUCT(nth, raw, before, after, ...groups) of the places where ``anchor`` is found; before and after go to the next place."""
    cells = [F.split(text, anchor).alias("pieces"), *(F.regexp_extract_all(text, F.lit(anchor), F.lit(i)).alias(n) for n, i in {"raw": 0, **groups}.items())]

    def of(x: Column) -> Column:
        one = lambda raw, i: F.struct(i.alias("nth"), raw.alias("raw"), F.get(x["pieces"], i).alias("before"), F.get(x["pieces"], i + 1).alias("after"), *(F.get(x[n], i).alias(n) for n in groups))
        return F.transform(x["raw"], one)

    return once(F.struct(*cells), of)


def _after_first(text: Column, anchor: str, kinds: tuple[str, ...]) -> Column:
    """The text from the end of the first citation of such kinds on; null without one."""

    def rest(x: Column) -> Column:
        named = F.transform(F.slice(x["pieces"], F.lit(1), F.size(x["raws"])), lambda before: F.coalesce(_names(before)["kind"].isin(*kinds), F.lit(False)))
        upto = lambda i: F.aggregate(F.slice(F.zip_with(x["pieces"], x["raws"], lambda a, b: F.length(a) + F.length(F.coalesce(b, F.lit("")))), F.lit(1), i), F.lit(0), lambda n, y: n + y)
        return once(F.array_position(named, True).cast("int"), lambda i: F.when(i > 0, F.substr(text, upto(i) + 1)))

    # a text is searched once, and split if there is a place to split it at
    cells = lambda raws: F.struct(raws.alias("raws"), F.split(text, anchor).alias("pieces"))
    return once(F.regexp_extract_all(text, F.lit(anchor), F.lit(0)), lambda raws: F.when(F.size(raws) > 0, once(cells(raws), rest)))


def law_citations(text: Column, kinds: tuple[str, ...] = (LAW,)) -> Column:
    """ARRAY of STRUCT(full_match, type, name, kind, number, year, series, gazette) of citations by number and year."""
    named = F.transform(_anchored(text, NUMBERED, {"number": 1, "year": 2}), lambda x: F.struct(x.alias("x"), _names(x["before"]).alias("n")))
    kept = F.filter(named, lambda y: F.coalesce(y["n"]["kind"].isin(*kinds), F.lit(False)))

    def cited(y: Column) -> Column:
        gap = F.regexp_extract(F.substring(y["x"]["before"], -REACH, REACH), r"(\s*)$", 1)
        gazette = gazette_after(y["x"]["after"])
        return F.struct(
            F.concat(y["n"]["name"], gap, y["x"]["raw"]).alias("full_match"),
            y["n"]["name"].alias("type"),
            y["n"]["plain"].alias("name"),
            y["n"]["kind"].alias("kind"),
            y["x"]["number"].alias("number"),
            y["x"]["year"].cast("int").alias("year"),
            gazette["series"].alias("series"),
            gazette["gazette"].alias("gazette"),
        )

    return F.transform(kept, cited)


def law_references(text: Column, names: tuple[str, ...] = SHORT) -> Column:
    """ARRAY of STRUCT(full_match, type, number, year) of laws under their short names."""
    found = F.filter(law_citations(text), lambda x: x["name"].isin(*names))
    return F.transform(found, lambda x: F.struct(x["full_match"].alias("full_match"), x["type"].alias("type"), x["number"].alias("number"), x["year"].alias("year")))


def dated_decrees(text: Column) -> Column:
    """ARRAY of STRUCT(day, month, year) of presidential decrees that are cited by their date; month is a number."""
    months = F.create_map(*[x for k, m in enumerate(MONTHS_OF, 1) for x in (fold_lower(F.lit(m)), F.lit(k))])
    found = F.filter(_anchored(text, DATED, {"day": 1, "month": 2, "year": 3}), lambda x: F.coalesce(_names(x["before"])["kind"] == PRESIDENTIAL, F.lit(False)))
    read = F.transform(found, lambda x: F.struct(x["day"].cast("int").alias("day"), F.try_element_at(months, fold_lower(x["month"])).alias("month"), x["year"].cast("int").alias("year")))
    return F.filter(read, lambda x: x["month"].isNotNull())


def _decision_pattern() -> str:
    """An unwanted paragraph before, then type and reference or reference and type.

    A reference is an identifier of capitals, digits and marks with a digit or
    slash in it, after words like "no." and before its publication and gazette.
    """
    full = r"(?:κοιν[ηή]ς?\s+)?υπουργικ[ηή]ς?\s+απ[οό]φασ(?:ης|εως|η|ε)"
    kind = rf"({full}|κ\.?υ\.?α\.?|υ\.?α\.?)"
    marks = r"A-ZΑ-Ω0-9()/.\-‐−"
    lead = r"(?:με\s+)?(?:υπ['’]?\s*)?(?:αρ(?:ιθμ(?:ό|ο)?)?\.?\s*)?(?:οικ\.?\s*)?"
    code = rf"((?=[{marks}]*[0-9/])[{marks}]+)"
    gazette = r"(?:\s*[,(]?\s*(?:ΦΕΚ|Φ\.Ε\.Κ\.)\s*([Α-ΩA-Z]+['’`]*)?\s*(\d+)(?:\s*[/-]\s*(\d{4}))?\s*\)?)?"
    published = r"(?:\s*\(ΑΔΑ:\s*[A-ZΑ-Ω0-9\-‐−]+\))?"
    reference = f"{lead}{code}{published}{gazette}"
    paragraph = r"(παρ(?:άγραφος|άγρ)?\.\s*\d+\s+)?"
    return rf"(?iu){paragraph}(?<![\p{{L}}\d])(?:{kind}\s+{reference}|{reference}\s+{kind})(?![\p{{L}}])"


DECISION = _decision_pattern()


def matches(text: Column, pattern: str, groups: dict[str, int]) -> Column:
    """ARRAY of STRUCTs, one per match, of the named groups."""
    cols = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in groups.values()]
    zipped = F.arrays_zip(*(c.alias(n) for n, c in zip(groups, cols, strict=True)))
    return F.transform(zipped, lambda x: F.struct(*(F.nullif(x[n], F.lit("")).alias(n) for n in groups)))


def decisions(text: Column) -> Column:
    """ARRAY of STRUCT(full_match, type, id, series, number, year) of ministerial decisions; those after a paragraph's number are left out."""
    names = {"full_match": 0, "paragraph": 1, "type1": 2, "id1": 3, "series1": 4, "number1": 5, "year1": 6, "id2": 7, "series2": 8, "number2": 9, "year2": 10, "type2": 11}
    found = F.filter(matches(text, DECISION, names), lambda x: x["paragraph"].isNull())
    either = lambda x, name: F.coalesce(x[f"{name}1"], x[f"{name}2"])
    columns = lambda x: [either(x, name).alias(name) for name in ("type", "id", "series", "number")]
    return F.transform(found, lambda x: F.struct(x["full_match"].alias("full_match"), *columns(x), either(x, "year").cast("int").alias("year")))


def decree_key(number: Column, date: Column) -> Column:
    """STRUCT(number, year) by which decrees are matched: the number trimmed, empty if null; the year of a date, or the first four digits by themselves; 0 if there is none."""
    year = F.coalesce(F.year(date.try_cast("date")), F.regexp_extract(date, r"\b(\d{4})\b", 1).try_cast("int"), F.lit(0))
    return F.struct(F.trim(F.coalesce(number.cast("string"), F.lit(""))).alias("number"), year.alias("year"))


def modifies_law(text: Column) -> Column:
    """Whether a law or decree is cited and, after the first citation, a quotation of several lines or a whole line of quotation follows."""
    after = F.struct(_after_first(text, NUMBERED, (LAW, LEGISLATIVE, PRESIDENTIAL)).alias("numbered"), _after_first(text, DATED, (PRESIDENTIAL,)).alias("dated"))

    def quoted(rest: Column) -> Column:
        line = F.exists(F.split(rest, "\n"), lambda x: x.contains("«") & trim(x).rlike(r"(?s)^«.{5,}(»|»\.)$"))
        return rest.rlike(r"(?s)«[^»]*\n[^»]*»") | line

    # what is left after the earlier of the two is longer
    size = lambda x: F.coalesce(F.length(x), F.lit(-1))
    first = once(after, lambda s: F.when(size(s["numbered"]) >= size(s["dated"]), s["numbered"]).otherwise(s["dated"]))
    # most texts have no quotation, and citations cost more to find than a mark
    return F.when(text.contains("«"), F.coalesce(once(first, quoted), F.lit(False))).otherwise(False)


def gazette_title(title: Column) -> Column:
    """STRUCT(series, number, year) of a gazette's title, strict form first, then any series, number and year in order."""
    strict = r"(?iu)ΦΕΚ\s+([Α-ΩA-Z]+)['΄’]?\s*(\d+)\s*/\s*(?:\d{1,2}[./]\d{1,2}[./])?(\d{4})"
    loose = r"(?iu)([Α-ΩA-Z]+)['΄’]?\s*[-,]?\s*(\d+)\D+(?:\d{1,2}\D\d{1,2}\D)?(\d{4})"
    part = lambda p, i: F.nullif(F.regexp_extract(title, p, i), F.lit(""))
    both = lambda i: F.coalesce(part(strict, i), part(loose, i))
    return F.struct(both(1).alias("series"), both(2).cast("int").alias("number"), both(3).cast("int").alias("year"))
