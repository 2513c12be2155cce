"""Greek numerals and ordinal words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold_lower, once, strip_accents

#: Values of the letters; the stigma pair ΣΤ is 6. 90 and 100 share a letter, as in common use.
LETTERS = {"Α": 1, "Β": 2, "Γ": 3, "Δ": 4, "Ε": 5, "Ζ": 7, "Η": 8, "Θ": 9, "Ι": 10, "Κ": 20, "Λ": 30, "Μ": 40, "Ν": 50, "Ξ": 60, "Ο": 70, "Π": 80, "Ρ": 100, "Σ": 200, "Τ": 300, "Υ": 400, "Φ": 500, "Χ": 600, "Ψ": 700, "Ω": 800}
UNITS = ("", "Α", "Β", "Γ", "Δ", "Ε", "ΣΤ", "Ζ", "Η", "Θ")
TENS = ("", "Ι", "Κ", "Λ", "Μ", "Ν", "Ξ", "Ο", "Π", "Ρ")
HUNDREDS = ("", "Ρ", "Σ", "Τ", "Υ", "Φ", "Χ", "Ψ", "Ω", "Ϡ")


def int_to_greek(n: Column) -> Column:
    """The numeral of 1 to 999; null elsewhere."""
    digit = lambda table, d: F.element_at(F.array(*map(F.lit, table)), (d + 1).cast("int"))
    out = F.concat(digit(HUNDREDS, F.floor(n / 100)), digit(TENS, F.floor(n / 10) % 10), digit(UNITS, n % 10))
    return F.when((n >= 1) & (n <= 999), out)


def known_numerals(most: int) -> list[str]:
    """The numerals of 1 to ``most`` that are read as the number they are written for."""
    written = {n: HUNDREDS[n // 100] + TENS[n // 10 % 10] + UNITS[n % 10] for n in range(1, most + 1)}
    read = lambda text: 6 * text.count("ΣΤ") + sum(LETTERS.get(c, 0) for c in text.replace("ΣΤ", ""))
    return [text for n, text in written.items() if read(text) == n]


def greek_to_int(label: Column) -> Column:
    """Sum of the values of a numeral's letters; other characters count nothing; null and empty give 0."""
    text = F.regexp_replace(F.upper(strip_accents(F.coalesce(label, F.lit("")))), "[΄'`·. ]", "")
    stigmas = F.size(F.split(text, "ΣΤ")) - 1
    values = F.create_map(*[F.lit(x) for pair in LETTERS.items() for x in pair])
    letters = F.filter(F.split(F.replace(text, F.lit("ΣΤ"), F.lit("")), ""), lambda c: c != "")
    return (F.aggregate(letters, F.lit(0), lambda s, c: s + F.coalesce(F.try_element_at(values, c), F.lit(0))) + 6 * stigmas).cast("int")


#: Ordinal words (neuter) by their parts; 11 and 12 have words of their own.
ORDINAL_UNITS = ("πρώτο", "δεύτερο", "τρίτο", "τέταρτο", "πέμπτο", "έκτο", "έβδομο", "όγδοο", "ένατο")
ORDINAL_TENS = ("δέκατο", "εικοστό", "τριακοστό", "τεσσαρακοστό", "πεντηκοστό", "εξηκοστό", "εβδομηκοστό", "ογδοηκοστό", "ενενηκοστό")
ORDINAL_HUNDREDS = ("εκατοστό", "διακοσιοστό", "τριακοσιοστό", "τετρακοσιοστό", "πεντακοσιοστό", "εξακοσιοστό", "επτακοσιοστό", "οκτακοσιοστό", "εννιακοσιοστό")
ORDINAL_TEENS = {"ενδέκατο": 11, "δωδέκατο": 12}
ORDINAL_THOUSAND = "χιλιοστό"


def ordinal_number(content: Column) -> Column:
    """The number of the ordinal words (1 to 1999) that a text begins with: thousand, hundred, ten and unit, each at most once; null if there is none."""
    parts = [{ORDINAL_THOUSAND: 1000}]
    parts += [{w: size * i for i, w in enumerate(words, 1)} for size, words in ((100, ORDINAL_HUNDREDS), (10, ORDINAL_TENS), (1, ORDINAL_UNITS))]
    parts[3] |= ORDINAL_TEENS
    folded = [{_fold(w): n for w, n in part.items()} for part in parts]
    thousand, hundred, ten, unit = ("|".join(x) for x in folded)
    teen = "|".join(_fold(w) for w in ORDINAL_TEENS)
    stop = r"(?:\s+|(?=[.,;:|()\-])|$)"
    small = rf"(?:({ten}){stop}(?:((?!{teen})(?:{unit})){stop})?|({unit}){stop})"
    pattern = rf"(?U)^(?=(?:{thousand}|{hundred}|{ten}|{unit})(?:[\s.,;:|()\-]|$))(?:({thousand}){stop})?(?:({hundred}){stop})?{small}?"
    values = [F.create_map(*[F.lit(x) for pair in of.items() for x in pair]) for of in (*folded, folded[3])]

    def total(text: Column) -> Column:
        return sum((F.coalesce(F.try_element_at(v, F.regexp_extract(text, pattern, k)), F.lit(0)) for k, v in enumerate(values, 1)), F.lit(0))

    return once(once(fold_lower(content), total), lambda n: F.nullif(n, F.lit(0)))


def heading_number(content: Column) -> Column:
    """STRUCT(number, type) of what follows the word "article" in a heading: digits, or else ordinal words; null if neither."""
    digits = F.regexp_extract(content, r"^(\d{1,9})(?:\s|$|[.,\-'|])", 1)
    word = ordinal_number(content)
    return F.when(digits != "", F.struct(digits.cast("int").alias("number"), F.lit("arabic").alias("type"))).otherwise(
        once(word, lambda n: F.when(n.isNotNull(), F.struct(n.alias("number"), F.lit("greek_word").alias("type"))))
    )


def _fold(word: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


def article_heading(line: Column) -> Column:
    """STRUCT(number, type) of a line that is an article's heading; null elsewhere.

    A line may have a markdown or table mark before the word "article"; what
    follows the word is read up to a bar, a stop or a dash.
    """
    body = F.when(line.startswith("##"), F.ltrim(F.substr(line, F.lit(3)))).when(line.startswith("|"), F.ltrim(F.substr(line, F.lit(2)))).otherwise(line)

    def read(text: Column) -> Column:
        word = F.regexp_extract(text, r"^(\p{L}+)\s", 1)
        rest = F.regexp_replace(F.substr(text, F.length(word) + 1), r"(?U)^\s+", "")
        content = F.substring_index(F.translate(rest, ".-–—", "||||"), "|", 1)
        return F.when(F.lower(word) == "άρθρο", once(F.regexp_replace(content, r"(?U)\s+$", ""), heading_number))

    return once(body, read)
