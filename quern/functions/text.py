"""Strings: blanks, trimming, accents, look-alikes, quotes, words and titles."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space of Java and Python alike, as a pattern and by its characters.
SPACE = r"(?U)\s"
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def is_blank(col: Column) -> Column:
    """Null or empty: "needs work" everywhere in this library."""
    return col.isNull() | (col == "")


def once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` a value that is computed once, however often ``of`` names it."""
    return F.element_at(F.transform(F.array(value), of), 1)


def trim(col: Column) -> Column:
    """Without Unicode white space at both ends (Spark's own trim knows the space only)."""
    return F.btrim(col, F.lit(SPACES))


def collapse(col: Column) -> Column:
    return trim(F.regexp_replace(col, r"(?U)\s+", " "))


def _folds() -> tuple[str, str]:
    """Accented letters of the Latin and Greek blocks and their base letters, from Unicode's own decompositions."""
    plain, base = [], []
    for code in (*range(0xC0, 0x250), *range(0x370, 0x400), *range(0x1E00, 0x2000)):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and all(unicodedata.combining(c) for c in parts[1:]):
            plain.append(chr(code))
            base.append(parts[0])
    return "".join(plain), "".join(base)


ACCENTED, UNACCENTED = _folds()


def strip_accents(col: Column) -> Column:
    """Without diacritics, precomposed or combining."""
    return F.regexp_replace(F.translate(col, ACCENTED, UNACCENTED), r"\p{Mn}", "")


def fold_upper(col: Column) -> Column:
    """Without accents, in capitals; null becomes empty."""
    return F.upper(strip_accents(F.coalesce(col, F.lit(""))))


def fold_lower(col: Column) -> Column:
    return strip_accents(F.lower(col))


#: Latin capitals that look like Greek ones.
LOOK_ALIKE_LATIN, LOOK_ALIKE_GREEK = "ABEZHIKMNOPTYX", "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"


def greek_look_alikes(col: Column) -> Column:
    return F.translate(col, LOOK_ALIKE_LATIN, LOOK_ALIKE_GREEK)


def plain_apostrophes(col: Column) -> Column:
    return F.regexp_replace(col, "[’‘'΄΅]", "'")


def within_one_edit(a: Column, b: Column) -> Column:
    """At most one insertion, deletion or substitution of a character apart."""
    return F.levenshtein(a, b, 1) >= 0


def inside_quotes(text: Column, at: Column) -> Column:
    """Whether an odd number of double or of single quotes stands before the 0-based place ``at``."""
    head = F.substring(text, F.lit(1), at)
    odd = lambda q: (F.length(head) - F.length(F.replace(head, F.lit(q), F.lit("")))) % 2 == 1
    return odd('"') | odd("'")


def lines(col: Column) -> Column:
    """Lines as in a text file: a line end at the very end starts no line, a return before a line end is dropped, empty text has no lines."""
    parts = F.split(col, "\n")
    parts = F.when(col.contains("\r"), F.transform(parts, lambda x: F.regexp_replace(x, "\r$", ""))).otherwise(parts)
    n = F.size(parts) - F.when(col.endswith("\n") | (col == ""), 1).otherwise(0)
    return F.slice(parts, F.lit(1), n)


def n_nonblank_lines(col: Column) -> Column:
    return F.size(F.filter(lines(col), lambda x: x.rlike(r"(?U)\S")))


def words(col: Column) -> Column:
    return F.filter(F.split(col, r"(?U)\s+"), lambda x: x != "")


def n_words(col: Column) -> Column:
    # without blanks at its ends, a text splits into its words alone
    return once(trim(col), lambda x: F.when(x == "", 0).otherwise(F.size(F.split(x, r"(?U)\s+"))))


def quoted_segments(col: Column, least: int = 5) -> Column:
    """Contents of « » of ``least`` characters or more, over line ends too."""
    return F.regexp_extract_all(col, F.lit(f"(?s)«([^»]{{{least},}})»"), F.lit(1))


def first_nonblank_lines(col: Column, n: int = 2) -> Column:
    # lines beyond the last that counts aren't looked at
    head = F.regexp_extract(col, rf"(?U)^(?:\s*\S[^\n]*){{0,{n}}}", 0)
    return F.array_join(F.filter(F.transform(F.split(head, "\n"), trim), lambda x: x != ""), "\n")


#: What no whole word has next to it.
_INSIDE = r"[^\s«»“”\"'\-.,;:!?()\[\]{}]"


def has_word(col: Column, folded: str) -> Column:
    """Whether a text has the whole word, given in lower case without accents."""
    # both forms of a final sigma, which engines lower differently
    forms = folded if not folded.endswith("ς") else folded[:-1] + "[σς]"
    return fold_lower(col).rlike(f"(?U)(?<!{_INSIDE}){forms}(?!{_INSIDE})")


def is_purpose(title: Column, content: Column) -> Column:
    """Whether an article states its purpose in its title or in its first two lines."""
    return has_word(F.concat(title, F.lit("\n"), first_nonblank_lines(content)), "σκοπος")


def is_object(title: Column, content: Column) -> Column:
    return has_word(F.concat(title, F.lit("\n"), first_nonblank_lines(content)), "αντικειμενο")


def is_complete(col: Column, endings: str = ".?!…") -> Column:
    """Whether a text ends like a sentence."""
    return trim(col).rlike(f"[{endings}]$")


def preview(col: Column, n: int = 100) -> Column:
    return F.when(col.isNull(), "NULL").when(col == "", "EMPTY").otherwise(F.substring(col, 1, n))


def safe_filename(col: Column) -> Column:
    """A file name: what is not a word character, dash or dot becomes an underscore, runs of them one."""
    return F.regexp_replace(F.regexp_replace(col, r"(?U)[^\w\-.]", "_"), "_+", "_")


#: Rules in order: (category, words that must be there, words that must not).
CATEGORIES = (
    ("law_draft", ("ΣΧΕΔΙΟ", "ΝΟΜΟΥ"), ()),
    ("analysis", ("ΑΝΑΛΥΣΗ", "ΣΥΝΕΠΕΙΩΝ"), ()),
    ("deliberation_report", ("ΕΚΘΕΣΗ", "ΔΙΑΒΟΥΛΕΥΣΗ"), ()),
    ("other_draft", ("ΣΧΕΔΙΟ",), ("ΝΟΜΟΥ",)),
    ("other_report", ("ΕΚΘΕΣΗ",), ("ΔΙΑΒΟΥΛΕΥΣΗ",)),
)


def categorize(title: Column, rules=CATEGORIES, default: str = "other") -> Column:
    """The category of the first rule that a title fulfils."""
    folded, out = fold_upper(title), None
    for name, needed, barred in rules:
        holds = F.lit(True)
        for w in needed:
            holds &= folded.contains(w)
        for w in barred:
            holds &= ~folded.contains(w)
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return out.otherwise(default)
