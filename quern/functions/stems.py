"""Stems and lemmas: a word's longest known ending is rewritten, by rules that are data.

A rule table maps endings to what takes their place. An ending counts only if
``least`` characters are left before it; of several that fit the longest one
does. Words that are known as a whole (irregular forms) come first. All of it
is one regular expression and a look-up, so it stays in the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once, strip_accents

#: Endings by language. Stems only have to agree among forms of a word; they needn't be words.
ENDINGS: dict[str, dict[str, str]] = {
    "en": dict.fromkeys("s es ed ing ings ly er ers est ness nesses ment ments able ible ful fully less ation ations ion ions ive ively al ally".split(), "") | {"ies": "y", "ied": "y", "ier": "y", "iest": "y", "iness": "y", "ily": "y"},
    "fr": dict.fromkeys("e s es é ée és ées er ez ant ante ants antes ent ait aient ais ions iez ement ements ité ités tion tions eur eurs euse euses ique iques if ive ifs ives".split(), "") | {"aux": "al", "eaux": "eau"},
    "de": dict.fromkeys("e en em er es n s st est t te ten tet ung ungen heit heiten keit keiten lich liche lichen licher isch ische ischen ig ige igen".split(), ""),
    "es": dict.fromkeys("s es o a os as e ar er ir ando iendo ado ada ados adas ido ida idos idas ción ciones mente dad dades able ables ible ibles amos emos imos".split(), ""),
    "el": dict.fromkeys("α ας ες ι ο ος ου ον οι ων ους η ης ην ηση ησης εις εων ις υς ω εις ει ουμε ετε ουν ουνε αν ατα ατος ατων μα ματα ματος ματων ικος ικη ικο ικου ικων ικες".split(), ""),
}
#: Forms that no ending explains.
IRREGULAR: dict[str, dict[str, str]] = {
    "en": {"is": "be", "are": "be", "was": "be", "were": "be", "been": "be", "has": "have", "had": "have", "does": "do", "did": "do", "men": "man", "women": "woman", "children": "child", "feet": "foot", "better": "good", "best": "good", "this": "this", "his": "his"},
    "fr": {"est": "être", "sont": "être", "était": "être", "a": "avoir", "ont": "avoir", "yeux": "œil"},
    "de": {"ist": "sein", "sind": "sein", "war": "sein", "waren": "sein", "hat": "haben", "haben": "haben"},
    "es": {"es": "ser", "son": "ser", "era": "ser", "fue": "ser", "ha": "haber", "han": "haber"},
    "el": {"ειναι": "ειμαι", "ηταν": "ειμαι", "εχει": "εχω", "εχουν": "εχω"},
}


def ending_pattern(endings: dict[str, str], least: int) -> str:
    """Groups: what is left, as short as it may be, and the ending, which is the longest then."""
    return rf"^(.{{{least},}}?)({'|'.join(sorted(map(re.escape, endings), key=lambda e: (-len(e), e)))})$"


def stem(word: Column, endings: dict[str, str], irregular: dict[str, str] | None = None, least: int = 3) -> Column:
    """The word with its longest ending rewritten, or its irregular form's entry; a word without known ending stays."""
    table = lambda pairs: F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    pattern = ending_pattern(endings, least)
    rewritten = once(F.regexp_extract(word, pattern, 2), lambda e: F.when(e == "", word).otherwise(F.concat(F.substr(word, F.lit(1), F.length(word) - F.length(e)), F.try_element_at(table(endings), e))))
    return F.coalesce(F.try_element_at(table(irregular), word), rewritten) if irregular else rewritten


def stems(words: Column, language: str, least: int = 3) -> Column:
    """The stems of an array of words in lower case; Greek words lose their accents first. A language without rules here leaves words as they are."""
    if language not in ENDINGS:
        return words
    bare = F.transform(words, strip_accents) if language == "el" else words
    return F.transform(bare, lambda w: stem(w, ENDINGS[language], IRREGULAR[language], least))


def stems_by(words: Column, language: Column, least: int = 3) -> Column:
    """The stems of words of the language that a column names."""
    out = None
    for name in ENDINGS:
        out = (F if out is None else out).when(language == name, stems(words, name, least))
    return out.otherwise(words)
