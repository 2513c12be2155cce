"""Forms of JSON answers as automata: which characters may come next, and whether an answer is one of the form.

A form is an object with its fields in order, each a text of limited length, one
of several values, or a list of names. A generator that only goes on with
allowed characters can't give anything else. Blanks may stand after a colon and
a comma, at most one of them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .json import CHANGE_TYPES, PROVISION_TYPES

#: Stands for any character that may be in a text as it is.
ANY = "any"
NAME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_ESCAPES, _HEX = frozenset('"\\/bfnrt'), frozenset("0123456789abcdefABCDEF")


@dataclass(frozen=True)
class Field:
    name: str
    #: One of these values, if there are any.
    values: tuple[str, ...] = ()
    #: A text of at most so many characters; 0: as many as you like.
    longest: int = 0
    #: A list of at least one and at most so many names (parts of letters and digits, joined by _); 0: no list.
    names: int = 0


# The forms of answers.
MODIFICATION = (Field("law_reference"), Field("article_number"), Field("change_type", CHANGE_TYPES), Field("major_change_summary", longest=550), Field("key_themes", names=3))
PROVISION = (Field("article_title"), Field("provision_type", PROVISION_TYPES), Field("core_provision_summary", longest=550), Field("key_themes", names=3))
CHAPTER, PART, POLISHED = (Field("summary", longest=2000),), (Field("summary", longest=3000),), (Field("polished_text", longest=2800),)
FORMS = {"MODIFICATION": MODIFICATION, "PROVISION": PROVISION, "CHAPTER": CHAPTER, "PART": PART, "POLISHED": POLISHED}

#: (field, place, count, rest): rest is what is left of a fixed string, or nothing.
State = tuple[int, str, int, tuple[str, ...]]


class Automaton:
    """Steps through an answer of a form character by character; a state is a small tuple."""

    def __init__(self, form: tuple[Field, ...]):
        self.form = form
        # what may follow each state met so far; a form has a few thousand states at most
        self._known: dict[State, dict[str, State]] = {}
        self.start: State = self._fixed(0, "key", 0, ('{"' + form[0].name + '":',))

    @staticmethod
    def _fixed(field: int, place: str, count: int, rest: tuple[str, ...]) -> State:
        return field, place, count, rest

    def _open(self, field: int) -> dict[str, State]:
        """The characters that a field's value may begin with."""
        f = self.form[field]
        if f.values:
            return {'"': (field, "value", 0, tuple(json.dumps(v, ensure_ascii=False)[1:] for v in f.values))}
        return {"[": (field, "list", 0, ())} if f.names else {'"': (field, "text", 0, ())}

    def _closed(self, field: int) -> dict[str, State]:
        """What may follow a field's value."""
        if field + 1 == len(self.form):
            return {"}": (field, "end", 0, ())}
        return {",": (field + 1, "comma", 0, ())}

    def next(self, state: State) -> dict[str, State]:
        """The state after each allowed character; ANY stands for the plain ones of a text."""
        field, place, count, rest = state
        f = self.form[field]
        if place in ("key", "value"):
            out: dict[str, State] = {}
            for c in {r[0] for r in rest}:
                left = tuple(r[1:] for r in rest if r[0] == c)
                out[c] = (field, place, 0, left) if all(left) else (field, "colon" if place == "key" else "closed", 0, ())
            return out
        if place == "comma":
            key = (field, "key", 0, ('"' + f.name + '":',))
            return {" ": key} | self.next(key)
        if place == "colon":
            return {" ": (field, "blank", 0, ())} | self._open(field)
        if place == "blank":
            return self._open(field)
        if place == "closed":
            return self._closed(field)
        if place == "text":
            out = {'"': (field, "closed", 0, ())}
            if not f.longest or count < f.longest:
                out |= {ANY: (field, "text", count + bool(f.longest), ()), "\\": (field, "escape", count, ())}
            return out
        if place == "escape":
            more = (field, "text", count + bool(f.longest), ())
            return dict.fromkeys(_ESCAPES, more) | {"u": (field, "hex4", count, ())}
        if place.startswith("hex"):
            left = int(place[3:]) - 1
            return dict.fromkeys(_HEX, (field, f"hex{left}", count, ()) if left else (field, "text", count + bool(f.longest), ()))
        if place in ("list", "more"):  # more: after a comma, with or without its blank
            blank = {" ": (field, "item", count, ())} if place == "more" else {}
            return {'"': (field, "first", count, ())} | blank
        if place == "item":
            return {'"': (field, "first", count, ())}
        if place == "first":  # of a part of a name
            return dict.fromkeys(NAME, (field, "name", count, ()))
        if place == "name":
            return dict.fromkeys(NAME, state) | {"_": (field, "first", count, ()), '"': (field, "named", count + 1, ())}
        if place == "named":
            return {"]": (field, "closed", 0, ())} | ({",": (field, "more", count, ())} if count < f.names else {})
        return {}

    def step(self, state: State, c: str) -> State | None:
        found = self._known.get(state)
        if found is None:
            found = self._known[state] = self.next(state)
        if c in found:
            return found[c]
        return found.get(ANY) if c >= " " and c not in '"\\' else None

    def reach(self, text: str, state: State | None = None) -> tuple[int, State]:
        """How many characters of a text the form allows, and the state after them."""
        state = state or self.start
        for k, c in enumerate(text):
            after = self.step(state, c)
            if after is None:
                return k, state
            state = after
        return len(text), state

    def complete(self, state: State) -> bool:
        return state[1] == "end"

    def shortest(self, state: State) -> str:
        """The characters that complete an answer soonest."""
        out = ""
        while not self.complete(state):
            found = self.next(state)
            place = state[1]
            c = '"' if place in ("text", "name", "item", "list", "more", "blank", "colon") and '"' in found else "]" if "]" in found else "n" if place == "escape" else "0" if place.startswith("hex") else min(x for x in found if x not in (" ", ANY))
            out, state = out + c, found[c]
        return out


@lru_cache(64)
def automaton(form: tuple[Field, ...]) -> Automaton:
    return Automaton(form)


def constrained(propose: Callable[[str], Iterable[str]], form: tuple[Field, ...], most: int = 4000) -> str:
    """An answer of the form: of what is proposed to go on with, best first, the first piece of which all characters are allowed.

    Where nothing fits, and after ``most`` characters, it is completed the shortest way.
    """
    machine, text = automaton(form), ""
    state = machine.start
    while not machine.complete(state) and len(text) < most:
        for piece in propose(text):
            n, after = machine.reach(piece, state)
            if piece and n == len(piece):
                text, state = text + piece, after
                break
        else:
            break
    return text if machine.complete(state) else text + machine.shortest(state)


def form_reach(answer: Column, form: tuple[Field, ...]) -> Column:
    """STRUCT(reach, complete): how many characters of an answer its form allows, and whether it is whole; null counts as empty."""

    def run(answers: pd.Series) -> pd.DataFrame:
        machine, out = automaton(form), []
        for text in answers:
            n, state = machine.reach(text or "")
            out.append((n, n == len(text or "") and machine.complete(state)))
        return pd.DataFrame(out, columns=["reach", "complete"]).astype({"reach": "int32", "complete": "bool"})

    return F.pandas_udf(run, "reach int, complete boolean")(answer)
