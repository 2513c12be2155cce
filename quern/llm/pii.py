"""Personal data by anchor expansion.

An Aho-Corasick automaton reads each text once and stops at anchors: at-signs,
digits, plus signs, schemes and cue words (in any case). A local parser for the anchor's kind
expands to both sides and validates; nothing else of the text is looked at.

Kinds email, ip, card and phone follow fixed patterns (see SPEC): the leftmost
matches that do not overlap, those that fail their check dropped without a
second try. Kinds url, iban and account are added by their own parsers.

An anchor that fails costs no more than the text around it: what was learned of
a stretch (its end, that it has no digit, that no host ends in it) is kept for
the anchors that follow in it.

Defined cases: a null text is empty and has no spans. Offsets count code
points, ends are exclusive. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account")
#: The whole patterns, for reference and tests; the parsers start from anchors instead.
SPEC = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP, _CARD, _PHONE = re.compile(SPEC["ip"]), re.compile(SPEC["card"]), re.compile(SPEC["phone"])
_DIGITS = re.compile(r"[0-9]+")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_URL_REST = re.compile(r"[^\s<>\"'`{}|\\^]+")
_MARK = re.compile(r"[@/?#]")
_LABELS = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_HOST = re.compile(r"(?:[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|localhost|\[[0-9a-fA-F:.]+\])(?::[0-9]{1,5})?(?=[/?#]|$)")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LINK = r"(?:\x20?(?:no\.?|nr\.?|number|code|#))?\x20?[:=#]?\x20?[\"']?"
_ACCOUNT = re.compile(_LINK + r"([0-9](?:[\x20-]?[0-9]){5,33})(?![0-9A-Za-z])")
_SECRET = re.compile(_LINK + r"([A-Za-z0-9_+/=.-]{16,})")
#: A stretch of a secret's characters that goes on for so long is the secret, whatever the link before it takes of it.
_LINK_AND_LEAST = 24
#: Cue words by the parser that reads what follows them.
CUES = {"iban": ("iban",), "account": ("account", "acct", "konto", "compte", "cuenta", "passport", "ssn", "tax id"), "secret": ("token", "secret", "password", "passwd", "api_key", "apikey", "api key")}


def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for word, value in (("@", ("email", 1)), ("+", ("phone", 1)), ("://", ("url", 3)), ("www.", ("www", 4)), *((d, ("digit", 1)) for d in "0123456789")):
        out.add_word(word, value)
    for kind, words in CUES.items():
        for word in words:
            out.add_word(word, (kind, len(word)))
    out.make_automaton()
    return out


def _lower(text: str) -> str:
    """Lower case, character by character: İ is the only one that would become two."""
    return text.replace("İ", "i").lower()


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _iban_valid(text: str) -> bool:
    text = text.replace(" ", "")
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


class _Addresses:
    """Ends of the addresses of one text, by where their hosts would begin; asked for in rising order."""

    def __init__(self, text: str):
        self.text = text
        self.run = (0, 0)  # a stretch of an address's characters
        self.end = 0  # of it, without closing punctuation
        self.mark = (-1, -1)  # no mark of authority's end from the first to the second place
        self.dead = (0, 0)  # labels after which no host ends

    def end_of(self, host: int) -> int | None:
        """Where the address ends whose host, or user, begins here; null if there is none."""
        if not self.run[0] <= host < self.run[1]:
            m = _URL_REST.match(self.text, host)
            if not m:
                return None
            self.run, self.end = m.span(), m.start() + len(m[0].rstrip(".,;:!?)]"))
        end = max(host, self.end)
        if not self.mark[0] <= host <= self.mark[1]:
            m = _MARK.search(self.text, host, self.run[1])
            self.mark = (host, m.start() if m else self.run[1])
        at = self.mark[1]
        at = at + 1 if at < end and self.text[at] == "@" else host
        if self.dead[0] <= at < self.dead[1]:
            return None
        if _HOST.match(self.text, at, end):
            return end
        m = _LABELS.match(self.text, at, end)
        self.dead = m.span() if m else self.dead
        return None


def find(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, by kind as listed, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)  # where each kind's search goes on
    addresses = _Addresses(text)
    barren = (0, 0)  # a stretch of a secret's characters without a digit
    for last, (kind, size) in automaton.iter(_lower(text)):
        at = last - size + 1
        if kind == "digit":
            if at >= done["ip"]:
                if m := _IP.match(text, at):
                    done["ip"] = m.end()
                    if all(len(x) <= 3 and int(x or 0) <= 255 for x in (y.lstrip("0") for y in m[0].split("."))):
                        found["ip"].append(m.span())
                else:
                    done["ip"] = _DIGITS.match(text, at).end()
            if at >= done["card"]:
                if m := _CARD.match(text, at):
                    done["card"] = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(m.span())
                else:
                    done["card"] = at + 1
        elif kind == "email":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                done["email"] = m.end()
                found["email"].append((start, m.end()))
        elif kind == "phone":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found["phone"].append(m.span())
        elif kind in ("url", "www"):
            start, host = at, at
            if kind == "url":
                host = at + 3
                while start > done["url"] and text[start - 1] in _SCHEME:
                    start -= 1
                while start < at and not text[start].isalpha():
                    start += 1
            if at < done["url"] or (kind == "url" and start == at):
                continue
            end = addresses.end_of(host)
            if end is not None:
                done["url"] = end
                found["url"].append((start, end))
        else:
            if text[at - 1 : at].isalnum() or at < done["account"]:
                continue
            after = last + 1
            if kind == "iban":
                m = re.compile(_LINK).match(text, after)
                m = _IBAN.match(text, m.end())
                if m and _iban_valid(m[0]):
                    done["account"] = m.end()
                    found["iban"].append(m.span())
            elif kind == "account" or not barren[0] <= after <= barren[1] - _LINK_AND_LEAST:
                m = (_ACCOUNT if kind == "account" else _SECRET).match(text, after)
                if m and (kind == "account" or any(c.isdigit() for c in m[1])):
                    done["account"] = m.end()
                    found["account"].append(m.span(1))
                elif m:
                    barren = m.span(1)
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, the count of each base kind, base_sha256 and spans (as "kind:start:end,...")."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            all_spans = [find(t, automaton) for t in batch.column("text").to_pylist()]
            base = [[x for x in spans if x[0] in BASE_KINDS] for spans in all_spans]
            counts = [pa.array([sum(x[0] == k for x in spans) for spans in base], pa.int64()) for k in BASE_KINDS]
            digests = pa.array([hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *counts, digests, pa.array(map(joined, all_spans), pa.string())], ["id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {', '.join(f'n_{k} long' for k in BASE_KINDS)}, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by <KIND>; of overlapping spans the first one, and the longest of those, counts."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
            at = b
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data of the text column replaced; null stays null."""
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            texts = [t if t is None else redact(t, find(t, automaton)) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text_col else batch.column(n) for n in names], names)

    return docs.mapInArrow(run, schema)
