"""Texts of PDF files by an extractor of the caller's, fetching up to a size, and what becomes of documents by it.

``simple_text`` is an extractor for plain files: it reads the text that content
streams show, uncompressed or deflated, in fonts whose codes are characters.
Scans and embedded encodings need a real one, which is passed in the same way.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.convert import pdf_filename
from quern.operators.states import advance

Extractor = Callable[[bytes], str]

_STREAM = re.compile(rb"<<((?:(?!stream|endobj).)*?)>>\s*stream\r?\n(.*?)\r?\n?endstream", re.S)
_BLOCK = re.compile(rb"\bBT\b(.*?)\bET\b", re.S)
#: A string or hexadecimal string, an operator, or a number.
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>|[A-Za-z'\"*]+|[-+]?\d*\.?\d+|\[|\]", re.S)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r?\n|.)", re.S)
_PLAIN = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: A gap in an array of strings that is as wide as a space.
GAP = -200


def _string(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:

        def plain(m: re.Match[bytes]) -> bytes:
            c = m[1]
            if c[:1] in b"01234567":
                return bytes([int(c, 8) & 255])
            return b"" if c[-1:] == b"\n" else _PLAIN.get(c, c)

        raw = _ESCAPE.sub(plain, token[1:-1])
    if raw[:2] == b"\xfe\xff":
        return raw[2:].decode("utf-16-be", "replace")
    return raw.decode("cp1252", "replace")


def _shown(block: bytes) -> str:
    """The text of a block: shown strings, with line ends where the position moves to another line."""
    out: list[str] = []
    held: list[str] = []
    numbers: list[float] = []
    for token in _TOKEN.findall(block):
        first = token[:1]
        if first in b"(<":
            held.append(_string(token))
            numbers = []
        elif first in b"[]":
            continue
        elif first in b"+-.0123456789":
            numbers.append(float(token))
            if held and numbers[-1] <= GAP:
                held.append(" ")
        else:
            if token in (b"T*", b"'", b'"') or (token in (b"Td", b"TD") and len(numbers) > 1 and numbers[-1] != 0):
                out.append("\n")
            if token in (b"Tj", b"TJ", b"'", b'"'):
                out += held
            held, numbers = [], []
    return "".join(out).strip()


def simple_text(content: bytes) -> str:
    """The shown text of a file, an empty line between blocks; an error if it isn't a PDF file."""
    if not content.lstrip()[:5] == b"%PDF-":
        raise ValueError("not a PDF file")
    found = []
    for head, body in _STREAM.findall(content):
        if b"/FlateDecode" in head:
            try:
                body = zlib.decompressobj().decompress(body)
            except zlib.error:
                continue
        elif b"/Filter" in head:
            continue
        found += [text for text in map(_shown, _BLOCK.findall(body)) if text]
    return "\n\n".join(found)


def simple_factory() -> Extractor:
    return simple_text


def extracted(files: DataFrame, key: str, content: str, factory: Callable[[], Extractor] = simple_factory) -> DataFrame:
    """(key, text, error) of each file; what fails keeps its error and has no text. The extractor is made once per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extract = factory()
        for batch in batches:
            rows = []
            for k, body in zip(batch["k"], batch["body"], strict=True):
                try:
                    rows.append((k, extract(bytes(body or b"")), None))
                except Exception as e:  # noqa: BLE001  any failure of the caller's extractor is a result here
                    rows.append((k, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["k", "text", "error"])

    kind = files.schema[key].dataType.simpleString()
    rows = files.select(F.col(key).alias("k"), F.col(content).alias("body"))
    return rows.mapInPandas(run, f"k {kind}, text string, error string").withColumnRenamed("k", key)


def fetched(rows: DataFrame, url: str, factory: Callable[[], Callable[[str], tuple[int | None, Iterator[bytes]]]], most: int = 50 << 20, tries: int = 3) -> DataFrame:
    """(url, content, error): the bodies of distinct addresses, each of at most ``most`` bytes.

    The caller's function gives a body's announced length, if there is one, and
    its pieces; what is announced to be too long isn't read, and reading ends
    where the limit is passed.
    """

    def body(fetch: Callable[[str], tuple[int | None, Iterator[bytes]]], address: str) -> bytes:
        announced, pieces = fetch(address)
        if announced is not None and announced > most:
            raise OverflowError(f"{announced} bytes are announced, {most} are allowed")
        out = bytearray()
        for piece in pieces:
            out += piece
            if len(out) > most:
                raise OverflowError(f"more than {most} bytes")
        return bytes(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = factory()
        for batch in batches:
            for address in batch["u"]:
                content = error = None
                for _ in range(tries):
                    try:
                        content, error = body(fetch, address), None
                        break
                    except OverflowError as e:
                        error = f"{type(e).__name__}: {e}"
                        break  # it won't be shorter
                    except Exception as e:  # noqa: BLE001  any failure of the caller's function is a result here
                        error = f"{type(e).__name__}: {e}"
                yield pd.DataFrame([(address, content, error)], columns=["u", "content", "error"])  # a body at a time

    distinct = rows.where(F.col(url).isNotNull()).select(F.col(url).alias("u")).distinct()
    return distinct.mapInPandas(run, "u string, content binary, error string").withColumnRenamed("u", url)


def process_documents(docs: DataFrame, files: DataFrame, factory: Callable[[], Extractor] = simple_factory, most_tries: int = 3) -> DataFrame:
    """Documents (id, url, status, processed_text, tries) after their files (name, content) were read; a file is named by its address (``pdf_filename``)."""
    named = docs.where(F.col("url").isNotNull()).select("id", pdf_filename(F.col("url")).alias("name"))
    texts = extracted(files, "name", "content", factory)
    outcomes = named.join(texts, "name").select("id", F.coalesce("text", F.lit("")).alias("text"))
    return advance(docs, outcomes, most_tries=most_tries)
