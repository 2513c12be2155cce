"""Benchmark decontamination.

The n-grams of the benchmark's words (13 of them, or all words of a shorter
item) form a hash set. Documents are scanned once: the windows of all lengths
in question are hashed together, hits are verified word by word, and the hit
words are counted or cut out.

The set is built from blocks of at most BLOCK_TEXT bytes of benchmark text and
broadcast block by block: a benchmark of any size is scanned in as many passes,
each of which adds to the hits found so far. The driver holds one block's index
at a time: its words, and 20 bytes for each window.

Rows of the benchmark that repeat id and text are one; a block is a range of
hashes of the others, cut where the limit is reached, so only an item that is
longer by itself exceeds it.

Defined cases: a null text has no words; an item without words has no window;
an item occurs as soon as one of its windows does; repeated item ids count
once. A null item id is an item of its own, written as null. An empty table of
either kind is allowed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash60, text_of, whole_row, written
from .kernels import ALNUM, LOWER, U, blocks, column_bytes, hash_ranges, padded, split_words

WINDOW = 13
BLOCK_TEXT = 16 << 20
_STEP = U(0xD6E8FEB86659FD93)


def _windows(hashes: np.ndarray, lengths: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of all windows of each length, shortest first (a longer one extends the shorter)."""
    acc = hashes.copy()
    for n in range(1, max(lengths, default=0) + 1):
        if n > 1:
            acc = acc[:-1] * _STEP + hashes[n - 1 :] if len(acc) > 1 else acc[:0]
        if n in lengths:
            yield n, acc


@dataclass
class Index:
    """Windows of a block of the benchmark: by length, ascending hashes with the place of their words in ``words`` and their item."""

    ids: list[str]
    words: bytes  # of all items, in lower case, with a space after each
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # hash, begin, end, item


def _index(items: Iterable[tuple[str, str]], window: int) -> Index:
    """The index takes 20 bytes for a window, besides the words themselves."""
    ids, words, size = [], [], 0
    parts: dict[int, list[tuple[np.ndarray, ...]]] = {}
    for item, text in items:
        raw = np.frombuffer(text.encode(), np.uint8)
        low = padded(LOWER[raw])
        starts, ends, _ = split_words(raw, np.array([0, len(raw)]), ALNUM)
        if not len(starts):
            continue
        n = min(window, len(starts))
        memory = low.tobytes()
        words.append(b"".join(memory[a:b] + b" " for a, b in zip(starts.tolist(), ends.tolist(), strict=True)))
        end = size + np.cumsum(ends - starts + 1) - 1
        begin = end - (ends - starts)
        (_, hashes), *_ = _windows(hash_ranges(low, starts, ends), {n})
        parts.setdefault(n, []).append((hashes, begin[: len(hashes)].astype(np.int32), end[n - 1 :].astype(np.int32), np.full(len(hashes), len(ids), np.int32)))
        ids.append(item)
        size += len(words[-1])
    windows = {}
    for n, of in parts.items():
        columns = [np.concatenate(x) for x in zip(*of, strict=True)]
        order = np.argsort(columns[0], kind="stable")
        windows[n] = tuple(x[order] for x in columns)
    return Index(ids, b"".join(words), windows)


class Scanner:
    """Finds the windows of one block of the benchmark in batches of texts."""

    def __init__(self, index: Index):
        self.index, self.filters = index, {}
        for n, (keys, *_) in index.windows.items():
            bits = max(16, min(26, int(np.log2(len(keys) + 1)) + 6))
            there = np.zeros(1 << bits, bool)
            there[(keys >> U(64 - bits)).astype(np.int64)] = True
            self.filters[n] = (U(64 - bits), there)

    def scan(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list, list[dict]]:
        """For each text: its number of words, the hit ranges as (first word, end word, start byte, end byte), the item ids."""
        starts, ends, first = split_words(buf, offsets, ALNUM)
        n_docs = len(offsets) - 1
        ranges: list[list] = [[] for _ in range(n_docs)]
        items: list[set] = [set() for _ in range(n_docs)]
        low = padded(LOWER[buf])
        memory = None
        marks: list[tuple[int, int]] = []
        last = np.repeat(first[1:], np.diff(first))
        for n, hashes in _windows(hash_ranges(low, starts, ends), set(self.index.windows)):
            shift, there = self.filters[n]
            found = np.flatnonzero(there[(hashes >> shift).astype(np.int64)] & (np.arange(n, n + len(hashes)) <= last[: len(hashes)]))
            keys, begin, end, item = self.index.windows[n]
            left, right = np.searchsorted(keys, hashes[found], "left"), np.searchsorted(keys, hashes[found], "right")
            for j, a, b in zip(found[left < right].tolist(), left[left < right].tolist(), right[left < right].tolist(), strict=True):
                memory = memory or low.tobytes()
                words = b" ".join(memory[x:y] for x, y in zip(starts[j : j + n].tolist(), ends[j : j + n].tolist(), strict=True))
                same = {int(item[k]) for k in range(a, b) if self.index.words[begin[k] : end[k]] == words}
                if same:
                    doc = int(np.searchsorted(first, j, "right")) - 1
                    items[doc].update(self.index.ids[k] for k in same)
                    marks.append((j, j + n))
        for a, b in merged(marks):
            doc = int(np.searchsorted(first, a, "right")) - 1
            # runs of neighbouring documents are told apart by the first word of the next one
            while a < b:
                end = min(b, int(first[doc + 1]))
                if end > a:
                    ranges[doc].append((int(a - first[doc]), int(end - first[doc]), int(starts[a] - offsets[doc]), int(ends[end - 1] - offsets[doc])))
                a, doc = max(a, end), doc + 1
        return np.diff(first), ranges, items


def merged(ranges: list[tuple[int, ...]]) -> list[tuple[int, int]]:
    """The union of ranges, in order; ranges that touch become one."""
    out: list[list[int]] = []
    for a, b in sorted((x[0], x[1]) for x in ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_STATE = "n_words long, hits array<struct<first:long,end:long,start_byte:long,end_byte:long>>, items array<string>"
_ARROW = [
    pa.field("n_words", pa.int64()),
    pa.field("hits", pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "end", "start_byte", "end_byte")]))),
    pa.field("items", pa.list_(pa.string())),
]


def _one_pass(rows: DataFrame, index: Index) -> DataFrame:
    """Columns id, text and the state (n_words, hits, items), to which one block's hits are added."""
    shared = rows.sparkSession.sparkContext.broadcast(index)
    kept = [x for x in rows.columns if x not in ("n_words", "hits", "items")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            counts, hits, items = [], [], []
            for a, b in blocks(offsets):
                part = offsets[a : b + 1]
                n, ranges, ids = scanner.scan(data[part[0] : part[-1]], part - part[0])
                counts.append(n)
                hits += ranges
                items += ids
            if "hits" in batch.schema.names:
                for k, (old, ids) in enumerate(zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                    hits[k] = _join([*hits[k], *((x["first"], x["end"], x["start_byte"], x["end_byte"]) for x in old)])
                    items[k] |= set(ids)
            state = [
                pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                pa.array([[dict(zip(("first", "end", "start_byte", "end_byte"), x, strict=True)) for x in of] for of in hits], _ARROW[1].type),
                pa.array([sorted(x) for x in items], _ARROW[2].type),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), *state], [*kept, "n_words", "hits", "items"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    return rows.mapInArrow(run, f"{kinds}, {_STATE}")


def _join(ranges: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The union of hit ranges, by word and by byte."""
    starts, ends = {x[0]: x[2] for x in ranges}, {x[1]: x[3] for x in ranges}
    return [(a, b, starts[a], ends[b]) for a, b in merged(ranges)]


#: A null item id while hits are collected.
_NULL = "\0"
#: Ranges of hashes that are summed at a time.
_FAN = 64


def _ranges(rows: DataFrame, block_text: int, lo: int = 0, hi: int = 1 << 60) -> Iterator[tuple[int, int]]:
    """Ranges of h of at most ``block_text`` bytes in all (columns h, size), or of one value of h."""
    step = -(-(hi - lo) // _FAN)
    sums = rows.where(F.col("h").between(lo, hi - 1)).groupBy(F.expr(f"(h - {lo}) div {step}").alias("part")).agg(F.sum("size").alias("size"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    begin, end, total = lo, lo, 0
    for x in sums.orderBy("part").collect():  # _FAN rows
        if total and total + x["size"] > block_text:
            yield begin, end
            begin, total = end, 0
        if x["size"] > block_text and x["lo"] < x["hi"]:
            yield from _ranges(rows, block_text, x["lo"], x["hi"] + 1)
            begin = end = x["hi"] + 1
            continue
        end, total = x["hi"] + 1, total + x["size"]
    if total:
        yield begin, end


def _blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str, block_text: int) -> Iterator[Index]:
    """The index of each block of the benchmark, one at a time; an empty one if there is none."""
    rows = benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit(_NULL)).alias("id"), text_of(benchmark, text_col).alias("text")).distinct()
    rows = rows.withColumn("h", hash60("id", "text")).withColumn("size", F.octet_length("text"))
    rows = written(rows.where("size > 0"), "benchmark")
    found = False
    for lo, hi in _ranges(rows.select("h", "size"), block_text):
        found = True
        yield _index(((r.id, r.text) for r in rows.where(F.col("h").between(lo, hi - 1)).toLocalIterator()), window)
    if not found:
        yield _index([], window)


def _named(found: DataFrame) -> DataFrame:
    """``found`` with the names of items as they are shown."""
    return found.withColumn("items", F.array_sort(F.transform("items", lambda x: F.when(x == _NULL, "null").otherwise(x))))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_text: int = BLOCK_TEXT, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, text, n_words, hits (ranges of hit words with their bytes) and items (ids, as sorted strings)."""
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    for k, index in enumerate(_blocks(benchmark, window, item_col, item_text, block_text)):
        rows = _one_pass(rows if not k else written(rows, f"hits{k}"), index)
    return _named(rows if keep_text else rows.drop("text"))


def measured(found: DataFrame) -> DataFrame:
    """``scan`` with n_hit, n_items, items_sha256 and contaminated (at least a word in 20 is hit)."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    out = found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
    out = out.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_text: int = BLOCK_TEXT) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with the hit spans cut out of the texts.

    Needs no shuffle. With several blocks, the hits of all passes count together.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    rows = docs.select(whole_row(docs).alias("row"), text_of(docs, text_col).alias("text"))
    for k, index in enumerate(_blocks(benchmark, window, item_col, item_text, block_text)):
        rows = _one_pass(rows if not k else written(rows, f"hits{k}"), index)
    rows = measured(rows)
    if remove == "documents":
        return rows.where(~F.col("contaminated")).select("row.*")
    raw = F.col("text").cast("binary")
    rest = F.aggregate(
        F.concat("hits", F.array(F.struct(F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("end"), F.octet_length("text").cast("long").alias("start_byte"), F.octet_length("text").cast("long").alias("end_byte")))),
        F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("out")),
        lambda s, x: F.struct(x["end_byte"].alias("at"), F.concat(s["out"], F.substring(raw, (s["at"] + 1).cast("int"), (x["start_byte"] - s["at"]).cast("int"))).alias("out")),
        lambda s: F.decode(s["out"], "UTF-8"),
    )
    cut = F.when(F.size("hits") > 0, rest).otherwise(F.col(f"row.`{text_col}`"))
    return rows.select("row.*", cut.alias("__cut")).select(*(F.col("__cut").alias(x) if x == text_col else F.col(f"`{x}`") for x in docs.columns))

