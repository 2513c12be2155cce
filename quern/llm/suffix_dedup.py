"""Removal of byte strings that repeat, by column-wise multi-document construction.

A string of MIN bytes that starts anywhere else too is removed wherever it
stands. Three steps find all of them, and nothing but them:

1. Anchors. Each start of a string of MIN bytes selects the GRAM-byte gram of
   least hash in it (the last of several). Equal strings select their gram at
   the same place, so comparing starts of one gram hash loses none. Starts in
   a row with one selected gram form a segment; segments of a gram that no
   other segment has are unique and go.
2. Equal segments of a gram are all repeats; one of each kind represents them.
3. What differs goes through the column-wise construction: the segments of a
   group are laid on top of each other at the gram, written as one file per
   batch with a column per record, and read back from the last column to the
   first. Each round puts one symbol in front of every segment, sorts the
   suffixes by symbol in their old order and carries the common prefixes of
   neighbours along; a suffix whose common prefix with a neighbour reaches MIN
   starts a repeated string. As the segments are aligned, only suffixes of the
   same round can share MIN bytes, so a round needs the order of its own
   suffixes and not that of all before (the whole collection's transform would
   be read once per round, which is the square of the length).

A gram with more than ``max_group`` different segments would be too much for
one task. A string of MIN bytes over the gram has at least half of its other
bytes after the gram or before it, so the group falls apart, without loss, into
groups of those that have the same bytes there; what is still large is halved
again. After LEVELS halvings a group has nearly a whole string in common, and
the few strings over that part are counted one by one by 128-bit digest.

Segments and strings are told apart by BLAKE2 digests of 128 bits, for which no
two different texts can be made to agree.

Defined cases: null and short texts have nothing removed; rows that repeat id
and text are documents of their own and repeats of each other, so all of their
text goes, and one of them stands for them when others are compared; overlapping
repeats count. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, salted_join, text_of, written
from .decontaminate import merged
from .kernels import U, _view, blocks, column_bytes, mix64, padded

MIN, GRAM = 400, 32
#: Contents of a group that are compared in one task, and how often a larger group is halved.
MAX_GROUP, LEVELS = 256, 3
BATCH = 8_192
#: No column.
NONE = -(1 << 62)
#: Longest stretch of starts that is looked at in one go; fits the bits left for places.
STRETCH = 1 << 19
_PLACE = 20


def select_anchors(buf: np.ndarray, starts: np.ndarray, min_bytes: int = MIN) -> tuple[np.ndarray, np.ndarray]:
    """For each start its selected gram's place, and the hashes of all grams of ``buf`` (less than 2^20 bytes)."""
    view = _view(padded(padded(padded(padded(buf)))), "<u8")
    n = len(buf)
    h = np.zeros(n, U)
    for lane in range(GRAM // 8):
        h = mix64((h ^ view[8 * lane : 8 * lane + n]) + U(0x9E3779B97F4A7C15))
    width = min_bytes - GRAM + 1
    last = U((1 << _PLACE) - 1)
    key = (h & ~last) | (last - np.arange(n, dtype=U))
    rows = -(-n // width) + 1
    square = np.full(rows * width, ~U(0), dtype=U)
    square[:n] = key
    square = square.reshape(rows, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[starts], ahead[starts + width - 1])
    return (last - (least & last)).astype(np.int64), h


def _digest(body: memoryview, seed: int) -> bytes:
    return hashlib.blake2b(body, digest_size=16, salt=seed.to_bytes(16, "little")).digest()


def segments_of(buf: np.ndarray, offsets: np.ndarray, min_bytes: int = MIN) -> dict[str, np.ndarray]:
    """The segments of a block of texts: doc, start, n (starts), lead (anchor's place in it), anchor, c1 and c2 (digest)."""
    size = np.diff(offsets)
    n_starts = np.maximum(size - min_bytes + 1, 0)
    doc = np.repeat(np.arange(len(size)), n_starts)
    starts = np.arange(len(doc)) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts) + offsets[:-1][doc]
    parts = []
    for at in range(0, len(starts), STRETCH):  # more than one round for a very long text only
        own = starts[at : at + STRETCH]
        base, stop = own[0], own[-1] + min_bytes
        if stop - base >= 1 << _PLACE:  # texts in between that are too short: look at each stretch of starts alone
            cuts = np.flatnonzero(np.diff(own) > 1) + 1
            parts += [(at + x[0], x) for x in np.split(np.arange(len(own)), cuts)]
        else:
            parts.append((at, np.arange(len(own))))
    out: dict[str, list] = {k: [] for k in ("doc", "start", "n", "lead", "anchor", "c1", "c2")}
    memory = memoryview(np.ascontiguousarray(buf))
    for at, own in parts:
        own = starts[at : at + len(own)]
        base = own[0]
        place, h = select_anchors(buf[base : own[-1] + min_bytes], own - base, min_bytes)
        place += base
        cut = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(own)]])
        s0, n = own[cut[:-1]], np.diff(cut)
        anchor = place[cut[:-1]]
        lead = anchor - s0
        digests = b"".join([_digest(memory[a:b], c) for a, b, c in zip(s0.tolist(), (s0 + n + min_bytes - 1).tolist(), lead.tolist(), strict=True)])
        pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
        of = doc[at : at + len(own)][cut[:-1]]
        for k, v in (("doc", of), ("start", s0 - offsets[of]), ("n", n), ("lead", lead), ("anchor", h[anchor - base].view(np.int64)), ("c1", pair[:, 0]), ("c2", pair[:, 1])):
            out[k].append(v)
    return {k: np.concatenate([np.zeros(0, np.int64), *v]) for k, v in out.items()}


class Columns:
    """Segments laid on top of each other at their anchors, in a file that is read column by column from the last one on.

    Rows are added in the order of their numbers and held in memory only up to
    a block of them, which is written turned round.
    """

    ROWS = 512

    def __init__(self) -> None:
        self.file = tempfile.TemporaryFile()  # noqa: SIM115
        self.blocks: list[tuple[int, int, int, int]] = []  # rows, first column, column after the last, place
        self.low: list[int] = []
        self.high: list[int] = []
        self.open: list[bytes] = []

    def __enter__(self) -> Columns:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()

    def add(self, text: bytes, lead: int) -> None:
        self.low.append(-lead)
        self.high.append(len(text) - lead)
        self.open.append(text)
        if len(self.open) == self.ROWS:
            self.write()

    def write(self) -> None:
        n = len(self.open)
        if not n:
            return
        low, high = self.low[-n:], self.high[-n:]
        first, stop = min(low), max(high)
        table = np.zeros((n, stop - first), np.uint8)
        for i, t in enumerate(self.open):
            table[i, low[i] - first : high[i] - first] = np.frombuffer(t, np.uint8)
        self.blocks.append((n, first, stop, self.file.tell()))
        np.ascontiguousarray(table.T[::-1]).tofile(self.file)
        self.open = []

    def symbols(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each column with its symbols (1 and up; 0 where a row has none), last column first."""
        self.write()
        low, high = np.array(self.low), np.array(self.high)
        for c in range(int(high.max()) - 1, int(low.min()) - 1, -1):
            column = np.zeros(len(low), np.int64)
            at = 0
            for n, first, stop, place in self.blocks:
                if first <= c < stop:
                    self.file.seek(place + (stop - 1 - c) * n)
                    column[at : at + n] = np.frombuffer(self.file.read(n), np.uint8)
                at += n
            yield c, np.where((low <= c) & (c < high), column + 1, 0)


def repeated_starts(columns: Columns, groups: np.ndarray, min_bytes: int = MIN) -> tuple[np.ndarray, np.ndarray]:
    """Column-wise construction over segments laid on top of each other at their anchors.

    ``groups`` are ascending numbers. Returns the first and last start of each
    segment that has ``min_bytes`` bytes in common with a segment of its group
    at the same column; -1 where there is none.
    """
    m = len(groups)
    first, last = np.full(m, NONE), np.full(m, NONE)
    order, common = np.arange(m), np.zeros(m + 1, np.int64)
    group = groups.astype(np.int64)
    for c, symbol in columns.symbols():
        key = group * 257 + symbol[order]
        rank = np.argsort(key, kind="stable") if (key[1:] < key[:-1]).any() else np.arange(m)
        key, order = key[rank], order[rank]
        a, b = rank[:-1], rank[1:]
        same = (key[1:] == key[:-1]) & (key[1:] % 257 > 0)
        new = np.zeros(m + 1, np.int64)
        near = np.flatnonzero(same & (b == a + 1))
        new[near + 1] = common[b[near]] + 1
        far = np.flatnonzero(same & (b != a + 1))
        if len(far):
            cuts = np.empty(2 * len(far), np.int64)
            cuts[0::2], cuts[1::2] = a[far] + 1, b[far] + 1
            new[far + 1] = np.minimum.reduceat(common, cuts)[0::2] + 1
        common = new
        hit = np.flatnonzero(common[:m] >= min_bytes)
        if len(hit):
            rows = np.concatenate([order[hit], order[hit - 1]])
            first[rows] = c
            fresh = rows[last[rows] == NONE]
            last[fresh] = c
    low = np.array(columns.low)
    return np.where(first != NONE, first - low, -1), np.where(last != NONE, last - low, -1)


_SEGMENT = "key binary, start int, n int, lead int, anchor long, c1 long, c2 long"


def _segments(rows: DataFrame, min_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for a, b in blocks(offsets, STRETCH):
                part = offsets[a : b + 1]
                found = segments_of(data[part[0] : part[-1]], part - part[0], min_bytes)
                keys = batch.column("key").take(pa.array(found.pop("doc") + a))
                cols = [pa.array(found[k], pa.int32()) for k in ("start", "n", "lead")] + [pa.array(found[k], pa.int64()) for k in ("anchor", "c1", "c2")]
                yield pa.RecordBatch.from_arrays([keys, *cols], ["key", "start", "n", "lead", "anchor", "c1", "c2"])

    return rows.where(F.octet_length("text") >= min_bytes).select("key", "text").mapInArrow(run, _SEGMENT)


def _bytes_of(rows: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """The bytes of one segment of each content: ``wanted`` has key and segs (start, n, lead, anchor, c1, c2, copies)."""
    names = ("anchor", "c1", "c2", "copies", "n", "lead")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            segs = batch.column("segs")
            docs = np.repeat(np.arange(batch.num_rows), np.diff(segs.offsets.to_numpy()))
            flat = segs.flatten()
            at = flat.field("start").to_numpy() + offsets[:-1][docs]
            end = at + flat.field("n").to_numpy() + min_bytes - 1
            memory = memoryview(data)
            bodies = pa.array([bytes(memory[a:b]) for a, b in zip(at.tolist(), end.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(flat.field(x) for x in names), bodies], [*names, "body"])

    return wanted.join(rows, "key").select("segs", "text").mapInArrow(run, "anchor long, c1 long, c2 long, copies long, n int, lead int, body binary")


_BODY = "group long, c1 long, c2 long, n int, lead int, body binary, before int, after int"
_PART = "c1 long, c2 long, lo int, hi int"


def _parts(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*found, strict=True)) or [[]] * 4
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["c1", "c2", "lo", "hi"])


def _compared(bodies: DataFrame, min_bytes: int) -> DataFrame:
    """(c1, c2, lo, hi): the repeated part of each content that shares a string with another one of its group. Groups are whole in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spool, of, names, group = Columns(), [], [], None

        def flush() -> pa.RecordBatch:
            with spool:
                first, last = repeated_starts(spool, np.array(of), min_bytes)
            return _parts([(*x, int(a), int(b) + min_bytes) for x, a, b in zip(names, first, last, strict=True) if a >= 0])

        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("group", "c1", "c2", "lead", "body")), strict=True):
                if row[0] != group:
                    if len(of) >= BATCH:
                        yield flush()
                        spool, of, names = Columns(), [], []
                    group = row[0]
                    number = of[-1] + 1 if of else 0
                of.append(number)
                names.append(row[1:3])
                spool.add(row[4], row[3])
        if of:
            yield flush()

    dealt = bodies.repartition("group").sortWithinPartitions("group")
    return dealt.select("group", "c1", "c2", "lead", "body").mapInArrow(run, _PART)


def _halved(bodies: DataFrame, min_bytes: int) -> DataFrame:
    """``bodies`` in smaller groups, in up to two each.

    All of a group have the gram and ``before`` and ``after`` bytes around it in
    common. A string of MIN bytes over these takes at least half of its other
    bytes after them or before them; two contents that share it meet in the
    group of what is there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _BODY.split(", ")]
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                half = (min_bytes - GRAM - row["before"] - row["after"] + 1) // 2
                body, a, b = row["body"], row["lead"] - row["before"], row["lead"] + GRAM + row["after"]
                seed = row["group"] & (2**64 - 1)
                if b + half <= len(body):
                    out.append(row | {"group": xxhash.xxh3_64_intdigest(b"a" + body[b : b + half], seed) - 2**63, "after": row["after"] + half})
                if a >= half:
                    out.append(row | {"group": xxhash.xxh3_64_intdigest(b"b" + body[a - half : a], seed) - 2**63, "before": row["before"] + half})
            types = [batch.schema.field(x).type for x in names]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in zip(names, types, strict=True)], names)

    return bodies.select(*(x.split()[0] for x in _BODY.split(", "))).mapInArrow(run, _BODY)


def _sized(bodies: DataFrame, total: int) -> DataFrame:
    """``bodies`` with the number of contents of their groups; those alone in theirs go."""
    sizes = written(bodies.groupBy("group").agg(F.count("*").alias("times")).where("times > 1"), "group-sizes")
    return salted_join(bodies, sizes, "group", hot_keys(sizes, "group", "times", total), F.xxhash64("c1", "c2"))


def _counted(left: DataFrame, min_bytes: int) -> DataFrame:
    """(c1, c2, lo, hi) for contents of groups that stay large, which have nearly a whole string in common: the few strings over it are counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                body = memoryview(row["body"])
                starts = np.arange(max(0, row["lead"] + GRAM + row["after"] - min_bytes), min(row["n"] - 1, row["lead"] - row["before"]) + 1)
                digests = b"".join(_digest(body[s : s + min_bytes], row["group"] & (2**64 - 1)) for s in starts.tolist())
                pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
                cols = [np.full(len(starts), row["c1"]), np.full(len(starts), row["c2"]), starts, starts - row["lead"], pair[:, 0], pair[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["c1", "c2", "s", "col", "d1", "d2"])

    windows = written(left.select(*(x.split()[0] for x in _BODY.split(", "))).mapInArrow(run, "c1 long, c2 long, s long, col long, d1 long, d2 long").distinct(), "windows")
    key = ["col", "d1", "d2"]
    counts = written(windows.groupBy(*key).agg(F.count("*").alias("times")), "window-counts")
    total = counts.agg(F.sum("times")).first()[0] or 0
    twice = salted_join(windows, counts.where("times > 1"), key, hot_keys(counts, key, "times", total), F.xxhash64("c1", "c2"))
    return twice.select("c1", "c2", F.col("s").cast("int").alias("lo"), (F.col("s") + min_bytes).cast("int").alias("hi"))


def _narrowed(bodies: DataFrame, min_bytes: int, max_group: int) -> list[DataFrame]:
    """(c1, c2, lo, hi) of contents in groups of over ``max_group``, which are halved until they are small or have nearly a whole string in common."""
    found = []
    for level in range(LEVELS):
        total = bodies.count()
        sized = written(_sized(_halved(bodies, min_bytes), 2 * total), f"halves{level}")
        small, bodies = sized.where(F.col("times") <= max_group), sized.where(F.col("times") > max_group).drop("times")
        found.append(written(_compared(small, min_bytes), "compared-halves"))
        if bodies.isEmpty():
            return found
    return [*found, _counted(bodies, min_bytes)]


def repeated_spans(rows: DataFrame, min_bytes: int = MIN, max_group: int = MAX_GROUP) -> DataFrame:
    """(key, spans) of texts (key, text) in which something repeats; spans may overlap."""
    if min_bytes < GRAM:
        raise ValueError(f"min_bytes must be {GRAM} or more")
    segs = written(_segments(rows, min_bytes), "segments")
    total = segs.count()
    anchors = segs.groupBy("anchor").agg(F.count("*").alias("times"), F.min("c1").alias("a1"), F.max("c1").alias("b1"), F.min("c2").alias("a2"), F.max("c2").alias("b2"))
    anchors = written(anchors.where("times > 1").select("anchor", "times", ((F.col("a1") == F.col("b1")) & (F.col("a2") == F.col("b2"))).alias("alike")), "anchors")
    again = salted_join(segs, anchors.drop("times"), "anchor", hot_keys(anchors, "anchor", "times", total), F.xxhash64("key", "start"))
    again = written(again, "repeated-anchors")
    whole = F.col("n") + min_bytes - 1
    spans = again.where("alike").select("key", F.col("start").alias("a"), (F.col("start") + whole).alias("b"))

    unlike = again.where("not alike")
    one = F.struct("key", "start", "n", "lead", "anchor")
    contents = unlike.groupBy("c1", "c2").agg(F.count("*").alias("copies"), F.min(one).alias("one"))
    contents = written(contents.select("c1", "c2", "copies", "one.*"), "contents")
    sizes = contents.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > max_group)
    sizes = written(sizes, "large-groups")
    some, n_large = sizes.count(), sizes.agg(F.sum("n")).first()[0] or 0
    if some:
        marked = salted_join(contents, sizes.select("anchor", F.lit(True).alias("large")), "anchor", hot_keys(sizes, "anchor", "n", n_large), F.xxhash64("c1", "c2"), "left")
    else:
        marked = contents.withColumn("large", F.lit(None).cast("boolean"))
    seg = F.collect_list(F.struct("start", "n", "lead", "anchor", "c1", "c2", "copies"))
    wanted = lambda large: marked.where(F.col("large").isNotNull() if large else F.col("large").isNull()).groupBy("key").agg(seg.alias("segs"))
    bodies = lambda large: _bytes_of(rows, wanted(large), min_bytes).withColumnRenamed("anchor", "group")
    found = [written(_compared(bodies(False), min_bytes), "compared")]
    if some:
        large = bodies(True).withColumns({"before": F.lit(0), "after": F.lit(0)})
        found += _narrowed(written(large, "large-bodies"), min_bytes, max_group)
    parts = reduce(DataFrame.unionByName, found)
    parts = parts.groupBy("c1", "c2").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    parts = contents.join(parts, ["c1", "c2"], "left").where("copies > 1 or hi is not null")
    parts = parts.select("c1", "c2", F.when(F.col("copies") > 1, 0).otherwise(F.col("lo")).alias("lo"), F.when(F.col("copies") > 1, whole).otherwise(F.col("hi")).alias("hi"))
    hot = hot_keys(contents, ["c1", "c2"], "copies", total)
    more = salted_join(unlike, parts, ["c1", "c2"], hot, F.xxhash64("key", "start"))
    spans = spans.unionByName(more.select("key", (F.col("start") + F.col("lo")).alias("a"), (F.col("start") + F.col("hi")).alias("b")))
    return spans.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def cut_repeats(docs: DataFrame, min_bytes: int = MIN, id_col: str = "doc_id", text_col: str = "text", max_group: int = MAX_GROUP, keep_bytes: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, spans (removed runs in bytes), n_removed, kept_sha256 and, unless left out, kept (bytes)."""
    text = text_of(docs, text_col)
    key = F.unhex(F.md5(F.concat(F.coalesce(docs[id_col].cast("string"), F.lit("null")), F.lit(":"), text)))
    rows = docs.select(docs[id_col].alias("id"), key.alias("key"), text.alias("text"), F.monotonically_increasing_id().alias("spread"))
    same = rows.where(F.octet_length("text") >= min_bytes).groupBy("key").agg(F.count("*").alias("times"))
    same = written(same.where("times > 1"), "repeated-rows")
    n_same = same.agg(F.sum("times")).first()[0]
    if not n_same:
        spans = repeated_spans(rows.select("key", "text"), min_bytes, max_group)
        joined = rows.join(spans, "key", "left")
    else:
        hot = written(hot_keys(same, "key", "times", n_same), "hot-rows")
        flagged = salted_join(rows, same, "key", hot, F.col("spread"), "left")
        once = written(flagged.where("times is not null").groupBy("key").agg(F.first("text").alias("text")), "rows-once")
        spans = repeated_spans(flagged.where("times is null").select("key", "text").unionByName(once), min_bytes, max_group)
        everything = F.array(F.struct(F.lit(0).alias("a"), F.lit((1 << 31) - 1).alias("b")))
        spans = spans.join(same.select("key"), "key", "left_anti").unionByName(same.select("key", everything.alias("spans")))
        joined = salted_join(rows, spans, "key", hot, F.col("spread"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            out, digests, kept = [], [], []
            for k, of in enumerate(batch.column("spans").to_pylist()):
                own = data[offsets[k] : offsets[k + 1]].tobytes()
                runs = merged([(x["a"], min(x["b"], len(own))) for x in of or ()])
                if runs:
                    edges = [0, *(x for r in runs for x in r), len(own)]
                    own = b"".join(own[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append([{"start": a, "end": b} for a, b in runs])
                digests.append(hashlib.sha256(own).hexdigest())
                kept.append(own if keep_bytes else None)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            removed = [sum(x["end"] - x["start"] for x in r) for r in out]
            cols = [batch.column("id"), pa.array(np.diff(offsets)), pa.array(out, kind), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["id", "n_bytes", "spans", "n_removed", "kept_sha256", "kept"])

    out = joined.select("id", "text", "spans").mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, spans array<struct<start:int,end:int>>, n_removed long, kept_sha256 string, kept binary")
    return out if keep_bytes else out.drop("kept")
