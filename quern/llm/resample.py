"""Importance resampling towards a target distribution.

Features of a text are hashed into buckets; how much likelier a bucket is in
the target texts than in all texts is its gain, a whole number. An array of
gains scores every text; Gumbel noise by id makes the highest scores a draw
without replacement. The draw is an external merge:

1. Scores, a few numbers per row, are written once. Splitters at quantiles of
   eligible scores cut the part to be drawn into ranges.
2. Each partition's eligible rows are sorted into a run (by Spark's sort, which
   spills), cut at the splitters and written as blocks of packed rows; rows
   that are alike in all numbers are one entry with a count.
3. Counts of the ranges give each range its first rank. Ranges beyond the draw
   are not merged. Each of the others is merged by one task: blocks come in the
   order of their first rows, so a run's next block is there when it is needed
   and a task holds one or two blocks of a run; a tournament tree over the runs
   finds the next row in a comparison per level. In the last range the merge
   stops at the exact count; what is left gets no rank.

The noise spreads scores over thousands of values however alike the texts are,
and rows alike in all numbers travel as one entry, so a range has about as many
entries as any other. No range, run or text passes through the driver; it sees
the buckets' counts and a count per range.

Defined cases: null texts have no features. Ids are whole numbers; a null id is
an empty one in the hash and comes after others in ties, rows of one id and
score are in order of their features and weight. An empty target or table
counts nothing, which leaves gains defined. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import text_of, written

#: Rows in a block of a run, and entries of a batch that merging gives back.
BLOCK_ROWS, OUT_ROWS = 1024, 8192
#: Ranges are as many as shuffle partitions, up to this.
MAX_RANGES = 1000
ROW = np.dtype([("score", "<i8"), ("absent", "<i8"), ("id", "<i8"), ("n_features", "<i8"), ("weight", "<i8"), ("n", "<i8")])
SCORED = "id long, n_words long, n_features long, weight long"
MERGED = "id long, n_features long, weight long, score long, rank long, n long"


def _grams(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``n`` words joined by single spaces: a buffer, starts and ends in it, and each document's first run (len + 1)."""
    if n == 1:
        return buf, starts, ends, first
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size + 1)])
    joined = np.full(at[-1], 32, np.uint8)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    joined[np.repeat(at[:-1], size) + within] = buf[np.repeat(starts, size) + within]
    of = np.maximum(0, np.diff(first) - n + 1)
    begin = np.concatenate([[0], np.cumsum(of)])
    word = np.repeat(first[:-1], of) + np.arange(begin[-1]) - np.repeat(begin[:-1], of)
    return kernels.padded(joined), at[:-1][word], at[:-1][word + n - 1] + size[word + n - 1], begin


def buckets_of(texts: pa.Array, orders: tuple[int, int], buckets: int) -> Iterator[tuple[int, int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """By block of texts: their range, their numbers of words, and for each length of run the features' buckets and where each text's begin."""
    data, offsets = kernels.column_bytes(texts)
    for a, b in kernels.blocks(offsets):
        own = kernels.LOWER[data[offsets[a] : offsets[b]]]
        starts, ends, first = kernels.split_words(own, offsets[a : b + 1] - offsets[a], kernels.ALNUM)
        own = kernels.padded(own)
        found = []
        for n in range(orders[0], orders[1] + 1):
            grams, begin, end, of = _grams(own, starts, ends, first, n)
            found.append(((kernels.crc32_ranges(grams, begin, end) % np.uint32(buckets)).astype(np.int64), of))
        yield a, b, np.diff(first), found


def bucket_counts(texts: DataFrame, text_col: str, orders: tuple[int, int], buckets: int) -> np.ndarray:
    """How many features of all texts are in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in buckets_of(batch.column("text"), orders, buckets):
                for at, _ in found:
                    counts += np.bincount(at, minlength=buckets)
        on = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int64()), pa.array(counts[on], pa.int64())], ["bucket", "n"])

    rows = texts.select(text_of(texts, text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # a row per bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target, with one feature more in each bucket."""
    s, t, n = source.tolist(), target.tolist(), len(source)
    s_all, t_all = float(sum(s) + n), float(sum(t) + n)
    return np.array([math.floor(1000 * math.log((y + 1) * s_all / ((x + 1) * t_all))) for x, y in zip(s, t, strict=True)], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, orders: tuple[int, int] = (1, 1), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features and weight, the sum of its features' gains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words, found in buckets_of(batch.column("text"), orders, len(gain)):
                total, count = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                for at, of in found:
                    upto = np.concatenate([[0], np.cumsum(gain[at])])
                    total += upto[of[1:]] - upto[of[:-1]]
                    count += np.diff(of)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(words.astype(np.int64)), pa.array(count), pa.array(total)], ["id", "n_words", "n_features", "weight"])

    return docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text")).mapInArrow(run, SCORED)


def with_score(rows: DataFrame, seed: int) -> DataFrame:
    """Adds score: the weight plus Gumbel noise in thousandths, by id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))))


def _runs(splitters: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of the sorted rows of a partition; ``splitters`` are in rising order."""
    edges = np.array(splitters, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            rows = np.zeros(len(batch), ROW)
            rows["absent"] = np.asarray(batch.column("id").is_null())
            rows["id"] = batch.column("id").fill_null(0).to_numpy()
            for name in ("score", "n_features", "weight"):
                rows[name] = batch.column(name).to_numpy()
            new = np.ones(len(rows), bool)
            new[1:] = rows[1:] != rows[:-1]
            at = np.flatnonzero(new)
            rows = rows[at]
            rows["n"] = np.diff(np.append(at, len(batch)))
            of = len(edges) - np.searchsorted(edges, rows["score"], "right")
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(rows)]
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                for x in range(a, b, BLOCK_ROWS):
                    own = rows[x : min(b, x + BLOCK_ROWS)]
                    out.append((int(of[x]), number, int(own["score"][0]), int(own["absent"][0]), int(own["id"][0]), int(own["n"].sum()), own.tobytes()))
                    number += 1
            if out:
                kinds = (pa.int64(),) * 6 + (pa.binary(),)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["range", "block", "score", "absent", "first_id", "n", "rows"])

    return run


class Tournament:
    """A tree of matches between the runs that have a row: each node holds the leaf of the lesser row below it."""

    def __init__(self) -> None:
        self.size = 1
        self.heads: list[tuple | None] = [None]  # by leaf
        self.nodes = [0, 0]
        self.rows: list[Iterator[list[int]]] = [iter(())]
        self.more: list[deque] = [deque()]  # blocks that wait
        self.leaf: dict[int, int] = {}  # by run
        self.free = [0]

    def least(self) -> tuple | None:
        return self.heads[self.nodes[1]]

    def _play(self, node: int) -> None:
        a, b = self.nodes[2 * node], self.nodes[2 * node + 1]
        x, y = self.heads[a], self.heads[b]
        self.nodes[node] = b if x is None or (y is not None and y < x) else a

    def _replay(self, leaf: int) -> None:
        node = (leaf + self.size) // 2
        while node:
            self._play(node)
            node //= 2

    def _grow(self) -> None:
        old = self.size
        self.size *= 2
        self.heads += [None] * old
        self.rows += [iter(()) for _ in range(old)]
        self.more += [deque() for _ in range(old)]
        self.free += range(self.size - 1, old - 1, -1)
        self.nodes = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            self._play(node)

    def _advance(self, leaf: int, run: int) -> None:
        row = next(self.rows[leaf], None)
        while row is None and self.more[leaf]:
            self.rows[leaf] = _unpacked(self.more[leaf].popleft())
            row = next(self.rows[leaf], None)
        if row is None:
            del self.leaf[run]
            self.free.append(leaf)
        self.heads[leaf] = None if row is None else (-row[0], *row[1:5], run, row[5])
        self._replay(leaf)

    def add(self, run: int, block: bytes) -> None:
        if run in self.leaf:
            self.more[self.leaf[run]].append(block)
            return
        if not self.free:
            self._grow()
        leaf = self.leaf[run] = self.free.pop()
        self.more[leaf].append(block)
        self._advance(leaf, run)

    def pop(self) -> tuple:
        leaf = self.nodes[1]
        head = self.heads[leaf]
        self._advance(leaf, head[5])
        return head

    def rest(self) -> Iterator[tuple]:
        """All rows that are left, in no order; ends the tournament."""
        for run, leaf in self.leaf.items():
            yield self.heads[leaf]
            for rows in (self.rows[leaf], *map(_unpacked, self.more[leaf])):
                for row in rows:
                    yield (-row[0], *row[1:5], run, row[5])


def _unpacked(block: bytes) -> Iterator[list[int]]:
    return iter(np.frombuffer(block, ROW).tolist())


def merged(blocks: Iterator[tuple[int, int, tuple, bytes]], first_rank: dict[int, int], draws: int) -> Iterator[tuple]:
    """(id, n_features, weight, score, rank, n) of blocks (range, run, first row, rows), which come by range and first row.

    ``rank`` is that of the first of n rows; it ends at ``draws``, beyond which it is null.
    """
    now, rank, tree = None, 0, Tournament()

    def given(row: tuple) -> Iterator[tuple]:
        nonlocal rank
        score, absent, key, n_features, weight, _, n = row
        key, take = None if absent else key, min(n, max(0, draws - rank + 1))
        if take:
            yield key, n_features, weight, -score, rank, take
        if take < n:
            yield key, n_features, weight, -score, None, n - take
        rank += n

    def ended() -> Iterator[tuple]:
        while tree.least() is not None and rank <= draws:
            yield from given(tree.pop())
        for row in tree.rest() if tree.least() is not None else ():
            yield from given(row)

    for number, run, head, block in blocks:
        if number != now:
            yield from ended()
            now, rank, tree = number, first_rank[number], Tournament()
        while rank <= draws and (least := tree.least()) is not None and least[:3] < head:
            yield from given(tree.pop())
        if rank <= draws:
            tree.add(run, block)
            continue
        for row in _unpacked(block):  # the draw is complete
            yield from given((-row[0], *row[1:5], run, row[5]))
    yield from ended()


def _merger(first_rank: dict[int, int], draws: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, tuple, bytes]]:
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("range", "run", "score", "absent", "first_id")]
            for k, (number, run, score, absent, first_id) in enumerate(zip(*columns, strict=True)):
                yield number, run, (-score, absent, first_id), batch.column("rows")[k].as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["id", "n_features", "weight", "score", "rank", "n"])

        for row in merged(blocks(batches), first_rank, draws):
            out.append(row)
            if len(out) == OUT_ROWS:
                yield packed()
                out = []
        if out:
            yield packed()

    return run


def _expanded(rows: DataFrame) -> DataFrame:
    """Each row as often as its n says, with ranks that follow each other; counts are those of a batch at most."""
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    many = rows.where("n > 1").repartition("id", "rank", "score").withColumn("nth", nth)
    return rows.where("n = 1").withColumn("nth", F.lit(0).cast("long")).unionByName(many).withColumn("rank", F.col("rank") + F.col("nth")).drop("n", "nth")


def draw(scored: DataFrame, percent: int = 10, least_words: int = 20) -> DataFrame:
    """Adds rank to written rows (id, n_words, n_features, weight, score): 1, 2, ... for the ``percent`` of eligible rows with the highest scores."""
    spark = scored.sparkSession
    scored = scored.withColumn("eligible", F.col("n_words") >= least_words)
    out = ["id", "n_features", "weight", "score"]
    ranges = min(MAX_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [max(0.0, 1 - 1.02 * percent / 100 * k / ranges) for k in range(1, ranges + 1)]
    total, splitters = scored.where("eligible").agg(F.count("*"), F.percentile_approx("score", shares, 10_000)).first()
    draws = total * percent // 100
    if not draws:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    splitters = sorted(set(splitters))

    runs = scored.where("eligible").select(*out).sortWithinPartitions(F.desc("score"), F.col("id").asc_nulls_last(), "n_features", "weight")
    runs = runs.mapInArrow(_runs(splitters), "range long, block long, score long, absent long, first_id long, n long, rows binary")
    runs = written(runs.withColumn("run", F.spark_partition_id()), "runs")
    counts = dict(runs.groupBy("range").agg(F.sum("n")).collect())  # a row per range
    first_rank, upto = {}, 0
    for k in range(len(splitters) + 1):
        if upto >= draws:
            break
        first_rank[k] = upto + 1
        upto += counts.get(k, 0)
    last = max(first_rank)

    drawn = runs.where(F.col("range") <= last).repartition(len(first_rank), "range").sortWithinPartitions("range", F.desc("score"), "absent", "first_id", "run", "block")
    drawn = written(drawn.mapInArrow(_merger(first_rank, draws), MERGED), "drawn")
    others = ~F.col("eligible") if last == len(splitters) else ~F.col("eligible") | (F.col("score") < splitters[len(splitters) - 1 - last])
    undrawn = scored.where(others).select(*out, F.lit(None).cast("long").alias("rank"))
    return _expanded(drawn).select(undrawn.columns).unionByName(undrawn)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    orders: tuple[int, int] = (1, 1),
    buckets: int = 10_000,
    least_words: int = 20,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_features, weight, score and rank (null if it isn't drawn)."""
    gain = gains(bucket_counts(docs, text_col, orders, buckets), bucket_counts(target, target_text_col, orders, buckets))
    scored = written(with_score(weights(docs, gain, orders, id_col, text_col), seed), "scored")
    return draw(scored, percent, least_words).withColumnRenamed("id", id_col)
