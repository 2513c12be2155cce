"""Modified Kneser-Ney trigram counts in shards, and their joins with the n-grams of texts.

Every n-gram has a 64-bit hash, and its place on that line decides its shard.
There are three tables, a row per shard: trigrams with their counts; bigrams
with the number of their left neighbours and, as contexts, the sum and the
counts of counts of what follows; words likewise. All words are kept, however
rare, and all n-grams, those of count 1 included.

Texts are worked on in blocks. A block asks each shard for each of its
different n-grams once, so a frequent n-gram costs a shard no more than a
request per block, and no key, context or word is a hot one. Bodies of rows are
packed arrays: ascending keys by their differences, byte planes, zstd.

Slices bound the disk: counts are gathered for a range of shards at a time, and
texts are scored a part at a time; shuffle files of a slice go when it ends.
Nothing but sums of counts of counts reaches the driver, and nothing is broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, scratch_path, shuffles_freed, written
from .kernels import SOLID, U, blocks, column_bytes, hash_ranges, mix64, padded, split_words

#: Bytes of trusted text for a shard, and of text for a block.
SHARD_BYTES, BLOCK_BYTES = 1 << 26, 1 << 21
#: A shard has no less text for the sake of more tasks.
LEAST_BYTES = 1 << 20
#: A table has at most so many buckets; a bucket may hold several shards.
MOST_BUCKETS = 10_000
#: Slices of large inputs; of small ones, as many as there are pieces of so many bytes.
SLICES, SLICE_BYTES = 8, 1 << 26
RUNS, SHAPES = 6, 168
#: The class of a word that repeats the one before.
AGAIN = SHAPES
CLASSES = SHAPES + 1

START = mix64(np.array([0x51], U))[0]
_AGAIN = mix64(np.arange(1, RUNS + 1, dtype=U) * U(0xD6E8FEB86659FD93))

# Counts of kinds of bytes side by side, 12 bits each: lower case and other scripts, upper case, digits, symbols, "!".
_KIND = np.zeros(256, U)
_KIND[97:123] = _KIND[128:] = 1
_KIND[65:91] = 1 << 12
_KIND[48:58] = 1 << 24
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 1 << 36
_KIND[33] = 1 << 48
_CLOSE = np.zeros(256, np.int64)
_CLOSE[[ord(c) for c in ".!?"]] = 1
_CLOSE[[ord(c) for c in ",;:"]] = 2


@dataclass
class Tokens:
    """Tokens of all texts of a buffer, and each text's first token (len + 1).

    A token is the hash of a word (a run without ASCII white space); a word
    that repeats the one before is the token of its place in the run of
    repeats, so that no run foretells itself.
    """

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    token: np.ndarray
    again: np.ndarray

    def classes(self, at: np.ndarray) -> np.ndarray:
        """The classes of some tokens: a word's shape, or AGAIN."""
        return np.where(self.again[at], AGAIN, _shapes(self.buf, self.starts[at], self.ends[at]))


def tokens_of(buf: np.ndarray, offsets: np.ndarray) -> Tokens:
    starts, ends, first = split_words(buf, offsets, SOLID)
    h = hash_ranges(padded(buf), starts, ends)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[first[:-1][first[:-1] < len(h)]] = False
    token = h
    if again.any():
        place = np.arange(len(h))
        run = place - np.maximum.accumulate(np.where(again, 0, place))
        token = np.where(again, _AGAIN[np.minimum(np.maximum(run, 1), RUNS) - 1], h)
    return Tokens(buf, starts, ends, first, token, again)


def _shapes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Letter case, digits, symbols, closing punctuation and length of words, as one number."""
    total = np.zeros(len(buf) + 1, U)
    np.cumsum(_KIND[buf], out=total[1:])
    n = total[ends] - total[starts]
    lower, upper, digits, symbols, cries = kinds = [((n >> U(12 * k)) & U(4095)).astype(np.int64) for k in range(5)]
    for i in np.flatnonzero(ends - starts > 4095):  # more than a count holds
        own = np.bincount(np.log2(_KIND[buf[starts[i] : ends[i]]].astype(float), where=_KIND[buf[starts[i] : ends[i]]] > 0, out=np.full(ends[i] - starts[i], 60.0)).astype(np.int64) // 12, minlength=5)
        for k, of in enumerate(kinds):
            of[i] = own[k]
    letters = lower + upper
    initial = buf[starts] if len(starts) else np.zeros(0, np.uint8)
    kind = np.select(
        [symbols > 0, (digits > 0) & (letters > 0), digits > 0, letters == 0, (upper > 1) & (lower == 0), (initial >= 65) & (initial <= 90)],
        [1, 2, 3, 0, 4, 5],
        6,
    )
    close = _CLOSE[buf[ends - 1]] if len(ends) else np.zeros(0, np.int64)
    return ((kind * 2 + (cries > 0)) * 3 + close) * 4 + np.searchsorted([4, 8, 13], ends - starts, "right")


def before(x: np.ndarray, first: np.ndarray, start: int | np.uint64) -> np.ndarray:
    """What each token's predecessor has; ``start`` at the beginning of a text."""
    out = np.full_like(x, start)
    out[1:] = x[:-1]
    out[first[:-1][np.diff(first) > 0]] = start
    return out


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of one token or pair after another."""
    return mix64(mix64(a + U(0x9E3779B97F4A7C15)) ^ b)


#: The context of a text's first token.
BEGIN = pair(np.array([START], U), np.array([START], U))[0]


def order_of(key: np.ndarray) -> np.ndarray:
    """The places of ascending hashes, those of equal ones in order.

    A place is put where a hash has its low bits, so that numbers are sorted
    instead of places; the few hashes that differ in these bits alone are seen
    afterwards, and then places are sorted after all.
    """
    low = U((1 << len(key).bit_length()) - 1)
    order = (np.sort((key & ~low) | np.arange(len(key), dtype=U)) & low).astype(np.int64)
    found = key[order]
    return order if (found[1:] >= found[:-1]).all() else np.argsort(key, kind="stable")


def placed(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes, ascending, and the place of each of ``key`` among them."""
    order = order_of(key)
    key = key[order]
    new = np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]])
    at = np.empty(len(key), np.int64)
    at[order] = np.cumsum(new) - 1
    return key[new], at


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, ascending, with a place and the number of each."""
    order = order_of(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    return key[new], order[new], np.diff(np.append(new, len(key)))


def dump(arrays: list[np.ndarray], ascending: bool = True) -> bytes:
    """64-bit arrays of one length, packed; the first is ascending keys, unless said otherwise."""
    planes = []
    for k, a in enumerate(arrays):
        a = np.ascontiguousarray(a).astype(U, copy=False)
        a = np.diff(a, prepend=U(0)) if ascending and not k else a
        planes.append(a.view(np.uint8).reshape(-1, 8).T.ravel())
    return zstandard.compress(np.concatenate(planes).tobytes(), 1)


def load(body: bytes, n_arrays: int, ascending: bool = True) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(body), np.uint8)
    out = [np.ascontiguousarray(x.reshape(8, -1).T).view(U).ravel() for x in np.split(raw, n_arrays)]
    return [np.cumsum(out[0], dtype=U), *out[1:]] if ascending else out


def load_all(bodies: list[bytes], n_arrays: int) -> list[np.ndarray]:
    parts = [load(b, n_arrays) for b in bodies]
    return [np.concatenate([np.zeros(0, U), *(p[k] for p in parts)]) for k in range(n_arrays)]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> U(32)) * U(shards)) >> U(32)


def cut(arrays: list[np.ndarray], shards: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Arrays by the shards of their first, which is ascending."""
    of = shard_of(arrays[0], shards)
    edges = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]]) if len(of) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(of[a]), [x[a:b] for x in arrays]


def summed(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Different keys, ascending, and the sums of their values."""
    order = order_of(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    return [key[new], *(np.add.reduceat(v[order], new) if len(new) else v[:0] for v in values)]


def by_count(n: np.ndarray) -> list[np.ndarray]:
    """Whether counts are 1, 2, or more."""
    return [(n == 1).astype(U), (n == 2).astype(U), (n > 2).astype(U)]


def _stats(n: np.ndarray) -> dict[str, int]:
    return {f"n{k}": int((n == U(k)).sum()) for k in (1, 2, 3, 4)} | {"total": int(n.sum())}


_ROW = "shard int, kind string, slice int, body binary"
_MADE = f"{_ROW}, n1 long, n2 long, n3 long, n4 long, total long, classes array<long>"
_SCHEMA = pa.schema([("shard", pa.int32()), ("kind", pa.string()), ("slice", pa.int32()), ("body", pa.binary()), *((x, pa.int64()) for x in ("n1", "n2", "n3", "n4", "total")), ("classes", pa.list_(pa.int64()))])


def _made(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _SCHEMA)


@dataclass
class Plan:
    """How a model is dealt: ``shards`` in ``slices`` of equal numbers."""

    shards: int
    slices: int

    def slice_of(self, shard: int) -> int:
        return shard * self.slices // self.shards

    def bounds(self, k: int) -> tuple[int, int]:
        return -(-k * self.shards // self.slices), -(-(k + 1) * self.shards // self.slices)


def pieces(n_bytes: int, slices: int = SLICES, slice_bytes: int = SLICE_BYTES) -> int:
    return max(1, min(slices, -(-n_bytes // slice_bytes)))


def _blocks_of(texts: DataFrame, of: Callable[[np.ndarray, np.ndarray], list[tuple]], limit: int) -> DataFrame:
    """``of`` gives (shard, kind, body) for each block of the column text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for a, b in blocks(offsets, limit):
                part = offsets[a : b + 1]
                rows = of(data[part[0] : part[-1]], part - part[0])
                shard, kind, body = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(kind, pa.string()), pa.array(body, pa.binary())], ["shard", "kind", "body"])

    return texts.select("text").mapInArrow(run, "shard int, kind string, body binary")


def _per_shard(rows: DataFrame, shards: range, of: Callable[[int, dict[str, list[bytes]]], list[dict]]) -> DataFrame:
    """``of`` makes rows from all bodies of a shard, by kind; each of ``shards`` is there, if without bodies."""
    spark = rows.sparkSession
    every = spark.range(shards.start, shards.stop).selectExpr("cast(id as int) as shard", "'' as kind", "cast(null as binary) as body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        bodies: dict[str, list[bytes]] = {}
        for batch in batches:
            for s, kind, body in zip(*(batch.column(x).to_pylist() for x in ("shard", "kind", "body")), strict=True):
                if s != now and now is not None:
                    yield from _made(of(now, bodies)).to_batches()
                    bodies = {}
                now = s
                bodies.setdefault(kind, []).append(body)
        if now is not None:
            yield from _made(of(now, bodies)).to_batches()

    # a shard is a task
    return rows.unionByName(every).repartitionById(len(shards), F.col("shard")).sortWithinPartitions("shard").mapInArrow(run, _MADE)


def _count_trigrams(texts: DataFrame, plan: Plan, k: int, limit: int) -> DataFrame:
    """Rows ``t3`` (trigram, count) of slice ``k``, and ``u2``: what they add to bigrams of any shard."""
    lo, hi = plan.bounds(k)

    def block(buf: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        found = tokens_of(buf, offsets)
        token, first = found.token, found.first
        below = pair(before(token, first, START), token)
        context = before(below, first, BEGIN)
        key = pair(context, token)
        of = shard_of(key, plan.shards)
        mine = np.flatnonzero((of >= U(lo)) & (of < U(hi)))
        key, at, n = grouped(key[mine])
        at = mine[at]
        return [(s, "tri", dump(x)) for s, x in cut([key, n.astype(U), context[at], below[at]], plan.shards)]

    def shard(s: int, bodies: dict[str, list[bytes]]) -> list[dict]:
        key, n, context, below = load_all(bodies.get("tri", []), 4)
        order = order_of(key)
        key, n, context, below = key[order], n[order], context[order], below[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
        key, n, context, below = key[new], np.add.reduceat(n, new) if len(new) else n, context[new], below[new]
        none, one = np.zeros(len(n), U), np.ones(len(n), U)
        more = summed(np.concatenate([context, below]), *(np.concatenate(x) for x in ((none, one), (n, none), *((c, none) for c in by_count(n)))))
        out = [{"shard": s, "kind": "t3", "slice": 0, "body": dump([key, n]), **_stats(n)}]
        return out + [{"shard": to, "kind": "u2", "slice": plan.slice_of(to), "body": dump(x)} for to, x in cut(more, plan.shards)]

    return _per_shard(_blocks_of(texts, block, limit), range(lo, hi), shard)


def _count_bigrams(texts: DataFrame, more: DataFrame, plan: Plan, k: int, limit: int) -> DataFrame:
    """Rows ``t2`` of slice ``k``, and ``u1``: what bigrams add to words, and the words' classes."""
    lo, hi = plan.bounds(k)

    def mine(keys: np.ndarray) -> np.ndarray:
        of = shard_of(keys, plan.shards)
        return (of >= U(lo)) & (of < U(hi))

    def block(buf: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        found = tokens_of(buf, offsets)
        token = found.token
        v = before(token, found.first, START)
        key = pair(v, token)
        own = np.flatnonzero(mine(key))
        key, at, _ = grouped(key[own])
        at = own[at]
        own = np.flatnonzero(mine(token))
        word, place, _ = grouped(token[own])
        rows = [(s, "bi", dump(x)) for s, x in cut([key, v[at], token[at]], plan.shards)]
        return rows + [(s, "word", dump(x)) for s, x in cut([word, found.classes(own[place]).astype(U)], plan.shards)]

    def shard(s: int, bodies: dict[str, list[bytes]]) -> list[dict]:
        table = summed(*load_all(bodies.get("u2", []), 6))
        key, x, y = load_all(bodies.get("bi", []), 3)
        key, at, _ = grouped(key)
        x, y = x[at], y[at]
        n = table[1][np.searchsorted(table[0], key)]
        word, of = load_all(bodies.get("word", []), 2)
        word, at, _ = grouped(word)
        none, zero = np.zeros(len(n), U), np.zeros(len(word), U)
        columns = [(np.ones(len(n), U), none, zero), (none, n, zero), *((none, c, zero) for c in by_count(n)), (none, none, of[at] + U(1))]
        words = summed(np.concatenate([y, x, word]), *(np.concatenate(c) for c in columns))
        out = [{"shard": s, "kind": "t2", "slice": 0, "body": dump(table), **_stats(table[1])}]
        return out + [{"shard": to, "kind": "u1", "slice": 0, "body": dump(c)} for to, c in cut(words, plan.shards)]

    return _per_shard(_blocks_of(texts, block, limit).unionByName(more.select("shard", "kind", "body")), range(lo, hi), shard)


def _count_words(more: DataFrame, plan: Plan) -> DataFrame:
    """Rows ``t1``, with the number of words of each class."""

    def shard(s: int, bodies: dict[str, list[bytes]]) -> list[dict]:
        *table, of = summed(*load_all(bodies.get("u1", []), 7))
        classes = np.bincount(of[of > 0].astype(np.int64) - 1, minlength=CLASSES)
        return [{"shard": s, "kind": "t1", "slice": 0, "body": dump(table), **_stats(table[1]), "classes": classes.tolist()}]

    return _per_shard(more.select("shard", "kind", "body"), range(plan.shards), shard)


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts of 0, 1, 2 and 3 or more, from the numbers of counts of 1 to 4."""
    n = [0, *n]
    if not all(n[1:4]):
        return [0.0, 0.5, 0.75, 0.9]
    y = n[1] / (n[1] + 2 * n[2])
    return [0.0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) for k in (1, 2, 3))]


@dataclass
class Model:
    spark: SparkSession
    plan: Plan
    tables: list[tuple[str, str]]  # name and path of the tables t3, t2 and t1
    d3: list[float]
    d2: list[float]
    d1: list[float]
    total1: int  # of all words' numbers of left neighbours
    rest1: float  # what words leave to their classes
    base: np.ndarray  # a class's share of all words

    def rows(self) -> DataFrame:
        """A row per shard with the bodies of all three tables; no shuffle, as they have the same buckets."""
        t3, t2, t1 = (self.spark.table(name).select("shard", F.col("body").alias(kind)) for (name, _), kind in zip(self.tables, ("t3", "t2", "t1"), strict=True))
        return t3.join(t2, "shard").join(t1, "shard")

    def drop(self) -> None:
        """Delete the tables, when everything is scored."""
        _dropped(self.spark, self.tables)


def _dropped(spark: SparkSession, tables: list[tuple[str, str]]) -> None:
    for name, path in tables:
        spark.sql(f"drop table if exists {name}")
        discard(spark, path)


def _kept(rows: DataFrame, kind: str, plan: Plan) -> tuple[str, str]:
    """Name and path of the rows of a kind as a table in buckets of shards."""
    spark = rows.sparkSession
    name, path = f"quern_{kind}_{uuid.uuid4().hex}", scratch_path(spark, kind)
    kept = rows.where(F.col("kind") == kind).select("shard", "body", "n1", "n2", "n3", "n4", "total", "classes")
    with shuffles_freed(spark):
        kept.write.format("parquet").bucketBy(min(plan.shards, MOST_BUCKETS), "shard").sortBy("shard").option("path", path).saveAsTable(name)
    return name, path


def train(texts: DataFrame, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES, slices: int = SLICES, slice_bytes: int = SLICE_BYTES) -> Model | None:
    """The model of the column ``text``; None without any word."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = pieces(size, max(1, 2 * slices // 3), slice_bytes // 2)
    busy = min(2 * parts * spark.sparkContext.defaultParallelism, -(-size // LEAST_BYTES))  # shards that keep all cores busy
    plan = Plan(max(1, -(-size // shard_bytes), busy), 1)
    plan.slices = min(plan.shards, parts)

    def made(rows: DataFrame, path: str) -> None:
        with shuffles_freed(spark):
            rows.write.mode("append").partitionBy("kind", "slice").parquet(path)

    def read(path: str) -> DataFrame:
        return spark.read.schema(_MADE).parquet(path)

    third, second = scratch_path(spark, "trigrams"), scratch_path(spark, "bigrams")
    for k in range(plan.slices):
        made(_count_trigrams(texts, plan, k, block_bytes), third)
    tables = [_kept(read(third), "t3", plan)]
    discard(spark, f"{third}/kind=t3")
    for k in range(plan.slices):
        more = read(third).where(f"kind = 'u2' and slice = {k}")
        made(_count_bigrams(texts, more, plan, k, block_bytes), second)
        discard(spark, f"{third}/kind=u2/slice={k}")
    tables.append(_kept(read(second), "t2", plan))
    discard(spark, f"{second}/kind=t2")
    tables.append(_kept(_count_words(read(second).where("kind = 'u1'"), plan), "t1", plan))
    discard(spark, second)

    parts = [spark.table(name).select(F.lit(k).alias("k"), "n1", "n2", "n3", "n4", "total") for k, (name, _) in enumerate(tables)]
    rows = reduce(DataFrame.unionByName, parts).groupBy("k").agg(*(F.sum(x) for x in ("n1", "n2", "n3", "n4", "total"))).orderBy("k").collect()  # a row per table
    sums = [[int(x) for x in r[1:]] for r in rows]
    classes = spark.table(tables[2][0]).select(F.posexplode("classes")).groupBy("pos").agg(F.sum("col")).toPandas()  # CLASSES rows
    if not sums[0][4]:
        _dropped(spark, tables)
        return None
    d3, d2, d1 = (discounts(s[:4]) for s in sums)
    words = np.zeros(CLASSES)
    words[classes.iloc[:, 0].to_numpy()] = classes.iloc[:, 1].to_numpy()
    n_words, (once, twice, *_, total) = int(words.sum()), sums[2]
    rest = (d1[1] * once + d1[2] * twice + d1[3] * (n_words - once - twice)) / total
    return Model(spark, plan, tables, d3, d2, d1, total, rest, (words + 1) / (n_words + CLASSES))


# scoring


def _tokens(rows: DataFrame, limit: int) -> DataFrame:
    """Blocks of texts (columns key, of 16 bytes, and text): keys, sizes, words with classes, and each token's word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            keys = batch.column("key").to_pylist()
            for a, b in blocks(offsets, limit):
                part = offsets[a : b + 1]
                found = tokens_of(data[part[0] : part[-1]], part - part[0])
                word, place = placed(found.token)
                at = np.zeros(len(word), np.int64)
                at[place] = np.arange(len(place))
                cells = [b"".join(keys[a:b]), dump([np.diff(found.first)], False), dump([word, found.classes(at)]), dump([place], False)]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in cells], ["b1", "b2", "b3", "b4"])

    return rows.select("key", "text").mapInArrow(run, "b1 binary, b2 binary, b3 binary, b4 binary").withColumn("block", F.monotonically_increasing_id())


class _Block:
    """The n-grams of a block: different trigrams, bigrams (contexts, too) and words, ascending, and which of them each token has."""

    def __init__(self, sizes: bytes, words: bytes, places: bytes) -> None:
        self.sizes = load(sizes, 1, False)[0].astype(np.int64)
        word, self.classes = load(words, 2)
        self.place = load(places, 1, False)[0].astype(np.int64)
        first = np.concatenate([[0], np.cumsum(self.sizes)])
        token = word[self.place]
        self.words = np.union1d(word, np.array([START], U))
        self.w = np.searchsorted(self.words, word)[self.place]
        self.v = before(self.w, first, int(np.searchsorted(self.words, START)))
        key = pair(self.words[self.v], token)
        self.bigrams, at = placed(np.append(key, BEGIN))
        self.bigram = at[:-1]
        self.context = before(self.bigram, first, int(at[-1]))
        self.trigrams, self.trigram = placed(pair(self.bigrams[self.context], token))


def different(sizes: bytes, words: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trigrams, bigrams and words of a ``_Block``, without the places of its tokens among them."""
    word = load(words, 2)[0]
    token = word[load(places, 1, False)[0].astype(np.int64)]
    first = np.concatenate([[0], np.cumsum(load(sizes, 1, False)[0].astype(np.int64))])
    below = pair(before(token, first, START), token)
    trigrams = _sorted_once(pair(before(below, first, BEGIN), token))
    return trigrams, _sorted_once(np.append(below, BEGIN)), np.union1d(word, np.array([START], U))


def _sorted_once(keys: np.ndarray) -> np.ndarray:
    """Different keys, ascending; sorting keys alone takes a part of the time of sorting their places."""
    keys = np.sort(keys)
    return keys[np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]])]


def _requests(tokens: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked: dict[int, dict[str, bytes]] = {}
                for name, keys in zip(("b3", "b2", "b1"), different(row["b2"], row["b3"], row["b4"]), strict=True):
                    for s, x in cut([keys], shards):
                        asked.setdefault(s, {})[name] = dump(x)
                cells = [pa.array([x.get(name) for x in asked.values()], pa.binary()) for name in ("b1", "b2", "b3")]
                yield pa.RecordBatch.from_arrays([pa.array(list(asked), pa.int32()), pa.array([row["block"]] * len(asked), pa.int64()), *cells], ["shard", "block", "b1", "b2", "b3"])

    return tokens.select("block", "b2", "b3", "b4").mapInArrow(run, "shard int, block long, b1 binary, b2 binary, b3 binary")


_ANSWER = "block long, shard int, b1 binary, b2 binary, b3 binary"


def _answered(model: pa.Table, asked: pa.Table) -> pa.Table:
    """What a shard knows of the n-grams it is asked for, in their order."""
    tables = {"b3": load(model.column("t3")[0].as_py(), 2), "b2": load(model.column("t2")[0].as_py(), 6), "b1": load(model.column("t1")[0].as_py(), 6)}

    def answer(name: str, body: bytes | None) -> bytes | None:
        if body is None:
            return None
        (key,), (keys, *values) = load(body, 1), tables[name]
        at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
        known = keys[at] == key if len(keys) else np.zeros(len(key), bool)
        return dump([np.where(known, x[at] if len(x) else U(0), U(0)) for x in values], False)

    cells = [pa.array([answer(name, x) for x in asked.column(name).to_pylist()], pa.binary()) for name in ("b1", "b2", "b3")]
    return pa.Table.from_arrays([asked.column("block"), asked.column("shard"), *cells], ["block", "shard", "b1", "b2", "b3"])


def _level(n: np.ndarray, d: list[float], total: np.ndarray, rest: np.ndarray, below: np.ndarray) -> np.ndarray:
    own = n.astype(float) - np.array(d)[np.minimum(n, U(3)).astype(np.int64)]
    return np.where(total > 0, own / np.maximum(total, 1.0) + rest * below, below)


def _rest(d: list[float], total: np.ndarray, by: list[np.ndarray]) -> np.ndarray:
    """What contexts leave to the order below."""
    return (d[1] * by[0] + d[2] * by[1] + d[3] * by[2]) / np.maximum(total, 1.0)


def log_probabilities(model: Model, block: _Block, tri: np.ndarray, bi: list[np.ndarray], uni: list[np.ndarray]) -> np.ndarray:
    """Each token's log-probability, from the counts of the block's n-grams."""
    own = (uni[0].astype(float) - np.array(model.d1)[np.minimum(uni[0], U(3)).astype(np.int64)])[block.w] / model.total1
    # what known words leave goes to unknown ones, an event for each class
    p1 = np.where((uni[0] > 0)[block.w], own, model.rest1 * model.base[block.classes.astype(np.int64)[block.place]])
    total2, total3 = uni[1].astype(float), bi[1].astype(float)
    rest2, rest3 = _rest(model.d2, total2, uni[2:]), _rest(model.d3, total3, bi[2:])
    p2 = _level(bi[0][block.bigram], model.d2, total2[block.v], rest2[block.v], p1)
    return np.log(_level(tri[block.trigram], model.d3, total3[block.context], rest3[block.context], p2))


def score(rows: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES, slices: int = SLICES, slice_bytes: int = SLICE_BYTES, piece_bytes: int = 0) -> DataFrame:
    """(key, n, nll) for each different text of ``rows`` (key, spread, text): tokens and negative log-probability.

    ``key`` must be 16 bytes; rows of one key must have one text. ``spread``
    is a number that deals the rows over slices. ``piece_bytes`` is the text
    whose requests a shard answers at a time (a shard's own size if 0).
    """
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = pieces(size, slices, slice_bytes)
    tasks = max(2 * model.spark.sparkContext.defaultParallelism, size // slices // SHARD_BYTES)
    plain = {x: getattr(model, x) for x in ("plan", "tables", "d3", "d2", "d1", "total1", "rest1", "base")}

    def finish(table: pa.Table) -> pa.Table:
        known = sorted(table.to_pylist(), key=lambda r: r["shard"])
        head, answers = known[0], known[1:]
        block = _Block(head["b2"], head["b3"], head["b4"])

        def joined(name: str, n: int) -> list[np.ndarray]:
            parts = [load(r[name], n, False) for r in answers if r[name] is not None]
            return [np.concatenate([np.zeros(0, U), *(p[k] for p in parts)]) for k in range(n)]

        log_p = log_probabilities(Model(None, **plain), block, joined("b3", 1)[0], joined("b2", 5), joined("b1", 5))
        cuts = np.concatenate([[0], np.cumsum(block.sizes)])
        nll = [-float(log_p[a:b].sum()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        keys = [head["b1"][i : i + 16] for i in range(0, len(head["b1"]), 16)]
        return pa.table({"key": pa.array(keys, pa.binary()), "n": pa.array(block.sizes), "nll": pa.array(np.round(nll, 6))})

    # requests for a shard are dealt in pieces, so that a group stays as small however much more text there is than the model has
    many = -(-size // slices // (model.plan.shards * (piece_bytes or SHARD_BYTES))) or 1
    by = ["shard", "piece"]
    shards = model.rows().withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(many - 1)))) if many > 1 else model.rows()
    parts = None
    for k in range(slices):
        own = rows.where(F.pmod("spread", F.lit(slices)) == k)
        path = scratch_path(model.spark, "tokens")
        made = _tokens(own, block_bytes)
        made.write.parquet(path)
        tokens = model.spark.read.schema(made.schema).parquet(path)
        asked = _requests(tokens, model.plan.shards)
        if many > 1:
            answers = shards.groupBy(*by).cogroup(asked.withColumn("piece", F.pmod("block", F.lit(many)).cast("int")).groupBy(*by)).applyInArrow(_answered, _ANSWER)
        else:
            answers = shards.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(_answered, _ANSWER)
        both = answers.withColumn("b4", F.lit(None).cast("binary")).unionByName(tokens.withColumn("shard", F.lit(-1)))
        dealt = both.repartition(tasks, "block")
        found = dealt.groupBy("block").applyInArrow(finish, "key binary, n long, nll double")
        part = written(found, "scores")
        discard(model.spark, path)
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("key").agg(F.min("n").alias("n"), F.min("nll").alias("nll"))
