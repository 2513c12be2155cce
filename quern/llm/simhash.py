"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints within radius r differ in at most r bits. Each bit gets a nonzero
vector of r + 1 bits, and each nonzero vector v gives a mask of those bits whose
vector has odd product with v: 2^(r+1) - 1 tables. The vectors of at most r
differing bits leave some v orthogonal to all of them, so a pair within the
radius agrees on all bits of some mask: no pair is lost.

Only distinct fingerprints enter the tables. Buckets are read in sorted order
as a stream; within one, members are linked by a search that compares each
member with those not reached yet, so a dense bucket costs little more than
its size, a sparse one the square of at most ``max_bucket`` words, and a bucket
gives fewer links than members. A bucket of more than
``max_bucket`` members goes to a second family of masks over the bits that are
still free, whose buckets can hold 2^16 fingerprints or so at most.

Defined cases: null and blank texts have fingerprint 0 and are linked as any
other; a text of fewer words than a shingle is one shingle; repeated ids are
separate rows of one component; a null id is never a component's smallest id
unless all its ids are null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, kept_rows, salted_join, text_of, written
from .components import components
from .kernels import LOWER, SOLID, U, blocks, column_bytes, padded, split_words, xxh64_ranges

SHINGLE, RADIUS, SEED = 4, 4, 42
MAX_BUCKET = 16_384


def fingerprints_of(buf: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text of a buffer."""
    out = np.zeros(len(offsets) - 1, U)
    starts, ends, first = split_words(buf, offsets, SOLID)
    if not len(starts):
        return out
    low, size = LOWER[buf], ends - starts
    # words side by side with one space after each
    stop = np.cumsum(size + 1)
    at = stop - size - 1
    line = padded(padded(low)[np.arange(stop[-1]) + np.repeat(starts - at, size + 1)])
    line[stop - 1] = 32
    n_words = np.diff(first)
    n_of = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    doc = np.repeat(np.arange(len(n_of)), n_of)
    begin = np.cumsum(n_of) - n_of
    word = first[doc] + np.arange(len(doc)) - begin[doc]
    end_word = np.minimum(word + shingle, first[doc + 1]) - 1
    h = xxh64_ranges(line, at[word], stop[end_word] - 1, seed)
    some = np.flatnonzero(n_of)
    cuts, half = begin[some], n_of[some].astype(U)
    bits = np.zeros(len(some), U)
    both = U((1 << 32) | 1)
    for k in range(32):  # bits k and k + 32 at once; each half counts to 2^32
        sums = np.add.reduceat((h >> U(k)) & both, cuts)
        bits |= ((sums & U(0xFFFFFFFF)) * U(2) > half).astype(U) << U(k)
        bits |= ((sums >> U(32)) * U(2) > half).astype(U) << U(k + 32)
    out[some] = bits
    return out


def _with_fingerprints(rows: DataFrame, shingle: int, seed: int) -> DataFrame:
    """``rows`` with fp in place of their column text."""
    kept = [x for x in rows.columns if x != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            fps = [np.zeros(0, U)]
            for a, b in blocks(offsets):
                part = offsets[a : b + 1]
                fps.append(fingerprints_of(data[part[0] : part[-1]], part - part[0], shingle, seed))
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), pa.array(np.concatenate(fps).view(np.int64))], [*kept, "fp"])

    kinds = ", ".join(f"{x} {rows.schema[x].dataType.simpleString()}" for x in kept)
    return rows.mapInArrow(run, f"{kinds}, fp long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fp) for each row; fp is the 64 bits of the fingerprint as a bigint."""
    return _with_fingerprints(docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text")), shingle, seed)


def covering_masks(radius: int, turn: int = 1) -> list[int]:
    """2^(radius+1) - 1 masks over 64 bits; ``turn`` gives another assignment of vectors to bits."""
    n = (1 << (radius + 1)) - 1
    vector = [(i * turn + (i // n) * (turn - 1) * 3) % n + 1 for i in range(64)]
    return [sum(1 << i for i in range(64) if (vector[i] & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def local_links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, least member) for each further member of the components of distinct fingerprints."""
    out, rest = [], np.sort(fps)
    while len(rest):
        root, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count((rest ^ queue.pop()).view(U)) <= radius
            if near.any():
                found = rest[near]
                out += [(int(x), int(root)) for x in found]
                queue += list(found)
                rest = rest[~near]
    return out


def _bucket_links(keyed: DataFrame, key: list[str], radius: int, limit: int | None) -> DataFrame:
    """Links within buckets (a, b), and as (t, k, a) with b null the members of buckets of over ``limit`` members."""
    n_keys = len(key)

    def flush(parts: list[np.ndarray]) -> list[tuple[int, int]]:
        fps = np.concatenate(parts)
        return local_links(fps, radius) if len(fps) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the open bucket
        held_key, size, over = None, 0, False
        links: list[tuple[int, int]] = []
        spill: list[tuple[np.ndarray, tuple]] = []

        def out() -> pa.RecordBatch:
            a = np.array([x[0] for x in links], np.int64)
            b = np.array([x[1] for x in links], np.int64)
            t = np.concatenate([np.zeros(0, np.int64), *(np.full(len(x), k[0], np.int64) for x, k in spill)])
            k2 = np.concatenate([np.zeros(0, np.int64), *(np.full(len(x), k[1], np.int64) for x, k in spill)])
            more = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in spill)])
            none = pa.nulls(len(a), pa.int64())
            cols = [
                pa.chunked_array([none, pa.array(t)]).combine_chunks(),
                pa.chunked_array([none, pa.array(k2)]).combine_chunks(),
                pa.array(np.concatenate([a, more])),
                pa.chunked_array([pa.array(b), pa.nulls(len(more), pa.int64())]).combine_chunks(),
            ]
            links.clear()
            spill.clear()
            return pa.RecordBatch.from_arrays(cols, ["t", "k", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(n_keys + 1)]
            fps = cols[-1]
            new = np.zeros(len(fps), bool)
            for c in cols[:-1]:
                new[1:] |= c[1:] != c[:-1]
            new[0] = held_key is None or any(int(c[0]) != x for c, x in zip(cols[:-1], held_key, strict=True))
            cuts = np.flatnonzero(new)
            edges = np.concatenate([[0] if not new[0] else [], cuts, [len(fps)]]).astype(np.int64)
            sizes = np.diff(edges)
            # whole buckets of two, all at once
            pair = np.flatnonzero(sizes == 2)
            pair = pair[(edges[pair] > 0) & (edges[pair] + 2 < len(fps))] if len(pair) else pair
            at = edges[pair]
            x, y = fps[at], fps[at + 1]
            close = np.bitwise_count((x ^ y).view(U)) <= radius
            links += list(zip(np.maximum(x, y)[close].tolist(), np.minimum(x, y)[close].tolist(), strict=True))
            done = np.zeros(len(sizes), bool)
            done[pair] = True
            done[1:-1] |= sizes[1:-1] == 1
            for i in np.flatnonzero(~done):
                a, b = edges[i], edges[i + 1]
                if new[a]:
                    if held and not over:
                        links += flush(held)
                    held, size, over = [], 0, False
                    held_key = tuple(int(c[a]) for c in cols[:-1])
                held.append(fps[a:b].copy())
                size += b - a
                if limit is not None and size > limit:
                    over = True
                    spill += [(part, held_key) for part in held]
                    held = []
            yield out()
        if held and not over:
            links += flush(held)
        yield out()

    return keyed.repartition(*key).sortWithinPartitions(*key, "fp").select(*key, "fp").mapInArrow(run, "t long, k long, a long, b long")


def near_links(fps: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join all pairs within the radius."""
    masks = covering_masks(radius)
    tables = F.array(*(F.struct(F.lit(t).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for t, m in enumerate(masks)))
    found = written(_bucket_links(fps.select("fp", F.inline(tables)), ["t", "k"], radius, max_bucket), "bucket-links")
    links, over = found.where("b is not null").select("a", "b"), found.where("b is null")
    if over.isEmpty():
        return links
    finer = covering_masks(radius, turn=5)
    first = F.element_at(F.array(*(F.lit(_signed(m)) for m in masks)), (F.col("t") + 1).cast("int"))
    again = F.array(*(F.struct(F.lit(j).cast("long").alias("u"), F.col("a").bitwiseAND(first.bitwiseOR(F.lit(_signed(m)))).alias("k2")) for j, m in enumerate(finer)))
    keyed = over.select("t", F.col("a").alias("fp"), F.inline(again))
    return links.unionByName(_bucket_links(keyed, ["t", "u", "k2"], radius, None).select("a", "b").where("b is not null"))


def _members(nodes: DataFrame, radius: int, max_bucket: int) -> DataFrame:
    """(fp, root) for the fingerprints that have links."""
    roots = written(components(near_links(nodes.select("fp"), radius, max_bucket)), "roots")
    return roots.select(F.col("node").alias("fp"), "root").unionByName(roots.select(F.col("root").alias("fp"), "root").distinct())


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row per row of ``docs``: id, fp and component_id, the smallest id that links reach."""
    rows = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("least_id"), F.count("*").alias("n")), "fp-nodes")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    members = _members(nodes, radius, max_bucket)
    members = written(members.join(nodes.select("fp", "least_id"), "fp"), "members")
    by_root = written(members.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("n")), "by-root")
    n_members = by_root.agg(F.sum("n")).first()[0] or 0
    linked = salted_join(members.select("fp", "root"), by_root.drop("n"), "root", hot_keys(by_root, "root", "n", n_members), F.col("fp")).select("fp", "component_id")
    named = nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least_id").alias("component_id"))
    out = salted_join(rows, named, "fp", hot_keys(nodes, "fp", "n", total), F.xxhash64("id"))
    return out.select(F.col("id").alias(id_col), "fp", "component_id")


def near_deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id, null last; of rows that repeat it, that whose id and text have the smallest hash."""
    text = text_of(docs, text_col)
    key = F.xxhash64(docs[id_col], text)
    rows = _with_fingerprints(docs.select(docs[id_col].alias("id"), key.alias("key"), text.alias("text")), shingle, seed)
    best = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "key"))
    nodes = written(rows.groupBy("fp").agg(best.alias("best")), "fp-nodes")
    rooted = nodes.join(_members(nodes, radius, max_bucket), "fp", "left")
    stay = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best")).select(F.col("best.id").alias("__id"), F.col("best.key").alias("__key"))
    return kept_rows(docs, docs[id_col], key, stay.withColumnsRenamed({"__id": "id", "__key": "key"}))
