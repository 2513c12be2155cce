"""Sharding by proportional stratified interleaving.

Rows of a source are put in a seeded random order; a row's fractional rank is
its place in that order over the number of rows of the source. Sorted by
fractional rank, every stretch of rows has the sources in proportion, so equal
cuts give shards that match the mixture and differ by one row at most.

Both rankings are spread over many tasks: a source is cut into hash buckets,
and the fractions, which are uniform, into ranges of about BUCKET_ROWS rows
each; counts of buckets give each bucket its first rank.

Defined cases: null sources form a source of their own, a null text is empty,
rows that tie in hash and id are told apart by checksum and size (identical
rows are interchangeable). Rows without id, and those of an id that a thousandth
of all rows have, are told apart by checksum, size and a number among those that
have the same, so many of them spread like others.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash60, hot_keys, salted_join, text_of, whole_row, written

BUCKET_ROWS = 5_000
#: Up to so many sources their table is broadcast; beyond, hot sources are salted.
BROADCAST_SOURCES = 100_000
BITS = 60


def _ranked(df: DataFrame, group: list[str], order: list, out: str) -> DataFrame:
    """0-based rank within ``group`` by (bucket, order): rank in the bucket plus all rows of the buckets before."""
    at = [*group, "bucket"]
    counts = df.groupBy(*at).agg(F.count("*").alias("in_bucket"))
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("first_rank", F.coalesce(F.sum("in_bucket").over(before), F.lit(0))).drop("in_bucket")
    own = df.withColumn("nth", F.row_number().over(Window.partitionBy(*at).orderBy(*order)) - 1)
    return own.join(firsts, at).withColumn(out, F.col("first_rank") + F.col("nth")).drop("first_rank", "nth", "bucket")


def _numbered(light: DataFrame) -> DataFrame:
    """Adds copy: rows without id, or of an id that very many have, that have one text are numbered, part of the table by part; null for others."""
    counts = written(light.groupBy("id").agg(F.count("*").alias("n")).where((F.col("n") >= 1000) | F.col("id").isNull()), "shard-ids")
    if counts.isEmpty():
        return light.withColumn("copy", F.lit(None).cast("long"))
    total = light.count()
    hot = hot_keys(counts.where("id is not null"), "id", "n", total).withColumn("many", F.lit(True))
    same = ["who", "text_crc32", "size"]
    # null stands for itself here, as all of these rows have a name
    lone = light.join(F.broadcast(hot), "id", "left").where("id is null or many").withColumn("who", F.coalesce(F.concat(F.lit("id "), F.col("id").cast("string")), F.lit("text")))
    lone = lone.select("row", *same, F.shiftrightunsigned("row", 33).alias("part"))
    before = Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = lone.groupBy(*same, "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = lone.withColumn("nth", F.row_number().over(Window.partitionBy(*same, "part").orderBy("row")))
    return light.join(own.join(counts, [*same, "part"]).select("row", (F.col("before") + F.col("nth")).alias("copy")), "row", "left")


def _placed(light: DataFrame, shards: int, seed: str) -> DataFrame:
    """Adds position, shard and slot to written rows (id, size, text_crc32, absent, name, row), whatever else they have; ``row`` is a number of a row's own."""
    light = _numbered(light)
    copies = F.concat_ws(" ", F.coalesce(F.concat(F.lit("id "), F.col("id").cast("string")), F.lit("text")), "text_crc32", "size", "copy")
    name = F.when(F.col("copy").isNull(), F.col("id").cast("string")).otherwise(copies)
    light = light.withColumn("h", hash60(F.lit(seed), name)).drop("copy")
    sources = light.groupBy("absent", "name").agg(F.count("*").alias("n_source"))
    sources = written(sources, "shard-sources")
    total, n_sources = sources.agg(F.sum("n_source"), F.count("*")).first()
    total = total or 0

    key = ["absent", "name"]
    if n_sources <= BROADCAST_SOURCES:
        light = light.join(F.broadcast(sources), key)
    else:
        light = salted_join(light, sources, key, hot_keys(sources, key, "n_source", total), F.col("h"))
    buckets = F.ceil(F.col("n_source") / BUCKET_ROWS)
    light = light.withColumn("bucket", F.floor(F.col("h") / F.lit(float(1 << BITS)) * buckets))
    ranked = _ranked(light, ["absent", "name"], ["h", "id", "text_crc32", "size", "row"], "rank")
    fraction = (2 * F.col("rank") + 1).cast("double") / (2 * F.col("n_source")).cast("double")
    ranked = written(ranked.withColumn("fraction", fraction), "shard-ranked")
    ranges = max(1, -(-total // BUCKET_ROWS))
    ranked = ranked.withColumn("bucket", F.floor(F.col("fraction") * ranges))
    placed = _ranked(ranked, [], ["fraction", "absent", "name"], "position")
    n = max(1, total)
    placed = placed.withColumn("shard", F.expr(f"cast(position * {shards} div {n} as int)"))
    first = F.expr(f"(cast(shard as bigint) * {n} + {shards - 1}) div {shards}")
    return placed.withColumn("slot", F.col("position") - first)


def _light(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    text = text_of(docs, text_col)
    return [
        docs[id_col].alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        docs[source_col].isNull().cast("int").alias("absent"),
        F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("name"),
        F.monotonically_increasing_id().alias("row"),
    ]


def shard(docs: DataFrame, shards: int = 24, seed: str = "shard", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, source, position, shard and slot."""
    placed = _placed(written(docs.select(*_light(docs, id_col, text_col, source_col)), "shard-light"), shards, seed)
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", F.when(F.col("absent") == 0, F.col("name")).alias(source_col), "position", "shard", "slot")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write ``docs`` with their slot, one folder per shard."""
    sharded(docs, **options).write.partitionBy("shard").parquet(path)


def sharded(docs: DataFrame, shards: int = 24, seed: str = "shard", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with the columns shard and slot. Each row keeps its own place, however many are equal: rows are numbered as they are written."""
    bare = docs.drop("shard", "slot")
    rows = written(docs.select(*_light(docs, id_col, text_col, source_col), whole_row(bare).alias("whole")), "shard-rows")
    places = _placed(rows.drop("whole"), shards, seed).select(F.col("row").alias("__row"), "shard", "slot")
    return rows.select("row", "whole").join(places, F.col("row") == F.col("__row")).select("whole.*", "shard", "slot")
