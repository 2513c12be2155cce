"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash of 60 bits. A source takes whole passes over its
documents and, for what is left of its target, those whose hash lies below a
threshold. Sizes are summed by source and hash bucket; the bucket in which a
budget runs out is the only one to be refined, 12 bits at a time. Nothing is
sorted by hash and no row leaves the JVM.

Defined cases: a null or blank text has size 0. Sources come in code point
order, null last, as a source of its own. Rows of one id (or, without id, of
one text) within a source share a hash and are taken together. A source whose
sizes sum to 0 takes nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash60, hot_keys, salted_join, text_of, whole_row, written

WORD = r"[^\x20\x09-\x0D]+"
BITS, STEP = 60, 12
#: Up to so many sources their table is broadcast; beyond, hot sources are salted.
BROADCAST_SOURCES = 100_000


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of sources (__key, source_size): ``total`` of all sizes shared by weight, none above ``most`` times its size.

    The common level is that of the last source, by cap over weight, that the
    budget fills up to its cap; those after it get the level times their weight.
    """
    order = Window.orderBy("__key")
    ranked = sources.withColumn("w", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", most * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("w"), "__key")
    ranked = (
        ranked.withColumn("below", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("w").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("budget", total * F.sum("source_size").over(Window.partitionBy()))
    )
    level = (F.col("budget") - F.col("below")) / F.col("open")
    ranked = ranked.withColumn("level", F.max(F.when(level * F.col("w") <= F.col("cap"), level)).over(Window.partitionBy()))
    return ranked.select("__key", "source_size", F.least(F.col("w") * F.coalesce("level", F.lit(float("inf"))), F.col("cap")).alias("target"))


def _keyed(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str) -> tuple[Column, Column]:
    """A source's key and the hash of a row."""
    same = F.coalesce(docs[id_col].cast("string"), F.concat(F.lit("text "), F.md5(text_of(docs, text_col))))
    key = F.struct(docs[source_col].isNull().alias("absent"), F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("name"))
    return key, hash60(F.lit(seed), same)


def _joined(rows: DataFrame, right: DataFrame, few: bool, hot: DataFrame) -> DataFrame:
    """``rows`` with what ``right`` has for their source (``__key``); a long table of sources is not broadcast."""
    if few:
        return rows.join(F.broadcast(right), "__key")
    return salted_join(rows, right, "__key", hot, F.col("__h"))


def _plan(light: DataFrame, weights: tuple[float, ...], total: float, most: float) -> tuple[DataFrame, bool, DataFrame]:
    """Each source's size, target, whole passes and threshold; whether the sources are few; the hot sources."""
    sources = written(light.groupBy("__key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "mix-sources")
    n_rows, n_sources = sources.agg(F.sum("n"), F.count("*")).first()
    few, hot = n_sources <= BROADCAST_SOURCES, hot_keys(sources, "__key", "n", n_rows or 0)

    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = source_targets(sources.select("__key", "source_size"), weights, total, most).withColumn("passes", passes.cast("long"))
    plan = written(plan.withColumn("rem", F.col("target") - F.col("passes") * F.col("source_size")), "mix-plan")

    found, bounds = [], plan.select("__key", "rem", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    for level in range(1, BITS // STEP + 1):
        shift = BITS - STEP * level
        inside = _joined(light, bounds, few, hot).where(F.shiftright("__h", shift + STEP) == F.col("prefix"))
        sums = inside.groupBy("__key", "rem", "before", F.shiftright("__h", shift).alias("bucket")).agg(F.sum("size").alias("s"), F.min("__h").alias("lo"), F.max("__h").alias("hi"))
        cum = F.col("before") + F.sum("s").over(Window.partitionBy("__key").orderBy("bucket"))
        edge = sums.withColumn("cum", cum).where((F.col("cum") > F.col("rem")) & (F.col("cum") - F.col("s") <= F.col("rem")))
        edge = written(edge, f"mix-edge{level}")
        prev = F.col("cum") - F.col("s")
        closer = F.col("cum") - F.col("rem") < F.col("rem") - prev
        found.append(edge.where("lo = hi").select("__key", F.when(closer, F.col("lo") + 1).otherwise(F.col("lo")).alias("threshold")))
        bounds = edge.where("lo < hi").select("__key", "rem", F.col("bucket").alias("prefix"), prev.alias("before"))
        if bounds.isEmpty():
            break
    thresholds = found[0]
    for more in found[1:]:
        thresholds = thresholds.unionByName(more)
    plan = plan.join(thresholds, "__key", "left").withColumn("threshold", F.coalesce("threshold", F.lit(1 << BITS)))
    return written(plan.drop("rem"), "mix-thresholds"), few, hot


def _copies() -> Column:
    copies = F.col("passes") + (F.col("__h") < F.col("threshold")).cast("long")
    return F.when(F.col("source_size") > 0, copies).otherwise(0).cast("long")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total: float = 1.5, most: float = 2.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies and taken (size times copies)."""
    key, h = _keyed(docs, seed, id_col, text_col, source_col)
    light = written(docs.select(docs[id_col].alias("id"), size_of(text_of(docs, text_col)).alias("size"), key.alias("__key"), h.alias("__h")), "mix-light")
    out = _joined(light, *_plan(light, weights, total, most)).withColumn("copies", _copies())
    source = F.when(~F.col("__key.absent"), F.col("__key.name"))
    return out.select(F.col("id").alias(id_col), source.alias(source_col), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total: float = 1.5, most: float = 2.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs``, each row as often as the mix takes it; the text crosses no network."""
    key, h = _keyed(docs, seed, id_col, text_col, source_col)
    light = written(docs.select(size_of(text_of(docs, text_col)).alias("size"), key.alias("__key"), h.alias("__h")), "mix-light")
    plan, few, hot = _plan(light, weights, total, most)
    plan = plan.select("__key", "source_size", "passes", "threshold").withColumnsRenamed({"source_size": "__size", "passes": "__passes", "threshold": "__threshold"})
    rows = _joined(docs.select(whole_row(docs).alias("row"), key.alias("__key"), h.alias("__h")), plan, few, hot)
    copies = F.when(F.col("__size") > 0, F.col("__passes") + (F.col("__h") < F.col("__threshold")).cast("long")).otherwise(0)
    rows = rows.withColumn("__copies", copies).where("__copies > 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select("row.*")


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")
