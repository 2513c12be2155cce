"""Exact deduplication by skew-safe combining.

Texts are equal when they are identical after ``normalise`` (by default: no
change). Three stages combine copies and compare the full content each time:
each task combines its own rows, groups of (digest, salt) are merged, and for
hot digests the winners of all salts are combined once more. The text crosses
the network once; only rows of hot digests (at most 1000 digests) and salts
cross it a second time.

Defined cases: a null text counts as empty. Among rows that repeat both id and
text exactly one is kept. A null id is smaller than any other. An empty table
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SALTS, hot_keys, kept_rows, salted_join, text_of, whole_row, written


#: Rows of one id and text that one task writes out.
PIECE = 10_000


def sha256_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _expanded(rows: DataFrame) -> DataFrame:
    """Each row as often as its n_rows says, numbered by nth; those with many are dealt out in pieces first."""
    few = rows.where(F.col("n_rows") <= PIECE).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
    many = rows.where(F.col("n_rows") > PIECE).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_rows") - 1) / PIECE))))
    many = many.repartition("digest", "id", "piece")
    nth = F.explode(F.sequence(F.col("piece") * PIECE + 1, F.least((F.col("piece") + 1) * PIECE, F.col("n_rows"))))
    return few.unionByName(many.withColumn("nth", nth).drop("piece"))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    digest: Callable[[Column], Column] = sha256_of,
    salts: int = SALTS,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept and the text's digest.

    The copy with the largest id is kept. ``digest`` only deals rows out: texts
    that share a digest but differ stay apart.
    """
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("id"), (normalise(text) if normalise else text).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    members = written(rows.groupBy("digest", "id").agg(F.count("*").alias("n_rows")), "members")
    total = members.agg(F.sum("n_rows")).first()[0] or 0
    hot = hot_keys(members.groupBy("digest").agg(F.sum("n_rows").alias("n")), "digest", "n", total)
    hot = written(hot, "hot-digests")

    flagged = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left")
    # a task combines its own copies, whatever their ids, and deals out what is left
    salt = F.when(F.col("hot"), F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(0)
    merged = (
        flagged.groupBy("digest", salt.alias("salt"), "hot", "text")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("digest", "hot", F.when(F.col("hot"), F.col("text")).alias("text"), "keep_id", "group_size")
    )
    merged = written(merged, "salt-winners")
    of_hot = merged.where("hot").groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    winners = merged.where("hot is null").select("digest", "keep_id", "group_size").unionByName(of_hot.select("digest", "keep_id", "group_size"))

    per_digest = winners.groupBy("digest").agg(F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    per_digest = written(per_digest, "winners")
    single = per_digest.where("texts = 1").drop("texts")
    out = salted_join(members, single, "digest", hot, F.xxhash64("id"))
    shared = per_digest.where("texts > 1").select("digest")
    if not shared.isEmpty():
        # Different texts under one digest: members find their winner by the whole text.
        apart = rows.join(shared, "digest", "left_semi")
        best = apart.groupBy("text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        own = apart.groupBy("digest", "id", "text").agg(F.count("*").alias("n_rows")).join(best, "text").drop("text")
        out = out.unionByName(own.select(out.columns))
    out = _expanded(out)
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "digest")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (of rows that repeat id and text, one)."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    digest = options.get("digest", sha256_of)
    text = text_of(docs, text_col)
    text = options["normalise"](text) if options.get("normalise") else text
    stay = exact_dedup(docs, **options).where("kept").select(F.col(id_col).alias("id"), F.col("digest").alias("key"))
    if digest is sha256_of:
        return kept_rows(docs, docs[id_col], digest(text), stay)
    # texts may share a digest: equal rows are told apart by the text itself
    rows = docs.select(whole_row(docs).alias("row"), docs[id_col].alias("id"), digest(text).alias("d"), text.alias("t"))
    kept = rows.join(stay, rows["id"].eqNullSafe(stay["id"]) & (F.col("d") == F.col("key")), "left_semi")
    return kept.dropDuplicates(["id", "t"]).select("row.*")
