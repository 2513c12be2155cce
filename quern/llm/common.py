"""Shared pieces: scratch tables, hot keys and salted joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import shared_folder

#: A key is hot from this share of all rows on, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 1000
SALTS = 32


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/quern-{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder before the application ends."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run in here delete their shuffle files as they end; for those whose result is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else key


def hot_keys(counts: DataFrame, key: str | list[str], n: str, total: int) -> DataFrame:
    """Keys with at least HOT_SHARE of ``total`` rows (and 1000): at most 1000 of them, so they may be broadcast."""
    return counts.where(F.col(n) >= max(1000, int(total * HOT_SHARE))).select(*_keys(key))


def salted_join(left: DataFrame, right: DataFrame, key: str | list[str], hot: DataFrame, spread: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join many rows of ``left`` to the one row of ``right`` that has their ``key``.

    ``hot`` holds the keys (at most 1 / HOT_SHARE) whose left rows are dealt
    over ``salts`` partitions by ``spread``; the right row is repeated for them.
    """
    key = _keys(key)
    flag = F.broadcast(hot.select(*key).distinct().withColumn("__hot", F.lit(True)))
    left = left.join(flag, key, "left").withColumn("__salt", F.when(F.col("__hot"), F.pmod(spread, F.lit(salts)).cast("int")).otherwise(0)).drop("__hot")
    right = right.join(flag, key, "left").withColumn("__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop("__hot")
    return left.join(right, [*key, "__salt"], how).drop("__salt")


def text_of(df: DataFrame, name: str) -> Column:
    """The column as text; null counts as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no helper column can clash with one of them."""
    return F.struct(*(df[f"`{name}`"] for name in df.columns))


def kept_rows(docs: DataFrame, row_id: Column, key: Column, stay: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (id, key) of ``stay``; ids may be null, keys may not.

    Rows that many others are equal to are dealt out by salt, and each task
    drops its own copies before they are sent on.
    """
    parts = ["key", "absent", "name"]
    named = [F.col("id").isNull().alias("absent"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("name")]
    rows = docs.select(row_id.alias("id"), key.alias("key"), F.monotonically_increasing_id().alias("spread"), whole_row(docs).alias("row")).select("key", *named, "spread", "row")
    counts = rows.groupBy(*parts).agg(F.count("*").alias("n")).where(F.col("n") >= 1000)
    counts = written(counts, "copies")
    total = counts.agg(F.sum("n")).first()[0]
    stay = stay.select("key", *named)
    if total:
        kept = salted_join(rows, stay, parts, hot_keys(counts, parts, "n", total), F.col("spread"), "left_semi")
    else:
        kept = rows.join(stay, parts, "left_semi")
    return kept.dropDuplicates(parts).select("row.*")


def hash60(*parts: Column) -> Column:
    """A hash of 60 bits from MD5, which any SQL engine can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")
