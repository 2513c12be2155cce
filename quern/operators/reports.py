"""Aggregate reports: completeness, histograms, verification of copies, method shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.session import stored


def completeness(df: DataFrame, table: str, defaults: dict[str, object] | None = None) -> DataFrame:
    """One row per column of ``df``: total, nulls, empties, defaults (set but equal to the default), populated and its rate in percent.

    A value counts once: an empty text is empty even if that is the default.
    """
    defaults = defaults or {}
    aggs = [F.count("*").alias("total")]
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        empty = (col == "") if kind == "string" else F.lit(False)
        aggs += [
            F.count_if(col.isNull()).alias(f"{name}__null"),
            F.count_if(empty).alias(f"{name}__empty"),
            (F.count_if((col == F.lit(defaults[name])) & ~empty) if name in defaults else F.lit(0).cast("long")).alias(f"{name}__default"),
        ]
    one = df.agg(*aggs)
    fields = F.array(*(F.struct(F.lit(n).alias("field"), F.col(f"`{n}__null`").alias("nulls"), F.col(f"`{n}__empty`").alias("empties"), F.col(f"`{n}__default`").alias("defaults")) for n in df.columns))
    out = one.select("total", F.inline(fields)).withColumn("populated", F.expr("total - nulls - empties - defaults"))
    rate = F.when(F.col("total") > 0, F.round(100.0 * F.col("populated") / F.col("total"), 2)).otherwise(0.0)
    return out.select(F.lit(table).alias("table_name"), "field", "total", "nulls", "empties", "defaults", "populated", rate.alias("rate"))


def completeness_of(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (completeness(df, name) for name, df in tables.items()))


def histogram(df: DataFrame, value: str, bins_per_unit: int = 10) -> DataFrame:
    """Dense bins [lo, hi) of equal width from the least to the greatest value: bin, lo, hi and n (0 for empty bins); nulls are left out."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.floor(F.col(value) * bins_per_unit).alias("bin")).agg(F.count("*").alias("n"))
    counts = stored(counts, "bins")  # a row per bin, used twice
    span = counts.agg(F.min("bin").alias("a"), F.max("bin").alias("b")).where("a is not null")
    dense = span.select(F.explode(F.sequence("a", "b")).alias("bin")).join(counts, "bin", "left")
    return dense.select("bin", (F.col("bin") / bins_per_unit).alias("lo"), ((F.col("bin") + 1) / bins_per_unit).alias("hi"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def compare_counts(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows in the old and in the new state (null where a table is missing) and whether they are as many."""
    count = lambda of, name: reduce(DataFrame.unionByName, (df.agg(F.count("*").alias(name)).withColumn("table_name", F.lit(t)) for t, df in of.items()))
    both = count(old, "old_rows").join(count(new, "new_rows"), "table_name", "full_outer")
    return both.select("table_name", "old_rows", "new_rows", F.col("old_rows").eqNullSafe(F.col("new_rows")).alias("matches"))


def all_match(compared: DataFrame) -> DataFrame:
    return compared.agg(F.bool_and("matches").alias("all_match"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per value (null is one) and their share in percent."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    share = F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2)
    return counts.withColumn("share", share)


def share_at_least(df: DataFrame, column: str, value, percent: float = 95.0) -> DataFrame:
    """One row: whether a value makes up ``percent`` of the rows that have any."""
    hit = 100.0 * F.count_if(F.col(column) == value) / F.count(column)
    return df.agg(F.round(hit, 2).alias("share"), F.coalesce(hit >= percent, F.lit(False)).alias("enough"))


def numeric_stats(df: DataFrame, column: str, digits: int = 3) -> DataFrame:
    """Count, mean, least and greatest of what can be read as numbers in a column."""
    from quern.functions.convert import lenient_double

    x = lenient_double(F.col(column))
    return df.agg(F.count(x).alias("n"), F.round(F.avg(x), digits).alias("mean"), F.round(F.min(x), digits).alias("least"), F.round(F.max(x), digits).alias("greatest"))
