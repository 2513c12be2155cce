"""Incremental maintenance: new and known items, merges, change records, replacement of children."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_items(listing: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return listing.join(known.select(key), key, "left_anti")


def known_items(listing: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return listing.join(known.select(key), key, "left_semi")


def above_mark(listing: DataFrame, stored: DataFrame, column: str) -> DataFrame:
    """Items after the greatest stored value: all, if nothing is stored."""
    mark = stored.agg(F.max(column)).scalar()
    return listing.where(mark.isNull() | (F.col(column) > mark))


def merge(old: DataFrame, new: DataFrame, key: str, frozen: str | None = None) -> DataFrame:
    """``old`` updated and extended by ``new``: new values win unless null; rows for which ``frozen`` (an expression over old's columns) holds don't change."""
    names = [c for c in old.columns if c != key]
    keep = F.coalesce(F.expr(frozen), F.lit(False)) if frozen else F.lit(False)
    left = old.select(key, *(F.col(c).alias(f"o_{c}") for c in names), F.lit(True).alias("__old"), keep.alias("__frozen"))
    right = new.select(key, *(F.col(c).alias(f"n_{c}") for c in names))
    both = left.join(right, key, "full_outer")
    return both.select(key, *(F.when(F.col("__frozen"), F.col(f"o_{c}")).otherwise(F.coalesce(f"n_{c}", f"o_{c}")).alias(c) for c in names))


def changes(old: DataFrame, new: DataFrame, key: str, watched: list[str], frozen: str | None = None) -> DataFrame:
    """One row per key that is new or has changed: kind (new, changed, removed) and the names of changed columns; frozen rows never change."""
    keep = F.coalesce(F.expr(frozen), F.lit(False)) if frozen else F.lit(False)
    left = old.select(key, *(F.col(c).alias(f"o_{c}") for c in watched), F.lit(True).alias("__old"), keep.alias("__frozen"))
    right = new.select(key, *(F.col(c).alias(f"n_{c}") for c in watched), F.lit(True).alias("__new"))
    both = left.join(right, key, "full_outer")
    diff = F.filter(F.array(*(F.when(~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")), c) for c in watched)), lambda x: x.isNotNull())
    kind = F.when(F.col("__old").isNull(), "new").when(F.col("__new").isNull(), "removed").when(~F.col("__frozen") & (F.size(diff) > 0), "changed")
    return both.withColumn("kind", kind).where("kind is not null").select(key, "kind", F.when(F.col("kind") == "changed", F.array_join(diff, ",")).otherwise("").alias("columns"))


def change_summary(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row: how many keys are new, in both, and gone."""
    a, b = old.select(key).distinct().withColumn("o", F.lit(1)), new.select(key).distinct().withColumn("n", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.agg(F.count_if(F.col("o").isNull()).alias("new_keys"), F.count_if(F.col("o").isNotNull() & F.col("n").isNotNull()).alias("kept_keys"), F.count_if(F.col("n").isNull()).alias("removed_keys"))


def replace_children(children: DataFrame, fresh: DataFrame, parent: str) -> DataFrame:
    """All children of the parents in ``fresh`` replaced by those of ``fresh``."""
    return children.join(fresh.select(parent).distinct(), parent, "left_anti").unionByName(fresh, allowMissingColumns=True)


BUCKETS = 64


def _latest(spark, path: str) -> tuple[int, dict[str, str]]:
    """Number and content (folder of each bucket) of the table's last manifest; 0 and nothing for a table that isn't there yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = at(f"{path}/_manifests")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
    last = max((int(n) for n in names if n.isdigit()), default=0)
    if not last:
        return 0, {}
    return last, json.loads("".join(r.value for r in spark.read.text(f"{path}/_manifests/{last}").collect()))


def read_merged(spark, path: str) -> DataFrame:
    """The table that ``write_merge`` keeps under a path."""
    last, folders = _latest(spark, path)
    if not last:
        raise FileNotFoundError(path)
    return spark.read.schema(folders["schema"]).parquet(*(f"{path}/{f}" for k, f in folders.items() if k.isdigit()))


def write_merge(spark, path: str, new: DataFrame, key: str, frozen: str | None = None, buckets: int = BUCKETS) -> None:
    """Merge into a table of Parquet folders, one per hash bucket of the key.

    Only buckets that ``new`` has keys of are read and written again, in new
    folders; a manifest that names the folders in force is put in place by one
    rename, so a crash leaves the table as it was, and readers see one state.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last, folders = _latest(spark, path)
    of = F.pmod(F.xxhash64(F.col(key)), F.lit(folders.get("buckets", buckets))).cast("int")
    touched = sorted(r[0] for r in new.select(of.alias("b")).distinct().collect())  # as many as there are buckets at most
    if not touched:
        return
    before = [f"{path}/{folders[str(b)]}" for b in touched if str(b) in folders]
    rows = merge(spark.read.schema(folders["schema"]).parquet(*before), new, key, frozen) if before else new.select(folders["columns"]) if last else new
    fresh = f"v{last + 1}-{uuid.uuid4().hex}"
    rows.withColumn("__bucket", of).write.partitionBy("__bucket").parquet(f"{path}/{fresh}")
    now = folders | {str(b): f"{fresh}/__bucket={b}" for b in touched}
    now |= {"buckets": folders.get("buckets", buckets), "columns": folders.get("columns", rows.columns), "schema": folders.get("schema", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema))}
    temporary = f"{path}/_manifests/_{fresh}"
    out = fs.create(at(temporary))
    out.write(bytearray(json.dumps(now).encode()))
    out.close()
    if not fs.rename(at(temporary), at(f"{path}/_manifests/{last + 1}")):
        raise RuntimeError(f"{path} was changed by someone else meanwhile")
