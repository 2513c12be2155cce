"""The session's parallelism and its shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors share.

    Only a local session may leave that setting out; it then gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='quern-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def spread(df: DataFrame, tasks: int = 0) -> DataFrame:
    """``df``, dealt over all cores, or ``tasks`` if they are more, if its scan has fewer partitions.

    A small file of one row group is a single partition, however costly its
    rows are, and one with short rows has few partitions, however many they
    are. A scan of many files is left as it is.
    """
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, tasks)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, for results that are used more than once; it goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quern-{label}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, rows: int = 100_000) -> bool:
    """Whether a table has no more than so many rows; it is read up to there."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df``, marked for broadcasting if it has no more than so many rows."""
    return F.broadcast(df) if is_small(df, rows) else df
