"""What the query modules share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.session import spread

#: A task has no more rows than these where the work is heavy per row.
TASK_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table for work that is heavy per row: dealt over all cores, and over as many tasks as its rows ask for."""
    df = table(spark, sf_dir, name)
    return spread(df, -(-df.count() // TASK_ROWS))
