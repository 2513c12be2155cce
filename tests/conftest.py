"""One local session for all tests, and DuckDB over the same tables."""

from __future__ import annotations

import math
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
sys.path.insert(0, str(ROOT))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "3g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = f"{SF_DIR}/{name}.parquet"
        con.execute(f"create view {name} as select * from '{path}/*.parquet'" if os.path.isdir(path) else f"create view {name} as select * from '{path}'")
    return con


def plain(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return f"[{','.join(map(plain, value))}]"
    if isinstance(value, dict):
        return f"{{{','.join(f'{k}:{plain(v)}' for k, v in sorted(value.items()))}}}"
    return str(value)


def same_rows(spark, duck, query, sql: str) -> None:
    df = query(spark, SF_DIR)
    names = sorted(df.columns)
    ours = sorted(tuple(plain(v) for v in (r.asDict(True)[n] for n in names)) for r in df.collect())
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    theirs = sorted(tuple(plain(r[columns.index(n)]) for n in names) for r in result.fetchall())
    assert ours == theirs
