"""Sources and sinks on files: markdown trees, CSV and JSON reports, SQLite, Parquet."""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not
from pyspark.sql.types import StructType

from quern.schemas import SCHEMAS


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, text) of all .md files under a folder."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").option("ignoreCorruptFiles", True).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=SCHEMAS.get(schema, schema), header=True, multiLine=True, escape='"')


def read_table_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Per file the sorted ranges of a table report: file_path and ranges."""
    rows = read_csv(spark, path, "table_issues")
    pair = F.struct(F.col("table_start_line").alias("start_line"), F.col("table_end_line").alias("end_line"))
    return rows.groupBy("file_path").agg(F.array_sort(F.collect_set(pair)).alias("ranges"))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def read_pdfs(spark: SparkSession, path: str, most_bytes: int) -> DataFrame:
    """(path, length, content) of the .pdf files up to a size; larger ones are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(path)
    return files.where(F.col("length") <= most_bytes).select("path", "length", "content")


def write_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One header per file."""
    (df.orderBy(*order) if order else df).write.csv(path, header=True, escape='"')


def write_quality_csv(df: DataFrame, path: str) -> None:
    """File name, badness with four decimals and percentages with two, by file name; needs name, badness, greek_pct and latin_pct."""
    rows = df.select(
        F.col("name").alias("File Name"),
        F.printf(F.lit("%.4f"), F.col("badness")).alias("Badness"),
        F.printf(F.lit("%.2f%%"), F.col("greek_pct")).alias("Greek Percentage"),
        F.printf(F.lit("%.2f%%"), F.col("latin_pct")).alias("Latin Percentage"),
    )
    write_csv(rows, path, ["File Name"])


def write_sections(sections: DataFrame, summary: DataFrame, path: str, order: list[str]) -> None:
    """Section labels as CSV and as JSON lines, and their summary as JSON lines."""
    write_csv(sections, f"{path}/csv", order)
    sections.write.json(f"{path}/json")
    summary.write.json(f"{path}/summary")


def write_comments_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """Flat comments as CSV that spreadsheets read as UTF-8: the header opens with a byte order mark."""
    first, *rest = df.columns
    mark = chr(0xFEFF)
    write_csv(df.orderBy(*order).select(F.col(first).alias(f"{mark}{first}"), *rest), path)


def write_matches_json(references: DataFrame, matches: DataFrame, key: str, path: str) -> None:
    """References with the ARRAY of the catalogue's records that match them, as JSON lines; those without a match are left out."""
    records = matches.groupBy(key).agg(F.collect_list(F.struct(*(c for c in matches.columns if c != key))).alias("matched_data"))
    references.join(records, key).write.json(path)


def with_defaults(df: DataFrame, schema: StructType, defaults: dict) -> DataFrame:
    """The rows in a table's columns: those that are missing or null get their default, others are dropped."""
    value = lambda f: F.coalesce(F.col(f.name) if f.name in df.columns else F.lit(None), F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
    return df.select(*map(value, schema))


def copy_table(df: DataFrame, path: str, schema: StructType, defaults: dict) -> None:
    """Copy rows into a Parquet table with another schema."""
    with_defaults(df, schema, defaults).write.mode("append").parquet(path)


def write_split(df: DataFrame, valid, good: str, bad: str) -> None:
    """Valid rows to one Parquet folder, the others to another."""
    df.where(F.coalesce(valid, F.lit(False))).write.parquet(good)
    df.where(~F.coalesce(valid, F.lit(False))).write.parquet(bad)


class _Slice(InputPartition):
    def __init__(self, lo: int | None, hi: int | None):
        self.lo, self.hi = lo, hi


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _bound(value: object) -> bool:
    """Whether SQLite compares a value as Spark does; text is compared by its bytes."""
    return isinstance(value, (int, str)) or (isinstance(value, float) and value == value)


def _condition(f: Filter, names: list[str]) -> tuple[str, tuple] | None:
    """A pushed filter as SQL and the values to bind; None for one that Spark has to apply itself."""
    if isinstance(f, Not):
        inner = _condition(f.child, names)
        return inner and (f"not ({inner[0]})", inner[1])
    if len(f.attribute) != 1 or f.attribute[0] not in names:
        return None
    column = f"{_quoted(f.attribute[0])} collate binary"
    if isinstance(f, IsNull):
        return f"{column} is null", ()
    if isinstance(f, IsNotNull):
        return f"{column} is not null", ()
    if type(f) in _COMPARED and _bound(f.value):
        return f"{column} {_COMPARED[type(f)]} ?", (f.value,)
    if isinstance(f, In) and len(f.value) <= 500 and all(map(_bound, f.value)):
        return f"{column} in ({', '.join('?' * len(f.value))})", tuple(f.value)
    return None


class _SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.key = options["path"], options.get("dbtable"), options.get("key")
        self.query, self.params = options.get("query"), tuple(json.loads(options.get("params", "[]")))
        self.n, self.names = int(options.get("partitions", 1)), [f.name for f in schema]
        self.where: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keeps what SQLite can say with bound values; gives the rest back."""
        for f in filters:
            found = None if self.query else _condition(f, self.names)
            if found is None:
                yield f
            else:
                self.where.append(found)

    def partitions(self) -> list[InputPartition]:
        if self.query or not self.key or self.n == 1:
            return [_Slice(None, None)]
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            lo, hi = db.execute(f"select min({_quoted(self.key)}), max({_quoted(self.key)}) from {_quoted(self.table)}").fetchone()
        if lo is None:
            return [_Slice(None, None)]
        step = -(-(hi - lo + 1) // self.n)
        return [_Slice(a, a + step) for a in range(lo, hi + 1, step)]

    def read(self, part: _Slice) -> Iterator[tuple]:
        sql, args = self.query, self.params
        if not sql:
            where = [*self.where, *([(f"{_quoted(self.key)} >= ? and {_quoted(self.key)} < ?", (part.lo, part.hi))] if part.lo is not None else [])]
            sql = f"select {', '.join(map(_quoted, self.names))} from {_quoted(self.table)}" + (f" where {' and '.join(f'({w})' for w, _ in where)}" if where else "")
            args = tuple(x for _, values in where for x in values)
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            yield from db.execute(sql, args)


class SqliteSource(DataSource):
    """``spark.read.format("sqlite")``: options path, dbtable, and key and partitions to read ranges of an integer key at once.

    Filters on columns go to SQLite as bound values where it compares as Spark
    does. In place of dbtable there may be a query with its params (a JSON list)
    and a schema.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        kinds = {"INTEGER": "BIGINT", "REAL": "DOUBLE", "BOOLEAN": "BOOLEAN", "BLOB": "BINARY"}
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            rows = db.execute(f"select name, upper(type) from pragma_table_info('{self.options['dbtable']}')").fetchall()
        return ", ".join(f"`{n}` {kinds.get(t, 'BIGINT' if 'INT' in t else 'DOUBLE' if 'FLOA' in t or 'DOUB' in t else 'STRING')}" for n, t in rows)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SqliteReader(self.options, schema)


def read_sqlite(spark: SparkSession, path: str, table: str, key: str | None = None, partitions: int = 1) -> DataFrame:
    """A table, in ranges of an integer key if one is named; filters are pushed down to it."""
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    options = {"path": path, "dbtable": table, "partitions": partitions} | ({"key": key} if key else {})
    return spark.read.format("sqlite").options(**options).load()


def query_sqlite(spark: SparkSession, path: str, sql: str, params: tuple = (), schema: str = "value string") -> DataFrame:
    """What a query of SQLite's own gives for some parameters, which are bound and never part of its text."""
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").schema(schema).options(path=path, query=sql, params=json.dumps(list(params))).load()
