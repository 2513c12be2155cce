"""Texts for readers: denormalised exports, change reports, traces, mirrored files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consultation_texts(consultations: DataFrame, articles: DataFrame, n: int | None = None) -> DataFrame:
    """(id, text): each consultation's title, address and dates, then its articles in order; the first ``n`` by id."""
    chosen = consultations.orderBy("id").limit(n) if n else consultations
    body = F.concat_ws("\n", F.col("title"), F.coalesce("content", F.lit("")))
    listed = articles.groupBy(F.col("consultation_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("id").alias("k"), body.alias("body")))), lambda s: s["body"]).alias("bodies"))
    dates = F.concat_ws(" – ", F.col("start_date").cast("string"), F.col("end_date").cast("string"))
    out = chosen.join(listed, "id", "left")
    parts = F.concat(F.array("title", "url", F.nullif(dates, F.lit(""))), F.coalesce("bodies", F.array().cast("array<string>")))
    return out.select("id", F.array_join(F.filter(parts, lambda x: x.isNotNull()), "\n\n").alias("text"))


def change_report(changes: DataFrame, key: str) -> DataFrame:
    """(key, line): a line of text per change record."""
    said = F.when(F.col("kind") == "changed", F.concat(F.lit("changed: "), F.col("columns"))).otherwise(F.col("kind"))
    return changes.select(key, F.concat(F.col(key).cast("string"), F.lit(" "), said).alias("line"))


def write_texts(df: DataFrame, path: str, name: str, text: str) -> None:
    """One folder per name with the text in it, the way the source tree was laid out."""
    df.select(F.col(name).alias("name"), F.col(text).alias("value")).write.partitionBy("name").text(path)


def write_trace(df: DataFrame, path: str) -> None:
    """Append a stage's records (stage, prompt, answer and so on) as JSON lines with the time."""
    df.withColumn("at", F.current_timestamp()).write.mode("append").json(path)
