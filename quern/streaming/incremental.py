"""Structured Streaming: windows, sessions, deduplication and upserts by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.upsert import write_merge


def read_events(spark: SparkSession, path: str, schema, per_trigger: int = 1) -> DataFrame:
    """A stream of the Parquet files that match a path."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def tumbling(events: DataFrame, ts: str, keys: list[str], width: str, late: str, value: str) -> DataFrame:
    """Count and sum per window and key; rows later than ``late`` are dropped by a stream."""
    seen = events.withWatermark(ts, late) if events.isStreaming else events
    out = seen.groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n", "total")


def sliding(events: DataFrame, ts: str, keys: list[str], width: str, slide: str, late: str) -> DataFrame:
    seen = events.withWatermark(ts, late) if events.isStreaming else events
    out = seen.groupBy(F.window(ts, width, slide), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def sessions(events: DataFrame, ts: str, key: str, gap: str, late: str) -> DataFrame:
    """Sessions of a key that end after a gap: start, end (last event plus gap) and number of events."""
    seen = events.withWatermark(ts, late) if events.isStreaming else events
    out = seen.groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def deduplicated(events: DataFrame, ts: str, keys: list[str], late: str) -> DataFrame:
    """The first event of each key, within the watermark on a stream."""
    if events.isStreaming:
        return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)


def joined(left: DataFrame, right: DataFrame, key: str, ts: str, within: str, late: str) -> DataFrame:
    """Pairs of events of a key of which the right one comes at most ``within`` after the left one; the watermarks bound what is kept of both.

    Columns of the right side get the prefix next_.
    """
    a = left.withWatermark(ts, late) if left.isStreaming else left
    b = right.select(*(F.col(c).alias(f"next_{c}") for c in right.columns))
    b = b.withWatermark(f"next_{ts}", late) if right.isStreaming else b
    near = (F.col(key) == F.col(f"next_{key}")) & (F.col(f"next_{ts}") >= F.col(ts)) & (F.col(f"next_{ts}") <= F.col(ts) + F.expr(f"interval {within}"))
    return a.join(b, near).drop(f"next_{key}")


def drained(stream: DataFrame, checkpoint: str, mode: str = "append") -> DataFrame:
    """All that a stream has by now, run to its end; written to the checkpoint's folder and read back."""
    out = f"{checkpoint}/out"
    if mode == "append":
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{checkpoint}/state").option("path", out).trigger(availableNow=True).start()
    else:
        # each batch of a complete result takes the place of the one before
        query = stream.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).outputMode(mode).option("checkpointLocation", f"{checkpoint}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def upsert_into(path: str, key: str, frozen: str | None = None, order: str | None = None) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch: merges each batch, reduced to the last row of each key, into a Parquet table."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if order:
            best = F.max_by(F.struct(*batch.columns), order)
            rows = batch.groupBy(key).agg(best.alias("r")).select("r.*")
        write_merge(batch.sparkSession, path, rows.dropDuplicates([key]), key, frozen)

    return run
