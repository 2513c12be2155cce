"""States of documents: pending, downloaded, processed, failed and skipped ones, and which of them a run takes up again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: States that a run takes up: never tried, failed, or skipped (the address may be of a known kind by now).
OPEN = ("pending", "download_failed", "processing_failed", "processing_skipped")


def is_document_url(url: Column) -> Column:
    """Whether an address is a PDF's or a download link's; null is neither."""
    low = F.lower(F.coalesce(url, F.lit("")))
    return low.endswith(".pdf") | low.contains("download.php?id=")


def is_open(status: Column, text: Column) -> Column:
    """Whether a document is to be processed: in an open state, or downloaded without text."""
    return F.coalesce(status.isin(*OPEN) | ((status == "downloaded") & text.isNull()), F.lit(False))


def advance(docs: DataFrame, outcomes: DataFrame, force: bool = False, most_tries: int | None = None, key: str = "id") -> DataFrame:
    """``docs`` (key, url, status, processed_text, tries and whatever else) after a run.

    ``outcomes`` has key and text: what was extracted, empty or null if that
    failed. Open documents (all with ``force``) that have been tried less than
    ``most_tries`` times are processed, or failed, or skipped if their address
    is of no known kind; others, and those without an outcome, stay as they are.
    """
    found = outcomes.groupBy(key).agg(F.max("text").alias("__text")).withColumn("__there", F.lit(True))
    out = docs.join(found, key, "left")
    open_now = F.lit(True) if force else is_open(F.col("status"), F.col("processed_text"))
    tries = F.coalesce(F.col("tries"), F.lit(0))
    if most_tries is not None:
        open_now = open_now & (tries < most_tries)
    known = is_document_url(F.col("url"))
    done = F.coalesce(F.col("__text"), F.lit("")) != ""
    ran = open_now & known & F.coalesce(F.col("__there"), F.lit(False))
    status = F.when(open_now & ~known, "processing_skipped").when(ran & done, "processed").when(ran, "processing_failed").otherwise(F.col("status"))
    return out.withColumns({"status": status, "processed_text": F.when(ran & done, F.col("__text")).otherwise(F.col("processed_text")), "tries": tries + ran.cast("int")}).drop("__text", "__there")


def unfinished(consultations: DataFrame, now: Column) -> DataFrame:
    """Consultations to be read again: not marked as finished, or marked before their end date."""
    return consultations.where(~F.coalesce(F.col("is_finished"), F.lit(False)) | (F.col("end_date") > now))
