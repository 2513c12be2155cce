"""Content-addressed WARC archive.

An archive is a folder with two tables. ``payloads`` holds the bytes of each
payload once, under its SHA-256; copies are combined by digest and by their
full bytes, hot payloads first by salt. ``headers`` holds the exact header
block of each record (WARC fields and HTTP head) and the address of its
payload. A record is its header block, its payload (unless it is a revisit that
was made here) and two line ends, so joining the tables on the address gives back every record, byte
by byte; records that come with their own headers are archived just so
(``archive_records``). When an archive is read, each payload's digest is computed anew and
compared with its address.

Defined cases: a null html is an empty payload; a null url leaves out the
target field; a null page id reads as null and is smaller than any other. Rows
that repeat page id and payload are records of one kind. An empty table gives
an empty archive. Further columns are ignored.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SALTS, hot_keys, salted_join, text_of, written

#: Fixed values of the format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 given as 40 hexadecimal digits: five digits make four letters."""
    letters = []
    for i in range(8):
        v = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for j in range(4):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(v, 15 - 5 * j).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def _header() -> Column:
    """The header block of a record from page_id, url, sha1, n, revisit and response_id."""
    def field(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))

    head = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), field("Content-Type", "text/html; charset=utf-8"), field("Content-Length", F.col("n").cast("string")), F.lit("\r\n"))
    block = F.octet_length(head) + F.when(F.col("revisit"), 0).otherwise(F.col("n"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        field("WARC-Record-ID", _urn(F.col("page_id"))),
        F.coalesce(field("WARC-Target-URI", url), F.lit("")),
        field("WARC-Date", DATE),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        F.when(F.col("revisit"), F.concat(field("WARC-Profile", REVISIT_PROFILE), field("WARC-Refers-To", _urn(F.col("response_id"))))).otherwise(""),
        field("Content-Type", "application/http; msgtype=response"),
        field("Content-Length", block.cast("string")),
        F.lit("\r\n"),
        head,
    ).cast("binary")


def _store(rows: DataFrame, light: DataFrame, path: str, salts: int) -> tuple[DataFrame, DataFrame]:
    """Write each payload of ``rows`` (address, payload) once; the groups of ``light`` (address, page_id) and the hot addresses."""
    groups = written(light.groupBy("address").agg(F.max("page_id").alias("response_id"), F.count("*").alias("records")), "warc-groups")
    n_rows, n_groups = groups.agg(F.sum("records"), F.count("*")).first()
    hot = written(hot_keys(groups, "address", "records", n_rows or 0), "warc-hot")
    flagged = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "address", "left")
    cold = flagged.where("hot is null").groupBy("address", "payload").agg(F.count("*").alias("records"))
    cold.select("address", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")
    if not hot.isEmpty():
        # a task combines its own copies and deals out what is left
        salted = flagged.where("hot").groupBy("address", F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"), "payload").agg(F.count("*").alias("records"))
        merged = salted.groupBy("address", "payload").agg(F.sum("records").alias("records"))
        merged.select("address", "payload").write.mode("append").option("compression", "zstd").parquet(f"{path}/payloads")
    stored = rows.sparkSession.read.parquet(f"{path}/payloads").count()
    if stored != n_groups:
        raise ValueError(f"{stored} payloads have {n_groups} addresses: two payloads share a digest")
    return groups, hot


def write_archive(pages: DataFrame, path: str, min_revisit: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", salts: int = SALTS) -> None:
    """Archive each row of ``pages``; of equal payloads of ``min_revisit`` bytes or more the largest id is the response."""
    payload = text_of(pages, html_col).cast("binary")
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("address", F.unhex(F.sha2("payload", 256)))
    light = rows.select("page_id", "url", "address", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n"), F.monotonically_increasing_id().alias("row"))
    light = written(light, "warc-light")
    groups, hot = _store(rows.select("address", "payload"), light, path, salts)
    named = salted_join(light, groups.drop("records"), "address", hot, F.col("row"))
    revisit = ~F.col("page_id").eqNullSafe(F.col("response_id")) & (F.col("n") >= min_revisit)
    headers = named.withColumn("revisit", revisit).select("address", _header().alias("header"), (~F.col("revisit")).alias("whole"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")


def archive_records(records: DataFrame, path: str, salts: int = SALTS) -> None:
    """Archive given records (header, payload; both binary): the header is everything before the payload, byte by byte, an HTTP head included."""
    rows = records.select(F.coalesce("header", F.lit(b"")).alias("header"), F.coalesce("payload", F.lit(b"")).alias("payload"))
    rows = rows.withColumn("address", F.unhex(F.sha2("payload", 256)))
    light = written(rows.select("address", "header", F.lit(None).cast("long").alias("page_id")), "warc-light")
    _store(rows.select("address", "payload"), light, path, salts)
    light.select("address", "header", F.lit(True).alias("whole")).write.option("compression", "zstd").parquet(f"{path}/headers")


def _tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Headers, payloads, and the hot addresses."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    counts = headers.groupBy("address").agg(F.count("*").alias("n"))
    return headers, payloads, written(hot_keys(counts, "address", "n", headers.count()), "warc-hot")


def _verified(payloads: DataFrame) -> Column:
    """The payload, or an error if its digest is not its address."""
    good = F.unhex(F.sha2("payload", 256)) == F.col("address")
    return F.when(good, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload does not have the digest "), F.hex("address"))).cast("binary"))


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, record_type, refers_to, url, and payload_bytes and payload_digest of its stored payload."""
    headers, payloads, hot = _tables(spark, path)
    facts = payloads.withColumn("payload", _verified(payloads))
    facts = facts.select("address", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_of_hex(F.sha1("payload")).alias("payload_digest"))
    text = F.decode("header", "UTF-8")
    rows = salted_join(headers, facts, "address", hot, F.monotonically_increasing_id()).withColumn("text", text)
    page = lambda name: F.expr(f"try_cast(regexp_extract({name}, '<urn:page:(-?[0-9]+)>', 1) as bigint)")
    rows = rows.withColumns({"record": _field(F.col("text"), "WARC-Record-ID"), "refers": F.coalesce(_field(F.col("text"), "WARC-Refers-To"), F.lit(""))})
    rows = rows.withColumn("claimed", _field(F.col("text"), "WARC-Payload-Digest"))
    digest = F.when(F.col("claimed") == F.concat(F.lit("sha1:"), F.col("payload_digest")), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record's payload digest is not that of its payload")).cast("string"))
    return rows.select(page("record").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), _field(F.col("text"), "WARC-Type").alias("record_type"), page("refers").alias("refers_to"), _field(F.col("text"), "WARC-Target-URI").alias("url"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The bytes of every record, put together from header and payload."""
    headers, payloads, hot = _tables(spark, path)
    rows = salted_join(headers, payloads.withColumn("payload", _verified(payloads)), "address", hot, F.monotonically_increasing_id())
    body = F.when(F.col("whole"), F.col("payload")).otherwise(F.lit(b""))
    return rows.select("address", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Fields, header bytes (up to the block) and block of each record of a WARC file, plain or gzipped, one at a time.

    Field names are told apart without regard to case and given as they are
    spelled; a space after the colon is optional; a line that begins with white
    space goes on with the field before. A record that the end of the file cuts
    off is left out.
    """
    file = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)

    def line() -> bytes:
        try:
            return file.readline()
        except EOFError:  # a gzipped file that is cut off
            return b""

    while True:
        first = line()
        while first in (b"\r\n", b"\n"):
            first = line()
        if not first:
            return
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {first[:40]!r}")
        head, fields, name = [first], {}, None
        while (x := line()) not in (b"", b"\r\n", b"\n"):
            head.append(x)
            text = x.decode("utf-8", "replace").rstrip("\r\n")
            if text[:1] in " \t" and name:
                fields[name] += f" {text.strip()}"
            else:
                name, _, value = text.partition(":")
                fields[name] = value.strip()
        if not x:
            return
        size = int(next((v for k, v in fields.items() if k.lower() == "content-length"), "0") or 0)
        try:
            block = file.read(size)
        except EOFError:
            return
        if len(block) < size:
            return
        yield fields, b"".join([*head, x]), block


def read_warc_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of plain or gzipped WARC files (of 2 GB at most): file, fields, header and block; one record at a time is in memory besides the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.binary()]
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                for fields, header, block in parse_records(data):
                    cells = [name, list(fields.items()), header, block]
                    yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], ["file", "fields", "header", "block"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, fields map<string,string>, header binary, block binary")


def split_block(header: Column, block: Column) -> tuple[Column, Column]:
    """Header and payload of a record for ``archive_records``: the head of an HTTP response counts to the header."""
    end = F.when(F.decode(F.substring(block, 1, 5), "UTF-8") == "HTTP/", F.instr(F.decode(block, "ISO-8859-1"), "\r\n\r\n")).otherwise(0)
    at = F.when(end > 0, end + 3).otherwise(0)
    return F.concat(header, F.substring(block, F.lit(1), at)), F.substring(block, at + 1, F.octet_length(block))
