"""Malformed tables in markdown text: detection, reports, removal.

A separator is a line whose first cell is dashes and colons; a row is a line
between pipes. A separator starts a table unless it is a row inside the body
of the table before; the table reaches from the row above it, if there is one,
to the last row below. All of a text's tables are found in one pass over its
lines within its row, so nothing is exploded or shuffled; a text without a
separator never reaches Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import lines
from quern.operators.clean import TABLE_REMOVED

#: Unicode white space, and what no line holds in the middle.
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SEPARATOR = rf"^{_SPACE}*\|{_SPACE}*[-:]+{_SPACE}*\|"
ROW = rf"^{_SPACE}*\|[^\n\r\x85\u2028\u2029]*\|{_SPACE}*$"
_SEPARATOR, _ROW, _ENDS = re.compile(SEPARATOR), re.compile(ROW), re.compile(rf"^{_SPACE}+|{_SPACE}+$")
HEADER_MISMATCH = "Table header and separator column count mismatch"
NO_HEADER = "Table separator without header row"
ROW_MISMATCH = "Table row has inconsistent column count"


_SPAN = "start_line int, end_line int"
FOUND = f"struct<tables: array<struct<sep_line int, columns int, header_columns int, {_SPAN}>>, issues: array<struct<line_number int, description string, expected int, found int, {_SPAN}>>>"


def column_count(line: str) -> int:
    """Cells of a row; 0 for a line that isn't between pipes."""
    core = _ENDS.sub("", line)
    if not (core.startswith("|") and core.endswith("|")) or len(core) <= 1:
        return 0
    return core[1:-1].count("|") + 1


def tables_of(text: list[str] | None) -> dict:
    """The tables of a text's lines, and what is wrong with them; lines count from 0, those of issues from 1, ends are inclusive."""
    tables: list[dict] = []
    issues: list[dict] = []
    ragged: list[tuple[int, int, int]] = []  # table, line, cells
    inside = above = False
    for i, line in enumerate(text or ()):
        row = "|" in line and _ROW.match(line) is not None
        if "|" in line and not (inside and row) and _SEPARATOR.match(line):
            header = column_count(text[i - 1]) if above else None
            tables.append({"sep_line": i, "columns": column_count(line), "header_columns": header, "start_line": i - 1 if above else i, "end_line": i})
            inside = True
        elif inside and row:
            tables[-1]["end_line"] = i
            n = column_count(line)
            if tables[-1]["columns"] > 0 and n != tables[-1]["columns"]:
                ragged.append((len(tables) - 1, i, n))
        else:
            inside = False
        above = row
    span = lambda t: {"start_line": t["start_line"], "end_line": t["end_line"]}
    for t in tables:
        if t["header_columns"] != t["columns"]:
            said = NO_HEADER if t["header_columns"] is None else HEADER_MISMATCH
            issues.append({"line_number": t["sep_line"] + 1, "description": said, "expected": t["header_columns"], "found": t["columns"], **span(t)})
    for k, i, n in ragged:
        issues.append({"line_number": i + 1, "description": ROW_MISMATCH, "expected": tables[k]["columns"], "found": n, **span(tables[k])})
    return {"tables": tables, "issues": issues}


def table_scan(text: Column) -> Column:
    """STRUCT(tables, issues) of a text; both empty where it has no separator."""
    scan = F.udf(tables_of, FOUND, useArrow=True)
    some = F.coalesce(text, F.lit("")).rlike(rf"(?m){SEPARATOR}")
    return scan(F.when(some, lines(text)))


def table_issues(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per issue: doc, line_number (from 1), description, expected, found, start_line, end_line."""
    found = df.select(F.col(id_col).alias("doc"), table_scan(F.col(text_col)).alias("found"))
    return found.select("doc", F.inline("found.issues"))


def table_summary(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document: total_tables and malformed_tables (the number of issues, as reports have it)."""
    found = df.select(F.col(id_col).alias("doc"), table_scan(F.col(text_col)).alias("found"))
    return found.select("doc", F.size("found.tables").cast("long").alias("total_tables"), F.size("found.issues").cast("long").alias("malformed_tables"))


def remove_ranges(text: Column, ranges: Column) -> Column:
    """A text without the lines in ``ranges`` (ARRAY of STRUCT(start_line, end_line), from 0, inclusive); each run of removed lines leaves one comment.

    The last line end is kept if there was one, unless the comment is all that
    is left. An empty text stays empty.
    """
    within = lambda i: F.exists(ranges, lambda r: (i >= r["start_line"]) & (i <= r["end_line"]))
    flagged = F.transform(lines(text), lambda x, i: F.struct(x.alias("line"), within(i).alias("gone"), within(i - 1).alias("above")))
    kept = F.filter(flagged, lambda s: ~(s["gone"] & s["above"]))
    body = F.array_join(F.transform(kept, lambda s: F.when(s["gone"], TABLE_REMOVED).otherwise(s["line"])), "\n")
    ended = F.when(text.endswith("\n") & (body != TABLE_REMOVED) & ~body.endswith("\n"), F.concat(body, F.lit("\n"))).when(~text.endswith("\n") & body.endswith("\n"), F.regexp_replace(body, "\n$", "")).otherwise(body)
    return F.when((F.size(ranges) <= 0) | (text == ""), text).otherwise(ended)


def _spans(issues: Column) -> Column:
    return F.array_distinct(F.transform(issues, lambda x: F.struct(x["start_line"].alias("start_line"), x["end_line"].alias("end_line"))))


def remove_malformed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with the tables that have an issue replaced by a comment."""
    out = df.withColumn("__found", table_scan(F.col(text_col)))
    text = F.when(F.size("__found.issues") > 0, remove_ranges(F.col(text_col), _spans(F.col("__found.issues")))).otherwise(F.col(text_col))
    return out.withColumn(text_col, text).drop("__found")


def clean_and_report(df: DataFrame, id_col: str, text_col: str, scripts=("latin", "greek")) -> DataFrame:
    """The four steps in one projection: clean, find tables, remove malformed ones, score what is left."""
    from quern.operators.clean import with_quality

    cleaned = with_quality(df.select(id_col, text_col), text_col, scripts).select(id_col, F.col("cleaned").alias(text_col))
    found = cleaned.withColumn("__found", table_scan(F.col(text_col)))
    text = F.when(F.size("__found.issues") > 0, remove_ranges(F.col(text_col), _spans(F.col("__found.issues")))).otherwise(F.col(text_col))
    counts = [F.size("__found.tables").cast("long").alias("total_tables"), F.size("__found.issues").cast("long").alias("malformed_tables")]
    final = with_quality(found.select(id_col, text.alias(text_col), *counts), text_col, scripts)
    score = lambda c: F.round(F.greatest(F.col(c), F.lit(0.0)), 3)
    return final.select(F.col(id_col), F.col("cleaned").alias(text_col), score("badness").alias("badness"), score("greek_pct").alias("greek_pct"), score("latin_pct").alias("latin_pct"), "total_tables", "malformed_tables")


def write_issues(df: DataFrame, path: str) -> None:
    """The detailed table report: one CSV row per issue, by file and line."""
    from quern.sources.files import write_csv

    write_csv(df, path, ["doc", "line_number"])
