"""Gaps and islands: runs of numbered headings, indexes, segments and missing numbers.

Input rows are (doc, line_no, number, type). Loops that carry state from
heading to heading become running counts of breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.numerals import article_heading

INDEX_SHARE, INDEX_MEAN = 0.20, 2.5


def headings(lines: DataFrame) -> DataFrame:
    """(doc, line_no, text, number, type) for lines (doc, line_no, line) that are article headings with a number."""
    found = lines.withColumn("h", article_heading(F.col("line"))).where("h is not null")
    return found.select("doc", "line_no", F.trim("line").alias("text"), "h.number", "h.type")


def runs(rows: DataFrame, skip: int = 1) -> DataFrame:
    """Adds run: the number of the run of one type in which each number is above the one before by skip + 1 at most; null for numbers below 1."""
    order = Window.partitionBy("doc").orderBy("line_no")
    before, kind = F.lag("number").over(order), F.lag("type").over(order)
    goes_on = (before >= 1) & (kind == F.col("type")) & (F.col("number") > before) & (F.col("number") <= before + 1 + skip)
    broken = (~F.coalesce(goes_on, F.lit(False))).cast("int")
    out = rows.withColumn("__broken", broken).withColumn("run", F.sum("__broken").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("run", F.when(F.col("number") >= 1, F.col("run"))).drop("__broken")


def sequences(rows: DataFrame, skip: int = 1, at_least: int = 2) -> DataFrame:
    """The headings that are in a run of ``at_least``, with the run's letter (A, B, ... per document)."""
    sized = runs(rows, skip).where("run is not null").withColumn("size", F.count("*").over(Window.partitionBy("doc", "run")))
    rank = F.dense_rank().over(Window.partitionBy("doc").orderBy("run"))
    return sized.where(F.col("size") >= at_least).withColumn("sequence", F.char(F.lit(64) + rank)).drop("run", "size")


def sequence_counts(rows: DataFrame, n_lines: DataFrame, skip: int = 5) -> DataFrame:
    """Per document: sequence_count (runs of any length) and their number per 100 lines; ``n_lines`` has doc and lines."""
    counted = runs(rows, skip).groupBy("doc").agg(F.count_distinct("run").alias("sequence_count"))
    out = n_lines.join(counted, "doc", "left").withColumn("sequence_count", F.coalesce("sequence_count", F.lit(0)).cast("long"))
    return out.withColumn("per_100_lines", F.when(F.col("lines") > 0, 100.0 * F.col("sequence_count") / F.col("lines")).otherwise(0.0))


def index_headings(lines: DataFrame, rows: DataFrame, share: float = INDEX_SHARE, mean: float = INDEX_MEAN, skip: int = 1) -> DataFrame:
    """``rows`` with is_index: runs of two or more in the first part of a document with few filled lines between headings are its table of contents."""
    upto = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    filled = lines.select("doc", "line_no", F.sum(F.col("line").rlike(r"(?U)\S").cast("int")).over(upto).alias("filled"), F.count("*").over(Window.partitionBy("doc")).alias("n"))
    numbered = runs(rows, skip).join(filled, ["doc", "line_no"])
    of_run = Window.partitionBy("doc", "type", "run")
    between = F.col("filled") - F.lag("filled").over(of_run.orderBy("line_no")) - 1
    numbered = numbered.withColumn("between", between)
    is_index = (
        F.col("run").isNotNull()
        & (F.count("*").over(of_run) >= 2)
        & (F.max("line_no").over(of_run) <= F.floor(F.col("n") * share))
        & (F.avg("between").over(of_run) < mean)
    )
    return numbered.withColumn("is_index", F.coalesce(is_index, F.lit(False))).drop("run", "filled", "n", "between")


CONTENTS_TITLE = "ΠΙΝΑΚΑΣ ΠΕΡΙΕΧΟΜΕΝΩΝ"


def segments(docs: DataFrame, accepted: DataFrame, index: DataFrame) -> DataFrame:
    """(doc, title, content, article_num, sequence, start_line, end_line) of documents with an accepted heading or an index.

    ``docs`` has doc and lines (an array), ``accepted`` doc, line_no, text,
    number and sequence, ``index`` doc and line_no. There is a segment for the
    index, from its first heading to its last, titled and led by the title of
    contents within five lines before it; one for what lies between the index (or
    the beginning) and the first accepted heading, unless blank; and one for each
    accepted heading, of the lines from the next one to the heading after it.
    Only headings are grouped; lines are cut out of a document's array.
    """
    marks = accepted.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("line_no", "text", "number", "sequence"))).alias("marks"))
    listed = index.groupBy("doc").agg(F.min("line_no").alias("i0"), F.max("line_no").alias("i1"))
    rows = docs.join(marks.join(listed, "doc", "full"), "doc")
    cut = lambda a, b: F.array_join(F.slice("lines", a + 1, F.greatest(b - a, F.lit(0))), "\n")
    part = lambda title, content, number, sequence, a, b: F.struct(title.cast("string").alias("title"), content.alias("content"), number.cast("int").alias("article_num"), sequence.cast("string").alias("sequence"), a.cast("int").alias("start_line"), b.cast("int").alias("end_line"))
    none, first, i0, i1 = F.lit(None), F.col("marks")[0]["line_no"], F.col("i0"), F.col("i1")
    near = F.slice("lines", F.greatest(i0 - 5, F.lit(0)) + 1, F.least(i0, F.lit(5)))
    title = F.try_element_at(F.filter(near, lambda x: x.contains(CONTENTS_TITLE)), F.lit(1))
    listing = part(F.coalesce(F.regexp_replace(title, r"(?U)^\s+|\s+$", ""), F.lit("Index")), F.concat(F.coalesce(F.concat(title, F.lit("\n")), F.lit("")), cut(i0, i1 + 1)), none, F.lit("INDEX"), i0, i1 + 1)
    begin = F.coalesce(i1 + 1, F.lit(0))
    intro = part(F.lit("Introduction"), cut(begin, first), none, none, begin, first)
    after = lambda i: F.coalesce(F.try_element_at(F.col("marks"), i + 2)["line_no"], F.size("lines"))
    articles = F.transform("marks", lambda m, i: part(m["text"], cut(m["line_no"] + 1, after(i)), m["number"], m["sequence"], m["line_no"], after(i)))
    empty = F.filter(F.array(listing), lambda x: F.lit(False))
    filled = intro["content"].rlike(r"(?U)\S") & (first > begin)
    every = F.concat(F.when(i0.isNotNull(), F.array(listing)).otherwise(empty), F.when(filled, F.array(intro)).otherwise(empty), F.coalesce(articles, empty))
    return rows.select("doc", F.inline(every))


def number_gaps(found: DataFrame, group: str, number: str, expected: DataFrame | None = None) -> DataFrame:
    """Numbers missing between the least and greatest of each group, or in ``expected`` (group, lo, hi)."""
    bounds = found.groupBy(group).agg(F.min(number).alias("lo"), F.max(number).alias("hi")) if expected is None else expected
    wanted = bounds.where("lo <= hi").select(group, F.explode(F.sequence("lo", "hi")).alias(number))
    return wanted.join(found.select(group, number).distinct(), [group, number], "left_anti")


def number_jumps(found: DataFrame, group: str, number: str) -> DataFrame:
    """Where sorted distinct numbers of a group don't go up by one: group, number and next_number."""
    order = Window.partitionBy(group).orderBy(number)
    out = found.select(group, number).distinct().withColumn("next_number", F.lead(number).over(order))
    return out.where(F.col("next_number") != F.col(number) + 1)


def order_anomalies(rows: DataFrame, group: str, key: str) -> DataFrame:
    """Rows whose key isn't above the one before."""
    order = Window.partitionBy(group).orderBy(key)
    return rows.withColumn("previous", F.lag(key).over(order)).where(F.col("previous") >= F.col(key))


def best_mentions(mentions: DataFrame, needed: DataFrame) -> DataFrame:
    """For each needed (doc, number) its best mention: at a line's start before within a line, unquoted before quoted, then the first."""
    priority = F.when(F.col("line_start") & ~F.col("quoted"), 1).when(F.col("line_start"), 2).when(~F.col("quoted"), 3).otherwise(4)
    ranked = mentions.join(needed.distinct(), ["doc", "number"], "left_semi").withColumn("priority", priority)
    best = F.row_number().over(Window.partitionBy("doc", "number").orderBy("priority", "pos"))
    return ranked.withColumn("__nth", best).where("__nth = 1").drop("__nth")


def title_range(title: Column) -> Column:
    """ARRAY of the numbers of a range like (3-7) in a title; empty if there is none."""
    pattern = r"\(\s*(\d{1,6})\s*[-–—]\s*(\d{1,6})\s*\)"
    a, b = (F.regexp_extract(title, pattern, i).try_cast("int") for i in (1, 2))
    return F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
