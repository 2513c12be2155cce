"""Jobs: the operators composed into the runs that keep the tables up to date.

``python -m quern.plans.jobs COMMAND IN OUT [script ...]``, where COMMAND is
``clean`` (clean a tree of markdown, write texts and report), ``score`` (scores
only), ``tables`` (report malformed tables), ``remove-tables``, ``sections``
(label articles in a Parquet table), ``summarise`` (the stages of generation
over such a table), ``refresh`` (a run over stored pages of a site) or ``pdfs``
(texts of a folder of PDF files). ``update`` reads stored pages.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.convert import normalized_url
from quern.functions.numerals import greek_to_int
from quern.operators.clean import stored_scores, with_quality
from quern.operators.crawl import article_pages, until_known
from quern.operators.html import convert_blank
from quern.operators.pdf import extracted
from quern.operators.reports import all_match, compare_counts, numeric_stats, shares
from quern.operators.sections import continuity_summary, parse_titles
from quern.operators.tables import clean_and_report, remove_malformed, table_issues, table_summary, write_issues
from quern.operators.upsert import merge, new_items
from quern.plans.refresh import ARTICLE, COMMENT, CONSULTATION, Site, refresh
from quern.plans.summaries import artefacts, write_artefacts
from quern.sources.files import read_markdown, read_pdfs, write_csv, write_quality_csv, write_sections, write_split


def discover(listing: DataFrame, known: DataFrame, mark=None) -> DataFrame:
    """Items of a listing (page_no, pos, url, title, date) that aren't known by their normalised address."""
    fresh = until_known(listing, mark).withColumn("url_norm", normalized_url(F.col("url")))
    return new_items(fresh, known.select(normalized_url(F.col("url")).alias("url_norm")), "url_norm").dropDuplicates(["url_norm"])


def process_articles(pages: DataFrame, scripts=("greek", "latin")) -> DataFrame:
    """Article pages (url, html) to articles with markdown content and scores."""
    parsed = article_pages(pages, "url", "html").withColumn("content", F.lit(None).cast("string"))
    return stored_scores(convert_blank(parsed), "content", scripts)


def update(articles: DataFrame, pages: DataFrame, listing: DataFrame, mark=None) -> DataFrame:
    """One incremental run: new items of the listing, their pages, articles made of them, merged into the table by address."""
    wanted = discover(listing, articles, mark).select("url_norm")
    found = pages.withColumn("url_norm", normalized_url(F.col("url"))).join(wanted, "url_norm", "left_semi").drop("url_norm")
    fresh = process_articles(found)
    known = articles.select(*(F.col(c) if c in articles.columns else F.lit(None).cast(fresh.schema[c].dataType).alias(c) for c in fresh.columns))
    return merge(known, fresh, "url")


def clean_tree(spark: SparkSession, source: str, target: str, scripts=("greek", "latin")) -> DataFrame:
    """Clean, report and rewrite all markdown files under a folder; returns the report."""
    done = clean_and_report(read_markdown(spark, source), "path", "text", scripts)
    done.select("path", "text").write.mode("overwrite").parquet(f"{target}/texts")
    report = done.drop("text")
    write_csv(report, f"{target}/report", ["path"])
    return report


def verify_copy(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Counts of all tables side by side, and whether all match."""
    counts = compare_counts(old, new)
    return counts, all_match(counts)


def cleaning_stats(documents: DataFrame) -> dict[str, DataFrame]:
    """What the state of cleaning is: scores, and documents by method."""
    return {c: numeric_stats(documents, c) for c in ("badness_score", "greek_percentage", "english_percentage")} | {"methods": shares(documents, "extraction_method")}


def score_tree(spark: SparkSession, source: str, target: str, scripts=("greek", "latin")) -> DataFrame:
    """Score all markdown files under a folder as they are cleaned, and write the scores; the texts stay where they are."""
    report = with_quality(read_markdown(spark, source), "text", scripts).select("name", "badness", "greek_pct", "latin_pct")
    write_quality_csv(report, target)
    return report


def tables_of_tree(spark: SparkSession, source: str, target: str, _scripts=()) -> DataFrame:
    """Report malformed tables of all markdown files under a folder: a summary, and one row per issue."""
    files = read_markdown(spark, source)
    summary = table_summary(files, "path", "text")
    write_csv(summary, f"{target}/summary", ["doc"])
    write_issues(table_issues(files, "path", "text"), f"{target}/issues")
    return summary


def without_tables(spark: SparkSession, source: str, target: str, _scripts=()) -> DataFrame:
    """Rewrite all markdown files under a folder without malformed tables."""
    out = remove_malformed(read_markdown(spark, source), "path", "text")
    out.select("path", "text").write.mode("overwrite").parquet(target)
    return out.select("path")


def sections_of(spark: SparkSession, source: str, target: str, _scripts=()) -> DataFrame:
    """Parts and chapters of the articles in a Parquet table (consultation_id, id, title), with what is wrong with their numbering."""
    rows = parse_titles(spark.read.parquet(source))
    number = lambda c: F.when(F.col(c).isNotNull(), greek_to_int(F.col(c)))
    summary = continuity_summary(rows.withColumns({"part_no": number("part"), "chapter_no": number("chapter")}), "consultation_id", "id", "part_no", "chapter_no")
    write_sections(rows, summary, target, ["consultation_id", "id"])
    return summary


def summarise(spark: SparkSession, source: str, target: str, _scripts=()) -> DataFrame:
    """Summaries of the articles in a Parquet table (consultation_id, id, title, content), with all that is kept of the way to them."""
    found = artefacts(spark.read.parquet(source))
    write_artefacts(found, target)
    return found["parts"]


def refresh_site(spark: SparkSession, source: str, target: str, _scripts=()) -> DataFrame:
    """A run over a site whose tables, listing and pages are Parquet tables in a folder; the new tables and the record are written to another."""
    read = lambda name, kind=None: (spark.read.schema(kind) if kind else spark.read).parquet(f"{source}/{name}")
    site, record = refresh(Site(read("consultations", CONSULTATION), read("articles", ARTICLE), read("comments", COMMENT)), read("listing"), read("pages"))
    for name in ("consultations", "articles", "comments"):
        getattr(site, name).write.parquet(f"{target}/{name}")
    record.write.parquet(f"{target}/record")
    return spark.read.parquet(f"{target}/record")


def texts_of_pdfs(spark: SparkSession, source: str, target: str, _scripts=()) -> DataFrame:
    """Texts of the PDF files under a folder, and the errors of those that can't be read."""
    out = extracted(read_pdfs(spark, source, 50 << 20), "path", "content")
    write_split(out, F.col("error").isNull(), f"{target}/texts", f"{target}/errors")
    return spark.read.parquet(f"{target}/texts").select("path", F.length("text").alias("n_chars"))


COMMANDS = {"clean": clean_tree, "score": score_tree, "tables": tables_of_tree, "remove-tables": without_tables, "sections": sections_of, "summarise": summarise, "refresh": refresh_site, "pdfs": texts_of_pdfs}


def main(args: list[str]) -> None:
    if len(args) < 3 or args[0] not in COMMANDS:
        sys.exit(__doc__)
    spark = SparkSession.builder.appName(args[0]).getOrCreate()
    COMMANDS[args[0]](spark, args[1], args[2], args[3:] or ("greek", "latin")).show(20, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
