"""Queries on stored pages, citations and document states, over pages and texts that orders and customers make up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.citations import LAW, PRESIDENTIAL, decisions, decree_key, law_citations
from quern.functions.convert import MONTHS_OF
from quern.functions.numerals import article_heading
from quern.operators.crawl import article_pages, comment_pages, gazette_rows, listing_items, metadata
from quern.operators.states import advance, unfinished
from quern.plans.base import table

_MONTHS = ", ".join(f"'{m}'" for m in MONTHS_OF)


def _greek_day(date: str) -> F.Column:
    return F.concat_ws(" ", F.day(date), F.element_at(F.array(*map(F.lit, MONTHS_OF)), F.month(date)), F.year(date))


def _text(*parts) -> F.Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) and not p.startswith("o_") and not p.startswith("c_") else F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts))


def stored_listing(spark, sf_dir) -> DataFrame:
    """Listing pages of two items each, the second without a date."""
    o = table(spark, sf_dir, "orders")
    html = _text("<ul>\n<li class='i'><a href=\"/m/?p=", "o_orderkey", '">Νόμος <b>', "o_custkey", "</b></a> <span class='start'>", _greek_day("o_orderdate"), "</span></li><li><a href='?p=0'>x</a> no date</li></ul>")
    pages = o.select("o_orderkey", F.lit("http://site.gr/m/page/2").alias("url"), html.alias("html"))
    return listing_items(pages, "o_orderkey", "url", "html").select(F.col("page_no").alias("o_orderkey"), "pos", "url", "title", "date")


SQL_LISTING = """
select o_orderkey, 0 as pos, 'http://site.gr/m/?p=' || o_orderkey as url, 'Νόμος ' || o_custkey as title, o_orderdate::date as date from orders
union all select o_orderkey, 1, 'http://site.gr/m/page/2?p=0', 'x', null from orders
"""


def stored_metadata(spark, sf_dir) -> DataFrame:
    """Consultation pages with a heading, a start and an end, and their total of comments in a phrase, a label, or not at all."""
    o = table(spark, sf_dir, "orders")
    total = F.when(F.col("o_orderkey") % 3 == 0, _text("o_custkey", " - Όλα τα Σχόλια")).when(F.col("o_orderkey") % 3 == 1, _text("5 Σχόλια, ", "o_custkey", " Σχόλια")).otherwise("")
    done = F.when(F.col("o_orderkey") % 2 == 0, "Ολοκληρώθηκε").otherwise("")
    html = _text("<h1>Σχέδιο <i>", "o_orderkey", "</i></h1><p>", _greek_day("o_orderdate"), ", 09:30</p><p>", _greek_day("o_orderdate"), "</p>", done, " <div>", total, "</div>")
    pages = o.select(_text("http://site.gr/m/?p=", "o_orderkey").alias("url"), html.alias("html"))
    return metadata(pages, "url", "html", now=F.lit("1995-01-01").cast("timestamp"))


SQL_METADATA = """
select 'http://site.gr/m/?p=' || o_orderkey as url, o_orderkey::varchar as post_id, 'Σχέδιο ' || o_orderkey as title, date_trunc('day', o_orderdate) + interval 570 minute as start_date, date_trunc('day', o_orderdate)::timestamp as end_date,
  o_orderkey % 2 = 0 or timestamp '1995-01-01' > date_trunc('day', o_orderdate) as is_finished,
  case o_orderkey % 3 when 0 then o_custkey when 1 then greatest(5, o_custkey) else 0 end::int as total_comments from orders
"""


def stored_articles(spark, sf_dir) -> DataFrame:
    """Article pages whose content has elements of its own kind inside, or no end, or isn't there."""
    o = table(spark, sf_dir, "orders")
    inner = _text("<p>", "o_orderkey", "</p><div class='x'>a<div>b</div></div> c")
    html = F.when(F.col("o_orderkey") % 3 == 0, _text("<h2>Άρθρο ", "o_custkey", "</h2><div class='a post_content b'>", inner, "</div><div>after</div>"))
    html = html.when(F.col("o_orderkey") % 3 == 1, _text("<h3>Άρθρο ", "o_custkey", "</h3><DIV class=\"post_content\">", inner)).otherwise(_text("<h2>Άρθρο ", "o_custkey", "</h2><div class='my-post_content'>x</div>"))
    return article_pages(o.select(_text("http://site.gr/m/?p=", "o_orderkey").alias("url"), html.alias("html")), "url", "html")


SQL_ARTICLES = """
select 'http://site.gr/m/?p=' || o_orderkey as url, o_orderkey::varchar as post_id, 'Άρθρο ' || o_custkey as title,
  case when o_orderkey % 3 < 2 then '<p>' || o_orderkey || '</p><div class=''x''>a<div>b</div></div> c' end as raw_html from orders
"""


def comment_page_list(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    url = _text("http://site.gr/m/?p=", "c_custkey")
    html = F.when(F.col("c_custkey") % 4 > 0, F.array_join(F.transform(F.sequence(F.lit(1), (F.col("c_custkey") % 4).cast("int")), lambda i: F.concat(F.lit("<a class='page-numbers' href='#'> "), i.cast("string"), F.lit("</a>"))), " ")).otherwise("")
    return c.select("c_custkey", F.explode(comment_pages(url, html)).alias("url"))


SQL_COMMENT_PAGES = """
select c_custkey, 'http://site.gr/m/?p=' || c_custkey as url from customer
union all select c_custkey, 'http://site.gr/m/?p=' || c_custkey || '&cpage=' || i from (select c_custkey, unnest(range(1, c_custkey % 4 + 1)) as i from customer where c_custkey % 4 > 1)
"""


def gazette_table(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    row = _text("<table><tr><td>Ν</td><td> ", "c_custkey", " </td><td>", "c_name", "</td><td><a href='f", "c_custkey", "'>ΦΕΚ Α ", "c_custkey", "</a></td><td>1</td><td>2</td><td><a href='p.pdf'>p</a></td></tr><tr><td>short</td></tr></table>")
    return gazette_rows(c.select(row.alias("html")), "html")


SQL_GAZETTE = "select 'Ν' as law_type, c_custkey::varchar as law_number, c_name as description, 'ΦΕΚ Α ' || c_custkey as fek_title, 'f' || c_custkey as fek_url, '1' as date, '2' as pages, 'p.pdf' as pdf_url from customer"


def full_law_citations(spark, sf_dir) -> DataFrame:
    """Citations in their full forms: bracketed with a gazette, of decrees that don't count as laws, and of presidential decrees by number or date."""
    o = table(spark, sf_dir, "orders")
    text = _text("[α.ν. ", "o_custkey", " / ", F.year("o_orderdate"), ", (Α' ", "o_orderkey", ")] και ν.δ. 5/1974, π.δ. ", "o_orderkey", "/", F.year("o_orderdate"))
    rows = o.select("o_orderkey", F.explode(law_citations(text, (LAW, PRESIDENTIAL))).alias("c"))
    return rows.select("o_orderkey", "c.type", "c.number", F.col("c.year").cast("string").alias("year"), "c.gazette")


SQL_FULL = """
select o_orderkey, 'α.ν.' as type, o_custkey::varchar as number, year(o_orderdate)::varchar as year, o_orderkey::varchar as gazette from orders
union all select o_orderkey, 'π.δ.', o_orderkey::varchar, year(o_orderdate)::varchar, null from orders
"""


def ministerial_decisions(spark, sf_dir) -> DataFrame:
    """Decisions by type and reference, by reference and type, and after a paragraph's number, which doesn't count."""
    o = table(spark, sf_dir, "orders")
    code = _text("Δ", "o_custkey", "/", "o_orderkey")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("με την υπουργική απόφαση υπ' αριθμ. "), code, F.lit(" (ΦΕΚ Β' 12/2001) του")))
    text = text.when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("σύμφωνα, "), code, F.lit(" ΚΥΑ, όπως"))).otherwise(F.concat(F.lit("στην παρ. 3 Υ.Α. "), code))
    return o.select("o_orderkey", F.inline(decisions(text))).drop("full_match")


SQL_MINISTERIAL = """
select o_orderkey, case o_orderkey % 3 when 0 then 'υπουργική απόφαση' else 'ΚΥΑ' end as type, 'Δ' || o_custkey || '/' || o_orderkey as id,
  case o_orderkey % 3 when 0 then 'Β' || chr(39) end as series, case o_orderkey % 3 when 0 then '12' end as number, case o_orderkey % 3 when 0 then 2001 end as year from orders where o_orderkey % 3 < 2
"""


def decree_keys(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    date = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, _text("έτος ", F.year("o_orderdate"), "."))
    number = F.when(F.col("o_orderkey") % 5 > 0, _text(" ", "o_custkey", " "))
    return o.select("o_orderkey", F.inline(F.array(decree_key(number, date))))


SQL_DECREES = "select o_orderkey, case when o_orderkey % 5 > 0 then o_custkey::varchar else '' end as number, case when o_orderkey % 3 < 2 then year(o_orderdate) else 0 end::int as year from orders"



def ordinal_headings(spark, sf_dir) -> DataFrame:
    """Headings whose number is in words, alone or joined, or in digits, or isn't one."""
    o = table(spark, sf_dir, "orders")
    words = F.element_at(F.array(*map(F.lit, ("πρώτο", "εικοστό", "εκατοστό", "εκατοστό πρώτο", "Διακοσιοστό Εικοστό Πρώτο", "τριακοσιοστό δωδέκατο", "χιλιοστό"))), (F.col("o_orderkey") % 7 + 1).cast("int"))
    line = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("## Άρθρο "), words, F.lit(" – Τίτλος"))).when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("| ΆΡΘΡΟ "), words, F.lit(" | x"))).when(F.col("o_orderkey") % 4 == 2, _text("Άρθρο ", "o_custkey", ". x")).otherwise(F.concat(F.lit("Το άρθρο "), words))
    return o.select("o_orderkey", article_heading(line).alias("h")).select("o_orderkey", "h.number", "h.type")


SQL_ORDINALS = "select o_orderkey, case when o_orderkey % 4 < 2 then [1, 20, 100, 101, 221, 312, 1000][1 + o_orderkey % 7] when o_orderkey % 4 = 2 then o_custkey end::int as number, case when o_orderkey % 4 < 2 then 'greek_word' when o_orderkey % 4 = 2 then 'arabic' end as type from orders"


def document_states(spark, sf_dir) -> DataFrame:
    """Orders as documents in all states, after a run that has texts for some, empty ones for others, and none for the rest."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = F.element_at(F.array(*map(F.lit, ("pending", "downloaded", "processed", "download_failed", "processing_failed", "processing_skipped"))), (k % 6 + 1).cast("int"))
    url = F.when(k % 5 == 0, "http://x/a.PDF").when(k % 5 == 1, "http://x/download.php?id=3").when(k % 5 == 2, "http://x/page").when(k % 5 == 3, "http://x/b.pdf")
    docs = o.select(k.alias("id"), url.alias("url"), status.alias("status"), F.when(k % 4 == 0, "old").alias("processed_text"), (k % 3).cast("int").alias("tries"))
    outcomes = o.where(k % 7 < 6).select(k.alias("id"), F.when(k % 7 < 3, "new").when(k % 7 == 3, "").alias("text"))
    return advance(docs, outcomes, most_tries=2).select("id", "status", "processed_text", "tries")


SQL_STATES = """
with d as (select o_orderkey as id, ['pending', 'downloaded', 'processed', 'download_failed', 'processing_failed', 'processing_skipped'][1 + o_orderkey % 6] as status, o_orderkey % 5 in (0, 1, 3) as known,
    case when o_orderkey % 4 = 0 then 'old' end as old, (o_orderkey % 3)::int as tries, o_orderkey % 7 as r from orders),
e as (select *, tries < 2 and (status in ('pending', 'download_failed', 'processing_failed', 'processing_skipped') or (status = 'downloaded' and old is null)) as open from d)
select id, case when open and not known then 'processing_skipped' when open and r < 3 then 'processed' when open and r < 6 then 'processing_failed' else status end as status,
  case when open and known and r < 3 then 'new' else old end as processed_text, tries + case when open and known and r < 6 then 1 else 0 end as tries from e
"""


def unfinished_consultations(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 3 == 1).alias("is_finished"), F.col("o_orderdate").cast("timestamp").alias("end_date"))
    return unfinished(rows, F.lit("1995-01-01").cast("timestamp")).select("o_orderkey")


SQL_UNFINISHED = "select o_orderkey from orders where o_orderkey % 3 <> 1 or o_orderdate > timestamp '1995-01-01'"


QUERIES = {
    "stored_listing": stored_listing,
    "stored_metadata": stored_metadata,
    "stored_articles": stored_articles,
    "comment_pages": comment_page_list,
    "gazette_table": gazette_table,
    "full_law_citations": full_law_citations,
    "ministerial_decisions": ministerial_decisions,
    "decree_keys": decree_keys,
    "ordinal_headings": ordinal_headings,
    "document_states": document_states,
    "unfinished_consultations": unfinished_consultations,
}
ORACLES = {
    "stored_listing": SQL_LISTING,
    "stored_metadata": SQL_METADATA,
    "stored_articles": SQL_ARTICLES,
    "comment_pages": SQL_COMMENT_PAGES,
    "gazette_table": SQL_GAZETTE,
    "full_law_citations": SQL_FULL,
    "ministerial_decisions": SQL_MINISTERIAL,
    "decree_keys": SQL_DECREES,
    "ordinal_headings": SQL_ORDINALS,
    "document_states": SQL_STATES,
    "unfinished_consultations": SQL_UNFINISHED,
}
