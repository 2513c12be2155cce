"""Queries on answers of generators, titles, comments, exports and small text functions, over texts that the given tables make up."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.citations import LAW, LEGISLATIVE, gazette_title, law_citations
from quern.functions.forms import PROVISION, form_reach
from quern.functions.json import repaired
from quern.functions.text import greek_look_alikes, inside_quotes, is_complete, plain_apostrophes
from quern.functions.tokens import read_ranks, token_lengths
from quern.operators.clean import decode_entities
from quern.operators.html import comments
from quern.operators.pdf import extracted
from quern.operators.relational import match_rate, unmatched
from quern.plans.base import spread_table, table
from quern.plans.incremental import SQL_CHANGES, change_record
from quern.sources.export import change_report, consultation_texts

#: Where the table of ranks is that tokens are counted by, unless the caller says otherwise.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _said(*parts) -> F.Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def decoded_entities(spark, sf_dir) -> DataFrame:
    """Character references with and without their semicolons."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    text = _said("&copy", k, " &amp", k, ";&#", 65 + k % 26, "; &notit; &notin; &x", k, ";&")
    return o.select("o_orderkey", decode_entities(text).alias("text"))


SQL_ENTITIES = "select o_orderkey, '©' || o_orderkey || ' &' || o_orderkey || ';' || chr((65 + o_orderkey % 26)::int) || ' ¬it; ∉ &x' || o_orderkey || ';&' as text from orders"


def answer_forms(spark, sf_dir) -> DataFrame:
    """Answers made of events: of the form, with another value than its list has, with a field too many, and cut off."""
    e, k = spread_table(spark, sf_dir, "events"), F.col("event_id")
    kind = F.when(k % 4 == 1, "x").otherwise("ρύθμιση")
    text = _said('{"article_title": "', F.col("event_type"), '", "provision_type": "', kind, '","core_provision_summary": "', k, '", "key_themes": ["a_', k, '", "b"]', F.when(k % 4 == 2, ', "more": 1').otherwise(""), "}")
    text = F.when(k % 4 == 3, F.substring(text, 1, 40)).otherwise(text)
    return e.select("event_id", form_reach(text, PROVISION).alias("r")).select("event_id", "r.reach", "r.complete")


SQL_FORMS = """
with e as (select event_id, length(event_type) as t, length(event_id::varchar) as n from events)
select event_id, (case event_id % 4 when 0 then t + 2 * n + 106 when 1 then t + 41 when 2 then t + 2 * n + 105 else 40 end)::int as reach, event_id % 4 = 0 as complete from e
"""


def repaired_answers(spark, sf_dir) -> DataFrame:
    """Objects that are whole, in chatter, or cut off in a text, after a comma, or in a list."""
    e, k = spread_table(spark, sf_dir, "events"), F.col("event_id")
    text = F.when(k % 5 == 0, _said('{"a": ', k, ', "b": "x"}')).when(k % 5 == 1, _said('Here it is: {"a": ', k, '} and so on')).when(k % 5 == 2, _said('{"a": ', k, ', "b": "x'))
    text = text.when(k % 5 == 3, _said('{"a": ', k, ', "b": ["x", "y"')).otherwise(_said("no object ", k))
    return e.select("event_id", repaired(text).alias("answer"))


SQL_REPAIRED = """
select event_id, case event_id % 5 when 0 then '{"a": ' || event_id || ', "b": "x"}' when 1 then '{"a": ' || event_id || '}' when 2 then '{"a": ' || event_id || ', "b": "x"}'
  when 3 then '{"a": ' || event_id || ', "b": ["x", "y"]}' end as answer from events
"""


def gazette_titles(spark, sf_dir) -> DataFrame:
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    title = F.when(k % 3 == 0, _said("ΦΕΚ Α ", F.col("o_custkey"), "/12.03.", F.year("o_orderdate"))).when(k % 3 == 1, _said("Β΄ - ", F.col("o_custkey"), " του ", F.year("o_orderdate"))).otherwise(_said("τίτλος ", k))
    return o.select("o_orderkey", gazette_title(title).alias("g")).select("o_orderkey", "g.series", "g.number", "g.year")


SQL_TITLES = "select o_orderkey, case o_orderkey % 3 when 0 then 'Α' when 1 then 'Β' end as series, case when o_orderkey % 3 < 2 then o_custkey end::int as number, case when o_orderkey % 3 < 2 then year(o_orderdate) end::int as year from orders"


def stored_comments(spark, sf_dir) -> DataFrame:
    """Comments of article pages, one of them twice; names are kept."""
    c, k = spread_table(spark, sf_dir, "customer"), F.col("c_custkey")
    one = lambda n, name, text: _said("<li class='comment' id='comment-", n, "'><cite class='fn'>", name, "</cite> <span class='date'>", n, " Μαΐου 2024</span><p>", text, "</p>")
    page = F.concat(F.lit("<p>before</p><ol>"), one(k, F.col("c_name"), F.lit("<b>first</b> &amp; one</p><p>more")), one(k, F.lit("again"), F.lit("same id")), F.when(k % 2 == 0, one(k + 100_000_000, F.lit("x"), F.lit("second"))).otherwise(""), F.lit("</ol>"))
    return comments(c.select("c_custkey", page.alias("html")), "c_custkey", "html", keep_names=True).withColumnRenamed("page", "c_custkey").where("content <> ''")


SQL_COMMENTS = """
select c_custkey, c_custkey::varchar as comment_id, c_name || 'again' as username, c_custkey || ' Μαΐου 2024' || c_custkey || ' Μαΐου 2024' as date, 'first & one' || chr(10) || chr(10) || 'more' || chr(10) || chr(10) || 'same id' as content from customer
union all select c_custkey, (c_custkey + 100000000)::varchar, 'x', (c_custkey + 100000000) || ' Μαΐου 2024', 'second' from customer where c_custkey % 2 = 0
"""


def change_lines(spark, sf_dir) -> DataFrame:
    """The change record as lines of a report."""
    return change_report(change_record(spark, sf_dir), "o_orderkey")


SQL_LINES = f"select o_orderkey, o_orderkey || ' ' || case when kind = 'changed' then 'changed: ' || columns else kind end as line from ({SQL_CHANGES})"


def consultation_exports(spark, sf_dir) -> DataFrame:
    """Orders with their items as a consultation with its articles, one text each."""
    o = table(spark, sf_dir, "orders")
    heads = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderkey") % 2 == 0, _said("http://x/", F.col("o_orderkey"))).alias("url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"), F.lit(None).cast("string").alias("end_date"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("id"), F.col("l_orderkey").alias("consultation_id"), F.col("l_returnflag").alias("title"), F.when(F.col("l_linenumber") < 3, F.col("l_linestatus")).alias("content"))
    return consultation_texts(heads, items)


SQL_EXPORTS = """
with i as (select l_orderkey, string_agg(l_returnflag || chr(10) || case when l_linenumber < 3 then l_linestatus else '' end, chr(10) || chr(10) order by l_linenumber, l_returnflag, l_linestatus) as body from lineitem group by l_orderkey)
select o_orderkey as id, concat_ws(chr(10) || chr(10), o_orderpriority, case when o_orderkey % 2 = 0 then 'http://x/' || o_orderkey end, strftime(o_orderdate, '%Y-%m-%d'), body) as text from orders left join i on l_orderkey = o_orderkey
"""


def text_helpers(spark, sf_dir) -> DataFrame:
    """Look-alike letters, apostrophes, quotes around a place, and ends of sentences."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    text = _said("ABE ’", k, "΄ \"x", F.when(k % 2 == 0, '" y').otherwise(" y"), F.when(k % 3 == 0, ". ").when(k % 3 == 1, "…").otherwise(","))
    return o.select("o_orderkey", greek_look_alikes(text).alias("greek"), plain_apostrophes(text).alias("plain"), inside_quotes(text, F.length(text) - 2).alias("inside"), is_complete(text).alias("complete"), text.isNotNull().alias("has_text"), (k % 3 == 5).alias("flag"))


SQL_HELPERS = """
with t as (select o_orderkey, 'ABE ’' || o_orderkey || '΄ "x' || case when o_orderkey % 2 = 0 then '" y' else ' y' end || case o_orderkey % 3 when 0 then '. ' when 1 then '…' else ',' end as x from orders)
select o_orderkey, translate(x, 'ABEZHIKMNOPTYX', 'ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ') as greek, replace(replace(x, '’', chr(39)), '΄', chr(39)) as plain,
  (length(left(x, length(x) - 2)) - length(replace(left(x, length(x) - 2), '"', ''))) % 2 = 1 or (length(left(x, length(x) - 2)) - length(replace(left(x, length(x) - 2), chr(39), ''))) % 2 = 1 as inside,
  o_orderkey % 3 < 2 as complete, true as has_text, false as flag from t
"""


def law_or_decree_citations(spark, sf_dir) -> DataFrame:
    """Laws and legislative decrees, with what isn't one beside them."""
    o, k = spread_table(spark, sf_dir, "orders"), F.col("o_orderkey")
    text = _said("των ΠΟΛ ", k, "/2020, κατά το ν.δ. ", F.col("o_custkey"), " / ", F.year("o_orderdate"), " (Α΄ ", k, "), π.δ. 1/2001 και του νόμου ", k, "/1999")
    return o.select("o_orderkey", F.inline(law_citations(text, (LAW, LEGISLATIVE)))).select("o_orderkey", "full_match", "kind", "number", "year", "gazette")


SQL_LAW_OR_DECREE = """
select o_orderkey, 'ν.δ. ' || o_custkey || ' / ' || year(o_orderdate) as full_match, 'legislative decree' as kind, o_custkey::varchar as number, year(o_orderdate)::int as year, o_orderkey::varchar as gazette from orders
union all select o_orderkey, 'νόμου ' || o_orderkey || '/1999', 'law', o_orderkey::varchar, 1999, null from orders
"""


def unmatched_refs(spark, sf_dir) -> DataFrame:
    """The first ten references that no catalogue has, with how often they are made and the rate of those it has."""
    refs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("number"), F.year("l_shipdate").alias("year"))
    cat = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("number"), F.explode(F.sequence(F.lit(1992), F.lit(1996))).alias("year"))
    rate = match_rate(refs, cat, ["number", "year"]).select("match_rate")
    return unmatched(refs, cat, ["number", "year"], 10).withColumn("match_rate", rate.scalar())


SQL_UNMATCHED = """
with r as (select l_partkey as number, year(l_shipdate) as year, count(*) as n from lineitem group by all),
m as (select r.*, p.p_partkey is not null as hit from r left join part p on p.p_partkey = r.number and p.p_partkey % 3 <> 0 and r.year between 1992 and 1996)
select number, year::int as year, n, (select round(100.0::double * count(*) filter (hit) / count(*), 2) from m) as match_rate from m where not hit order by n desc, number, year limit 10
"""


def pdf_texts(spark, sf_dir) -> DataFrame:
    """Files made of orders, some of which aren't PDF files, through an extractor."""
    o, k = spread_table(spark, sf_dir, "orders"), F.col("o_orderkey")
    body = _said("%PDF-1.4\n1 0 obj << /Length 9 >>\nstream\nBT /F1 12 Tf 72 700 Td (Order \\(", k, "\\)) Tj 0 -14 Td [(li) -20 (ne) -300 (", F.col("o_custkey"), ")] TJ ET\nBT <414243> Tj ET\nendstream\nendobj\n%%EOF")
    files = o.select("o_orderkey", F.when(k % 4 == 3, _said("plain ", k)).otherwise(body).cast("binary").alias("content"))
    return extracted(files, "o_orderkey", "content")


SQL_PDF = """
select o_orderkey, case when o_orderkey % 4 < 3 then 'Order (' || o_orderkey || ')' || chr(10) || 'line ' || o_custkey || chr(10) || chr(10) || 'ABC' end as text,
  case when o_orderkey % 4 = 3 then 'ValueError: not a PDF file' end as error from orders
"""


def token_counts(spark, sf_dir) -> DataFrame:
    """Exact token counts of documents, and of their words as an estimate."""
    docs = spread_table(spark, sf_dir, "documents")
    return docs.select("doc_id", token_lengths(F.col("text"), read_ranks(spark, f"file://{RANKS}")).alias("n_tokens"))


QUERIES = {
    "decoded_entities": decoded_entities,
    "answer_forms": answer_forms,
    "repaired_answers": repaired_answers,
    "gazette_titles": gazette_titles,
    "stored_comments": stored_comments,
    "change_lines": change_lines,
    "consultation_exports": consultation_exports,
    "text_helpers": text_helpers,
    "law_or_decree_citations": law_or_decree_citations,
    "unmatched_refs": unmatched_refs,
    "pdf_texts": pdf_texts,
} | ({"token_counts": token_counts} if Path(RANKS).exists() else {})
ORACLES = {
    "decoded_entities": SQL_ENTITIES,
    "answer_forms": SQL_FORMS,
    "repaired_answers": SQL_REPAIRED,
    "gazette_titles": SQL_TITLES,
    "stored_comments": SQL_COMMENTS,
    "change_lines": SQL_LINES,
    "consultation_exports": SQL_EXPORTS,
    "text_helpers": SQL_HELPERS,
    "law_or_decree_citations": SQL_LAW_OR_DECREE,
    "unmatched_refs": SQL_UNMATCHED,
    "pdf_texts": SQL_PDF,
}
