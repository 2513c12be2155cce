"""Queries on text quality and tables in text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.clean import TEXT_MISSING, clean_text, quality_report, removable, script_count, visible, with_clean, with_quality
from quern.operators.reports import histogram
from quern.operators.tables import clean_and_report, remove_malformed, table_issues, table_summary
from quern.plans.base import spread_table, table

DROPPED = removable(["latin"])


def quality_report_by_lang(spark, sf_dir) -> DataFrame:
    return quality_report(spread_table(spark, sf_dir, "documents"), "lang")


def clean_metrics_per_doc(spark, sf_dir) -> DataFrame:
    return with_clean(spread_table(spark, sf_dir, "documents"), "text", ["latin"]).select("doc_id", "orig_chars", "kept_chars", F.length("cleaned").alias("cleaned_chars"))


#: Lines of documents, cleaned: the synthetic documents have neither tags nor entities, so only characters are dropped.
_LINES = f"""
l as (select doc_id, lang, n, i, list_extract(ls, i) as raw from (
    select doc_id, lang, ls, len(ls) - case when text = '' or text like '%\n' then 1 else 0 end as n, unnest(range(1, len(ls) - case when text = '' or text like '%\n' then 1 else 0 end + 1)) as i
    from (select doc_id, lang, text, string_split(text, chr(10)) as ls from documents))),
c as (select doc_id, lang, i, raw, translate(raw, '{DROPPED}', '') as out from l),
k as (select *, length(regexp_replace(raw, '\\s', '', 'g')) - length(regexp_replace(out, '\\s', '', 'g')) as loss from c),
o as (select *, case when loss >= 5 and trim(out) <> '' then rtrim(out) || ' {TEXT_MISSING}' when loss >= 5 and trim(raw) <> '' then '{TEXT_MISSING}' else out end as line,
    case when loss >= 5 and trim(out) <> '' then 22 when loss >= 5 and trim(raw) <> '' then 21 else 0 end as extra from k),
m as (select doc_id, lang, sum(length(raw)) as orig, greatest(sum(length(line) - extra), 0) as kept, sum(length(line)) + count(*) - 1 as chars,
    string_agg(line, chr(10) order by i) as cleaned from o group by doc_id, lang)
"""
_SCORED = f"""
with {_LINES},
d as (select doc_id, lang, text from documents),
s as (select d.doc_id, d.lang, coalesce(orig, 0) as orig, coalesce(kept, 0) as kept,
    coalesce(cleaned, '') || case when text like '%\n' and cleaned is not null then chr(10) else '' end as cleaned,
    case when coalesce(orig, 0) > 0 then 1 - kept / orig::double else 0.0::double end as badness
  from d left join m using (doc_id)),
p as (select *, length(regexp_replace(cleaned, '\\s', '', 'g')) as vis, length(regexp_replace(cleaned, '[^a-zA-Z]', '', 'g')) as lat from s)
"""
SQL_REPORT = (
    _SCORED
    + """select lang, count(*) as documents, count(*) filter (cleaned <> '') as cleaned_documents, round(avg(badness), 4) as avg_badness, round(min(badness), 4) as min_badness,
  round(max(badness), 4) as max_badness, round(avg(case when vis > 0 then 100.0::double * lat / vis else 0.0::double end), 1) as avg_latin_pct from p group by lang"""
)
SQL_METRICS = _SCORED + "select doc_id, orig::bigint as orig_chars, kept::bigint as kept_chars, length(cleaned) as cleaned_chars from p"


def script_percentages(spark, sf_dir) -> DataFrame:
    scored = with_quality(spread_table(spark, sf_dir, "documents"), "text", ["latin", "greek"])
    return scored.select("doc_id", F.round("latin_pct", 4).alias("latin_pct"), F.round("greek_pct", 4).alias("greek_pct"))


def raw_script_counts(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", script_count(F.col("text"), "latin").alias("latin"), script_count(F.col("text"), "numbers").alias("numbers"), visible(F.col("text")).alias("visible_chars"))


SQL_RAW = "select doc_id, length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) as latin, length(regexp_replace(text, '[^0-9]', '', 'g')) as numbers, length(regexp_replace(text, '\\s', '', 'g')) as visible_chars from documents"


def badness_histogram(spark, sf_dir) -> DataFrame:
    scored = with_quality(spread_table(spark, sf_dir, "documents"), "text", ["latin"]).select(F.round("badness", 6).alias("badness"))
    return histogram(scored, "badness", 10).select("bin", "n")


SQL_HISTOGRAM = (
    _SCORED
    + """, b as (select floor(round(badness, 6) * 10)::bigint as bin from p)
select g.bin, count(b.bin) as n from (select unnest(range((select min(bin) from b), (select max(bin) from b) + 1)) as bin) g left join b using (bin) group by g.bin"""
)


def clean_pages_tags(spark, sf_dir) -> DataFrame:
    return with_clean(spread_table(spark, sf_dir, "pages"), "html", ["latin", "french", "spanish"]).select("page_id", "orig_chars", F.length(clean_text(F.col("html"), ["latin"])).alias("cleaned_chars"))


SQL_PAGES = f"""
with l as (select page_id, i, list_extract(ls, i) as raw from (select page_id, ls, unnest(range(1, len(ls) - case when html = '' or html like '%\n' then 1 else 0 end + 1)) as i
    from (select page_id, html, string_split(html, chr(10)) as ls from pages))),
e as (select *, replace(replace(replace(replace(raw, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') as txt from l),
b as (select *, regexp_replace(txt, '(<!--.*?-->)|<[^>]*>', '\\1', 'g') as bare, len(list_filter(regexp_extract_all(txt, '<!--.*?-->|<[^>]*>'), lambda x: x[1:4] <> '<!--')) as tags from e),
c as (select *, translate(bare, '{DROPPED}', '') as out from b),
k as (select *, length(regexp_replace(txt, '\\s', '', 'g')) - length(regexp_replace(out, '\\s', '', 'g')) - 2 * tags as loss, regexp_matches(trim(out), '^<!--[^>]*-->$') as whole from c),
o as (select *, case when loss >= 5 and not whole and trim(out) <> '' then rtrim(out) || ' {TEXT_MISSING}' when loss >= 5 and not whole and trim(raw) <> '' then '{TEXT_MISSING}' else out end as line from k)
select page_id, sum(length(raw))::bigint as orig_chars, (sum(length(line)) + count(*) - 1 + case when any_value(html) like '%\n' then 1 else 0 end)::bigint as cleaned_chars
from o join pages using (page_id) group by page_id
"""


def _with_tables(spark, sf_dir) -> DataFrame:
    """Documents whose lines with pipes become rows, with a separator after every third line of them and after each line that ends with "the."."""
    docs = spread_table(spark, sf_dir, "documents")
    row = lambda x: F.when(x.contains("|"), F.concat(F.lit("| "), x, F.lit(" |"))).otherwise(x)
    out = F.transform(F.split("text", "\n"), lambda x, i: F.when(x.contains("|") & (i % 3 == 1), F.concat(row(x), F.lit("\n| --- | --- |"))).when(x.contains("|") & (i % 7 == 2), F.concat(F.lit("|:--| x\n"), row(x))).otherwise(row(x)))
    return docs.select("doc_id", F.array_join(out, "\n").alias("text"))


def malformed_tables(spark, sf_dir) -> DataFrame:
    return table_issues(_with_tables(spark, sf_dir), "doc_id", "text").withColumnRenamed("doc", "doc_id")


def table_summaries(spark, sf_dir) -> DataFrame:
    return table_summary(_with_tables(spark, sf_dir), "doc_id", "text").withColumnRenamed("doc", "doc_id")


_TABLES = r"""
with recursive src as (select doc_id, string_split(array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: case
      when contains(x, '|') and (i - 1) % 3 = 1 then '| ' || x || ' |' || chr(10) || '| --- | --- |'
      when contains(x, '|') and (i - 1) % 7 = 2 then '|:--| x' || chr(10) || '| ' || x || ' |'
      when contains(x, '|') then '| ' || x || ' |' else x end), chr(10)), chr(10)) as ls from documents),
l as (select doc_id, i - 1 as line_no, list_extract(ls, i) as line from (select doc_id, ls, unnest(range(1, len(ls) + 1 - case when ls[len(ls)] = '' then 1 else 0 end)) as i from src where list_any_value(ls) is not null)),
k as (select *, regexp_matches(line, '^\s*\|.*\|\s*$') as is_row, regexp_matches(line, '^\s*\|\s*[-:]+\s*\|') as is_sep,
    case when trim(line) like '|%|' and length(trim(line)) > 1 then len(string_split(trim(line)[2:-2], '|')) else 0 end as cols from l),
-- the state of the loop: the last line of the table that is being read
w as (select doc_id, line_no, is_row, is_sep, cols, is_sep as starts, is_sep or false as in_table from k where line_no = 0
  union all
  select k.doc_id, k.line_no, k.is_row, k.is_sep, k.cols, k.is_sep and not (w.in_table and k.is_row), (k.is_sep and not (w.in_table and k.is_row)) or (w.in_table and k.is_row)
  from w join k on k.doc_id = w.doc_id and k.line_no = w.line_no + 1),
t as (select *, sum(case when starts then 1 else 0 end) over (partition by doc_id order by line_no) as nth, lag(is_row, 1, false) over (partition by doc_id order by line_no) as above_row,
    lag(cols) over (partition by doc_id order by line_no) as above_cols from w),
h as (select doc_id, nth, line_no as sep, cols as expected, case when above_row then above_cols end as header, case when above_row then line_no - 1 else line_no end as start_line from t where starts),
z as (select doc_id, nth, max(line_no) as end_line from t where in_table group by doc_id, nth),
f as (select * from h join z using (doc_id, nth)),
issues as (
  select doc_id, sep + 1 as line_number, case when header is null then 'Table separator without header row' else 'Table header and separator column count mismatch' end as description,
    header as expected, f.expected as found, start_line, end_line from f where header is null or header <> f.expected
  union all
  select doc_id, line_no + 1, 'Table row has inconsistent column count', f.expected, t.cols, start_line, end_line
  from t join f using (doc_id, nth) where t.in_table and not t.starts and t.is_row and f.expected > 0 and t.cols <> f.expected)
"""
SQL_ISSUES = _TABLES + "select doc_id, line_number::bigint as line_number, description, expected::bigint as expected, found::bigint as found, start_line::bigint as start_line, end_line::bigint as end_line from issues"
SQL_SUMMARY = _TABLES + "select d.doc_id, coalesce(a.n, 0)::bigint as total_tables, coalesce(b.n, 0)::bigint as malformed_tables from documents d left join (select doc_id, count(*) as n from f group by doc_id) a using (doc_id) left join (select doc_id, count(*) as n from issues group by doc_id) b using (doc_id)"


def remove_tables(spark, sf_dir) -> DataFrame:
    out = remove_malformed(_with_tables(spark, sf_dir), "doc_id", "text")
    return out.select("doc_id", F.length("text").alias("chars"), F.md5("text").alias("digest"))


SQL_REMOVED = (
    _TABLES
    + r""", g as (select l.doc_id, l.line_no, l.line, exists (select 1 from issues x where x.doc_id = l.doc_id and l.line_no between x.start_line and x.end_line) as gone from l),
r as (select *, lag(gone, 1, false) over (partition by doc_id order by line_no) as above from g),
j as (select doc_id, string_agg(case when gone then '<!-- table-removed -->' else line end, chr(10) order by line_no) as body, count(*) filter (gone) as n from r where not (gone and above) group by doc_id),
q as (select s.doc_id, array_to_string(s.ls, chr(10)) as whole, j.body, j.n from src s left join j using (doc_id)),
e as (select doc_id, case when coalesce(n, 0) = 0 then whole when whole like '%
' and body <> '<!-- table-removed -->' then body || chr(10) else body end as text from q)
select doc_id, length(text) as chars, md5(text) as digest from e"""
)

def complete_report(spark, sf_dir) -> DataFrame:
    """All four steps: clean, find tables, remove malformed ones, score what is left."""
    out = clean_and_report(_with_tables(spark, sf_dir), "doc_id", "text", ["latin"])
    return out.select("doc_id", "total_tables", "malformed_tables", F.md5("text").alias("digest"))


#: The same by the steps' SQL: lines are cleaned, then tables found in what came out of it. No line of the documents is dropped by either cleaning.
SQL_COMPLETE = (
    _TABLES.replace("select doc_id, i - 1 as line_no, list_extract(ls, i) as line from", f"select doc_id, i - 1 as line_no, translate(list_extract(ls, i), '{DROPPED}', '') as raw_line, list_extract(ls, i) as raw from").replace(
        "\nk as (", """
y as (select *, length(regexp_replace(raw, '\\s', '', 'g')) - length(regexp_replace(raw_line, '\\s', '', 'g')) as loss from l),
o as (select doc_id, line_no, case when loss >= 5 and trim(raw_line) <> '' then rtrim(raw_line) || ' """
        + TEXT_MISSING
        + """' when loss >= 5 and trim(raw) <> '' then '"""
        + TEXT_MISSING
        + """' else raw_line end as line from y),
k as (""",
    ).replace("else 0 end as cols from l)", "else 0 end as cols from o)")
    + r""", gone as (select o.doc_id, o.line_no, o.line, exists (select 1 from issues x where x.doc_id = o.doc_id and o.line_no between x.start_line and x.end_line) as gone from o),
r as (select *, lag(gone, 1, false) over (partition by doc_id order by line_no) as above from gone),
j as (select doc_id, string_agg(case when gone then '<!-- table-removed -->' else line end, chr(10) order by line_no) as body from r where not (gone and above) group by doc_id),
e as (select doc_id, ls[len(ls)] = '' and len(ls) > 1 as ended from src)
select d.doc_id, coalesce(a.n, 0)::bigint as total_tables, coalesce(b.n, 0)::bigint as malformed_tables,
  md5(coalesce(body, '') || case when ended and body is not null and body <> '<!-- table-removed -->' then chr(10) else '' end) as digest
from documents d left join (select doc_id, count(*) as n from f group by doc_id) a using (doc_id) left join (select doc_id, count(*) as n from issues group by doc_id) b using (doc_id) left join j using (doc_id) left join e using (doc_id)
"""
)


QUERIES = {
    "quality_report_by_lang": quality_report_by_lang,
    "clean_metrics_per_doc": clean_metrics_per_doc,
    "clean_pages_tags": clean_pages_tags,
    "script_percentages": script_percentages,
    "raw_script_counts": raw_script_counts,
    "badness_histogram": badness_histogram,
    "malformed_tables": malformed_tables,
    "table_summary": table_summaries,
    "remove_tables": remove_tables,
    "complete_report": complete_report,
}
ORACLES = {
    "quality_report_by_lang": SQL_REPORT,
    "clean_metrics_per_doc": SQL_METRICS,
    "clean_pages_tags": SQL_PAGES,
    "script_percentages": _SCORED + "select doc_id, round(case when vis > 0 then 100.0::double * lat / vis else 0.0::double end, 4) as latin_pct, 0.0::double as greek_pct from p",
    "raw_script_counts": SQL_RAW,
    "badness_histogram": SQL_HISTOGRAM,
    "malformed_tables": SQL_ISSUES,
    "table_summary": SQL_SUMMARY,
    "remove_tables": SQL_REMOVED,
    "complete_report": SQL_COMPLETE,
}
