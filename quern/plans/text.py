"""Queries on scalar functions, citations, HTML and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.budgets import budget, dynamic_budget, estimated_tokens, n_sentences
from quern.functions.citations import law_references, modifies_law
from quern.functions.convert import MONTHS_OF, extraction_quality, greek_date, greek_timestamp, lenient_double, lenient_int, ministry_code, new_status, normalized_url, url_host, with_parameter, year_of
from quern.functions.json import bullet, json_field, plan_errors, validated
from quern.functions.numerals import article_heading, greek_to_int, int_to_greek
from quern.functions.text import categorize, fold_upper, is_object, is_purpose, n_nonblank_lines, n_words, quoted_segments, safe_filename, strip_accents, within_one_edit
from quern.operators.html import article_links, html_to_markdown, links, page_title, paragraphs
from quern.plans.base import spread_table, table


def normalize_url(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", normalized_url(F.col("url")).alias("normalized"), url_host(F.col("url")).alias("host"), ministry_code(F.col("url")).alias("code"))


SQL_URL = r"""
with p as (select page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?', ['host', 'path', 'query']) as u from pages)
select page_id, lower(u.host) || case when u.path = '/' then '/' else rtrim(u.path, '/') end || case when u.query <> '' then '?' || u.query else '' end as normalized,
  nullif(lower(u.host), '') as host, nullif(lower(split_part(ltrim(u.path, '/'), '/', 1)), '') as code from p
"""


def host_counts(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.groupBy(url_host(F.col("url")).alias("host")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(20)


def page_parameter(spark, sf_dir) -> DataFrame:
    """The page parameter of addresses, and the address of the comments of page 2."""
    pages = table(spark, sf_dir, "pages")
    found = F.nullif(F.regexp_extract("url", r"[?&]page=([^&#]*)", 1), F.lit(""))
    return pages.select("page_id", found.alias("page"), with_parameter(F.col("url"), "cpage", F.lit(2), "comments").alias("next_url"))


SQL_PARAMETER = r"select page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as page, regexp_replace(url, '#.*$', '') || case when contains(regexp_replace(url, '#.*$', ''), '?') then '&' else '?' end || 'cpage=2#comments' as next_url from pages"


def page_links(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.posexplode(links(F.col("html")))).select("page_id", "pos", "col.href", "col.label")


SQL_LINKS = r"""
with l as (select page_id, regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) as h, regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2) as t from pages)
select page_id, (i - 1)::int as pos, h[i] as href, trim(regexp_replace(t[i], '<[^>]*>', '', 'g')) as label from (select *, unnest(range(1, len(h) + 1)) as i from l)
"""


def page_titles(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", page_title(F.col("html")).alias("title"))


def paragraph_text(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.posexplode(paragraphs(F.col("html"))).alias("pos", "paragraph"))


SQL_PARAGRAPHS = r"""
with s as (select page_id, string_split(regexp_replace(coalesce(html, ''), '(?is)<p(?:\s[^>]*)?>', chr(1), 'g'), chr(1)) as parts from pages),
e as (select page_id, unnest(range(2, len(parts) + 1)) as i, parts from s),
t as (select page_id, i, trim(regexp_replace(regexp_replace(regexp_replace(parts[i], '(?is)(</p>|<p\s).*$', ''), '<[^>]*>', '', 'g'), '[ \t\r\n]+', ' ', 'g')) as paragraph from e)
select page_id, (row_number() over (partition by page_id order by i) - 1)::int as pos, paragraph from t where paragraph <> ''
"""


def markdown_pages(spark, sf_dir) -> DataFrame:
    return spread_table(spark, sf_dir, "pages").select("page_id", html_to_markdown(F.col("html")).alias("markdown"))


def listing_links(spark, sf_dir) -> DataFrame:
    """Links of a listing made of the pages' own links, numbered as posts."""
    pages = table(spark, sf_dir, "pages").withColumn("html", F.regexp_replace("html", 'href="/', 'href="/x/?p=1'))
    return pages.select("page_id", F.size(article_links(F.col("html"))).alias("n"))


_LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>"""
SQL_LISTING_LINKS = rf"""
with p as (select page_id, replace(coalesce(html, ''), 'href="/', 'href="/x/?p=1') as html from pages),
l as (select page_id, unnest(list_zip(regexp_extract_all(html, '{_LINK}', 1), regexp_extract_all(html, '{_LINK}', 2))) as x from p),
k as (select page_id, x[1] as href, trim(regexp_replace(x[2], '<[^>]*>', '', 'g')) as label from l)
select p.page_id, count(distinct href) filter (regexp_matches(href, '[?&]p=\d+') and length(label) >= 3 and label not like '%http%')::int as n from p left join k using (page_id) group by p.page_id
"""


def text_measures(spark, sf_dir) -> DataFrame:
    docs, t = table(spark, sf_dir, "documents"), F.col("text")
    return docs.select("doc_id", n_words(t).alias("words"), n_nonblank_lines(t).alias("filled_lines"), n_sentences(t).alias("sentences"), estimated_tokens(t).alias("tokens"))


SQL_MEASURES = r"""
with d as (select doc_id, text, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) as words from documents)
select doc_id, words::int as words, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S')))::int as filled_lines,
  greatest(1, length(text) - length(translate(text, '.;', '')))::int as sentences, floor(words / 0.75::double)::bigint as tokens from d
"""


def length_budget(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("b", budget(F.col("text"))).withColumn("d", dynamic_budget(F.col("text")))
    return docs.select("doc_id", "b.target_words", "b.target_sentences", "b.token_limit", "d.min_words", "d.max_words")


SQL_BUDGET = r"""
with d as (select doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) as w from documents),
b as (select doc_id, greatest(1, floor(w * 0.1::double))::bigint as t, greatest(1, floor(w * 0.12::double))::bigint as u from d)
select doc_id, t as target_words, greatest(1, round_even(t / 20::double, 0))::bigint as target_sentences, ceil(t * 2.5::double * 1.1::double)::bigint as token_limit, floor(u * 0.8::double)::bigint as min_words, floor(u * 1.2::double)::bigint as max_words from b
"""

_RULES = (("steel_brass", ("STEEL", "PLATED"), ()), ("tin", ("TIN",), ("SMALL",)), ("brass", ("BRASS",), ("PROMO",)))


def categorize_titles(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", categorize(F.col("p_type"), _RULES).alias("category"))


SQL_CATEGORY = "select p_partkey, case when p_type like '%STEEL%' and p_type like '%PLATED%' then 'steel_brass' when p_type like '%TIN%' and p_type not like '%SMALL%' then 'tin' when p_type like '%BRASS%' and p_type not like '%PROMO%' then 'brass' else 'other' end as category from part"


def lenient_casts(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    text = F.when(F.col("c_custkey") % 5 == 0, "None").when(F.col("c_custkey") % 5 == 1, F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit("%"))).when(F.col("c_custkey") % 5 == 2, F.concat(F.lit("Some("), F.col("c_custkey").cast("string"), F.lit(".5)"))).when(F.col("c_custkey") % 5 == 3, "").otherwise(F.col("c_custkey").cast("string"))
    return c.select("c_custkey", lenient_double(text).alias("number"), lenient_int(text).alias("whole"))


SQL_CASTS = "select c_custkey, case c_custkey % 5 when 1 then c_custkey::double when 2 then c_custkey + 0.5::double when 4 then c_custkey::double end as number, case when c_custkey % 5 in (1, 2, 4) then c_custkey end as whole from customer"


def years(spark, sf_dir) -> DataFrame:
    """Years of dates written as ISO, day first, or not at all."""
    o = table(spark, sf_dir, "orders")
    iso, day = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "dd.MM.yyyy")
    text = F.when(F.col("o_orderkey") % 3 == 0, iso).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("No. 7 of "), day)).otherwise("undated")
    return o.select("o_orderkey", year_of(text).alias("year"))


def statuses(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    old = F.when(F.col("o_orderkey") % 4 == 0, "Good").when(F.col("o_orderkey") % 4 == 1, "FAILED").when(F.col("o_orderkey") % 4 == 2, "downloaded")
    rating = F.when(F.col("o_orderstatus") == "F", "good").when(F.col("o_orderstatus") == "O", "bad")
    error = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("")
    return o.select("o_orderkey", new_status(old).alias("status"), extraction_quality(rating, error).alias("quality"))


SQL_STATUSES = "select o_orderkey, case o_orderkey % 4 when 0 then 'processed' when 1 then 'processing_failed' when 2 then 'downloaded' else 'pending' end as status, case o_orderstatus when 'F' then 'good' when 'O' then 'bad' else case when o_orderkey % 2 = 0 then o_orderpriority else 'unknown' end end as quality from orders"


def citation_extract(spark, sf_dir) -> DataFrame:
    """Citations in sentences that orders make up: law number of the key, year of the date."""
    o = table(spark, sf_dir, "orders")
    text = F.concat(F.lit("σύμφωνα με τον Ν. "), F.col("o_custkey").cast("string"), F.lit("/"), F.year("o_orderdate").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" και του ΝΌΜΟΥ "), F.col("o_orderkey").cast("string"), F.lit(" / 2001"))).otherwise(" και 12/2001"))
    return o.select("o_orderkey", F.posexplode(law_references(text)).alias("pos", "r")).select("o_orderkey", "pos", "r.full_match", "r.type", "r.number", "r.year")


SQL_CITATIONS = """
select o_orderkey, 0 as pos, 'Ν. ' || o_custkey || '/' || year(o_orderdate) as full_match, 'Ν.' as type, o_custkey::varchar as number, year(o_orderdate)::int as year from orders
union all select o_orderkey, 1, 'ΝΌΜΟΥ ' || o_orderkey || ' / 2001', 'ΝΌΜΟΥ', o_orderkey::varchar, 2001 from orders where o_orderkey % 2 = 0
"""


def greek_scalars(spark, sf_dir) -> DataFrame:
    """Orders' numbers as numerals there and back, and functions on Greek texts with them."""
    o = spread_table(spark, sf_dir, "orders").withColumn("n", (F.col("o_orderkey") % 999 + 1).cast("int"))
    n, numeral = F.col("n"), int_to_greek(F.col("n"))
    day = (n % 28 + 1).cast("string")
    return o.select(
        "o_orderkey",
        numeral.alias("numeral"),
        greek_to_int(numeral).alias("back"),
        article_heading(F.concat(F.lit("## Άρθρο "), n.cast("string"), F.lit(". Τίτλος")))["number"].alias("heading"),
        fold_upper(F.concat(F.lit("Σκοπός του άρθρου "), n.cast("string"))).alias("folded"),
        within_one_edit(F.concat(F.lit("ΜΕΡΟ"), numeral), F.lit("ΜΕΡΟΣ")).alias("near"),
        greek_timestamp(F.concat(day, F.lit(" Μαΐου 2024, 09:30"))).alias("stamp"),
        greek_date(F.concat(day, F.lit(" Μάιος, 2024"))).alias("day"),
        modifies_law(F.concat(F.lit("Στον ν. "), n.cast("string"), F.lit("/2020 προστίθεται:\n«Κείμενο\nσε γραμμές"), F.when(n % 2 == 0, "»").otherwise(""))).alias("modifies"),
    )


#: The numeral's 90 shares its letter with 100, and 900 has one that isn't read back.
SQL_GREEK = """
with o as (select o_orderkey, (o_orderkey % 999 + 1)::int as n from orders),
k as (select *, ['', 'Ρ', 'Σ', 'Τ', 'Υ', 'Φ', 'Χ', 'Ψ', 'Ω', 'Ϡ'][n // 100 + 1] || ['', 'Ι', 'Κ', 'Λ', 'Μ', 'Ν', 'Ξ', 'Ο', 'Π', 'Ρ'][n // 10 % 10 + 1] || ['', 'Α', 'Β', 'Γ', 'Δ', 'Ε', 'ΣΤ', 'Ζ', 'Η', 'Θ'][n % 10 + 1] as numeral from o)
select o_orderkey, numeral, (n + case when n // 10 % 10 = 9 then 10 else 0 end - case when n >= 900 then 900 else 0 end)::int as back, n as heading, 'ΣΚΟΠΟΣ ΤΟΥ ΑΡΘΡΟΥ ' || n as folded,
  length(numeral) = 1 or (length(numeral) = 2 and contains(numeral, 'Σ')) as near, make_timestamp(2024, 5, n % 28 + 1, 9, 30, 0) as stamp, make_date(2024, 5, n % 28 + 1) as day, n % 2 = 0 as modifies from k
"""


def quotes_and_names(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    text = F.concat(F.lit("a «"), F.col("text"), F.lit("» b «abc»"))
    return c.select("conv_id", "turn", F.size(quoted_segments(text)).alias("n_quotes"), safe_filename(F.concat(F.col("role"), F.lit(" / "), F.col("turn").cast("string"), F.lit("?.txt"))).alias("name"))


SQL_QUOTES = "select conv_id, turn, case when length(text) >= 5 then 1 else 0 end as n_quotes, role || '_' || turn || '_.txt' as name from conversations"


def json_validated_parse(spark, sf_dir) -> DataFrame:
    """Answers made of events: some in fences, some with a field too many or too few."""
    e = table(spark, sf_dir, "events")
    body = F.concat(F.lit('{"article_title": "'), F.col("event_type"), F.lit('", "provision_type": "x", "core_provision_summary": " s ", "key_themes": ["a ", "b", "", "c", "d"]'), F.when(F.col("event_id") % 3 == 0, ', "more": 1}').otherwise("}"))
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```"))).when(F.col("event_id") % 5 == 0, F.lit("no answer")).otherwise(body)
    fields = ("article_title", "provision_type", "core_provision_summary", "key_themes")
    v = validated(raw, fields)
    return e.select("event_id", v["article_title"].alias("title"), v["core_provision_summary"].alias("summary"), F.array_join(v["key_themes"], "|").alias("themes"), json_field(raw, "provision_type").alias("kind"), bullet(F.lit("new_provision"), raw).alias("bullet"))


SQL_JSON = """
with e as (select event_id, event_type, event_id % 2 = 1 and event_id % 5 = 0 as none, event_id % 3 = 0 as more from events)
select event_id, case when not none and not more then event_type end as title, case when not none and not more then 's' end as summary, case when not none and not more then 'a|b|c' end as themes,
  case when not none then 'x' end as kind, case when not none and not more then '• ' || event_type || ' (x): s' end as bullet from e
"""


def event_properties(spark, sf_dir) -> DataFrame:
    """Keys of the events' JSON."""
    e = table(spark, sf_dir, "events")
    return e.select(F.explode(F.json_object_keys("props")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


def plans_checked(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    known = F.concat(F.lit("kefalaio_"), (F.col("c_custkey") % 4).cast("string"))
    plan = F.concat(F.lit('{"overall_narrative_arc": "a", "protagonist": "b", "problem": "c", "narrative_sections": [{"section_title": "t", "section_role": "r", "source_chapters": ["'), known, F.lit('"]}]}'))
    raw = F.when(F.col("c_custkey") % 5 == 0, '{"problem": "c"}').otherwise(plan)
    return c.select("c_custkey", F.size(plan_errors(raw, F.array(F.lit("kefalaio_1"), F.lit("kefalaio_2")))).alias("n_errors"))


def accent_fold(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(strip_accents(F.col("text"))).alias("digest"))


def edit_le1(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").where(within_one_edit(F.col("p_brand"), F.lit("Brand#12"))).select("p_partkey", "p_brand")


def parse_dates(spark, sf_dir) -> DataFrame:
    """Order dates written in Greek with a time made of the key, and read again; every tenth is no date."""
    o = table(spark, sf_dir, "orders")
    month = F.element_at(F.array(*map(F.lit, MONTHS_OF)), F.month("o_orderdate"))
    text = F.concat_ws(" ", F.day("o_orderdate"), month, F.concat(F.year("o_orderdate").cast("string"), F.lit(", "), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":15")))
    return o.select("o_orderkey", greek_timestamp(F.when(F.col("o_orderkey") % 10 != 0, text).otherwise("x")).alias("at"))


SQL_DATES = "select o_orderkey, case when o_orderkey % 10 <> 0 then date_trunc('day', o_orderdate) + to_hours((o_orderkey % 24)::int) + interval 15 minute end as at from orders"


def scope_detect(spark, sf_dir) -> DataFrame:
    """Purpose and object articles among titles that name one, the other, or neither."""
    c = table(spark, sf_dir, "customer")
    title = F.when(F.col("c_custkey") % 3 == 0, "Άρθρο 1 – Σκοπός").when(F.col("c_custkey") % 3 == 1, "ΑΝΤΙΚΕΙΜΕΝΟ:").otherwise(F.col("c_name"))
    return c.select("c_custkey", is_purpose(title, F.col("c_name")).alias("purpose"), is_object(title, F.col("c_name")).alias("object"))


QUERIES = {
    "accent_fold": accent_fold,
    "edit_le1": edit_le1,
    "parse_dates": parse_dates,
    "scope_detect": scope_detect,
    "normalize_url": normalize_url,
    "host_counts": host_counts,
    "page_parameter": page_parameter,
    "links_from_pages": page_links,
    "title_from_pages": page_titles,
    "paragraph_text": paragraph_text,
    "html_to_markdown": markdown_pages,
    "listing_links": listing_links,
    "text_measures": text_measures,
    "length_budget": length_budget,
    "categorize_titles": categorize_titles,
    "lenient_cast": lenient_casts,
    "extract_year": years,
    "status_mapping": statuses,
    "citation_extract": citation_extract,
    "greek_scalars": greek_scalars,
    "quotes_and_names": quotes_and_names,
    "json_validated_parse": json_validated_parse,
    "event_properties": event_properties,
    "plan_validation": plans_checked,
}
ORACLES = {
    "paragraph_text": SQL_PARAGRAPHS,
    "listing_links": SQL_LISTING_LINKS,
    "greek_scalars": SQL_GREEK,
    "accent_fold": "select doc_id, md5(strip_accents(text)) as digest from documents",
    "edit_le1": "select p_partkey, p_brand from part where levenshtein(p_brand, 'Brand#12') <= 1",
    "parse_dates": SQL_DATES,
    "scope_detect": "select c_custkey, c_custkey % 3 = 0 as purpose, c_custkey % 3 = 1 as object from customer",
    "normalize_url": SQL_URL,
    "host_counts": "select lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) as host, count(*) as n from pages group by 1 order by n desc, host limit 20",
    "page_parameter": SQL_PARAMETER,
    "links_from_pages": SQL_LINKS,
    "title_from_pages": "select page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') as title from pages",
    "text_measures": SQL_MEASURES,
    "length_budget": SQL_BUDGET,
    "categorize_titles": SQL_CATEGORY,
    "lenient_cast": SQL_CASTS,
    "extract_year": "select o_orderkey, case when o_orderkey % 3 < 2 then year(o_orderdate)::int end as year from orders",
    "status_mapping": SQL_STATUSES,
    "citation_extract": SQL_CITATIONS,
    "quotes_and_names": SQL_QUOTES,
    "json_validated_parse": SQL_JSON,
    "event_properties": "select key, count(*) as n from (select unnest(json_keys(props)) as key from events) group by key",
    "plan_validation": "select c_custkey, case when c_custkey % 5 = 0 then 1 when c_custkey % 4 in (1, 2) then 0 else 1 end as n_errors from customer",
}
