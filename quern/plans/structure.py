"""Queries on the structure of documents: numbered runs, indexes, segments, sections, gaps, hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.islands import index_headings, number_gaps, number_jumps, order_anomalies, segments, sequence_counts, sequences, title_range
from quern.operators.sections import chapter_texts, continuity, continuity_summary, dry_run_report, dry_run_text, forward_fill, hierarchy
from quern.operators.structure import article_chunks, chunks, pairwise_reduce, spans
from quern.plans.base import table


def _headings(spark, sf_dir) -> DataFrame:
    """Orders as headings: the customer is the document, the key the line, the day of the month gives the number."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("line_no"), (F.day("o_orderdate") % 6).alias("number"), F.when(F.col("o_orderstatus") == "O", "arabic").otherwise("greek_word").alias("type"))


_HEADINGS = "h as (select o_custkey as doc, o_orderkey as line_no, (day(o_orderdate) % 6)::int as number, case when o_orderstatus = 'O' then 'arabic' else 'greek_word' end as type from orders)"


def _runs(skip: int) -> str:
    return f"""
{_HEADINGS},
p as (select *, lag(number) over w as pn, lag(type) over w as pt from h window w as (partition by doc order by line_no)),
b as (select *, case when pn >= 1 and pt = type and number > pn and number <= pn + {1 + skip} then 0 else 1 end as brk from p),
g as (select *, case when number >= 1 then sum(brk) over (partition by doc order by line_no) end as run from b)"""


def article_sequences(spark, sf_dir) -> DataFrame:
    return sequences(_headings(spark, sf_dir)).select("doc", "line_no", "number", "type", "sequence")


SQL_SEQUENCES = f"""
with {_runs(1)},
s as (select *, count(*) over (partition by doc, run) as n from g where run is not null)
select doc, line_no, number, type, chr(64 + (dense_rank() over (partition by doc order by run))::int) as sequence from s where n >= 2
"""


def sequences_per_document(spark, sf_dir) -> DataFrame:
    rows = _headings(spark, sf_dir)
    return sequence_counts(rows, rows.groupBy("doc").agg(F.count("*").alias("lines")))


SQL_COUNTS = f"""
with {_runs(5)}
select doc, count(*) as lines, count(distinct run) as sequence_count, 100.0::double * count(distinct run) / count(*) as per_100_lines from g group by doc
"""


def _lines(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


_LINES = "l as (select doc_id as doc, i - 1 as line_no, list_extract(ls, i) as line from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as i from (select doc_id, string_split(text, chr(10)) as ls from documents)))"


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines that begin with T or E as headings, numbered by their length."""
    return lines.where(F.col("line").rlike("^[TE]")).select("doc", "line_no", F.substring("line", 1, 20).alias("text"), (F.length("line") % 5).alias("number"), F.substring("line", 1, 1).alias("type"))


_NUMBERED = "h as (select doc, line_no, substr(line, 1, 20) as text, length(line) % 5 as number, substr(line, 1, 1) as type from l where regexp_matches(line, '^[TE]'))"


def index_detection(spark, sf_dir) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return index_headings(lines, _numbered(lines), share=0.6).select("doc", "line_no", "number", "type", "is_index")


_INDEX = r"""
p as (select *, lag(number) over w as pn, lag(type) over w as pt from h window w as (partition by doc order by line_no)),
g as (select *, case when number >= 1 then sum(case when pn >= 1 and pt = type and number > pn and number <= pn + 2 then 0 else 1 end) over (partition by doc order by line_no) end as run from p),
c as (select doc, line_no, sum(case when regexp_matches(line, '\S') then 1 else 0 end) over (partition by doc order by line_no) as filled, count(*) over (partition by doc) as n from l),
j as (select g.*, c.filled, c.n, c.filled - lag(c.filled) over (partition by g.doc, g.type, g.run order by g.line_no) - 1 as gap from g join c using (doc, line_no)),
x as (select *, coalesce(run is not null and count(*) over w >= 2 and max(line_no) over w <= floor(n * 0.6::double) and avg(gap) over w < 2.5, false) as is_index from j window w as (partition by doc, type, run))"""
SQL_INDEX = f"with {_LINES}, {_NUMBERED}, {_INDEX} select doc, line_no, number, type, is_index from x"


def segment_content(spark, sf_dir) -> DataFrame:
    lines = _lines(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.split("text", "\n").alias("lines"))
    found = index_headings(lines, _numbered(lines), share=0.6)
    out = segments(docs, sequences(found.where("not is_index")), found.where("is_index"))
    return out.select("doc", "title", "article_num", "sequence", "start_line", "end_line", F.md5("content").alias("digest"))


SQL_SEGMENTS = rf"""
with {_LINES}, {_NUMBERED}, {_INDEX},
hi as (select doc, line_no, text, number, type from x where not is_index),
p2 as (select *, lag(number) over w as pn, lag(type) over w as pt from hi window w as (partition by doc order by line_no)),
g2 as (select *, case when number >= 1 then sum(case when pn >= 1 and pt = type and number > pn and number <= pn + 2 then 0 else 1 end) over (partition by doc order by line_no) end as run from p2),
s as (select *, count(*) over (partition by doc, run) as n from g2 where run is not null),
a as (select doc, line_no, text, number, chr(64 + (dense_rank() over (partition by doc order by run))::int) as sequence from s where n >= 2),
e as (select doc, max(line_no) + 1 as n from l group by doc),
i as (select doc, min(line_no) as i0, max(line_no) + 1 as i1 from x where is_index group by doc),
f as (select doc, min(line_no) as first from a group by doc),
r as (select doc, text as title, number as article_num, sequence, line_no as start_line, line_no + 1 as b0, coalesce(lead(line_no) over (partition by doc order by line_no), n) as end_line from a join e using (doc)
  union all select doc, 'Index', null, 'INDEX', i0, i0, i1 from i
  union all select doc, 'Introduction', null, null, coalesce(i1, 0), coalesce(i1, 0), first from f left join i using (doc) where first > coalesce(i1, 0)),
t as (select r.doc, title, article_num, sequence, start_line, end_line, coalesce(string_agg(line, chr(10) order by l.line_no), '') as content
  from r left join l on l.doc = r.doc and l.line_no >= b0 and l.line_no < end_line group by all)
select doc, title, article_num, sequence, start_line, end_line, md5(content) as digest from t where title <> 'Introduction' or sequence is not null or regexp_matches(content, '\S')
"""


def section_forward_fill(spark, sf_dir) -> DataFrame:
    """Turns of users open parts (named by the length of their text), those of others with an odd length open chapters."""
    c = table(spark, sf_dir, "conversations")
    rows = c.select("conv_id", "turn", F.when(F.col("role") == "user", F.length("text").cast("string")).alias("p"), F.when((F.col("role") != "user") & (F.length("text") % 2 == 1), F.length("text").cast("string")).alias("ch"))
    return forward_fill(rows, "conv_id", "turn", "p", "ch").select("conv_id", "turn", "in_part", "in_chapter")


SQL_FILL = """
with r as (select conv_id, turn, case when role = 'user' then length(text)::varchar end as p, case when role <> 'user' and length(text) % 2 = 1 then length(text)::varchar end as ch from conversations),
f as (select *, last_value(p ignore nulls) over w as part, count(p) over w as nth from r window w as (partition by conv_id order by turn rows between unbounded preceding and current row))
select conv_id, turn, part || '''' as in_part, last_value(ch ignore nulls) over (partition by conv_id, nth order by turn rows between unbounded preceding and current row) || '''' as in_chapter from f
"""


def _numbers(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.when(F.col("role") == "user", F.col("turn") % 3 + 1).alias("p"), F.when(F.length("text") % 3 > 0, F.length("text") % 3).alias("ch"))


def continuity_check(spark, sf_dir) -> DataFrame:
    return continuity(_numbers(spark, sf_dir), "conv_id", "turn", "p", "ch")


_CONTINUITY = """
r as (select conv_id, turn, case when role = 'user' then turn % 3 + 1 end as p, case when length(text) % 3 > 0 then length(text) % 3 end as ch from conversations),
a as (select *, last_value(p ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as lp from r),
n as (select *, p is not null and p is distinct from lp as new from a),
g as (select *, sum(case when new then 1 else 0 end) over (partition by conv_id order by turn) as grp from n),
c as (select *, last_value(ch ignore nulls) over (partition by conv_id, grp order by turn rows between unbounded preceding and 1 preceding) as lc from g),
x as (select conv_id, turn, 'parts start with ' || p as problem from c where new and lp is null and p <> 1
  union all select conv_id, turn, 'part ' || lp || ' is followed by ' || p from c where new and p <> lp + 1
  union all select conv_id, turn, 'chapters start with ' || ch from c where lc is null and ch <> 1
  union all select conv_id, turn, 'chapter ' || lc || ' is followed by ' || ch from c where ch not in (lc, lc + 1))
"""


def continuity_status(spark, sf_dir) -> DataFrame:
    out = continuity_summary(_numbers(spark, sf_dir), "conv_id", "turn", "p", "ch")
    return out.select("conv_id", "status", F.size("problems").alias("n_problems"), "articles")


SQL_STATUS = f"with {_CONTINUITY} select conv_id, case when count(x.problem) > 0 then 'issues' else 'ok' end as status, count(x.problem) as n_problems, any_value(n) as articles from (select conv_id, count(*) as n from conversations group by conv_id) t left join x using (conv_id) group by conv_id"


def gaps(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").where("l_linenumber % 2 = 1 or l_quantity > 25")
    return number_gaps(items, "l_orderkey", "l_linenumber")


SQL_GAPS = """
with f as (select l_orderkey, l_linenumber from lineitem where l_linenumber % 2 = 1 or l_quantity > 25),
w as (select l_orderkey, unnest(range(min(l_linenumber), max(l_linenumber) + 1)) as l_linenumber from f group by l_orderkey)
select l_orderkey, l_linenumber from w except select l_orderkey, l_linenumber from f
"""


def jumps(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").where("l_linenumber % 2 = 1 or l_quantity > 25")
    return number_jumps(items, "l_orderkey", "l_linenumber")


SQL_JUMPS = "with f as (select distinct l_orderkey, l_linenumber from lineitem where l_linenumber % 2 = 1 or l_quantity > 25), n as (select *, lead(l_linenumber) over (partition by l_orderkey order by l_linenumber) as next_number from f) select * from n where next_number <> l_linenumber + 1"


def anomalies(spark, sf_dir) -> DataFrame:
    """Suppliers that an order has twice."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return order_anomalies(items, "l_orderkey", "l_suppkey")


SQL_ANOMALIES = "select * from (select l_orderkey, l_suppkey, lag(l_suppkey) over (partition by l_orderkey order by l_suppkey) as previous from lineitem) where previous >= l_suppkey"


def hierarchy_rollup(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("part", (F.col("turn") % 2).cast("string"))
    return chapter_texts(c, "conv_id", "part", "role", "turn", "text").select("conv_id", "part", "role", "articles", F.md5("body").alias("digest"))


SQL_ROLLUP = "select conv_id, (turn % 2)::varchar as part, role, count(*) as articles, md5(string_agg(text, chr(10) || chr(10) order by turn)) as digest from conversations group by all"


def hierarchy_shape(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("part", (F.col("turn") % 2).cast("string"))
    out = hierarchy(c, "conv_id", "part", "role", "turn", "text")
    return out.select("conv_id", "part", F.size("chapters").alias("n_chapters"), F.aggregate("chapters", F.lit(0), lambda s, x: s + F.size(x["articles"])).alias("n_articles"))


def outline_report(spark, sf_dir) -> DataFrame:
    """Outlines of conversations: parts by thirds of turns, chapters by role."""
    c = table(spark, sf_dir, "conversations")
    rows = c.select("conv_id", "turn", F.floor(F.col("turn") / 3).cast("string").alias("part"), F.when(F.col("turn") % 5 > 0, F.col("role")).alias("chapter"), F.concat(F.lit("Turn "), F.col("turn").cast("string")).alias("title"), "text")
    problems = continuity(_numbers(spark, sf_dir), "conv_id", "turn", "p", "ch")
    return dry_run_text(dry_run_report(rows, "conv_id", "turn", "part", "chapter", "title", "text"), problems, "conv_id")


SQL_OUTLINE = rf"""
with {_CONTINUITY},
b as (select conv_id, turn, floor(turn / 3)::int::varchar as part, case when turn % 5 > 0 then role end as chapter, text from conversations),
m as (select *, part is distinct from lag(part) over w as np, chapter is distinct from lag(chapter) over w as nc from b window w as (partition by conv_id order by turn)),
o as (select conv_id, string_agg(case when np then '# ' || part || chr(10) else '' end || case when (np or nc) and chapter is not null then '## ' || chapter || chr(10) else '' end
    || '- Turn ' || turn || ' (' || len(regexp_extract_all(coalesce(text, ''), '\S+')) || ' words)', chr(10) order by turn) as report from m group by conv_id),
q as (select conv_id, 'Problems:' || chr(10) || string_agg('- ' || problem, chr(10) order by problem) || chr(10) || chr(10) as head from x group by conv_id)
select conv_id, coalesce(head, '') || report as report from o left join q using (conv_id)
"""


def chunk_by_budget(spark, sf_dir) -> DataFrame:
    """Lines of documents in chunks of 150 characters at most, each led by the last line of the chunk before."""
    docs = table(spark, sf_dir, "documents").withColumn("ls", F.split("text", "\n"))
    cut = chunks(F.col("ls"), F.transform("ls", F.length), 150)
    return docs.select("doc_id", F.size(cut).alias("n_chunks"), F.aggregate(cut, F.lit(0), lambda s, x: s + F.size(x)).alias("n_items"))


SQL_BUDGET_CHUNKS = """
with recursive l as (select doc_id, i - 1 as i, length(ls[i]) as cost from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as i from (select doc_id, string_split(text, chr(10)) as ls from documents))),
w as (select doc_id, i, cost as s, 0 as first, 1 as n from l where i = 0
  union all
  select l.doc_id, l.i, case when w.s + l.cost > 150 and l.i > w.first then l.cost else w.s + l.cost end, case when w.s + l.cost > 150 and l.i > w.first then l.i else w.first end, w.n + case when w.s + l.cost > 150 and l.i > w.first then 1 else 0 end
  from w join l on l.doc_id = w.doc_id and l.i = w.i + 1)
select doc_id, max(n)::int as n_chunks, (max(i) + max(n))::int as n_items from w group by doc_id
"""


def tree_reduce(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumn("word", F.substring_index("text", " ", 1))
    return pairwise_reduce(c, "conv_id", "turn", "word", lambda a, b: f"{a} {b}").withColumnRenamed("word", "joined")


SQL_TREE = "select conv_id, string_agg(split_part(text, ' ', 1), ' ' order by turn) as joined, ceil(log2(count(*)))::int as rounds from conversations group by conv_id"


def chunked_articles(spark, sf_dir) -> DataFrame:
    """Texts with a header before every paragraph, cut at the headers."""
    docs = table(spark, sf_dir, "documents")
    text = F.array_join(F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.lit("## Article "), (i + 1).cast("string"), F.lit("\n"), x)), "\n")
    cut = article_chunks(text, F.lit("Title"))
    return docs.select("doc_id", F.size(cut).alias("n_chunks"), F.element_at(cut, -1)["article_number"].alias("last_number"), F.md5(F.element_at(cut, 1)["content"]).alias("first_digest"))


SQL_CHUNKED = r"select doc_id, len(string_split(text, chr(10))) as n_chunks, len(string_split(text, chr(10)))::int as last_number, md5(trim(string_split(text, chr(10))[1])) as first_digest from documents"


def number_spans(spark, sf_dir) -> DataFrame:
    return spans(table(spark, sf_dir, "documents"), "doc_id", "text", r"[0-9]{4,}")


SQL_SPANS = """
with d as (select doc_id as doc, regexp_extract_all(text, '[0-9]{4,}') as m, regexp_split_to_array(text, '[0-9]{4,}') as p from documents),
u as (select doc, m, p, unnest(range(1, len(m) + 1)) as i from d),
s as (select doc, m[i] as match, (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::int as start from u)
select doc, match, start, (start + length(match))::int as "end" from s
"""


def ranges_in_titles(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    title = F.concat(F.lit("Articles ("), (F.col("o_custkey") % 9).cast("string"), F.lit(" - "), (F.col("o_orderkey") % 11).cast("string"), F.lit(")"))
    return orders.select("o_orderkey", F.size(title_range(title)).alias("n"))


QUERIES = {
    "article_sequences": article_sequences,
    "sequence_counts": sequences_per_document,
    "index_detection": index_detection,
    "segment_content": segment_content,
    "section_forward_fill": section_forward_fill,
    "continuity_check": continuity_check,
    "continuity_status": continuity_status,
    "number_gaps": gaps,
    "number_jumps": jumps,
    "order_anomalies": anomalies,
    "hierarchy_rollup": hierarchy_rollup,
    "hierarchy_shape": hierarchy_shape,
    "outline_report": outline_report,
    "chunk_by_budget": chunk_by_budget,
    "tree_reduce": tree_reduce,
    "article_chunks": chunked_articles,
    "number_spans": number_spans,
    "title_ranges": ranges_in_titles,
}
ORACLES = {
    "article_sequences": SQL_SEQUENCES,
    "sequence_counts": SQL_COUNTS,
    "index_detection": SQL_INDEX,
    "segment_content": SQL_SEGMENTS,
    "section_forward_fill": SQL_FILL,
    "continuity_check": f"with {_CONTINUITY} select * from x",
    "continuity_status": SQL_STATUS,
    "number_gaps": SQL_GAPS,
    "number_jumps": SQL_JUMPS,
    "order_anomalies": SQL_ANOMALIES,
    "hierarchy_rollup": SQL_ROLLUP,
    "hierarchy_shape": "select conv_id, (turn % 2)::varchar as part, count(distinct role) as n_chapters, count(*) as n_articles from conversations group by all",
    "tree_reduce": SQL_TREE,
    "outline_report": SQL_OUTLINE,
    "chunk_by_budget": SQL_BUDGET_CHUNKS,
    "number_spans": SQL_SPANS,
    "article_chunks": SQL_CHUNKED,
    "title_ranges": "select o_orderkey, greatest(0, o_orderkey % 11 - o_custkey % 9 + 1) as n from orders",
}
