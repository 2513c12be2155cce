"""Queries on joins, aggregates, set operations, sorting and windows over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import is_blank, preview
from quern.operators.relational import cascade, child_counts, first_match, first_per_key, first_with_content, match_decisions, match_rate, resume_page, sample_rows, side_texts, top_frequencies
from quern.operators.reports import shares
from quern.plans.base import table


def existing_by_cascade(spark, sf_dir) -> DataFrame:
    """Pages found for search terms, one made of each page: by exact address, else by host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host = F.regexp_extract("url", "//([^/]*)", 1)
    terms = pages.select("page_id", F.when(F.col("page_id") % 20 == 0, F.col("url")).otherwise(host).alias("term"))
    return cascade(terms, "page_id", "term", [(pages, F.col("url"), "exact"), (pages, host, "host")], "page_id").select("page_id", "tier", "tier_name", "match_page_id")


SQL_CASCADE = """
with p as (select page_id, url, regexp_extract(url, '//([^/]*)', 1) as host from pages),
q as (select page_id, case when page_id % 20 = 0 then url else host end as term from p),
e as (select url as k, min(page_id) as m from p group by url), h as (select host as k, min(page_id) as m from p group by host)
select page_id, case when e.m is not null then 1 else 2 end as tier, case when e.m is not null then 'exact' else 'host' end as tier_name, coalesce(e.m, h.m) as match_page_id
from q left join e on e.k = q.term left join h on h.k = q.term where e.m is not null or h.m is not null
"""


def first_consultation(spark, sf_dir) -> DataFrame:
    """The first order, as a consultation, that has an item with a text, and the page to go on with after its items."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_quantity") > 40, F.col("l_returnflag")).otherwise(" ").alias("text"))
    return first_with_content(items, "l_orderkey", "text").withColumn("page", resume_page(items).scalar())


SQL_FIRST_CONTENT = "select min(l_orderkey) filter (l_quantity > 40 and trim(l_returnflag) <> '') as l_orderkey, (count(*) // 12 + 1)::int as page from lineitem"


def decision_match(spark, sf_dir) -> DataFrame:
    """Orders as references (year only for even keys, series only for keys that 3 divides) against line items' own."""
    orders = table(spark, sf_dir, "orders")
    refs = orders.select(
        F.col("o_orderkey").alias("ref_id"),
        F.concat(F.lit(" D-"), F.col("o_custkey").cast("string")).alias("id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.year("o_orderdate")).alias("year"),
        F.when(F.col("o_orderkey") % 3 == 0, F.upper("o_orderstatus")).alias("series"),
    )
    cat = orders.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("cat_id"), F.concat(F.lit("d-"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("id"), F.year("o_orderdate").alias("year"), F.lower("o_orderstatus").alias("series"))
    return match_decisions(refs, cat)


SQL_DECISIONS = """
select r.o_orderkey as ref_id, c.o_orderkey as cat_id from orders r join orders c on r.o_custkey = c.o_custkey and c.o_orderkey % 5 = 0
where (r.o_orderkey % 2 <> 0 or year(r.o_orderdate) = year(c.o_orderdate)) and (r.o_orderkey % 3 <> 0 or lower(r.o_orderstatus) = lower(c.o_orderstatus))
"""


def first_catalogue_match(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"))
    cat = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 150).alias("k"), F.col("o_orderkey").alias("cat_id"))
    return first_match(items, cat, ["k"], "cat_id")


SQL_FIRST = "select l.k, min(o.o_orderkey) as cat_id from (select distinct l_suppkey as k from lineitem) l left join orders o on o.o_custkey % 150 = l.k group by l.k"


def citation_match_rate(spark, sf_dir) -> DataFrame:
    refs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("number"), F.year("l_shipdate").alias("year"))
    cat = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("number"), F.explode(F.sequence(F.lit(1992), F.lit(1996))).alias("year"))
    return match_rate(refs, cat, ["number", "year"])


SQL_RATE = """
with r as (select l_partkey as number, year(l_shipdate) as year, count(*) as n from lineitem group by all),
m as (select r.*, p.p_partkey is not null as hit from r left join part p on p.p_partkey = r.number and p.p_partkey % 3 <> 0 and r.year between 1992 and 1996)
select sum(n)::bigint as total_refs, count(*) as unique_refs, count(*) filter (hit) as matched, round(100.0::double * count(*) filter (hit) / count(*), 2) as match_rate from m
"""


def children_per_parent(spark, sf_dir) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return child_counts(customers, "c_custkey", table(spark, sf_dir, "orders"), "o_custkey", "n_orders")


def correlated_count(spark, sf_dir) -> DataFrame:
    """The same by a correlated subquery, which Spark turns into the join."""
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return spark.sql("select c_custkey, (select count(*) from {o} where o_custkey = c_custkey) as n_orders from {c}", c=customers, o=orders)


def having_topk(spark, sf_dir) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    per = joined.groupBy("c_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open")).where("n >= 3")
    return per.orderBy(F.desc("n"), "c_custkey").limit(10)


SQL_HAVING = "select c_custkey, count(*) as n, count(*) filter (o_orderstatus = 'O') as n_open from orders join customer on o_custkey = c_custkey group by c_custkey having count(*) >= 3 order by n desc, c_custkey limit 10"


def method_counts(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") < 6, F.col("l_returnflag")).alias("method"))
    return shares(rows, "method")


SQL_METHODS = "with m as (select case when l_linenumber < 6 then l_returnflag end as method from lineitem) select method, count(*) as n, round(100.0::double * count(*) / (select count(*) from m), 2) as share from m group by method"


def global_counts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
        F.count_if(F.col("o_totalprice") > 200000).alias("large"),
        F.count_distinct("o_custkey").alias("customers"),
        F.round(F.avg("o_totalprice"), 3).alias("mean"),
        F.min("o_totalprice").alias("least"),
        F.max("o_totalprice").alias("greatest"),
    )


def left_merge_suffix(spark, sf_dir) -> DataFrame:
    """Left merge on a name that both sides have; the right side's id is taken."""
    left = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("key"), F.col("c_custkey").alias("id"))
    right = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("key")).agg(F.min("s_suppkey").alias("id_right"))
    return left.join(right, "key", "left").select("key", "id", "id_right")


def outer_to_inner(spark, sf_dir) -> DataFrame:
    """A chain of left joins that a filter on the last table makes inner (the optimizer does, too)."""
    c, o, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "nation")
    chain = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    return chain.where("n_regionkey = 1").select("o_orderkey", "c_name", "n_name")


def listagg_metadata(spark, sf_dir) -> DataFrame:
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    pairs = F.concat_ws(": ", "o_orderpriority", "o_orderstatus")
    joined = c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_custkey").agg(F.array_join(F.array_sort(F.collect_set(F.when(o.o_orderkey.isNotNull(), pairs))), "; ").alias("metadata"))
    return joined


SQL_LISTAGG = "select c_custkey, coalesce(string_agg(distinct o_orderpriority || ': ' || o_orderstatus, '; ' order by o_orderpriority || ': ' || o_orderstatus), '') as metadata from customer left join orders on c_custkey = o_custkey group by c_custkey"


def status_filter(spark, sf_dir) -> DataFrame:
    """Open states, or one state while another column is empty; unequal drops nulls, as SQL does."""
    rows = table(spark, sf_dir, "orders").withColumn("note", F.when(F.col("o_orderkey") % 4 == 0, "").when(F.col("o_orderkey") % 4 != 1, F.col("o_orderpriority")))
    hit = F.col("o_orderstatus").isin("P", "O") | ((F.col("o_orderstatus") == "F") & is_blank(F.col("note")))
    return rows.where(hit & (F.col("note") != "5-LOW")).select("o_orderkey", "note", preview(F.col("note"), 3).alias("shown"))


SQL_STATUS = """
with r as (select *, case when o_orderkey % 4 = 0 then '' when o_orderkey % 4 <> 1 then o_orderpriority end as note from orders)
select o_orderkey, note, case when note is null then 'NULL' when note = '' then 'EMPTY' else substr(note, 1, 3) end as shown
from r where (o_orderstatus in ('P', 'O') or (o_orderstatus = 'F' and (note is null or note = ''))) and note <> '5-LOW'
"""


def like_filters(spark, sf_dir) -> DataFrame:
    """Any of several patterns, case ignored; lengths; word starts."""
    part = table(spark, sf_dir, "part")
    hit = F.lower("p_name").rlike("pdf|an|extraction") | F.col("p_type").ilike("%STEEL%") | F.col("p_name").startswith("b")
    return part.where(hit & (F.length("p_name") > 5)).select("p_partkey", "p_name")


SQL_LIKE = "select p_partkey, p_name from part where (regexp_matches(lower(p_name), 'pdf|an|extraction') or p_type ilike '%STEEL%' or p_name like 'b%') and length(p_name) > 5"


def citation_topk(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    return top_frequencies(items, "l_partkey", "pos", 10)


SQL_TOPK = "select l_partkey, count(*) as n, min(l_orderkey * 10 + l_linenumber)::bigint as first_at from lineitem group by l_partkey order by n desc, first_at limit 10"


def random_sample(spark, sf_dir) -> DataFrame:
    return sample_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), 5, "seed", "c_custkey")


def offset_page(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").orderBy("s_suppkey").select("s_suppkey", "s_name").offset(3).limit(4)


def distinct_content(spark, sf_dir) -> DataFrame:
    return first_per_key(table(spark, sf_dir, "documents"), ["text"], ["doc_id"]).select("doc_id", F.md5("text").alias("digest"))


def dedup_comments(spark, sf_dir) -> DataFrame:
    return first_per_key(table(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn"]).select("conv_id", "role", "turn", "text")


def side_text_join(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("filename"))
    files = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("f"), F.col("item_id").cast("string"), F.lit(".md")).alias("name"), "text")
    return side_texts(docs, "filename", files).select("doc_id", F.length("markdown").alias("chars"))


def set_operations(spark, sf_dir) -> DataFrame:
    """Nations with customers and suppliers, either, and only customers."""
    c = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    named = lambda df, n: df.withColumn("kind", F.lit(n))
    return named(c.intersect(s), "both").unionByName(named(c.union(s).distinct(), "either")).unionByName(named(c.subtract(s), "only"))


SQL_SETS = """
with c as (select c_nationkey as k from customer where c_acctbal > 9000), s as (select s_nationkey as k from supplier)
select k, 'both' as kind from (select k from c intersect select k from s) union all select k, 'either' from (select k from c union select k from s) union all select k, 'only' from (select k from c except select k from s)
"""


def rollup_cube(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


def rank_windows(spark, sf_dir) -> DataFrame:
    by = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    out = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(by).alias("nth"), F.lag("o_orderkey").over(by).alias("before"), F.count("*").over(by.rowsBetween(-2, 0)).alias("last_three"))
    return out


SQL_RANK = "select o_custkey, o_orderkey, row_number() over w as nth, lag(o_orderkey) over w as before, count(*) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 2 preceding and current row) as last_three from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)"


def topk_per_group(spark, sf_dir) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey"))
    return table(spark, sf_dir, "customer").withColumn("nth", nth).where("nth <= 3").select("c_mktsegment", "nth", "c_custkey", "c_acctbal")


SQL_GROUP_TOPK = "select c_mktsegment, nth, c_custkey, c_acctbal from (select *, row_number() over (partition by c_mktsegment order by c_acctbal desc, c_custkey) as nth from customer) where nth <= 3"


def pricing_summary(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return items.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("sum_qty"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.count("*").alias("n"),
    )


SQL_PRICING = "select l_returnflag, l_linestatus, sum(l_quantity::bigint)::bigint as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, round(avg(l_discount), 6) as avg_disc, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by all"

QUERIES = {
    "existing_by_cascade": existing_by_cascade,
    "decision_match": decision_match,
    "first_consultation": first_consultation,
    "first_catalogue_match": first_catalogue_match,
    "citation_match_rate": citation_match_rate,
    "child_counts": children_per_parent,
    "correlated_count": correlated_count,
    "having_topk": having_topk,
    "method_counts": method_counts,
    "global_counts": global_counts,
    "left_merge_suffix": left_merge_suffix,
    "outer_to_inner": outer_to_inner,
    "listagg_metadata": listagg_metadata,
    "status_filter": status_filter,
    "like_filters": like_filters,
    "citation_topk": citation_topk,
    "random_sample": random_sample,
    "offset_page": offset_page,
    "distinct_content": distinct_content,
    "dedup_comments": dedup_comments,
    "side_text_join": side_text_join,
    "set_ops": set_operations,
    "rollup_cube": rollup_cube,
    "rank_windows": rank_windows,
    "topk_per_group": topk_per_group,
    "pricing_summary": pricing_summary,
}
ORACLES = {
    "existing_by_cascade": SQL_CASCADE,
    "decision_match": SQL_DECISIONS,
    "first_consultation": SQL_FIRST_CONTENT,
    "first_catalogue_match": SQL_FIRST,
    "citation_match_rate": SQL_RATE,
    "child_counts": "select c_custkey, any_value(c_name) as c_name, count(o_orderkey) as n_orders from customer left join orders on o_custkey = c_custkey group by c_custkey",
    "correlated_count": "select c_custkey, (select count(*) from orders where o_custkey = c_custkey) as n_orders from customer",
    "having_topk": SQL_HAVING,
    "method_counts": SQL_METHODS,
    "global_counts": "select count(*) as total, count(*) filter (o_orderstatus = 'F') as finished, count(*) filter (o_totalprice > 200000) as large, count(distinct o_custkey) as customers, round(avg(o_totalprice), 3) as mean, min(o_totalprice) as least, max(o_totalprice) as greatest from orders",
    "left_merge_suffix": "select c_nationkey as key, c_custkey as id, r.id_right from customer left join (select s_nationkey, min(s_suppkey) as id_right from supplier group by s_nationkey) r on s_nationkey = c_nationkey",
    "outer_to_inner": "select o_orderkey, c_name, n_name from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey where n_regionkey = 1",
    "listagg_metadata": SQL_LISTAGG,
    "status_filter": SQL_STATUS,
    "like_filters": SQL_LIKE,
    "citation_topk": SQL_TOPK,
    "random_sample": "select c_custkey, c_name from customer order by md5('seed' || c_custkey), c_custkey limit 5",
    "offset_page": "select s_suppkey, s_name from supplier order by s_suppkey limit 4 offset 3",
    "distinct_content": "select min(doc_id) as doc_id, md5(text) as digest from documents group by text",
    "dedup_comments": "select conv_id, role, turn, text from (select *, row_number() over (partition by conv_id, role order by turn) as nth from conversations) where nth = 1",
    "side_text_join": "select doc_id, length(b.text) as chars from documents left join benchmark b on b.item_id = doc_id",
    "set_ops": SQL_SETS,
    "rollup_cube": "select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity::bigint)::bigint as quantity from lineitem group by cube (l_returnflag, l_linestatus)",
    "rank_windows": SQL_RANK,
    "topk_per_group": SQL_GROUP_TOPK,
    "pricing_summary": SQL_PRICING,
}
