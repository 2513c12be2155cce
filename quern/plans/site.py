"""Queries on elements of pages and on stored consultations: the given pages, and pages and records that orders make up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.convert import post_id
from quern.operators.crawl import absolute
from quern.operators.elements import article_list, element_text
from quern.operators.matching import stored_consultations
from quern.plans.base import spread_table, table

#: Where a page's content may be, the likeliest place first.
CONTENT_CHAIN = ("div.post_content", "article div.entry", "main > article", "article", "main", "div.content", "div#content", "body")


def element_texts(spark, sf_dir) -> DataFrame:
    """The content of the pages' element by the chain, as paragraphs, items and headings."""
    pages = spread_table(spark, sf_dir, "pages").select("page_id", element_text(F.col("html"), CONTENT_CHAIN).alias("e"))
    return pages.select("page_id", "e.tier", F.length("e.text").alias("n_chars"), F.md5("e.text").alias("digest"))


def _made_pages(spark, sf_dir) -> DataFrame:
    """Pages of orders, by remainder: a post with paragraphs, a list and a heading; nested articles; an id and no paragraphs; nothing that fits."""
    o, k = spread_table(spark, sf_dir, "orders"), F.col("o_orderkey").cast("string")
    post = F.concat(F.lit("<html><body><div class='x post_content'><!-- c --><h2>Art. "), k, F.lit("</h2><p>a <b>b</b> "), F.col("o_custkey").cast("string"), F.lit("<p>&lt;c&gt;</p><script>no()</script><ul><li>one<li>two <i>"), k, F.lit("</i></ul><ol><li>three</li></ol></div><p>out</p>"))
    nested = F.concat(F.lit("<article><p>first</p></article><main><section><article>no</article></section><article class=b><p> "), k, F.lit(" </p></article></main>"))
    by_id = F.concat(F.lit("<div id='content'> plain <em> "), k, F.lit(" </em>text<br>end</div><div class='content-x'>no</div>"))
    html = F.when(F.col("o_orderkey") % 4 == 0, post).when(F.col("o_orderkey") % 4 == 1, nested).when(F.col("o_orderkey") % 4 == 2, by_id).otherwise(F.concat(F.lit("<span>"), k, F.lit("</span>")))
    return o.select("o_orderkey", html.alias("html"))


def stored_elements(spark, sf_dir) -> DataFrame:
    found = _made_pages(spark, sf_dir).select("o_orderkey", element_text(F.col("html"), CONTENT_CHAIN).alias("e"))
    return found.select("o_orderkey", "e.tier", "e.text")


SQL_ELEMENTS = r"""
select o_orderkey, (case o_orderkey % 4 when 0 then 1 when 1 then 3 when 2 then 7 end)::int as tier,
  case o_orderkey % 4 when 0 then concat_ws(chr(10) || chr(10), 'ab' || o_custkey, '<c>', '• one', '• two' || o_orderkey, '- three', 'Art. ' || o_orderkey)
    when 1 then o_orderkey::varchar when 2 then 'plain' || o_orderkey || 'textend' else '' end as text from orders
"""


def navigation_links(spark, sf_dir) -> DataFrame:
    """Articles that consultation pages list: in their navigation, by the class of links or the first link, or else in their content."""
    o, k = spread_table(spark, sf_dir, "orders"), F.col("o_orderkey").cast("string")
    listed = F.concat(F.lit("<div id=consnav><ul class='articlesList x'><li><a href='/no'>no</a><a class='list_comments_link' href='/m/?p="), k, F.lit("'>Art. <b>1</b></a></li><li><a href='?p=5'>two</a><li><a>none</a></ul></div><div class=post_content><a href='?p=9'>nine</a></div>"))
    old = F.concat(F.lit("<div class='navigation'><ul><li><a href='/a'>a</a></ul></div><div class='post_content'><a href='?p="), k, F.lit("&amp;x=1'> Long title </a><a href='?p=1'>no</a><a href='?p=2'>http://x.gr</a><p><a href='http://other.gr/?p=3'>third</a></div><a href='?p=4'>outside</a>"))
    html = F.when(F.col("o_orderkey") % 2 == 0, listed).otherwise(old)
    rows = o.select("o_orderkey", F.posexplode(article_list(html)).alias("pos", "a"))
    url = absolute(F.col("a.href"), F.lit("http://site.gr/m/?p=1"))
    return rows.select("o_orderkey", "pos", "a.source", post_id(url).alias("post_id"), "a.title", url.alias("url"))


SQL_NAVIGATION = """
with r as (select o_orderkey, unnest(case when o_orderkey % 2 = 0 then
    [{'pos': 0, 'source': 'list', 'post_id': o_orderkey::varchar, 'title': 'Art.1', 'url': 'http://site.gr/m/?p=' || o_orderkey}, {'pos': 1, 'source': 'list', 'post_id': '5', 'title': 'two', 'url': 'http://site.gr/m/?p=5'}]
  else [{'pos': 0, 'source': 'content', 'post_id': o_orderkey::varchar, 'title': 'Long title', 'url': 'http://site.gr/m/?p=' || o_orderkey || '&x=1'}, {'pos': 1, 'source': 'content', 'post_id': '3', 'title': 'third', 'url': 'http://other.gr/?p=3'}] end) as a from orders)
select o_orderkey, a.pos, a.source, a.post_id, a.title, a.url from r
"""


def existing_by_tiers(spark, sf_dir) -> DataFrame:
    """Addresses of a listing against stored consultations: post ids are shared by up to three of them, addresses by some."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    address = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    post = F.floor(k / 12)
    stored = o.where("o_orderkey % 3 > 0").select(k.alias("id"), address("https://Site.gr/m", k % 4, "/?p=", post).alias("url"), F.when(k % 5 > 0, F.col("o_orderstatus") == "F").alias("is_finished"))
    url = F.when(k % 4 == 0, address("http://SITE.gr/m", k % 4, "?p=", post, "#top")).when(k % 4 == 1, address("http://site.gr/m", k % 3, "/sub/?p=", post)).when(k % 4 == 2, address("http://site.gr/other/?p=", post)).otherwise(address("http://site.gr/m1/?q=", post))
    found = stored_consultations(o.select("o_orderkey", url.alias("url")), stored)
    return found.select("o_orderkey", "tier", "tier_name", F.col("match.id").alias("match_id"))


SQL_TIERS = """
with s as (select o_orderkey as id, o_orderkey % 4 as m, o_orderkey // 12 as post, case when o_orderkey % 5 > 0 then o_orderstatus = 'F' else false end as done from orders where o_orderkey % 3 > 0),
q as (select o_orderkey, case o_orderkey % 4 when 0 then o_orderkey % 4 when 1 then o_orderkey % 3 else -1 end as m, o_orderkey // 12 as post, o_orderkey % 4 as kind from orders),
a as (select m, post, min(id) as id from s group by all),
p as (select post, min(id) as id, count(*) as n, arg_min(id, case when done then 1 else 0 end * 1000000000000 + id) as open_id from s group by post),
j as (select o_orderkey, case when kind = 0 then a.id end as t1, case when kind < 3 and p.n = 1 then p.id end as t2, case when kind < 3 then a.id end as t3, case when kind < 3 then p.open_id end as t4
  from q left join a on a.m = q.m and a.post = q.post left join p on p.post = q.post)
select o_orderkey, (case when t1 is not null then 1 when t2 is not null then 2 when t3 is not null then 3 when t4 is not null then 4 end)::int as tier,
  case when t1 is not null then 'address' when t2 is not null then 'post id' when t3 is not null then 'ministry' when t4 is not null then 'unfinished first' end as tier_name,
  coalesce(t1, t2, t3, t4) as match_id from j
"""


QUERIES = {"element_text": element_texts, "stored_elements": stored_elements, "navigation_links": navigation_links, "existing_by_tiers": existing_by_tiers}
ORACLES = {"stored_elements": SQL_ELEMENTS, "navigation_links": SQL_NAVIGATION, "existing_by_tiers": SQL_TIERS}
