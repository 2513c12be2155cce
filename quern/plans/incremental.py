"""Queries on upserts, change records, reports, topics, generation and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.generate import chapter_prompts, noted, part_summaries, plan_input, stage_one, structured_prompt, usable
from quern.operators.relational import first_per_key
from quern.operators.reports import all_match, compare_counts, completeness_of, histogram, numeric_stats, share_at_least
from quern.operators.keywords import mmr
from quern.operators.topics import class_tfidf, plain_words, similarity, stop_words, top_terms
from quern.operators.upsert import above_mark, change_summary, changes, known_items, merge, new_items, replace_children
from quern.plans.base import spread_table, table
from quern.session import shared_folder, small, stored
from quern.streaming.incremental import deduplicated, drained, joined, read_events, sessions, sliding, tumbling


def _snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders as they were (no key that 5 divides) and as they are (no key that 7 divides; prices of keys that 3 divides raised, some priorities unknown)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("long").alias("price"), "o_orderpriority")
    new = o.where("o_orderkey % 7 <> 0").withColumn("price", F.when(F.col("o_orderkey") % 3 == 0, F.col("price") + 1).otherwise(F.col("price"))).withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")))
    return o.where("o_orderkey % 5 <> 0"), new


_SNAPSHOTS = """
o as (select o_orderkey, o_orderstatus, trunc(o_totalprice)::bigint as price, o_orderpriority from orders where o_orderkey % 5 <> 0),
n as (select o_orderkey, o_orderstatus, trunc(o_totalprice)::bigint + case when o_orderkey % 3 = 0 then 1 else 0 end as price, case when o_orderkey % 11 <> 0 then o_orderpriority end as o_orderpriority from orders where o_orderkey % 7 <> 0)
"""


def new_items_anti(spark, sf_dir) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return new_items(new, old, "o_orderkey").select("o_orderkey")


def existing_items_semi(spark, sf_dir) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return known_items(new, old, "o_orderkey").select("o_orderkey", "price")


def upsert_merge(spark, sf_dir) -> DataFrame:
    return merge(*_snapshots(spark, sf_dir), "o_orderkey", frozen="o_orderstatus = 'F'")


SQL_MERGE = f"""
with {_SNAPSHOTS}
select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey, case when o.o_orderstatus = 'F' then o.o_orderstatus else coalesce(n.o_orderstatus, o.o_orderstatus) end as o_orderstatus,
  case when o.o_orderstatus = 'F' then o.price else coalesce(n.price, o.price) end as price, case when o.o_orderstatus = 'F' then o.o_orderpriority else coalesce(n.o_orderpriority, o.o_orderpriority) end as o_orderpriority
from o full join n on o.o_orderkey = n.o_orderkey
"""


def change_record(spark, sf_dir) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return changes(old, new, "o_orderkey", ["price", "o_orderpriority"], frozen="o_orderstatus = 'F'")


SQL_CHANGES = f"""
with {_SNAPSHOTS},
b as (select coalesce(o.o_orderkey, n.o_orderkey) as k, o.o_orderkey is null as fresh, n.o_orderkey is null as gone, coalesce(o.o_orderstatus = 'F', false) as frozen, o.price is distinct from n.price as dp, o.o_orderpriority is distinct from n.o_orderpriority as dq
  from o full join n on o.o_orderkey = n.o_orderkey)
select k as o_orderkey, case when fresh then 'new' when gone then 'removed' else 'changed' end as kind, case when fresh or gone then '' when dp and dq then 'price,o_orderpriority' when dp then 'price' else 'o_orderpriority' end as columns
from b where fresh or gone or (not frozen and (dp or dq))
"""


def change_counts(spark, sf_dir) -> DataFrame:
    return change_summary(*_snapshots(spark, sf_dir), "o_orderkey")


SQL_CHANGE_COUNTS = f"with {_SNAPSHOTS} select count(*) filter (o.o_orderkey is null) as new_keys, count(*) filter (o.o_orderkey is not null and n.o_orderkey is not null) as kept_keys, count(*) filter (n.o_orderkey is null) as removed_keys from o full join n on o.o_orderkey = n.o_orderkey"


def replaced_children(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    fresh = c.where("conv_id % 4 = 0 and turn < 2").withColumn("role", F.lit("fresh"))
    return replace_children(c, fresh, "conv_id")


SQL_REPLACED = "select conv_id, turn, role from conversations where conv_id not in (select conv_id from conversations where conv_id % 4 = 0 and turn < 2) union all select conv_id, turn, 'fresh' from conversations where conv_id % 4 = 0 and turn < 2"


def incremental_highwater(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    stored = e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    return above_mark(e, stored, "ts").groupBy("event_type").agg(F.count("*").alias("n"))


SQL_HIGHWATER = "select event_type, count(*) as n from events where ts > (select max(ts) from events where ts < timestamp '2024-01-20') group by event_type"


def completeness_report(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_orderpriority"))).alias("note"))
    return completeness_of({"orders": o, "labels": table(spark, sf_dir, "labels"), "documents": table(spark, sf_dir, "documents").select("doc_id", "lang", "source")})


def _field(t: str, f: str, col: str, text: bool, src: str) -> str:
    empty = f"count(*) filter ({col} = '')" if text else "0"
    return f"select '{t}' as table_name, '{f}' as field, count(*) as total, count(*) filter ({col} is null) as nulls, {empty} as empties, 0 as defaults from {src}"


_NOTES = "(select o_orderkey, case when o_orderkey % 3 <> 0 then case when o_orderkey % 4 = 0 then '' else o_orderpriority end end as note from orders)"
SQL_COMPLETE = (
    "with f as ("
    + " union all ".join(
        [_field("orders", "o_orderkey", "o_orderkey", False, _NOTES), _field("orders", "note", "note", True, _NOTES)]
        + [_field("labels", c, c, False, "labels") for c in ("doc_id", "quality", "toxic")]
        + [_field("documents", c, c, c != "doc_id", "documents") for c in ("doc_id", "lang", "source")]
    )
    + ") select table_name, field, total, nulls, empties::bigint as empties, defaults::bigint as defaults, (total - nulls - empties - defaults)::bigint as populated, case when total > 0 then round(100.0::double * (total - nulls - empties - defaults) / total, 2) else 0.0::double end as rate from f"
)


def table_count_verify(spark, sf_dir) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    return compare_counts({"orders": old, "nation": n, "supplier": s}, {"orders": new, "nation": n, "region": table(spark, sf_dir, "region")})


SQL_VERIFY = f"""
with {_SNAPSHOTS}, a as (select 'orders' as t, count(*) as old_rows from o union all select 'nation', count(*) from nation union all select 'supplier', count(*) from supplier),
b as (select 'orders' as t, count(*) as new_rows from n union all select 'nation', count(*) from nation union all select 'region', count(*) from region)
select coalesce(a.t, b.t) as table_name, old_rows, new_rows, old_rows is not distinct from new_rows as matches from a full join b on a.t = b.t
"""


def counts_all_match(spark, sf_dir) -> DataFrame:
    return all_match(table_count_verify(spark, sf_dir))


def method_share_check(spark, sf_dir) -> DataFrame:
    return share_at_least(table(spark, sf_dir, "labels"), "quality", 1, 80.0)


SQL_SHARE = "select round(100.0::double * count(*) filter (quality = 1) / count(quality), 2) as share, 100.0::double * count(*) filter (quality = 1) / count(quality) >= 80 as enough from labels"


def balance_histogram(spark, sf_dir) -> DataFrame:
    return histogram(table(spark, sf_dir, "supplier").withColumn("v", F.col("s_acctbal") / 1000), "v", 1).select("bin", "lo", "hi", "n")


SQL_BALANCE = "with b as (select floor(s_acctbal / 1000)::bigint as bin from supplier) select g.bin, g.bin::double as lo, (g.bin + 1)::double as hi, count(b.bin) as n from (select unnest(range((select min(bin) from b), (select max(bin) from b) + 1)) as bin) g left join b using (bin) group by g.bin"


def numeric_report(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 3 == 0, "n/a").otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit("%"))).alias("score"))
    return numeric_stats(c, "score")


def stopword_threshold(spark, sf_dir) -> DataFrame:
    return stop_words(spread_table(spark, sf_dir, "documents"), "text", 100)


_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[ \t\r\n]+'), lambda w: w <> '')"
SQL_STOP = f"select word, count(*) as n from (select unnest({_WORDS}) as word from documents) group by word having count(*) > 100"


def ctfidf(spark, sf_dir) -> DataFrame:
    return class_tfidf(spread_table(spark, sf_dir, "documents"), "lang", "text").where("n >= 5").select("lang", "word", "n", F.round("score", 6).alias("score"))


SQL_CTFIDF = f"""
with w as (select lang, unnest({_WORDS}) as word from documents), c as (select lang, word, count(*) as n from w group by all),
p as (select lang, sum(n) as m from c group by lang), t as (select word, sum(n) as k from c group by word)
select c.lang, c.word, c.n, round(c.n / p.m::double * ln(1 + (select avg(m) from p) / t.k::double), 6) as score from c join p using (lang) join t using (word) where c.n >= 5
"""


def topic_terms(spark, sf_dir) -> DataFrame:
    return top_terms(class_tfidf(spread_table(spark, sf_dir, "documents"), "lang", "text"), "lang", 10).select("lang", "rank", "word")


SQL_TERMS = f"""
with w as (select lang, unnest({_WORDS}) as word from documents), c as (select lang, word, count(*) as n from w group by all),
p as (select lang, sum(n) as m from c group by lang), t as (select word, sum(n) as k from c group by word),
s as (select c.lang, c.word, c.n / p.m::double * ln(1 + (select avg(m) from p) / t.k::double) as score from c join p using (lang) join t using (word)),
r as (select lang, row_number() over (partition by lang order by score desc, word) as rank, word from s)
select lang, rank::int as rank, word from r where rank <= 10
"""


def plain_word_lists(spark, sf_dir) -> DataFrame:
    """Words of documents without digits and a few stop words."""
    docs = spread_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(F.array_join(plain_words(F.col("text"), ("the", "of", "and")), " ")).alias("digest"))


SQL_PLAIN = r"select doc_id, md5(array_to_string(list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '[0-9]', '', 'g'), '[ \t\r\n]+'), lambda w: w not in ('', 'the', 'of', 'and')), ' ')) as digest from documents"


def structured_prompts(spark, sf_dir) -> DataFrame:
    """Prompts of conversations, and summaries in which blank turns have a note."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 4 > 0, F.col("text")).otherwise(" ").alias("chunk"))
    out = noted(c, "chunk", "summary", "(nothing)")
    return out.select("conv_id", "turn", "summary", F.md5(structured_prompt(F.concat(F.lit("[SCHEMA:PART] Sum up: "), F.col("chunk")), "PART")).alias("digest"))


SQL_PROMPTS = r"""
with c as (select conv_id, turn, case when turn % 4 > 0 then text else ' ' end as chunk from conversations)
select conv_id, turn, case when trim(coalesce(chunk, '')) = '' then '(nothing)' else 'Summary of ' || (len(regexp_extract_all(chunk, '\S+')) + 6) || ' words.' end as summary,
  md5(trim(' Sum up: ' || chunk) || chr(10) || chr(10) || 'Answer with a single JSON object of this form, in double quotes, with nothing before or after it; shorten what is too long:' || chr(10) || '{"summary": "..."}' || chr(10)) as digest from c
"""


def mmr_keywords(spark, sf_dir) -> DataFrame:
    return mmr(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 15, 0.3).withColumn("relevance", F.round("relevance", 9))


def _mmr_sql(k: int = 15, diversity: float = 0.3) -> str:
    steps = [
        "u as materialized (select label, vec_id, list_transform(embedding, lambda y: y::double / sqrt(list_inner_product(embedding::double[], embedding::double[]))) as x from embeddings)",
        "g as materialized (select label, list(m order by i) as y from (select label, i, avg(x[i]) as m from u, range(1, 65) r(i) group by all) group by label)",
        "s0 as materialized (select u.label, vec_id, x, list_inner_product(x, y) / sqrt(list_inner_product(y, y)) as relevance, 0::double as near from u join g using (label))",
    ]
    for r in range(1, k + 1):
        score = "relevance" if r == 1 else f"(1 - {diversity}::double) * relevance - {diversity}::double * near"
        steps.append(f"c{r} as materialized (select label, vec_id, relevance, x from s{r - 1} qualify row_number() over (partition by label order by {score} desc, vec_id) = 1)")
        near = "list_inner_product(c.x, s.x)" if r == 1 else "greatest(s.near, list_inner_product(c.x, s.x))"
        steps.append(f"s{r} as materialized (select s.label, s.vec_id, s.x, s.relevance, {near} as near from s{r - 1} s join c{r} c using (label) where s.vec_id <> c.vec_id)")
    return f"with {', '.join(steps)} " + " union all ".join(f"select label, vec_id, {r}::int as rank, round(relevance, 9) as relevance from c{r}" for r in range(1, k + 1))


def vector_similarity(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    first = first_per_key(e, ["label"], ["vec_id"]).select("label", F.col("embedding").alias("first"))
    return e.join(small(first), "label").select("vec_id", F.round(similarity(F.col("embedding"), F.col("first")), 4).alias("cosine"))


SQL_COSINE = "with f as (select label, embedding::double[] as first from (select *, row_number() over (partition by label order by vec_id) as nth from embeddings) where nth = 1) select vec_id, round(list_cosine_similarity(embedding::double[], first), 4) as cosine from embeddings join f using (label)"


def _articles(spark, sf_dir) -> DataFrame:
    docs = spread_table(spark, sf_dir, "documents")
    cited = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Στον ν. 12/2020 προστίθεται:\n«"), F.substring("text", 1, 60), F.lit("\nτέλος»\n"), F.col("text"))).otherwise(F.col("text"))
    return docs.select(F.col("doc_id"), F.col("source").alias("part"), F.col("lang").alias("chapter"), F.lit("Άρθρο").alias("title"), cited.alias("content"), (F.col("doc_id") % 5).cast("int").alias("article_number"))


def stage_one_routing(spark, sf_dir) -> DataFrame:
    return stage_one(_articles(spark, sf_dir)).select("doc_id", "route", "decision", "summary", "bullet")


def chapter_bullets(spark, sf_dir) -> DataFrame:
    return chapter_prompts(usable(stage_one(_articles(spark, sf_dir)), "summary"), "part", "chapter", "doc_id")


def part_narratives(spark, sf_dir) -> DataFrame:
    chapters = stored(chapter_bullets(spark, sf_dir).withColumnRenamed("prompt", "summary"), "chapter-bullets")
    inputs = plan_input(chapters, "part", "chapter").select("part", F.length("plan_input").alias("plan_chars"))
    return part_summaries(chapters, "part", "chapter").join(inputs, "part")


#: The stages by SQL: what the stub answers follows from the number of words.
_STAGE_ONE = r"""
a as (select doc_id, source as part, lang as chapter, case when doc_id % 2 = 0 then 'Στον ν. 12/2020 προστίθεται:' || chr(10) || '«' || substr(text, 1, 60) || chr(10) || 'τέλος»' || chr(10) || text else text end as content from documents),
n as (select *, coalesce(len(regexp_extract_all(content, '\S+')), 0) as words, doc_id % 2 = 0 and content is not null as modifies from a),
o as (select doc_id, part, chapter, case when coalesce(content, '') = '' then 'skip' when words < 80 then 'verbatim' else 'summarise' end as route, case when modifies then 'modifies' else 'new_provision' end as decision,
    case when coalesce(content, '') = '' then null when words < 80 then content else 'Summary of ' || (words + 6) || ' words.' end as summary,
    case when coalesce(content, '') = '' then null when modifies then '• Στο νομοσχέδιο τροποποιείται το άρθρο 1 του ν. 1/2000. Η σύνοψη της αλλαγής είναι: stub' else '• stub (ρύθμιση): stub' end as bullet from n)"""
SQL_STAGE_ONE = f"with {_STAGE_ONE} select doc_id, route, decision, summary, bullet from o"
_CHAPTERS = f"""{_STAGE_ONE},
c as (select part, chapter, string_agg(bullet, chr(10) order by doc_id) as prompt from o where bullet is not null and not regexp_matches(lower(summary), '\\[error|\\[failed|placeholder') group by part, chapter)"""
SQL_CHAPTERS = f"with {_CHAPTERS} select part, chapter, prompt from c"
SQL_PARTS = rf"""
with {_CHAPTERS},
k as (select part, 'kefalaio_' || lower(chapter) as key, len(regexp_extract_all(prompt, '\S+')) as words, length(replace(prompt, chr(10), 'nn')) as chars, row_number() over (partition by part order by lower(chapter)) as nth, count(*) over (partition by part) as n from c)
select part, any_value(n)::int as paragraphs, string_agg('Summary of ' || case when n = 1 then words + 6 else words + 8 + 4 * (nth - 1) end || ' words.', chr(10) || chr(10) order by nth) as text,
  (sum(length(key) + chars + 5) + any_value(n) + 1)::int as plan_chars from k group by part
"""


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/event[s].parquet"  # as a pattern, since a stream takes a plain path for a folder
    return read_events(spark, path, spark.read.parquet(path).schema).withColumn("ts", F.col("ts").cast("timestamp"))


def _plain_times(df: DataFrame) -> DataFrame:
    """Times without zone, as the tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


def _state(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def stream_tumbling(spark, sf_dir) -> DataFrame:
    out = tumbling(_stream(spark, sf_dir), "ts", ["event_type"], "1 day", "40 days", "event_id")
    return _plain_times(drained(out, _state(spark), "complete"))


SQL_TUMBLING = "select time_bucket(interval 1 day, ts) as start, time_bucket(interval 1 day, ts) + interval 1 day as \"end\", event_type, count(*) as n, sum(event_id)::bigint as total from events group by all"


def stream_sliding(spark, sf_dir) -> DataFrame:
    return _plain_times(drained(sliding(_stream(spark, sf_dir), "ts", ["event_type"], "2 days", "1 day", "40 days"), _state(spark), "complete"))


SQL_SLIDING = "with b as (select time_bucket(interval 1 day, ts) as d, event_type from events), w as (select d as start, event_type from b union all select d - interval 1 day, event_type from b) select start, start + interval 2 day as \"end\", event_type, count(*) as n from w group by all"


def stream_session(spark, sf_dir) -> DataFrame:
    return _plain_times(drained(sessions(_stream(spark, sf_dir), "ts", "user_id", "6 hours", "40 days"), _state(spark), "complete"))


SQL_SESSION = """
with g as (select user_id, ts, case when ts < lag(ts) over w + interval 6 hour then 0 else 1 end as brk from events window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(brk) over (partition by user_id order by ts rows unbounded preceding) as nth from g)
select user_id, min(ts) as start, max(ts) + interval 6 hour as "end", count(*) as n from s group by user_id, nth
"""


def stream_dedup(spark, sf_dir) -> DataFrame:
    kept = deduplicated(_stream(spark, sf_dir), "ts", ["user_id", "event_type"], "60 days").select("user_id", "event_type")
    return drained(kept, _state(spark))


def stream_join(spark, sf_dir) -> DataFrame:
    """Purchases within six hours after a click of the same user."""
    clicks = _stream(spark, sf_dir).where("event_type = 'click'").select("user_id", "event_id", "ts")
    buys = _stream(spark, sf_dir).where("event_type = 'purchase'").select("user_id", "event_id", "ts")
    return drained(joined(clicks, buys, "user_id", "ts", "6 hours", "60 days").select("user_id", "event_id", "next_event_id"), _state(spark))


SQL_STREAM_JOIN = "select a.user_id, a.event_id, b.event_id as next_event_id from events a join events b on a.user_id = b.user_id and a.event_type = 'click' and b.event_type = 'purchase' and b.ts >= a.ts and b.ts <= a.ts + interval 6 hour"


QUERIES = {
    "new_items_anti": new_items_anti,
    "existing_items_semi": existing_items_semi,
    "upsert_merge": upsert_merge,
    "change_record": change_record,
    "change_counts": change_counts,
    "replace_children": replaced_children,
    "incremental_highwater": incremental_highwater,
    "completeness_report": completeness_report,
    "table_count_verify": table_count_verify,
    "counts_all_match": counts_all_match,
    "method_share_check": method_share_check,
    "balance_histogram": balance_histogram,
    "numeric_report": numeric_report,
    "stopword_threshold": stopword_threshold,
    "ctfidf": ctfidf,
    "topic_terms": topic_terms,
    "mmr_keywords": mmr_keywords,
    "plain_word_lists": plain_word_lists,
    "structured_prompts": structured_prompts,
    "vector_similarity": vector_similarity,
    "stage_one_routing": stage_one_routing,
    "chapter_bullets": chapter_bullets,
    "part_narratives": part_narratives,
    "stream_tumbling": stream_tumbling,
    "stream_sliding": stream_sliding,
    "stream_session": stream_session,
    "stream_dedup": stream_dedup,
    "stream_join": stream_join,
}
ORACLES = {
    "new_items_anti": f"with {_SNAPSHOTS} select o_orderkey from n where o_orderkey not in (select o_orderkey from o)",
    "existing_items_semi": f"with {_SNAPSHOTS} select o_orderkey, price from n where o_orderkey in (select o_orderkey from o)",
    "upsert_merge": SQL_MERGE,
    "change_record": SQL_CHANGES,
    "change_counts": SQL_CHANGE_COUNTS,
    "replace_children": SQL_REPLACED,
    "incremental_highwater": SQL_HIGHWATER,
    "completeness_report": SQL_COMPLETE,
    "table_count_verify": SQL_VERIFY,
    "counts_all_match": f"select bool_and(matches) as all_match from ({SQL_VERIFY})",
    "method_share_check": SQL_SHARE,
    "balance_histogram": SQL_BALANCE,
    "numeric_report": "select count(*) as n, round(avg(c_custkey), 3) as mean, min(c_custkey)::double as least, max(c_custkey)::double as greatest from customer where c_custkey % 3 <> 0",
    "stopword_threshold": SQL_STOP,
    "ctfidf": SQL_CTFIDF,
    "topic_terms": SQL_TERMS,
    "mmr_keywords": _mmr_sql(),
    "plain_word_lists": SQL_PLAIN,
    "structured_prompts": SQL_PROMPTS,
    "stage_one_routing": SQL_STAGE_ONE,
    "chapter_bullets": SQL_CHAPTERS,
    "part_narratives": SQL_PARTS,
    "vector_similarity": SQL_COSINE,
    "stream_tumbling": SQL_TUMBLING,
    "stream_sliding": SQL_SLIDING,
    "stream_session": SQL_SESSION,
    "stream_join": SQL_STREAM_JOIN,
    "stream_dedup": "select distinct user_id, event_type from events",
}
