"""The queries opN_<name> over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'text ' || md5(coalesce(text, '')))), 1, 15))::bigint as h
  from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as k from d group by source),
w as (select *, [1.0, 5.0, 2.0][1 + k % 3]::double as w, 2.0::double * source_size as cap from s),
f as (select *, coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0)::double as below,
    sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following)::double as open,
    1.5::double * (sum(source_size) over ())::double as budget from w),
l as (select *, max(case when (budget - below) / open * w <= cap then (budget - below) / open end) over () as level from f),
t as (select source, source_size, least(w * coalesce(level, 'infinity'::double), cap) as target from l),
p as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as passes from t),
r as (select *, target - passes * source_size as rem from p),
c as (select d.*, r.source_size, r.target, r.passes, r.rem,
    sum(size) over (partition by d.source order by h range between unbounded preceding and current row) as cum,
    sum(size) over (partition by d.source, h) as unit
  from d join r on d.source is not distinct from r.source)
select doc_id, size::bigint as size, source_size, target,
  (case when source_size > 0 then size * (passes + case when cum <= rem or (cum - unit <= rem and cum - rem < rem - (cum - unit)) then 1 else 0 end) else 0 end)::bigint as taken
from c
"""


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP4_SQL = """
with d as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from d group by text)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256
from d join g using (text)
"""


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    out = shard(table(spark, sf_dir, "documents"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


_CRC_STEPS = ", ".join(f"t{k} as (select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end as c from t{k - 1})" for k in range(1, 9))
OP5_SQL = f"""
with t0 as (select i::bigint as i, i::bigint as c from range(256) r(i)), {_CRC_STEPS}, crc as (select list(c order by i) as t from t8),
d as (select doc_id, source, hex(encode(coalesce(text, ''))) as x, ('0x' || substr(md5('shard:' || doc_id), 1, 15))::bigint as h from documents),
b as (select doc_id, source, h, x, list_transform(range(0, length(x), 2), lambda k: ('0x' || substr(x, k + 1, 2))::bigint) as bytes from d),
c as (select doc_id, source, h, (length(x) / 2 + 8)::bigint as size, xor(list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, y: xor(c >> 8, t[1 + xor(c & 255, y)])), 4294967295) as text_crc32 from b, crc),
r as (select *, row_number() over (partition by source order by h, doc_id, text_crc32, size) - 1 as nth, count(*) over (partition by source) as n_source, count(*) over () as n from c),
p as (select *, row_number() over (order by (2 * nth + 1)::double / (2 * n_source)::double, source is null, coalesce(source, '')) - 1 as position from r)
select doc_id, size, text_crc32::bigint as text_crc32, 'rows' as law, (position * 24 // n)::int as shard, position - (position * 24 // n * n + 23) // 24 as slot, null::int as grown_shard from p
"""


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import scratch_path
    from .warc import read_archive, write_archive

    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path, min_revisit=0)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
g as (select html, max(page_id) as response from p group by html)
select page_id, octet_length(encode(html))::bigint as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::int >> (15 - 5 * (i % 4))) & 31)::int, 1) for i in range(32)], '') as payload_digest,
  case when page_id = response then 'response' else 'revisit' end as record_type,
  case when page_id = response then null else response end as refers_to
from p join g using (html)
"""


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import measured, scan

    out = measured(scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep_text=False))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP2_SQL = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
il as (select item_id, w, least(13, len(w)) as n from iw where len(w) > 0),
win as (select distinct coalesce(item_id::varchar, 'null') as item_id, n, array_to_string(w[i:i + n - 1], ' ') as gram from (select *, unnest(range(1, len(w) - n + 2)) as i from il)),
dg as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as gram from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, (select distinct n from win))),
hit as (select doc_id, i, n, item_id from dg join win using (n, gram)),
pos as (select doc_id, count(distinct p)::bigint as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id),
its as (select doc_id, count(distinct item_id)::bigint as n_items, array_to_string(list_sort(list(distinct item_id)), ',') as ids from hit group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw left join pos using (doc_id) left join its using (doc_id)
"""


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract

    return extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import cut_repeats

    out = cut_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


#: Every string of 400 bytes by its digest; runs of starts that repeat, at most 400 apart, are spans.
OP8_SQL = """
with d as materialized (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
w as (select r, i, md5(substr(x, 2 * i + 1, 800)) as h from (select r, x, unnest(range(0, length(x) // 2 - 399)) as i from d)),
s as (select r, i from w qualify count(*) over (partition by h) > 1),
g as (select r, i, case when i <= lag(i) over (partition by r order by i) + 400 then 0 else 1 end as fresh from s),
n as (select r, i, sum(fresh) over (partition by r order by i) as k from g),
p as (select r, k, min(i) as a, max(i) + 400 as b from n group by r, k),
q as (select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) as before, lead(a) over (partition by r order by a) as after from p),
c as (select q.r, count(*) as n_spans, sum(b - a) as n_removed, string_agg(substr(x, 2 * before + 1, 2 * (a - before)) || case when after is null then substr(x, 2 * b + 1) else '' end, '' order by a) as kept from q join d using (r) group by q.r)
select doc_id, (length(x) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept, x))) as kept_sha256 from d left join c using (r)
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import classes

    out = classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_pii

    return find_pii(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_chats, turns, under_loss

    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    kinds = dict(chats.dtypes)
    out = format_chats(chats.unionByName(extra.select(*(F.col(c).cast(kinds[c]) for c in chats.columns))))
    read = out.select("conv_id", "formatted", turns(F.col("formatted")).alias("turns"), under_loss(F.col("segments")).alias("learned"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ANGLED = r"/s>|<SYS>>|</SYS>>|s>|\|begin_of_text\|>|\|start_header_id\|>|\|end_header_id\|>|\|eom_id\|>|\|eot_id\|>|\|im_start\|>|\|im_end\|>|\|end_of_text\|>|\|endoftext\|>"
_ESCAPED = rf"regexp_replace(regexp_replace(%s, '(<)(\\*)({_ANGLED})', '\1\2\\\3', 'g'), '(\[)(\\*)(INST\]|/INST\])', '\1\2\\\3', 'g')"
OP11_SQL = f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
m as (select *, case when role is not distinct from lag(role) over w then 10 else 19 + 17 + 2 + length({_ESCAPED % "role"}) + case when row_number() over w = 1 then 17 + 10 else 10 end end as mark
  from c window w as (partition by conv_id order by turn nulls first, role, text))
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(mark + length({_ESCAPED % "text"}))::bigint as formatted_chars
from m group by conv_id
"""


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resample import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
with t0 as (select i::bigint as i, i::bigint as c from range(256) r(i)), {_CRC_STEPS}, crc as (select list(c order by i) as t from t8),
w as materialized (select true as own, doc_id as id, unnest({_WORDS}) as word from documents union all select false, item_id, unnest({_WORDS}) from benchmark),
x as (select word, hex(encode(word)) as x from (select distinct word from w)),
b as materialized (select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(x), 2), lambda k: ('0x' || substr(x, k + 1, 2))::bigint)),
    lambda c, y: xor(c >> 8, t[1 + xor(c & 255, y)])), 4294967295) % 10000 as bucket from x, crc),
n as (select bucket, (count(*) filter (own))::double as s, (count(*) filter (not own))::double as t from w join b using (word) group by bucket),
g as (select bucket, floor(1000 * ln((t + 1) * (sum(s) over () + 10000) / ((s + 1) * (sum(t) over () + 10000))))::bigint as gain from n),
d as (select id, count(*) as n_features, sum(gain)::bigint as weight from w join b using (word) join g using (bucket) where own group by id),
a as (select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint::double as h from documents left join d on doc_id = id),
z as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from a),
r as (select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as total from z where n_features >= 20)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score::bigint as score, (case when rank <= total * 10 // 100 then rank end)::bigint as rank
from z left join r using (doc_id)
"""


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .cluster import cluster

    return cluster(table(spark, sf_dir, "embeddings"))


def _op13_sql(clusters: int = 40, rounds: int = 5) -> str:
    distance = "list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x)"
    steps = [
        "v as materialized (select vec_id, list_transform(embedding, lambda y: floor(256::double * y::double)) as x from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda y: isfinite(y))) = 64)",
        f"c0 as materialized (select row_number() over (order by h) - 1 as c, x from (select x, sha256('2:' || vec_id) as h from v order by h limit {clusters}))",
    ]
    for k in range(rounds + 1):
        steps.append(f"a{k} as materialized (select v.vec_id, any_value(v.x) as x, arg_min(c.c, [{distance}, c.c::double]) as c, min({distance}) as d from v, c{k} as c group by v.vec_id)")
        if k < rounds:
            steps.append(
                f"c{k + 1} as materialized (select o.c, coalesce(m.x, o.x) as x from c{k} o left join (select c, list(mean order by i) as x from "
                f"(select c, i, floor(sum(x[i]) / count(*)) as mean from a{k}, range(1, 65) r(i) group by c, i) group by c) m using (c))"
            )
    return (
        f"with {', '.join(steps)} select vec_id, c::int as cluster, d::bigint as distance, (sum(d) over (partition by c))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia, "
        f"sha256(array_to_string(list_transform(k.x, lambda y: y::bigint), ',')) as centroid_sha256 from a{rounds} join c{rounds} k using (c)"
    )


OP13_SQL = _op13_sql()


QUERIES = {
    "op1_warc": op1_warc,
    "op2_decontamination": op2_decontamination,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sharding": op5_sharding,
    "op6_html_extraction": op6_html_extraction,
    "op7_quality": op7_quality,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_simhash": op9_simhash,
    "op10_pii": op10_pii,
    "op11_chat": op11_chat,
    "op12_resampling": op12_resampling,
    "op13_clustering": op13_clustering,
}
ORACLES = {"op1_warc": OP1_SQL, "op2_decontamination": OP2_SQL, "op3_mixing": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op5_sharding": OP5_SQL, "op8_suffix_array_dedup": OP8_SQL, "op11_chat": OP11_SQL, "op12_resampling": OP12_SQL, "op13_clustering": OP13_SQL}
