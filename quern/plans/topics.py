"""Queries on keywords, the topic model and stems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.stems import ENDINGS, IRREGULAR, ending_pattern, stems_by
from quern.operators.keywords import keywords
from quern.operators.topic_model import fit
from quern.operators.topics import plain_words
from quern.plans.base import spread_table, table

_WORDS = r"list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '[0-9]', '', 'g'), '[ \t\r\n]+'), lambda w: w <> '')"


def text_keywords(spark, sf_dir) -> DataFrame:
    """Three keywords of each language."""
    return keywords(spread_table(spark, sf_dir, "documents"), "lang", "text", k=3, least=3).select("lang", "rank", "term", F.round("relevance", 9).alias("relevance"))


def _keywords_sql(k: int = 3, dims: int = 32, diversity: float = 0.3) -> str:
    cosine = lambda a, b: f"list_inner_product({a}, {b}) / sqrt(list_inner_product({a}, {a}) * list_inner_product({b}, {b}))"
    steps = [
        f"t as materialized (select lang, term, count(*) as n from (select lang, unnest({_WORDS}) as term from documents) group by all having count(*) >= 3)",
        f"b as (select *, '^' || term || '$' as m, list_transform(range(1, greatest(length(m) - 2, 1) + 1), lambda i: ('0x' || substr(md5(substr(m, i, 3)), 1, 8))::bigint % {dims}) as hashes from t)",
        f"v as materialized (select lang, term, n, list_transform(range({dims}), lambda d: len(list_filter(hashes, lambda x: x = d))::double) as x from b)",
        f"g as materialized (select lang, list(s order by i) as y from (select lang, i, sum(n * x[i]) as s from v, range(1, {dims + 1}) r(i) group by all) group by lang)",
        f"s0 as materialized (select v.lang, term, x, {cosine('x', 'y')} as relevance, 0::double as near from v join g on v.lang is not distinct from g.lang)",
    ]
    for r in range(1, k + 1):
        score = "relevance" if r == 1 else f"(1 - {diversity}::double) * relevance - {diversity}::double * near"
        steps.append(f"c{r} as materialized (select lang, term, relevance, x from s{r - 1} qualify row_number() over (partition by lang order by {score} desc, term) = 1)")
        near = cosine("c.x", "s.x") if r == 1 else f"greatest(s.near, {cosine('c.x', 's.x')})"
        steps.append(f"s{r} as materialized (select s.lang, s.term, s.x, s.relevance, {near} as near from s{r - 1} s join c{r} c on s.lang is not distinct from c.lang where s.term <> c.term)")
    return f"with {', '.join(steps)} " + " union all ".join(f"select lang, {r}::int as rank, term, round(relevance, 9) as relevance from c{r}" for r in range(1, k + 1))


TOPICS, ROUNDS, DIMS = 8, 3, 64


def topic_model(spark, sf_dir) -> DataFrame:
    """A model of the documents, applied to the benchmark's items, which it hasn't seen."""
    model = fit(spread_table(spark, sf_dir, "documents"), "doc_id", "text", topics=TOPICS, rounds=ROUNDS, dims=DIMS)
    return model.transform(table(spark, sf_dir, "benchmark"), "item_id", "text")


def topic_model_terms(spark, sf_dir) -> DataFrame:
    """The model's topics: their sizes and first terms."""
    model = fit(spread_table(spark, sf_dir, "documents"), "doc_id", "text", topics=TOPICS, rounds=ROUNDS, dims=DIMS)
    sizes = model.centres.where("topic >= 0").select("topic", "size")
    return sizes.join(model.terms.where("rank <= 5").select("topic", "rank", "word"), "topic")


_CRC = ", ".join(f"t{k} as (select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end as c from t{k - 1})" for k in range(1, 9))


def _model_sql() -> str:
    distance = "list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x)"
    nearest = lambda rows, k: f"select v.id, any_value(v.x) as x, arg_min(c.c, [{distance}, c.c::double]) as c, min({distance}) as d from {rows} v, c{k} c group by v.id"
    steps = [
        "t0 as (select i::bigint as i, i::bigint as c from range(256) r(i))",
        _CRC,
        "crc as (select list(c order by i) as t from t8)",
        f"w as materialized (select true as own, doc_id as id, unnest({_WORDS}) as word from documents union all select false, item_id, unnest({_WORDS}) from benchmark)",
        "h as (select word, hex(encode(word)) as x from (select distinct word from w))",
        f"""b as materialized (select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(x), 2), lambda k: ('0x' || substr(x, k + 1, 2))::bigint)),
  lambda c, y: xor(c >> 8, t[1 + xor(c & 255, y)])), 4294967295) % {DIMS} as bucket from h, crc)""",
        "n as materialized (select own, id, bucket, count(*) as n, sum(count(*)) over (partition by own, id) as total from w join b using (word) group by own, id, bucket)",
        "k as (select true as own, doc_id as id from documents union all select false, item_id from benchmark)",
        f"x as materialized (select k.own, k.id, list(coalesce(floor(1000 * n / total::double), 0)::double order by d) as x from (select k.own, k.id, d from k, range({DIMS}) r(d)) k left join n on n.own = k.own and n.id = k.id and n.bucket = k.d group by k.own, k.id)",
        "docs as materialized (select id, x from x where own)",
        f"c0 as materialized (select row_number() over (order by md5('1:' || id), x) - 1 as c, x from docs order by md5('1:' || id), x limit {TOPICS})",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} as materialized ({nearest('docs', r)})")
        if r < ROUNDS:
            steps.append(
                f"c{r + 1} as materialized (select o.c, coalesce(m.x, o.x) as x from c{r} o left join (select c, list(mean order by i) as x from "
                f"(select c, i, floor(sum(x[i]) / count(*)) as mean from a{r}, range(1, {DIMS + 1}) r(i) group by c, i) group by c) m using (c))"
            )
    steps.append(f"z as (select c, count(a.id) as size from c{ROUNDS} left join a{ROUNDS} a using (c) group by c)")
    steps.append("l as materialized (select c, size, case when size >= 10 then row_number() over (order by size desc, c) - 1 else -1 end as topic from z)")
    return ", ".join(steps), nearest


_MODEL, _NEAREST = _model_sql()
SQL_MODEL = f"with {_MODEL}, items as (select id, x from x where not own), f as ({_NEAREST('items', ROUNDS)}) select f.id as item_id, topic::int as topic, d::bigint as distance from f join l using (c)"
SQL_MODEL_TERMS = f"""
with {_MODEL}, m as (select topic, word from w join a{ROUNDS} a using (id) join l using (c) where own and topic >= 0),
p as (select topic, word, count(*) as n from m group by all), q as (select topic, sum(n) as total from p group by topic), u as (select word, sum(n) as everywhere from p group by word),
s as (select topic, word, sqrt(n / total::double) * ln(1 + (select avg(total) from q) / everywhere::double) as score from p join q using (topic) join u using (word))
select s.topic::int as topic, size, (row_number() over (partition by s.topic order by score desc, word))::int as rank, word from s join l using (topic) qualify rank <= 5
"""


def stemmed_words(spark, sf_dir) -> DataFrame:
    """Documents' words by their stems, those of their language."""
    docs = spread_table(spark, sf_dir, "documents").select("doc_id", "lang", plain_words(F.col("text")).alias("words"))
    docs = docs.select("doc_id", stems_by(F.col("words"), F.col("lang")).alias("stems"))
    return docs.select("doc_id", F.size(F.array_distinct("stems")).alias("n_stems"), F.md5(F.array_join("stems", " ")).alias("digest"))


def _stems_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    table_of = lambda pairs: "map {" + ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in pairs.items()) + "}"
    cases = []
    for name, endings in ENDINGS.items():
        ending = f"regexp_extract(w, {quoted(ending_pattern(endings, 3))}, 2)"
        one = f"coalesce({table_of(IRREGULAR[name])}[w], case when {ending} = '' then w else left(w, length(w) - length({ending})) || {table_of(endings)}[{ending}] end)"
        if name != "el":  # no Greek texts here, and accents fold differently
            cases.append(f"when lang = '{name}' then list_transform(words, lambda w: {one})")
    return f"with d as (select doc_id, lang, {_WORDS} as words from documents), s as (select doc_id, case {' '.join(cases)} else words end as stems from d) select doc_id, len(list_distinct(stems))::int as n_stems, md5(array_to_string(stems, ' ')) as digest from s"


QUERIES = {"text_keywords": text_keywords, "topic_model": topic_model, "topic_model_terms": topic_model_terms, "stemmed_words": stemmed_words}
ORACLES = {"text_keywords": _keywords_sql(), "topic_model": SQL_MODEL, "topic_model_terms": SQL_MODEL_TERMS, "stemmed_words": _stems_sql()}
