"""The queries of the corpus operators and the pipeline."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import SF_DIR, same_rows

from quern.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    same_rows(spark, duck, queries.QUERIES[name], queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_covers_its_table(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op6_") else ("documents", "doc_id")
    ids = Counter(r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect())
    assert Counter(r[0] for r in queries.QUERIES[name](spark, SF_DIR).select(key).collect()) == ids


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    bad = {r[0] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 0").select("doc_id").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns + (["shard", "slot"] if k == 4 else [])
        now = {r[0] for r in docs.select("doc_id").collect()}
        assert now <= seen
        seen = now
    assert len(bad & seen) <= 3 and len(seen) > 100
    counts = [r[0] for r in docs.groupBy("shard").count().select("count").collect()]
    assert len(counts) == 24 and max(counts) - min(counts) <= 1


ODD = "doc_id long, text string, lang string, source string, n_chars long, `row` string, `key` string, id string, size string, hits string, shard int"


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_pipeline_of_odd_tables(spark, tmp_path, rows):
    """Null and repeated ids, nulls in all columns, equal rows, ties, a long text and clashing names; and empty tables."""
    import random

    import corpus_pipeline

    r = random.Random(3)
    word = lambda: "".join(r.choice("aeinorst") for _ in range(r.randrange(2, 8)))
    texts = [" ".join(word() for _ in range(r.randrange(1, 90))) for _ in range(150)]
    extra = ("r", "k", "i", "s", "h", 7)
    docs = [(i, t, r.choice(["en", None]), r.choice(["a", "a", None, ""]), None, *extra) for i, t in enumerate(texts)]
    docs += [docs[3], docs[3], (5, "other text of id five", "en", "a", 1, *extra), (None, texts[9], "en", None, 1, *extra), (None, texts[9], "en", None, 1, *extra), (None, "two without id differ", None, None, *[None] * 7)]
    docs += [(None, None, None, None, *[None] * 7)] * 3 + [(500, "", "en", "a", 0, *extra), (501, None, "xx", "b", None, *extra), (502, " ".join(word() for _ in range(20_000)), "en", "a", 1, *extra)]
    labels = [(i, 1, 0) for i in range(120)] + [(1, 0, 0), (None, 1, 0), (2, None, None), (3, 1, None)]
    items = [(1, texts[40]), (2, ""), (3, None), (None, "no id here")]
    cut = 0 if rows == "empty" else None
    folder = f"{tmp_path}/{rows}"
    for name, data, kind in (("documents", docs, ODD), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data[:cut], kind).write.parquet(f"{folder}/{name}.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    now, whole = table, Counter(map(tuple, docs[:cut]))
    for name, stage in corpus_pipeline.STAGES:
        before = Counter(tuple(x) for x in now.collect())
        out = stage(spark, now, folder)
        if name != "shard":
            assert out.columns == table.columns
            got = Counter(tuple(x) for x in out.collect())
            assert set(got) <= set(before) and (name == "mix" or all(got[k] <= before[k] for k in got))
            if name == "near_dedup":
                assert max(got.values(), default=1) == 1 and len({x[1] for x in got}) == len(got)
        else:
            assert out.columns == [*(c for c in table.columns if c != "shard"), "shard", "slot"]
            assert Counter(tuple(x[c] for c in table.columns if c != "shard") for x in out.collect()) == Counter(tuple(v for c, v in zip(table.columns, x, strict=True) if c != "shard") for x in before.elements())
            break
        now = spark.createDataFrame(out.collect(), out.schema)
    assert sum(whole.values()) == (0 if rows == "empty" else len(docs))
