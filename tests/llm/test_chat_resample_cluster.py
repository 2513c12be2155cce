"""Chat formatting, importance resampling and centroid clustering against brute force, on odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pytest

# chat formatting

CHATS = "conv_id long, turn long, role string, text string, id string, turns string, roles string, messages int"
ODD_TEXTS = ["", None, "plain", "<|eot_id|>", r"<\|eot_id|>", r"a<\\\|eom_id|><|eom_id|>", "<<|eot_id|>", "[INST]x[/INST]", r"[\INST]", "\n\n", "\\", "<", "<|start_header_id|>user<|end_header_id|>\n\nhi<|eot_id|>", "é 😀 <s> </s>", "$1 \\$2", "<s" + ">" * 3]


def chats(spark):
    r = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(r.randrange(1, 9)):
            rows.append((conv, r.choice([turn, turn, None, 1]), r.choice(["user", "assistant", "system", None, "", "<|eot_id|>", "a\nb"]), r.choice(ODD_TEXTS), "i", "t", "r", 1))
    rows += [rows[0], rows[0], (None, 1, "user", "alone", *rows[0][4:]), (None, 1, "user", "alone", *rows[0][4:]), (None, None, None, None, *[None] * 4)]
    rows += [(99, k, "user" if k % 3 else "assistant", "word " * (k % 7), *rows[0][4:]) for k in range(3000)]
    r.shuffle(rows)
    return rows, spark.createDataFrame(rows, CHATS).repartition(3)


def test_chats_are_read_back(spark):
    from pyspark.sql import functions as F

    from quern.llm.chat import LLAMA, format_chats, messages, turns, under_loss

    rows, df = chats(spark)
    known = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            known.setdefault(conv, []).append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    want = {c: [(b.decode(), t.decode()) for _, b, t in sorted(x)] for c, x in known.items()}
    got = format_chats(df).select("conv_id", "formatted", "segments", turns(F.col("formatted")).alias("turns"), under_loss(F.col("segments")).alias("learned")).collect()
    assert Counter(x.conv_id for x in got) == Counter([*want, None, None, None])
    for x in got:
        said = [tuple(t) for t in x.turns]
        assert said == want[x.conv_id] if x.conv_id is not None else said in ([("user", "alone")], [("", "")])
        assert x.learned == "".join(t for role, t in said if role == "assistant")
        assert x.formatted == "".join(s.mark + s.text for s in x.segments)
        assert all(c not in s.text for s in x.segments for c in LLAMA.controls)
        assert x.formatted.count(LLAMA.open_role) == sum(1 for _ in groupby(said, key=lambda t: t[0]))
        assert x.formatted.count(LLAMA.next_part) == len(said) - x.formatted.count(LLAMA.open_role)
    for x in messages(df).where("conv_id is not null").collect():
        assert [(m.role, list(m.texts)) for m in x.messages] == [(k, [t for _, t in g]) for k, g in groupby(want[x.conv_id], key=lambda t: t[0])]
    assert format_chats(df.limit(0)).collect() == []


def test_template_must_be_readable():
    from quern.llm.chat import Template

    assert Template(learned=("a", "b")).learned == ("a", "b")
    for bad in ({"begin": "<"}, {"next_part": "<|eot_id|><"}, {"foreign": ("|eot",)}, {"foreign": ("x\\y",)}):
        with pytest.raises(ValueError):
            Template(**bad)


def test_chat_formatting_has_no_python_and_one_shuffle(spark):
    from quern.llm.chat import format_chats

    _, df = chats(spark)
    df.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/chats")
    plan = format_chats(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


# importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, id string, weight string, score string, `rank` int, n int"


def grams_of(text, lo, hi):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


def resampled(docs, target, percent, lo, hi, buckets, least, seed):
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(at(f) for _, x in rows for f in grams_of(x, lo, hi)[1]) for rows in (docs, target))
    S, T = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * S / ((s[b] + 1) * T)))
    out = []
    for i, x in docs:
        words, found = grams_of(x, lo, hi)
        weight = sum(gain(at(f)) for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    n = len(eligible) * percent // 100
    drawn = [(i, f, w, s, k + 1) for k, (i, _, f, w, s) in enumerate(eligible[:n])]
    return Counter(drawn) + Counter((i, f, w, s, None) for i, _, f, w, s in [*eligible[n:], *(r for r in out if r[1] < least)])


def corpus(r: random.Random, n: int):
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(1, 6))) for _ in range(300)] + ["ÉTÉ", "naïve", "日本語", "x" * 3000]
    text = lambda k: r.choice([" ", ", ", "--"]).join(r.choice(vocabulary).upper() if r.random() < 0.1 else r.choice(vocabulary) for _ in range(k))
    rows = [(i, text(r.randrange(0, 60))) for i in range(n)]
    same = text(30)
    rows += [(5000 + i, same) for i in range(20)] + [(7, same)] * 25 + [(None, same)] * 12 + [(None, None), (None, ""), (8, None), (9, "\x00!?"), (10, text(5000)), (11, None)]
    return rows


@pytest.mark.parametrize("percent,lo,hi,least,partitions", [(10, 1, 1, 20, 7), (60, 1, 2, 10, 3), (100, 2, 3, 1, 5), (1, 1, 1, 1, 1)])
def test_resampling(spark, percent, lo, hi, least, partitions):
    from quern.llm.resample import resample

    r = random.Random(percent)
    rows, target = corpus(r, 300), [(i, x) for i, x in corpus(r, 40)]
    docs = spark.createDataFrame([(*x, "i", "w", "s", 1, 2) for x in rows], DOCS).repartition(partitions)
    got = resample(docs, spark.createDataFrame(target, "item_id long, text string"), percent, (lo, hi), 500, least, 7).collect()
    assert Counter(tuple(x) for x in got) == resampled(rows, target, percent, lo, hi, 500, least, 7)


def test_resampling_of_empty_tables(spark):
    from quern.llm.resample import resample

    some, none = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    assert resample(none, some).collect() == []
    assert [x["rank"] for x in resample(some, none, percent=100, least_words=1).collect()] == [1]


def test_tournament_merges_blocks_and_stops(monkeypatch):
    from quern.llm import resample

    r = random.Random(2)
    for runs in (1, 2, 5, 40):
        kept, blocks = [], []
        for run in range(runs):
            rows = np.zeros(r.randrange(1, 400), resample.ROW)
            for name, top in (("score", 50), ("absent", 2), ("id", 9), ("n_features", 3), ("weight", 2)):
                rows[name] = [r.randrange(top) for _ in range(len(rows))]
            rows["n"] = 1 + np.arange(len(rows)) % 3
            order = lambda x: (-x[0], *x[1:5])
            ordered = sorted(rows.tolist(), key=order)
            kept += ordered
            for a in range(0, len(ordered), 16):
                part = ordered[a : a + 16]
                blocks.append((0, run, order(part[0])[:3], np.array(part, resample.ROW).tobytes()))
        blocks.sort(key=lambda b: (b[0], b[2], b[1]))
        want, rank = [], 1
        total = sum(x[5] for x in kept)
        draws = total * 2 // 3
        for x in sorted(kept, key=lambda x: (-x[0], *x[1:5])):
            want += [((None if x[1] else x[2]), x[3], x[4], x[0], rank + k if rank + k <= draws else None) for k in range(x[5])]
            rank += x[5]
        got = [(i, f, w, s, None if at is None else at + k) for i, f, w, s, at, n in resample.merged(iter(blocks), {0: 1}, draws) for k in range(n)]
        assert Counter(got) == Counter(want)
        assert sorted(x[4] for x in got if x[4]) == list(range(1, draws + 1))


# centroid clustering

VECTORS = "vec_id long, embedding array<double>, label int, id string, cluster string, vector string"


def clustered(rows, k, rounds, dims, scale, seed):
    kept = [(i, [math.floor(x * scale) if abs(x) < 1e290 else int(x) * scale for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept))
    centroids = [x for _, x in order[:k]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = {}
        for _, x in kept:
            own.setdefault(nearest(x)[1], []).append(x)
        centroids = [[sum(col) // len(own[j]) for col in zip(*own[j], strict=True)] if j in own else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(x)) for i, x in kept]
    by = Counter()
    for _, d, j in found:
        by[j] += d
    fits = lambda x: x if abs(x) < 1 << 63 else None
    return Counter((i, j, fits(d), fits(by[j]), fits(sum(by.values())), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, d, j in found)


@pytest.mark.parametrize("kind", ["plain", "ties", "large", "huge", "few"])
def test_clustering(spark, kind):
    from quern.llm.cluster import cluster

    r = random.Random(kind)
    dims, n = 5, 4 if kind == "few" else 300
    rows = [(i, [r.gauss(0, 1) for _ in range(dims)]) for i in range(n)]
    if kind == "ties":
        rows = [(i, [float(r.randrange(-1, 2)) for _ in range(dims)]) for i in range(n)]
    if kind in ("large", "huge"):  # beyond float64's integers, and beyond longs
        size = 1e6 if kind == "large" else 1e300
        rows += [(1000 + i, [r.uniform(-size, size) for _ in range(dims)]) for i in range(40)] + [(2000, [1.7e308, -1.7e308, 0.0, 1e22, -5e-324])]
    rows += [rows[0], rows[0], (None, [0.5] * dims), (None, [0.5] * dims), (None, [-0.5] * dims), (rows[1][0], [2.0] * dims)]
    odd = [(3000, None), (3001, []), (3002, [1.0] * (dims + 1)), (3003, [1.0, None, 1.0, 1.0, 1.0]), (3004, [float("nan")] * dims), (3005, [float("-inf")] + [0.0] * (dims - 1))]
    table = spark.createDataFrame([(i, v, None, "i", "c", "v") for i, v in rows + odd], VECTORS).repartition(4)
    got = cluster(table, clusters=7, rounds=3, dims=dims, scale=256, seed=2).collect()
    assert Counter(tuple(x) for x in got) == clustered(rows + odd, 7, 3, dims, 256, 2)


def test_clustering_of_an_empty_table(spark):
    from quern.llm.cluster import cluster

    out = cluster(spark.createDataFrame([(1, None, 1, "", "", "")], VECTORS), dims=5)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and out.collect() == []
