"""Listing streams that go on where they ended, polite attempts, SQLite push-down, answer forms, token counts and entities."""

from __future__ import annotations

import base64
import itertools
import json
import random
import re
import sqlite3
from collections import Counter
from datetime import date, datetime, timedelta
from html.entities import html5
from pathlib import Path

import pytest

# listings


def test_listing_reads_each_page_once(spark, tmp_path):
    from quern.streaming.crawl import listing_stream

    log = tmp_path / "log"
    months = ("Ιανουαρίου", "Φεβρουαρίου", "Μαρτίου", "Απριλίου", "Μαΐου", "Ιουνίου")

    def fetch(n):
        with open(log, "a") as f:
            f.write(f"{n}\n")
        return None if n > 6 else f"<ul><li><a href='/?p={n}'>x</a><span class='start'>2 {months[6 - n]} 2024</span></li><li><span class=start>none</span></li></ul>"

    def run(checkpoint, mark):
        stream = listing_stream(spark, fetch, mark, pages=2)
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{checkpoint}/state").option("path", f"{checkpoint}/out").trigger(availableNow=True).start()
        query.awaitTermination()

    for _ in range(5):
        run(tmp_path / "all", None)
    assert sorted(r.page_no for r in spark.read.parquet(str(tmp_path / "all/out")).collect()) == [1, 2, 3, 4, 5, 6]
    assert Counter(map(int, log.read_text().split())) == Counter(range(1, 8))
    log.write_text("")
    for _ in range(3):
        run(tmp_path / "known", date(2024, 4, 2))
    assert sorted(r.page_no for r in spark.read.parquet(str(tmp_path / "known/out")).collect()) == [1, 2, 3]
    assert Counter(map(int, log.read_text().split())) == Counter([1, 2, 3])


# attempts


def replayed(events, cap, gap, wait, tries, end):
    """All attempts at all hosts, by going through time in one piece."""
    out = []
    for host in {e[0] for e in events}:
        queue, running, free, order = [], 0, 0, 0
        own = sorted((e for e in events if e[0] == host), key=lambda e: (e[2], e[1], e[3] or ""))
        times = sorted({e[2] for e in own}) + [end]
        at = 0
        for now in times:
            while queue and running < cap:
                ready = max(free, min(q[0] for q in queue))
                if ready >= now:
                    break
                first = min((q for q in queue if q[0] <= ready), key=lambda q: q[1])
                queue.remove(first)
                out.append((host, first[2], first[3] + 1, ready))
                running, free = running + 1, ready + gap
            for _, url, t, outcome, attempt in own:
                if t == now:
                    running = max(0, running - (outcome is not None))
                    if outcome is None or (outcome != "ok" and attempt < tries):
                        order += 1
                        queue.append((t + (wait * 2 ** (attempt - 1) if outcome else 0), order, url, attempt or 0))
            at = now
        assert at == end
    return Counter(out)


def test_turns_go_by_the_clock(spark, tmp_path):
    from quern.streaming.crawl import polite

    r = random.Random(3)
    begin = datetime(2024, 1, 1)
    events = [(r.choice("ab"), f"u{i}", r.randrange(0, 60_000), None, None) for i in range(40)]
    events += [(h, u, t + 7_000 + r.randrange(20_000), r.choice(["ok", "error"]), r.choice([1, 2, 3])) for h, u, t, _, _ in events[:25]]
    end = 400_000
    kinds = "host string, url string, ts timestamp, outcome string, attempt int"
    rows = sorted(events, key=lambda e: e[2])
    folder = tmp_path / "in"
    for k in range(4):
        part = [x for x in rows if k * 25_000 <= x[2] < (k + 1) * 25_000]
        spark.createDataFrame([(h, u, begin + timedelta(milliseconds=t), o, a) for h, u, t, o, a in part], kinds).coalesce(1).write.mode("append").parquet(str(folder))
    # events of a host that does nothing move the watermark on, past all timers
    for k in (1, 2):
        spark.createDataFrame([("z", "z", begin + timedelta(milliseconds=end * k), "ok", 1)], kinds).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(folder))
    query = polite(stream, late="1 second", cap=2, gap=1500, wait=4000, tries=3).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = Counter((x.host, x.url, x.attempt, round((x.at - begin).total_seconds() * 1000)) for x in spark.read.parquet(str(tmp_path / "out")).collect())
    want = replayed(events, 2, 1500, 4000, 3, end)
    assert got == Counter({k: n for k, n in want.items() if k[0] != "z"})
    for host in "ab":
        times = sorted(k[3] for k in got if k[0] == host)
        assert all(b - a >= 1500 for a, b in itertools.pairwise(times))


# SQLite


def test_sqlite_filters_are_pushed_down(spark, tmp_path):
    from pyspark.sql import functions as F

    from quern.sources.files import query_sqlite, read_sqlite

    path = str(tmp_path / "x.db")
    rows = [(i, None if i % 5 == 0 else f"N{i % 7}", i / 4, "it's" if i % 3 else 'a"b') for i in range(300)] + [(999, "n1", None, "Ñ")]
    with sqlite3.connect(path) as db:
        db.execute('create table t (id integer, name text collate nocase, x real, "od""d" text)')
        db.executemany("insert into t values (?, ?, ?, ?)", rows)
    df = read_sqlite(spark, path, "t")
    odd = F.col('`od"d`')
    cases = {
        "id = 7": lambda i, n, x, o: i == 7,
        "name = 'N1'": lambda i, n, x, o: n == "N1",
        "name in ('N1', 'n1', 'zzz') and id > 100": lambda i, n, x, o: n in ("N1", "n1") and i > 100,
        "not (name = 'N1')": lambda i, n, x, o: n is not None and n != "N1",
        "name is null and x <= 10.5": lambda i, n, x, o: n is None and x is not None and x <= 10.5,
        "x is not null and id < 5 and name <=> null": lambda i, n, x, o: x is not None and i < 5 and n is None,
        "name like 'N%' and id >= 290": lambda i, n, x, o: (n or "").startswith("N") and i >= 290,
    }
    for where, keep in cases.items():
        for found in (df.where(where), read_sqlite(spark, path, "t", "id", 4).where(where)):
            assert Counter(map(tuple, found.collect())) == Counter(x for x in rows if keep(*x)), where
    assert df.where(odd == "it's").count() == sum(x[3] == "it's" for x in rows) and df.where(odd == 'a"b').count() == 100
    plan = df.where("id = 7 and name = 'N0'").select("x")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter \(", plan), plan
    found = query_sqlite(spark, path, "select id, name from t where name = ? and id < ? order by id", ("N1", 100), "id long, name string").collect()
    assert [x.id for x in found] == [i for i, n, *_ in rows if n == "N1" and i < 100]
    assert query_sqlite(spark, path, "select id from t where name = ?", ("x' or '1'='1",), "id long").count() == 0


# forms of answers


def is_whole(text, form):
    try:
        value = json.loads(text)
    except ValueError:
        return False
    if not isinstance(value, dict) or list(value) != [f.name for f in form] or re.search(r'^\s|\s$|\{\s|\s[}\],:]|\[\s|[,:]\s\s|"\s+[,:}\]]|[\x00-\x1f]', re.sub(r'"(?:[^"\\]|\\.)*"', '""', text)) or len(re.findall(r'"', re.sub(r"\\.", "", text))) % 2:
        return False
    for f in form:
        v = value[f.name]
        if f.names:
            if not isinstance(v, list) or not 1 <= len(v) <= f.names or not all(isinstance(x, str) and re.fullmatch(r"[a-z0-9]+(_[a-z0-9]+)*", x) for x in v):
                return False
        elif not isinstance(v, str) or (f.values and v not in f.values) or (f.longest and len(v) > f.longest):
            return False
    return True


def test_forms_of_answers():
    from quern.functions.forms import FORMS, Automaton, Field, constrained

    r = random.Random(7)
    form = (Field("a", values=("x", "xy", "z")), Field("b", longest=3), Field("c", names=2))
    machine = Automaton(form)
    good = ['{"a":"%s"%s"b":%s"%s",%s"c":["%s"%s]}' % (a, s1, s2, b, s3, c, d) for a in ("x", "xy", "z") for s1 in (",", ", ") for s2 in ("", " ") for b in ("", "abc", "\\n\\u00e9!") for s3 in ("", " ") for c in ("k", "k_1") for d in ("", ',"z9"', ', "z9"')]  # noqa: UP031
    for text in good:
        n, state = machine.reach(text)
        assert n == len(text) and machine.complete(state) and is_whole(text, form)
        for k in range(len(text)):  # every prefix can be gone on with
            m, part = machine.reach(text[:k])
            assert m == k and not machine.complete(part) and is_whole(text[:k] + machine.shortest(part), form)
    for _ in range(4000):
        text = list(r.choice(good))
        for _ in range(r.randrange(1, 3)):
            k = r.randrange(len(text))
            text[k : k + r.randrange(2)] = r.choice(['"', ",", ":", " ", "}", "]", "x", "_", "A", "é", "\\", "\n", ""])
        text = "".join(text)
        n, state = machine.reach(text)
        assert (n == len(text) and machine.complete(state)) == is_whole(text, form), text
    for name, own in FORMS.items():
        text = Automaton(own).shortest(Automaton(own).start)
        assert is_whole(text, own), name
        guess = r"""{"":, []_ab'"n""" + text
        wild = constrained(lambda prefix: [guess[(len(prefix) * 7 + i) % len(guess)] for i in range(9)], own, 300)
        assert is_whole(wild, own), name


# token counts


def test_token_counts(spark, tmp_path):
    from pyspark.sql import functions as F

    from quern.functions.tokens import merged_length, read_ranks, token_lengths

    def by_hand(piece, ranks):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while (best := min(((ranks[a + b], i) for i, (a, b) in enumerate(itertools.pairwise(parts)) if a + b in ranks), default=None)) is not None:
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return len(parts)

    r = random.Random(2)
    for _ in range(2000):
        ranks = {t: i for i, t in enumerate({bytes(r.choice(b"abc") for _ in range(r.randrange(2, 6))) for _ in range(r.randrange(1, 30))})}
        piece = bytes(r.choice(b"abc") for _ in range(r.randrange(0, 16)))
        assert merged_length(piece, ranks) == (1 if piece in ranks else by_hand(piece, ranks))
    table = {bytes([k]): k for k in range(256)} | {b"th": 256, b"the": 257, b" the": 258, "é".encode(): 259}
    (tmp_path / "ranks").write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(n).encode() for t, n in table.items()))
    ranks = read_ranks(spark, str(tmp_path / "ranks"))
    assert ranks == table
    texts = ["", None, "the the", "thé", "theth", "a" * 1000, "don't  stop"]
    got = [x.n for x in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(token_lengths(F.col("t"), ranks).alias("n")).collect()]
    assert got == [0, 0, 2, 2, 2, 1000, 11]
    known = Path("/opt/tokenizers/byte_bpe_50k.tiktoken")
    if known.exists():
        import tiktoken

        from quern.functions.tokens import PIECES

        ranks = read_ranks(spark, str(known))
        coder = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", token_lengths(F.col("text"), ranks).alias("n")).collect()
        assert all(x.n == len(coder.encode_ordinary(x.text or "")) for x in docs)


# entities


@pytest.mark.parametrize("seed", [1, 2])
def test_entities_with_and_without_semicolon(spark, seed):
    from pyspark.sql import functions as F

    from quern.operators.clean import decode_entities

    def plain(m):
        name = m[1]
        if name[0] == "#":
            number = int(name[2:-1], 16) if name[1] in "xX" else int(name[1:-1])
            return chr(number) if 0 < number < 0x110000 and not 0xD800 <= number < 0xE000 else m[0]
        found = next((k for k in range(len(name), 1, -1) if name[:k] in html5), 0)
        return html5[name[:found]] + name[found:] if found else m[0]

    r, names = random.Random(seed), sorted(html5)
    texts = ["&amp", "&copy2020", "&notit;", "&ampamp;", "&&amp;&", "&#38;", "&#x26;", "&#38", "&#0;", "&#xD800;", "", "&"] + ["".join(r.choice(["&", "x", " ", "1"]) + r.choice(names) for _ in range(4)) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decode_entities(F.col("t")).alias("d")).collect()
    assert [x.d for x in rows] == [re.sub(r"&(#[0-9]{1,7};|#[xX][0-9a-fA-F]{1,6};|[A-Za-z][A-Za-z0-9]*;?)", plain, x.t) for x in rows]


# the run to summaries


def test_summaries_are_written(spark, tmp_path):
    from quern.plans.jobs import summarise

    quotation = "Στον ν. 1/2000 αντικαθίσταται:\n«νέο\nκείμενο»"
    rows = [
        (1, 1, "ΜΕΡΟΣ Α", f"Άρθρο 1\nΣκοπός του νόμου\nΆρθρο 2\n{quotation}"),
        (1, 2, "ΚΕΦΑΛΑΙΟ Α", "λέξη " * 100),
        (1, 3, "ΚΕΦΑΛΑΙΟ Β", quotation),
        (1, 4, "x", None),
        (2, 5, "y", "σύντομο"),
    ]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, "consultation_id long, id long, title string, content string").write.parquet(source)
    parts = {(x.consultation_id, x.part): x for x in summarise(spark, source, target).collect()}
    assert set(parts) == {("1", "Α'"), ("2", "-")} and parts["1", "Α'"].paragraphs == 3 and parts["2", "-"].paragraphs == 1
    read = lambda name: spark.read.json(f"{target}/{name}").collect()
    assert Counter((x.id, x.nth, x.change_type) for x in read("modifications")) == Counter([(1, 1, "τροποποιείται"), (3, 0, "τροποποιείται")])
    assert Counter((x.id, x.nth) for x in read("provisions")) == Counter([(2, 0), (5, 0)])
    intro = spark.read.csv(f"{target}/intro", header=True, multiLine=True, escape='"').collect()
    assert [(x.id, x.type) for x in intro] == [("1", "purpose")]
    stage = spark.read.csv(f"{target}/stage_one", header=True, multiLine=True, escape='"').collect()
    assert Counter((x.id, x.part, x.chapter, x.route) for x in stage) == Counter([("1", "Α'", "-", "purpose"), ("1", "Α'", "-", "verbatim"), ("2", "Α'", "Α'", "summarise"), ("3", "Α'", "Β'", "verbatim"), ("5", "-", "-", "verbatim")])
    assert {x.consultation_id: x.text.split("\n\n")[0] for x in read("final")} == {"1": "Α'", "2": "-"}
    assert len(read("trace")) == 4


# PDF files


def pdf_of(body: bytes, deflated: bool = False) -> bytes:
    import zlib

    body = zlib.compress(body) if deflated else body
    return b"%PDF-1.5\n4 0 obj\n<< /Length " + str(len(body)).encode() + (b" /Filter /FlateDecode" if deflated else b"") + b" >>\nstream\n" + body + b"\nendstream\nendobj\n%%EOF"


def test_texts_of_simple_pdfs():
    from quern.operators.pdf import simple_text

    body = rb"q BT /F1 9 Tf (a\(b\)\\ \351\n) Tj T* (next) Tj 10 0 Td (same) ' ET Q BT <FEFF03B103B2> Tj ET BT [(wo) 20 (rd) -250 (two)] TJ ET"
    for deflated in (False, True):
        assert simple_text(pdf_of(body, deflated)) == "a(b)\\ é\n\nnext\nsame\n\nαβ\n\nword two"
    assert simple_text(b"%PDF-1.4\nnothing") == "" and simple_text(pdf_of(b"BT ET")) == ""
    for bad in (b"", b"<html>", b"PDF"):
        with pytest.raises(ValueError):
            simple_text(bad)


def test_documents_by_their_files(spark):
    import hashlib

    from quern.operators.pdf import fetched, process_documents

    name = lambda url: hashlib.md5(url.encode()).hexdigest()[:8] + ".pdf"
    urls = ["http://x/a.pdf", "http://x/b.pdf", "http://x/c.pdf", "http://x/d.pdf"]
    files = [(name(urls[0]), pdf_of(b"BT (text a) Tj ET")), (name(urls[1]), b"broken"), (name(urls[2]), pdf_of(b"BT ET"))]
    docs = [(i, u, "pending", None, 0) for i, u in enumerate(urls)] + [(9, None, "pending", None, 0)]
    out = process_documents(spark.createDataFrame(docs, "id long, url string, status string, processed_text string, tries int"), spark.createDataFrame(files, "name string, content binary"))
    got = {x.id: (x.status, x.processed_text) for x in out.collect()}
    assert got[0] == ("processed", "text a") and got[1][0] == got[2][0] == "processing_failed" and got[3] == ("pending", None) and got[9][0] == "processing_skipped"

    def factory():
        tries = Counter()

        def fetch(url):
            tries[url] += 1
            if url == "flaky" and tries[url] < 3:
                raise OSError("again")
            if url == "down":
                raise OSError("down")
            return (None if url == "silent" else 1000 if url == "long" else 3), iter([b"ab", b"c"] if url != "silent" else [b"x" * 60] * 2)

        return fetch

    rows = spark.createDataFrame([("ok",), ("ok",), ("flaky",), ("down",), ("long",), ("silent",), (None,)], "u string").coalesce(1)
    got = {x.u: (x.content and bytes(x.content), x.error) for x in fetched(rows, "u", factory, most=100).collect()}
    assert got["ok"] == got["flaky"] == (b"abc", None) and got["down"] == (None, "OSError: down") and set(got) == {"ok", "flaky", "down", "long", "silent"}
    assert got["long"][1].startswith("OverflowError: 1000") and got["silent"] == (None, "OverflowError: more than 100 bytes")
