"""Literal fixtures: text, numerals, dates, URLs, citations, JSON, HTML and sections."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quern.functions import budgets, citations, convert, json, numerals, text


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items())).select(column.alias("x")).first().x


def test_lines_are_those_of_a_file(spark):
    for t in ("", "a", "a\n", "a\n\n", "a\r\nb", "\n", "a\n\rb"):
        want = [x.removesuffix("\r") for x in (t[:-1] if t.endswith("\n") else t).split("\n")] if t else []
        assert one(spark, text.lines(F.col("t")), t=t) == want


def test_text(spark):
    c = F.col("t")
    assert one(spark, text.fold_upper(c), t="Σκοπός Ϊ café") == "ΣΚΟΠΟΣ Ι CAFE"
    assert one(spark, text.strip_accents(c), t="éά") == "eα"
    assert one(spark, text.trim(c), t="  a b ") == "a b"
    assert one(spark, text.greek_look_alikes(c), t="MEPOΣ A") == "ΜΕΡΟΣ Α"
    assert one(spark, text.within_one_edit(c, F.lit("ΜΕΡΟΣ")), t="ΜΕΡΟ") and not one(spark, text.within_one_edit(c, F.lit("ΜΕΡΟΣ")), t="ΜΕΡ")
    assert one(spark, text.inside_quotes(c, F.lit(4)), t='a "b c') and not one(spark, text.inside_quotes(c, F.lit(1)), t='a "b c')
    assert one(spark, text.quoted_segments(c), t="«abc» «abc\ndef» «12345»") == ["abc\ndef", "12345"]
    assert one(spark, text.is_purpose(c, F.lit("x")), t="Άρθρο 1 – ΣΚΟΠΟΣ.") and not one(spark, text.is_purpose(c, F.lit("x")), t="Σκοπόςα")
    assert one(spark, text.is_object(F.lit("t"), c), t="\n a\nΑντικείμενο\n") and not one(spark, text.is_object(F.lit("t"), c), t="a\nb\nΑντικείμενο")
    assert one(spark, text.is_complete(c), t="Done. ") and not one(spark, text.is_complete(c), t="Done")
    assert one(spark, text.safe_filename(c), t="α/β  γ?.txt") == "α_β_γ_.txt"
    assert one(spark, text.preview(c), t="") == "EMPTY"


@pytest.mark.parametrize(
    ("title", "want"),
    [("Σχέδιο Νόμου", "law_draft"), ("ανάλυση συνεπειών ρύθμισης", "analysis"), ("Έκθεση επί της διαβούλευσης", "deliberation_report"), ("Έκθεση ελέγχου", "other_report"), ("ΕΚΘΕΣΗ ΔΙΑΒΟΥΛΕΥΣΗΣ", "deliberation_report"), ("Σχέδιο απόφασης", "other_draft"), (None, "other"), ("x", "other")],
)
def test_categories(spark, title, want):
    assert spark.createDataFrame([(title,)], "t string").select(text.categorize(F.col("t")).alias("x")).first().x == want


def test_numerals(spark):
    rows = spark.range(1, 1000).select(F.col("id").cast("int").alias("n")).select("n", numerals.int_to_greek(F.col("n")).alias("g"))
    found = {r.n: r.g for r in rows.collect()}
    assert [found[n] for n in (1, 6, 10, 16, 21, 100, 111, 200)] == ["Α", "ΣΤ", "Ι", "ΙΣΤ", "ΚΑ", "Ρ", "ΡΙΑ", "Σ"]
    assert found[90] == found[100] == "Ρ"
    assert one(spark, numerals.greek_to_int(F.col("t")), t="ιστ΄") == 16 and one(spark, numerals.greek_to_int(F.col("t")), t="") == 0
    for line, want in (("Άρθρο 12", (12, "arabic")), ("## ΆΡΘΡΟ 3. Τίτλος", (3, "arabic")), ("| Άρθρο 7 | x", (7, "arabic")), ("Άρθρο δέκατο τρίτο", (13, "greek_word")), ("Άρθρο Πρώτο – Σκοπός", (1, "greek_word")), ("Άρθρο ένα", None), ("Το άρθρο 5", None), ("Άρθρο εκατοστό πρώτο", (101, "greek_word")), ("Άρθρο τριακοσιοστό", (300, "greek_word")), ("Άρθρο διακοσιοστό τριακοστό ένατο – x", (239, "greek_word")), ("Άρθρο εκατοστό δωδέκατο.", (112, "greek_word")), ("Άρθρο χιλιοστό", (1000, "greek_word")), ("Άρθρο πρώτος", None), ("Άρθρο δέκατο – τρίτο", (10, "greek_word"))):
        got = one(spark, numerals.article_heading(F.col("t")), t=line)
        assert (got and tuple(got)) == want, line


def test_dates_and_casts(spark):
    c = F.col("t")
    assert one(spark, convert.greek_timestamp(c), t="5  Μαρτίου 2024, 9:05") == dt.datetime(2024, 3, 5, 9, 5)
    assert one(spark, convert.greek_timestamp(c), t="05 Μαΐου 2024") == dt.datetime(2024, 5, 5)
    assert one(spark, convert.greek_timestamp(c), t="gestern") is None
    assert one(spark, convert.greek_date(c), t="17 Ιούνιος, 2021") == dt.date(2021, 6, 17)
    assert one(spark, convert.year_of(c), t="Α 12 (1998)") == 1998 and one(spark, convert.year_of(c), t="none") is None
    for t, want in (("79.10%", 79.1), ("Some(0.1)", 0.1), ("", None), ("None", None), (" 3 ", 3.0)):
        assert one(spark, convert.lenient_double(c), t=t) == want
    assert one(spark, convert.lenient_bool(c), t="Yes") is True and one(spark, convert.lenient_bool(c), t="?") is None


def test_urls(spark):
    c = F.col("t")
    assert one(spark, convert.normalized_url(c), t=" HTTPS://WWW.X.gr/Yme/?p=5#c ") == "www.x.gr/Yme?p=5"
    assert one(spark, convert.normalized_url(c), t="http://x.gr/") == "x.gr/" and one(spark, convert.normalized_url(c), t=" ") is None
    assert one(spark, convert.ministry_code(c), t="http://x.gr/YME/?p=1") == "yme"
    assert one(spark, convert.post_id(c), t="http://x.gr/?p=12") == "12" and one(spark, convert.post_id(c), t="http://x.gr/") is None
    assert one(spark, convert.with_parameter(c, "cpage", F.lit(2), "comments"), t="http://x/?p=1&cpage=9#z") == "http://x/?p=1&cpage=2#comments"


def test_citations(spark):
    c = F.col("t")
    pairs = lambda t: [(r.number, r.year) for r in one(spark, citations.law_references(c), t=t)]
    assert pairs("ν. 4887/2022 και Ν.12 / 2001, του νόμου 1/1999 ή ΝΌΜΟΥ  7/2003") == [("4887", 2022), ("12", 2001), ("1", 1999), ("7", 2003)]
    assert pairs("τίποτα 12/2001") == [] and pairs("ν. 1/20") == [] and pairs("") == []
    kinds = (citations.LAW, citations.LEGISLATIVE)
    full = lambda t, k=kinds: [(r.type, r.number, r.year) for r in one(spark, citations.law_citations(c, k), t=t)]
    assert full("ν.δ. 5/1974", (citations.LAW,)) == [] and full("ν.δ. 5/1974") == [("ν.δ.", "5", 1974)]
    assert full("νόμου 4727/2020") == [("νόμου", "4727", 2020)] and full("ν. ΓΩΠΣΤ 3/1912, v. 2/2000") == [("ν. ΓΩΠΣΤ", "3", 1912), ("v.", "2", 2000)]
    # whole names only
    assert full("των ΠΟΛ 12/2020") == [] and full("αυτών. 12/2020") == [] and full("5/2001 και 6/2002") == []
    assert [r.full_match for r in one(spark, citations.law_citations(c), t="του ν.  3 / 2001(Α 4), α.ν. 5/1936")] == ["ν.  3 / 2001", "α.ν. 5/1936"]
    long = "λόγος " * 3000 + "ν. 1/2001 " * 500
    assert len(pairs(long)) == 500
    assert one(spark, citations.modifies_law(c), t="Στον ν. 1/2020:\n«α\nβ»") and one(spark, citations.modifies_law(c), t="π.δ. 5/2001\n«ολόκληρη γραμμή»\n")
    assert not one(spark, citations.modifies_law(c), t="«α\nβ» ν. 1/2020") and not one(spark, citations.modifies_law(c), t="«α\nβ»")
    found = lambda t: [(r.id, r.series, r.number, r.year) for r in one(spark, citations.decisions(c), t=t)]
    assert found("Την υπουργική απόφαση υπ' αριθμ. Δ6/Β/1234 και") == [("Δ6/Β/1234", None, None, None)]
    assert found("η Κ.Υ.Α. 145447/2011 (ΦΕΚ Β' 1015/2011) ισχύει") == [("145447/2011", "Β'", "1015", 2011)]
    assert found("με την 145447/2011 ΚΥΑ") == [("145447/2011", None, None, None)] and found("παρ. 3 ΚΥΑ 12/2011") == [] and found("απόφαση 12") == []
    key = lambda n, d: tuple(spark.createDataFrame([(n, d)], "n string, d string").select(citations.decree_key(F.col("n"), F.col("d")).alias("x")).first().x)
    assert [key(" 12 ", "2001-03-04"), key(None, "έτος 1998."), key("3", None), key("3", "x")] == [("12", 2001), ("", 1998), ("3", 0), ("3", 0)]
    gazette = lambda t: [(r.type, r.number, r.year, r.series, r.gazette) for r in one(spark, citations.law_citations(c), t=t)]
    assert gazette("[α.ν. 5 / 1936, (Α' 12)]") == [("α.ν.", "5", 1936, "Α'", "12")] and gazette("ν. 1/2001 (Β' 3)") == [("ν.", "1", 2001, None, None)]
    assert gazette("ν. 1/2001 A 7 και ν. 2/2002") == [("ν.", "1", 2001, "A", "7"), ("ν.", "2", 2002, None, None)]
    dated = lambda t: [tuple(r) for r in one(spark, citations.dated_decrees(c), t=t)]
    assert dated("π.δ. της 28ης Ιουλίου 1931, προεδρικό διάταγμα της 1 Μαΐου 1982") == [(28, 7, 1931), (1, 5, 1982)]
    assert dated("απόφαση της 28ης Ιουλίου 1931") == [] and dated("π.δ. της 28ης Τίποτα 1931") == []
    assert one(spark, citations.modifies_law(c), t="π.δ. της 1ης Μαΐου 1982\n«ολόκληρη γραμμή»\n") and not one(spark, citations.modifies_law(c), t="«ολόκληρη γραμμή»\nπ.δ. της 1ης Μαΐου 1982")
    assert tuple(one(spark, citations.gazette_title(c), t="ΦΕΚ Α 123/12.03.2010")) == ("Α", 123, 2010)


def test_json(spark):
    good = '{"law_reference": "a", "article_number": "b", "change_type": "τροποποιείται", "major_change_summary": "s", "key_themes": ["x ", "", "y", "z", "w"]}'
    c = F.col("t")
    got = one(spark, json.validated(c, json.MODIFICATION), t=f"```json\n{good}\n```")
    assert got.law_reference == "a" and got.key_themes == ["x", "y", "z"]
    for bad in ("", "no", good.replace('"law_reference": "a", ', ""), good[:-1] + ', "more": 1}', good.replace("[", '"').replace("]", '"')):
        assert one(spark, json.validated(c, json.MODIFICATION), t=bad) is None
    assert one(spark, json.bullet(F.lit("modifies"), c), t=good).startswith("• Στο νομοσχέδιο τροποποιείται το b του a.")
    assert one(spark, json.json_field(c, "summary"), t='x {"summary": " s "} y') == "s" and one(spark, json.json_field(c, "summary"), t="s") is None
    assert json.repair('{"a": [1, 2') == '{"a": [1, 2]}' and json.repair('{"a": "b", "c": "d') == '{"a": "b", "c": "d"}'
    assert json.repair('text {"a": 1} more') == '{"a": 1}' and json.repair("none") is None and json.repair('{"a": 1, "b') == '{"a": 1}'


def test_budgets(spark):
    words = " ".join(["w"] * 250)
    assert tuple(one(spark, budgets.budget(F.col("t")), t=words)) == (25, 1, 69)
    assert tuple(one(spark, budgets.dynamic_budget(F.col("t")), t=words)) == (24, 36, 83)
    assert tuple(one(spark, budgets.budget(F.col("t")), t=""))[:2] == (1, 1)


def test_repair_of_early_damage():
    rest = ", ".join(f'"k{i}": [{i}]' for i in range(500))
    assert json.repair('{"a": [1, 2], "b": oops, ' + rest + "}") == '{"a": [1, 2]}'
    assert json.repair('{"a": {"b": "c" "d": 1, ' + rest) == '{"a": {"b": "c"}}'
