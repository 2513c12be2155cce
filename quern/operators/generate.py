"""Generation stages over articles: routing, prompts, stub answers, validation with retries, parts.

A generator is a callable (prompt, max_tokens) -> text. The stub answers
without any model, always the same; a real one is loaded once per worker by
the factory that is passed in.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quern.functions.citations import modifies_law
from quern.functions.json import bullet, repair
from quern.functions.text import is_blank, is_object, is_purpose, n_words

Generator = Callable[[str, int], str]
VERBATIM_WORDS = 80
PIECES = 64
MARKERS = ("[error", "[failed", "placeholder")
PROMPTS = {
    "summary": "Summarise the article in plain language.\n\n",
    "modifies": "[SCHEMA:MODIFICATION] Describe the change as JSON.\n\n",
    "new_provision": "[SCHEMA:PROVISION] Describe the provision as JSON.\n\n",
    "plan": "[SCHEMA:PLAN] Plan the narrative of the part as JSON.\n\n",
    "paragraph": "Write the next paragraph of the narrative.\n\n",
}


def prompt(key: str) -> str:
    if key not in PROMPTS:
        raise KeyError(f"no prompt is called {key!r}")
    return PROMPTS[key]


def stub(text: str, max_tokens: int = 0) -> str:
    """A fixed answer for each kind of prompt."""
    if "[SCHEMA:MODIFICATION]" in text:
        return json.dumps({"law_reference": "ν. 1/2000", "article_number": "άρθρο 1", "change_type": "τροποποιείται", "major_change_summary": "stub", "key_themes": ["stub"]}, ensure_ascii=False)
    if "[SCHEMA:PROVISION]" in text:
        return json.dumps({"article_title": "stub", "provision_type": "ρύθμιση", "core_provision_summary": "stub", "key_themes": ["stub"]}, ensure_ascii=False)
    if "[SCHEMA:PLAN]" in text:
        keys = sorted(set(re.findall(r"kefalaio_\w+", text)))
        return json.dumps({"overall_narrative_arc": "stub", "protagonist": "stub", "problem": "stub", "narrative_sections": [{"section_title": f"{k}", "section_role": "stub", "source_chapters": [k]} for k in keys]}, ensure_ascii=False)
    return f"Summary of {len(text.split())} words."


def stub_factory() -> Generator:
    return stub


def with_retries(generate: Generator, text: str, max_tokens: int, valid: Callable[[str], bool], retries: int = 2, shrink: float = 0.7) -> tuple[str, int]:
    """The first valid answer and the number of tries; each retry has a smaller budget; the last answer if none is valid."""
    answer = ""
    for n in range(retries + 1):
        answer = generate(text, max_tokens)
        if valid(answer):
            return answer, n + 1
        max_tokens = max(1, int(max_tokens * shrink))
    return answer, retries + 1


def continued(generate: Generator, text: str, max_tokens: int, endings: str = ".?!…", retries: int = 2) -> str:
    """An answer that is asked to go on until it ends like a sentence."""
    answer = generate(text, max_tokens).rstrip()
    for _ in range(retries):
        if answer.endswith(tuple(endings)):
            break
        max_tokens = max(1, int(max_tokens * 0.7))
        answer = f"{answer} {generate(f'{text}{answer}', max_tokens).strip()}"
    return answer


#: Fields of the answers that a structured prompt asks for.
SHAPES = {
    "CHAPTER": ("summary",),
    "PART": ("summary",),
    "POLISHED": ("summary_text",),
    "MODIFICATION": ("law_reference", "article_number", "change_type", "major_change_summary", "key_themes"),
}


def structured_prompt(text: Column, shape: str) -> Column:
    """A prompt that asks for one JSON object and nothing else, with the fields of a shape (of a chapter, if it isn't known); the shape's own marker is taken out."""
    fields = SHAPES.get(shape, SHAPES["CHAPTER"])
    form = json.dumps({f: ["..."] if f.endswith("themes") else "..." for f in fields}, ensure_ascii=False)
    rules = f"Answer with a single JSON object of this form, in double quotes, with nothing before or after it; shorten what is too long:\n{form}"
    return F.concat(F.trim(F.replace(text, F.lit(f"[SCHEMA:{shape}]"), F.lit(""))), F.lit(f"\n\n{rules}\n"))


def shortened(generate: Generator, text: str, max_tokens: int, endings: str = ".?!…", share: float = 0.8) -> str:
    """An answer; if it breaks off, a second one that is asked to be shorter, unless that breaks off, too, and is no longer."""
    answer = generate(text, max_tokens).rstrip()
    if answer.endswith(tuple(endings)):
        return answer
    again = generate(f"{text}\n\nRewrite this in fewer words, to the end:\n{answer}", max(1, int(max_tokens * share))).rstrip()
    return again if again.endswith(tuple(endings)) or len(again) > len(answer) else answer


def generated(df: DataFrame, prompt_col: str, out: str, factory: Callable[[], Generator] = stub_factory, max_tokens: int = 512) -> DataFrame:
    """Adds the answers to a column of prompts (null stays null); the generator is made once per task."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        generate = factory()
        for batch in batches:
            yield pa.array([None if p is None else continued(generate, p, max_tokens) if "[SCHEMA" not in p else repair(generate(p, max_tokens)) for p in batch.to_pylist()], pa.string())

    # Python gets the prompts alone; as nondeterministic, no filter makes an answer anew.
    return df.withColumn(out, F.arrow_udf(run, StringType()).asNondeterministic()(F.col(prompt_col)))


def noted(df: DataFrame, chunk: str, out: str, note: str, factory: Callable[[], Generator] = stub_factory, max_tokens: int = 512) -> DataFrame:
    """Adds the summary of each chunk; a blank chunk gets a fixed note and no generation."""
    ask = F.when(F.trim(F.coalesce(F.col(chunk), F.lit(""))) != "", F.concat(F.lit(PROMPTS["summary"]), F.col(chunk)))
    return generated(df.withColumn("__ask", ask), "__ask", out, factory, max_tokens).withColumn(out, F.coalesce(out, F.lit(note))).drop("__ask")


def route(title: Column, content: Column, number: Column) -> Column:
    """What stage one does with an article: skip, purpose, object, verbatim, or summarise."""
    return (
        F.when(is_blank(content), "skip")
        .when((number == 1) & is_purpose(title, content), "purpose")
        .when((number == 2) & is_object(title, content), "object")
        .when(F.length(content) < 2 * VERBATIM_WORDS - 1, "verbatim")  # too short for so many words
        .when(n_words(content) < VERBATIM_WORDS, "verbatim")
        .otherwise("summarise")
    )


def decision(content: Column) -> Column:
    return F.when(modifies_law(content), "modifies").otherwise("new_provision")


def stage_one(articles: DataFrame, factory: Callable[[], Generator] = stub_factory) -> DataFrame:
    """Articles (title, content, article_number) with route, decision, summary, parsed_json and bullet."""
    out = articles.withColumns({"route": route(F.col("title"), F.col("content"), F.col("article_number")), "decision": decision(F.col("content"))})
    out = out.withColumn("__p", F.when(F.col("route") == "summarise", F.concat(F.lit(PROMPTS["summary"]), F.col("content"))))
    out = generated(out, "__p", "__s", factory)
    out = out.withColumn("summary", F.when(F.col("route") == "summarise", F.col("__s")).when(F.col("route") != "skip", F.col("content")))
    ask = F.when(F.col("decision") == "modifies", PROMPTS["modifies"]).otherwise(PROMPTS["new_provision"])
    out = out.withColumn("__p", F.when(F.col("route").isin("summarise", "verbatim"), F.concat(ask, F.col("content"))))
    out = generated(out.drop("__s"), "__p", "parsed_json", factory)
    return out.withColumn("bullet", bullet(F.col("decision"), F.col("parsed_json"))).drop("__p")


def usable(df: DataFrame, column: str) -> DataFrame:
    """Rows whose generated text has no marker of failure."""
    low = F.lower(F.col(column))
    return df.where(~F.coalesce(F.reduce(F.array(*map(F.lit, MARKERS)), F.lit(False), lambda s, m: s | low.contains(m)), F.lit(True)))


def chapter_prompts(bullets: DataFrame, part: str, chapter: str, order: str) -> DataFrame:
    """Per chapter the ordered bullets of its articles, gathered in PIECES first: a hot chapter's articles are dealt over as many tasks."""
    piece = F.pmod(F.xxhash64(order), F.lit(PIECES)).alias("__piece")
    pieces = bullets.where("bullet is not null").groupBy(part, chapter, piece).agg(F.collect_list(F.struct(order, "bullet")).alias("__listed"))
    listed = F.array_sort(F.flatten(F.collect_list("__listed")))
    return pieces.groupBy(part, chapter).agg(F.array_join(F.transform(listed, lambda s: s["bullet"]), "\n").alias("prompt"))


def plan_input(summaries: DataFrame, part: str, chapter: str) -> DataFrame:
    """Per part a JSON object of its chapters' summaries by key."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("kefalaio_"), F.lower(F.col(chapter))), "summary"))))
    return summaries.groupBy(part).agg(F.to_json(entries).alias("plan_input"))


def part_summaries(summaries: DataFrame, part: str, chapter: str, factory: Callable[[], Generator] = stub_factory, max_tokens: int = 512) -> DataFrame:
    """Per part: plan, then a paragraph per section that sees the ones before, then the joined text. One chapter needs no plan.

    The fold is sequential, so a part, which has a few chapters, is one task.
    """
    kind = summaries.schema[part].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        generate = factory()
        rows = rows.sort_values(chapter)
        texts = {f"kefalaio_{str(c).lower()}": s for c, s in zip(rows[chapter], rows["summary"], strict=True)}
        if len(texts) == 1:
            paragraphs = [continued(generate, PROMPTS["summary"] + next(iter(texts.values())), max_tokens)]
        else:
            ask = PROMPTS["plan"] + json.dumps(texts, ensure_ascii=False)
            good = lambda a: bool((json.loads(repair(a) or "{}") or {}).get("narrative_sections"))
            answer, _ = with_retries(generate, ask, max_tokens, good)
            sections = json.loads(repair(answer) or "{}").get("narrative_sections") or [{"section_title": k, "source_chapters": [k]} for k in texts]
            paragraphs = []
            for s in sections:
                own = "\n".join(texts[k] for k in s.get("source_chapters", []) if k in texts)
                paragraphs.append(continued(generate, f"{PROMPTS['paragraph']}{s.get('section_title', '')}\n{own}\n\n" + "\n\n".join(paragraphs), max_tokens))
        return pd.DataFrame({part: [rows[part].iloc[0]], "paragraphs": [len(paragraphs)], "text": ["\n\n".join(paragraphs)]})

    return summaries.select(part, chapter, "summary").groupBy(part).applyInPandas(run, f"{part} {kind}, paragraphs int, text string")


def with_notes(summaries: DataFrame, notes: DataFrame, key: str, default: str = "No omissions.") -> DataFrame:
    """Summaries with their note on omissions, where one says something."""
    said = notes.where(F.length(F.trim(F.coalesce("note", F.lit("")))) > 3).select(key, "note")
    return summaries.join(said, key, "left").withColumn("note", F.coalesce("note", F.lit(default)))


def theme_lines(col: Column) -> Column:
    """One theme per line, bullets trimmed."""
    return F.filter(F.transform(F.split(col, "\n"), lambda x: F.regexp_replace(x, r"(?U)^[\s\-*•]+|\s+$", "")), lambda x: x != "")
