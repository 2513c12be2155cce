"""JSON answers of generators: extraction from chatter, validation and repair."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once

#: Kinds of change and of provision, as answers name them.
CHANGE_TYPES = ("τροποποιείται", "καταργείται", "αντικαθίσταται", "προστίθεται", "συμπληρώνεται", "διαγράφεται")
PROVISION_TYPES = ("ορισμός", "σκοπός", "αρμοδιότητες", "διαδικασία", "οργάνωση", "ρύθμιση", "διάρθρωση")
MODIFICATION = ("law_reference", "article_number", "change_type", "major_change_summary", "key_themes")
PROVISION = ("article_title", "provision_type", "core_provision_summary", "key_themes")


def json_slice(raw: Column) -> Column:
    """From the first opening to the last closing brace, without code fences and zero-width marks; null if there is none."""
    text = F.regexp_replace(raw, "[\\uFEFF\\u200B]", "")
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def json_field(raw: Column, name: str) -> Column:
    """A text field of an answer, trimmed; null if there is none."""
    value = F.get_json_object(json_slice(raw), f"$.{name}")
    return F.nullif(F.trim(value), F.lit(""))


def validated(raw: Column, fields: tuple[str, ...], list_field: str = "key_themes", most: int = 3) -> Column:
    """STRUCT of an answer that has just these fields, a list among them; null otherwise. The list keeps ``most`` trimmed items."""
    ddl = ", ".join(f"{f} {'array<string>' if f == list_field else 'string'}" for f in fields)
    wanted = F.array(*map(F.lit, fields))

    def read(body: Column) -> Column:
        keys = F.json_object_keys(body)
        same = once(keys, lambda k: (F.size(F.array_except(k, wanted)) == 0) & (F.size(F.array_except(wanted, k)) == 0))
        return F.when(same & F.get_json_object(body, f"$.{list_field}").startswith("["), F.from_json(body, ddl))

    def of(parsed: Column) -> Column:
        themes = F.slice(F.filter(F.transform(parsed[list_field], lambda x: F.trim(x)), lambda x: x != ""), 1, most)
        return F.when(parsed[list_field].isNotNull(), F.struct(*(themes.alias(f) if f == list_field else F.trim(parsed[f]).alias(f) for f in fields)))

    return once(once(json_slice(raw), read), of)


def bullet(decision: Column, raw: Column) -> Column:
    """The line for one article's answer; null if the answer is not valid."""
    change = lambda m: F.when(m.isNotNull(), F.format_string("• Στο νομοσχέδιο %s το %s του %s. Η σύνοψη της αλλαγής είναι: %s", m["change_type"], m["article_number"], m["law_reference"], m["major_change_summary"]))
    new = lambda p: F.when(p.isNotNull(), F.format_string("• %s (%s): %s", p["article_title"], p["provision_type"], p["core_provision_summary"]))
    return F.when(decision == "modifies", once(validated(raw, MODIFICATION), change)).when(decision == "new_provision", once(validated(raw, PROVISION), new))


def plan_errors(raw: Column, allowed: Column) -> Column:
    """ARRAY of what is wrong with a narrative plan (empty: nothing): top-level fields, sections, and their chapter keys."""
    top = F.array(*map(F.lit, ("narrative_sections", "overall_narrative_arc", "problem", "protagonist")))
    need = F.array(*map(F.lit, ("section_role", "section_title", "source_chapters")))
    missing = F.array_except(top, F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")))
    sections = F.from_json(F.get_json_object(raw, "$.narrative_sections"), "array<string>")

    def of(section: Column, i: Column) -> Column:
        keys = F.json_object_keys(section)
        absent = F.array_except(need, F.coalesce(keys, F.array().cast("array<string>")))
        chapters = F.get_json_object(section, "$.source_chapters")
        listed = F.from_json(chapters, "array<string>")
        unknown = F.array_except(F.coalesce(listed, F.array().cast("array<string>")), allowed)
        name = F.concat(F.lit("Section "), i.cast("string"))
        return (
            F.when(keys.isNull(), F.concat(name, F.lit(" is not a JSON object")))
            .when(F.size(absent) > 0, F.concat(name, F.lit(" lacks "), F.array_join(absent, ", ")))
            .when(~chapters.startswith("["), F.concat(name, F.lit(": source_chapters is not a list")))
            .when((F.size(listed) > 0) & (F.size(unknown) == F.size(F.array_distinct(listed))), F.concat(name, F.lit(" has unknown chapters only: "), F.array_join(unknown, ", ")))
        )

    found = F.filter(F.transform(sections, of), lambda x: x.isNotNull())
    return (
        F.when(F.size(missing) > 0, F.array(F.concat(F.lit("Missing: "), F.array_join(missing, ", "))))
        .when(F.coalesce(F.size(sections), F.lit(0)) <= 0, F.array(F.lit("narrative_sections must be a list with sections")))
        .otherwise(found)
    )


def repair(text: str | None) -> str | None:
    """A JSON object out of a text that is cut off or has chatter around it; null if there is none to be had."""
    if not text or "{" not in text:
        return None
    body = text[text.index("{") :]
    try:
        return json.dumps(json.JSONDecoder().raw_decode(body)[0], ensure_ascii=False)
    except json.JSONDecodeError as e:
        wrong = e.pos
    # Close what is open at each place, from the first error backwards, where a value may have ended: beyond it nothing can be right.
    stack, inside, escaped, ends = [], False, False, []
    for i, c in enumerate(body):
        if inside:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                inside = False
                ends.append((i + 1, "".join(reversed(stack))))
            continue
        if c == '"':
            inside = True
        elif c in "{[":
            stack.append("}" if c == "{" else "]")
            ends.append((i + 1, "".join(reversed(stack))))
        elif c in "}]":
            if not stack or stack.pop() != c:
                break
            ends.append((i + 1, "".join(reversed(stack))))
        elif c == ",":
            ends.append((i, "".join(reversed(stack))))
    tries = ([(len(body), '"' + "".join(reversed(stack)))] if inside else [(len(body), "".join(reversed(stack)))]) + [x for x in reversed(ends) if x[0] <= wrong]
    for end, close in tries:
        try:
            return json.dumps(json.loads(body[:end] + close), ensure_ascii=False)
        except ValueError:
            continue
    return None


def _repair_batch(answers: pd.Series) -> pd.Series:
    return answers.map(repair, na_action="ignore")


def repaired(col: Column) -> Column:
    """``repair`` on a column, in Arrow batches (no expression can follow brackets)."""
    return F.pandas_udf(_repair_batch, "string")(col)
