"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; runs of turns
of one role are merged into messages; messages become marked text. Runs are
found by index and cut out with ``slice``: folding turns into a growing array
or string would copy it at each step, so a long conversation would cost the
square of its length. No Python worker takes part.

A message is ``open_role`` role ``close_role`` text ``close_turn``; the texts
of merged turns stay apart by ``next_part``. Control strings within roles and
texts, the template's and those of other common templates, get a backslash
after their first character (one more if they have some there), which is taken
out again in reading, so every conversation can be read back exactly.

The result is a list of segments (mark, text, loss): the formatted text is
their concatenation, and texts with ``loss`` are under the loss mask. Marks are
never under it.

Defined cases: turns are in order of turn (null first), those that tie in order
of role and text; repeated rows are turns of their own. Null roles and texts
count as empty. A row without conversation is a conversation of its own, with
null as its id, so rows without id never meet in one task. A conversation is
one row of the result and has to fit in it. An empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks of turns, control strings that texts must not hold, and the roles that are learned."""

    begin: str = "<|begin_of_text|>"
    open_role: str = "<|start_header_id|>"
    close_role: str = "<|end_header_id|>"
    gap: str = "\n\n"
    next_part: str = "<|eom_id|>"
    close_turn: str = "<|eot_id|>"
    foreign: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|end_of_text|>", "<|endoftext|>")
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        for a in self.controls:
            if len(a) < 2 or "\\" in a:
                raise ValueError(f"a control string has two characters or more and no backslash: {a!r}")
            for b in self.controls:
                if any(b.startswith(a[k:]) or a[k:].startswith(b) for k in range(1, len(a))):
                    raise ValueError(f"control strings overlap: {a!r} and {b!r}")

    @property
    def controls(self) -> list[str]:
        return sorted({self.begin, self.open_role, self.close_role, self.next_part, self.close_turn, *self.foreign})

    @property
    def forms(self) -> list[tuple[str, str]]:
        """Patterns of a control string's first character and of what may follow it."""
        return [(re.escape(first), "|".join(re.escape(x[1:]) for x in found)) for first, found in groupby(self.controls, key=lambda x: x[0])]


LLAMA = Template()


def escaped(text: Column, template: Template = LLAMA) -> Column:
    for first, rest in template.forms:
        text = F.regexp_replace(text, rf"({first})(\\*)({rest})", r"$1$2\\$3")
    return text


def unescaped(text: Column, template: Template = LLAMA) -> Column:
    for first, rest in template.forms:
        text = F.regexp_replace(text, rf"({first})(\\*)\\({rest})", r"$1$2$3")
    return text


def messages(chats: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: id and messages, an array of (role, texts); texts has an entry for each merged turn."""
    empty = F.lit("")
    turn = F.struct(chats[turn_col].alias("turn"), F.coalesce(chats[role_col].cast("string"), empty).alias("role"), F.coalesce(chats[text_col].cast("string"), empty).alias("text"))
    rows = chats.select(chats[id_col].alias("id"), turn.alias("turn"))
    together = rows.where("id is not null").groupBy("id").agg(F.collect_list("turn").alias("turns"))
    alone = rows.where("id is null").select("id", F.array("turn").alias("turns"))
    # what a lambda looks up by index is a column by then, and named twice, so that it isn't computed for each element
    out = together.unionByName(alone).select("id", F.array_sort("turns").alias("turns"))
    out = out.select("id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    starts = F.filter(F.sequence(F.lit(0), F.size("roles") - 1), lambda i: (i == 0) | (F.get("roles", i) != F.get("roles", i - 1)))
    out = out.select("id", "roles", "texts", starts.alias("starts"))
    merged = F.transform("starts", lambda s, k: F.struct(F.get("roles", s).alias("role"), F.slice("texts", s + 1, F.coalesce(F.get("starts", k + 1), F.size("texts")) - s).alias("texts")))
    return out.select(F.col("id").alias(id_col), merged.alias("messages"))


def segments(found: Column, template: Template = LLAMA) -> Column:
    """Messages as an array of (mark, text, loss), texts escaped; an array of null messages is empty."""
    t = template

    def segment(role: Column, text: Column, k: Column, part: Column) -> Column:
        head = F.concat(F.when(k > 0, F.lit(t.close_turn)).otherwise(F.lit(t.begin)), F.lit(t.open_role), escaped(role, t), F.lit(t.close_role + t.gap))
        return F.struct(F.when(part > 0, F.lit(t.next_part)).otherwise(head).alias("mark"), escaped(text, t).alias("text"), role.isin(*t.learned).alias("loss"))

    body = F.transform(found, lambda m, k: F.transform(m["texts"], lambda text, part: segment(m["role"], text, k, part)))
    end = F.struct(F.lit(t.close_turn).alias("mark"), F.lit("").alias("text"), F.lit(False).alias("loss"))
    return F.concat(F.flatten(body), F.array(end))


def formatted(parts: Column) -> Column:
    """The text of segments."""
    return F.array_join(F.transform(parts, lambda s: F.concat(s["mark"], s["text"])), "")


def under_loss(parts: Column, template: Template = LLAMA) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(parts, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")


def turns(text: Column, template: Template = LLAMA) -> Column:
    """The turns (role, text) of a formatted conversation, as they were."""
    t = template

    def of_message(message: Column) -> Column:
        role = unescaped(F.substring_index(F.substring(message, len(t.open_role) + 1, 1 << 30), t.close_role, 1), t)
        body = F.substring(F.substring_index(message, t.close_role, -1), len(t.gap) + 1, 1 << 30)
        return F.transform(F.split(body, re.escape(t.next_part)), lambda x: F.struct(role.alias("role"), unescaped(x, t).alias("text")))

    found = F.split(F.substring(text, len(t.begin) + 1, 1 << 30), re.escape(t.close_turn))
    return F.flatten(F.transform(F.filter(found, lambda x: x != ""), of_message))


def format_chats(chats: DataFrame, template: Template = LLAMA, **columns: str) -> DataFrame:
    """One row per conversation: id, segments and formatted."""
    id_col = columns.get("id_col", "conv_id")
    out = messages(chats, **columns).select(id_col, segments(F.col("messages"), template).alias("segments"))
    return out.select(id_col, "segments", formatted(F.col("segments")).alias("formatted"))
