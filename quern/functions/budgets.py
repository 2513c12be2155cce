"""Length budgets of summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import n_words

WORDS_PER_SENTENCE, TOKENS_PER_WORD, OVERSHOOT = 20, 2.5, 1.10


def estimated_tokens(text: Column) -> Column:
    """Words over 0.75."""
    return F.floor(n_words(text) / 0.75).cast("long")


def n_sentences(text: Column) -> Column:
    marks = F.length(text) - F.length(F.translate(text, ".;", ""))
    return F.greatest(F.lit(1), marks)


def budget(text: Column, ratio: float = 0.10, words_per_sentence: int = WORDS_PER_SENTENCE, tokens_per_word: float = TOKENS_PER_WORD, overshoot: float = OVERSHOOT) -> Column:
    """STRUCT(target_words, target_sentences, token_limit) for a summary of ``ratio`` of the words."""
    words = F.greatest(F.lit(1), F.floor(n_words(text) * ratio)).cast("long")
    sentences = F.greatest(F.lit(1), F.bround(words / words_per_sentence)).cast("long")
    return F.struct(words.alias("target_words"), sentences.alias("target_sentences"), F.ceil(words * tokens_per_word * overshoot).cast("long").alias("token_limit"))


def dynamic_budget(text: Column, ratio: float = 0.12, variance: float = 0.2) -> Column:
    """STRUCT(min_words, max_words, token_limit) around the target."""
    base = budget(text, ratio)
    share = lambda x: F.floor(base["target_words"] * x).cast("long")
    return F.struct(share(1 - variance).alias("min_words"), share(1 + variance).alias("max_words"), base["token_limit"].alias("token_limit"))


def desired_tokens(tokens: Column, ratio: float = 0.10) -> Column:
    return F.greatest(F.lit(1), F.floor(tokens * ratio)).cast("long")


def should_split(tokens: Column, most: int) -> Column:
    return tokens > most
