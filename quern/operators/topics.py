"""Topic helpers: frequent words, class-based TF-IDF, cosines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import small, stored


def word_counts(df: DataFrame, text: str) -> DataFrame:
    words = F.explode(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[ \t\r\n]+"), lambda w: w != ""))
    return df.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def stop_words(df: DataFrame, text: str, above: int = 10) -> DataFrame:
    """Words that occur more than ``above`` times."""
    return word_counts(df, text).where(F.col("n") > above)


def plain_words(text, stop: list[str] | tuple[str, ...] = ()):
    """ARRAY of a text's words in lower case, without digits and stop words."""
    found = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[0-9]", ""), r"[ \t\r\n]+")
    if not stop:
        return F.array_remove(found, "")
    drop = F.array(*map(F.lit, stop))
    return F.filter(found, lambda w: (w != "") & ~F.array_contains(drop, w))


def class_tfidf(df: DataFrame, label: str, text: str, reduce_frequent: bool = False) -> DataFrame:
    """Per class and word: count, and share in the class times log(1 + mean words of a class / count of the word in all classes).

    ``reduce_frequent`` takes the square root of the share.
    """
    words = F.explode(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[ \t\r\n]+"), lambda w: w != ""))
    counts = stored(df.select(label, words.alias("word")).groupBy(label, "word").agg(F.count("*").alias("n")), "word-counts")
    per_class = stored(counts.groupBy(label).agg(F.sum("n").alias("class_words")), "class-words")
    per_word = counts.groupBy("word").agg(F.sum("n").alias("word_total"))
    mean = per_class.agg(F.avg("class_words").alias("mean_words"))
    out = counts.join(small(per_class), label).join(per_word, "word").withColumn("mean_words", mean.scalar())
    share = F.col("n") / F.col("class_words")
    score = (F.sqrt(share) if reduce_frequent else share) * F.log(1 + F.col("mean_words") / F.col("word_total"))
    return out.select(label, "word", "n", score.alias("score"))


def top_terms(scored: DataFrame, label: str, k: int = 10) -> DataFrame:
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy(label).orderBy(F.desc("score"), "word"))
    return scored.withColumn("rank", nth).where(F.col("rank") <= k)


def similarity(a, b):
    """Cosine of two ARRAY<FLOAT> columns."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
