"""Quality classifier: an interpolated modified Kneser-Ney trigram model of trusted text.

The model (see ``ngrams``) has every word and every n-gram of all trusted
training documents, however rare, in shards that grow in number with the text.
Documents' n-grams are joined with the shards by a shuffle. Known words and, for
each class of words (letter case, digits, symbols, closing punctuation, length),
the event of an unknown word of that class share the probability of one token:
what the counts of words leave is dealt to the classes by their share of all
known words. Probabilities after any context sum to 1.

A document's score is its mean negative log-probability per token, drawn to
its language's mean as if by PRIOR tokens more, so a few odd words in a short
text don't decide. A document is rejected if its score is above its language's
threshold: the QUANTILE of the scores of trusted documents that the model was
not trained on (a fifth of them, by hash of the id).

Defined cases: a null text is empty; an empty text has no perplexity and is
kept. A null language is a language of its own. Languages with less than
LEAST_HELD held-out documents use the threshold over all languages; without
any trusted document nothing is rejected. Repeated or contradictory labels: an
id is trusted if it has a row with quality 1 and none with quality 0 or
toxic 1. Further columns pass through ``accepted``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hot_keys, salted_join, text_of, whole_row, written
from .ngrams import score, train

PRIOR, QUANTILE, LEAST_HELD, BINS = 16, 0.999, 20, 256
#: Up to so many trusted ids they are broadcast; beyond, documents are shuffled by id.
BROADCAST_IDS = 1_000_000


def trusted_ids(labels: DataFrame, label_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    bad = (F.coalesce(labels[quality], F.lit(1)) == 0) | (F.coalesce(labels[toxic], F.lit(0)) == 1)
    per = labels.where(labels[label_id].isNotNull()).groupBy(labels[label_id].alias("id")).agg(F.max((labels[quality] == 1).cast("int")).alias("good"), F.max(bad.cast("int")).alias("bad"))
    return per.where("good = 1 and bad = 0").select("id")


def _language(docs: DataFrame, lang_col: str) -> list[Column]:
    """Whether there is none, and which; null is told from an empty one."""
    return [docs[lang_col].isNull().alias("absent"), F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang")]


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _thresholds(held: DataFrame, quantile: float) -> tuple[DataFrame, float, float]:
    """Mean and threshold of each language, and over all, from scored held-out documents."""
    whole = held.agg(F.sum("nll") / F.sum("n")).first()[0]
    means = held.groupBy("absent", "lang").agg(F.count("*").alias("docs"), (F.sum("nll") / F.sum("n")).alias("mean"))
    means = written(means.where(F.col("docs") >= LEAST_HELD), "means")

    def limits(scores: DataFrame, mean: Column, by: list[str]) -> DataFrame:
        bins = scores.withColumn("bin", F.floor((F.col("nll") + PRIOR * mean) / (F.col("n") + PRIOR) * BINS)).groupBy(*by, "bin").agg(F.count("*").alias("c"))
        window = Window.partitionBy(*by)
        bins = bins.withColumns({"upto": F.sum("c").over(window.orderBy("bin")), "all": F.sum("c").over(window)})
        return bins.where(F.col("upto") >= F.ceil(F.col("all") * quantile)).groupBy(*by).agg(((F.min("bin") + 1) / BINS).alias("limit"))

    by = ["absent", "lang"]
    own = limits(held.join(means, by), F.col("mean"), by)
    overall = limits(held, F.lit(whole), []).first()[0]
    return written(means.join(own, by).select(*by, "mean", "limit"), "limits"), whole, overall


@dataclass
class Judged:
    """All rows as (id, absent, lang, key, n, nll), and how they are judged; without a model, n and nll are null."""

    rows: DataFrame
    limits: DataFrame | None
    mean: float | None
    limit: float | None

    def decided(self) -> DataFrame:
        """The rows with score, perplexity, threshold and keep."""
        if self.limits is None:
            none = F.lit(None).cast("double")
            return self.rows.withColumns({"score": none, "perplexity": none, "threshold": none, "keep": F.lit(True)})
        rows = self.rows.join(F.broadcast(self.limits) if self.limits.count() <= BROADCAST_IDS else self.limits, ["absent", "lang"], "left")
        mean, limit = F.coalesce("mean", F.lit(self.mean)), F.coalesce("limit", F.lit(self.limit))
        rows = rows.withColumn("score", F.when(F.col("n") > 0, (F.col("nll") + PRIOR * mean) / (F.col("n") + PRIOR)))
        rows = rows.withColumn("threshold", limit).withColumn("perplexity", F.exp(F.col("nll") / F.nullif("n", F.lit(0))))
        return rows.withColumn("keep", F.coalesce(F.col("score") <= F.col("threshold"), F.lit(True))).drop("mean", "limit")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE, **sizes: int) -> Judged:
    """Train on four fifths of the trusted documents, score all, and set thresholds on the other fifth.

    ``sizes`` are those of shards, blocks, slices and pieces in ``train`` and ``score``.
    """
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("id"), *_language(docs, lang_col), text.alias("text"))
    ids = written(trusted_ids(labels), "trusted")
    few = ids.count() <= BROADCAST_IDS
    trusted = rows.join(F.broadcast(ids) if few else ids, "id", "left_semi")
    held = F.pmod(F.xxhash64("id"), F.lit(5)) == 0
    training = {k: v for k, v in sizes.items() if k != "piece_bytes"}
    model = train(trusted.where(~held).select("text"), **training)
    keyed = rows.select("id", "absent", "lang", _key(F.col("text")).alias("key"))
    if model is None:
        return Judged(keyed.withColumns({"n": F.lit(None).cast("long"), "nll": F.lit(None).cast("double")}), None, None, None)
    scoring = {k: v for k, v in sizes.items() if k != "shard_bytes"}
    scores = score(rows.select(_key(F.col("text")).alias("key"), F.xxhash64("id", "text").alias("spread"), "text"), model, **scoring)
    model.drop()
    keyed = written(keyed, "keyed")
    copies = written(keyed.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    total = copies.agg(F.sum("copies")).first()[0] or 0
    scored = written(salted_join(keyed, scores, "key", hot_keys(copies, "key", "copies", total), F.xxhash64("id")), "scored")
    own = scored.where(held & F.col("id").isNotNull() & (F.col("n") > 0)).join(F.broadcast(ids) if few else ids, "id", "left_semi")
    own = written(own.select("absent", "lang", "n", "nll"), "held-out")
    if own.isEmpty():
        return Judged(scored, None, None, None)
    return Judged(scored, *_thresholds(own, quantile))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """One row per row of ``docs``: id, lang, n_tokens, perplexity, score, threshold and keep."""
    out = judge(docs, labels, id_col, text_col, lang_col, **options).decided()
    return out.select(F.col("id").alias(id_col), F.when(~F.col("absent"), F.col("lang")).alias("lang"), F.col("n").alias("n_tokens"), "perplexity", "score", "threshold", "keep")


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``docs`` without those rejected. Rows of one text and language are judged alike; many copies of one are salted."""
    judged = judge(docs, labels, id_col, text_col, lang_col, **options)
    if judged.limits is None:
        return docs
    by = ["key", "absent", "lang"]
    rejected = written(judged.decided().where("not keep").groupBy(*by).agg(F.count("*").alias("n")), "rejected")
    hot = hot_keys(rejected, by, "n", rejected.agg(F.sum("n")).first()[0] or 0)
    text = text_of(docs, text_col)
    rows = docs.select(_key(text).alias("key"), *_language(docs, lang_col), F.xxhash64(docs[id_col], F.monotonically_increasing_id()).alias("spread"), whole_row(docs).alias("row"))
    out = salted_join(rows, rejected.select(*by, F.lit(True).alias("out")), by, hot, F.col("spread"), "left")
    return out.where("out is null").select("row.*")
