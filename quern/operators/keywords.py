"""Keywords of groups of texts, near what the group is about and unlike each other.

Terms are runs of plain words; a term's vector counts its character trigrams by
hash, a group's is the sum of its terms' by frequency. Relevance is the cosine
of the two. Keywords are chosen one rank a round, by relevance less what a term
has in common with those chosen before (marginal relevance): each round is an
aggregate over the table of terms, with a partial one in each task, and what is
carried from round to round is a short list per group. No group meets in one
task, however many terms it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import once
from quern.operators.topics import plain_words
from quern.session import is_small, small, stored


def terms(df: DataFrame, group: str, text: str, sizes: tuple[int, int] = (1, 1), least: int = 1, stop: tuple[str, ...] = ()) -> DataFrame:
    """(group, term, n): runs of ``sizes`` words that occur ``least`` times or more in a group."""
    rows = df.select(df[group].alias("group"), plain_words(df[text], list(stop)).alias("words"))

    def runs(k: int) -> Column:
        if k == 1:
            return F.col("words")
        starts = F.filter(F.sequence(F.lit(1), F.size("words")), lambda i: i + k - 1 <= F.size("words"))
        return F.transform(starts, lambda i: F.array_join(F.slice("words", i, k), " "))

    found = F.when(F.size("words") > 0, F.concat(*map(runs, range(sizes[0], sizes[1] + 1))))
    return rows.select("group", F.explode(found).alias("term")).groupBy("group", "term").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def trigram_vector(term: Column, dims: int) -> Column:
    """Counts of a term's trigrams, begin and end marked, by hash."""
    marked = F.concat(F.lit("^"), term, F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - 2, F.lit(1))), lambda i: F.substr(marked, i, F.lit(3)))
    at = F.transform(grams, lambda g: F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("long") % dims)
    places = F.sequence(F.lit(0).cast("long"), F.lit(dims - 1).cast("long"))
    # the buckets are worked out once, not for each place
    return once(at, lambda a: F.transform(places, lambda d: (F.size(a) - F.size(F.array_remove(a, d))).cast("double")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 if a vector has no direction."""
    size = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def keywords(df: DataFrame, group: str, text: str, k: int = 15, diversity: float = 0.3, sizes: tuple[int, int] = (1, 1), least: int = 1, dims: int = 32, stop: tuple[str, ...] = ()) -> DataFrame:
    """(group, rank, term, relevance): the ``k`` keywords of each group; ties go to the term that comes first.

    Groups without terms have no rows; a null group is a group of its own.
    """
    found = terms(df, group, text, sizes, least, stop).withColumn("group", F.struct(F.col("group").alias("name"))).withColumn("vector", trigram_vector(F.col("term"), dims))
    found = stored(found, "terms")
    about = found.groupBy("group").agg(F.array(*(F.sum(F.col("n") * F.col("vector")[d]) for d in range(dims))).alias("about"))
    scored = found.join(small(stored(about, "about")), "group").select("group", "term", "vector", cosine(F.col("vector"), F.col("about")).alias("relevance"))
    scored = stored(scored, "scored-terms")

    return marginal(scored, k, diversity).withColumnRenamed("group", group)


def marginal(scored: DataFrame, k: int, diversity: float) -> DataFrame:
    """(group, rank, term, relevance) of ``k`` rows per group of a written table (group: a struct of name, term, vector, relevance).

    The first one is the most relevant; then those with the most relevance, less
    the greatest cosine to those chosen before, in these shares. Ties go to the
    lesser term. What is chosen is kept in a table of a row per group.
    """
    kind = f"array<struct<term:{scored.schema['term'].dataType.simpleString()},relevance:double,vector:array<double>>>"
    chosen = stored(scored.select("group").distinct().withColumn("chosen", F.array().cast(kind)), "chosen")
    sent = F.broadcast if is_small(chosen) else lambda df: df  # groups stay as many as they are
    for _ in range(k):
        open_ = scored.join(sent(chosen), "group").where(~F.exists("chosen", lambda c: c["term"] == F.col("term")))
        near = F.coalesce(F.array_max(F.transform("chosen", lambda c: cosine(c["vector"], F.col("vector")))), F.lit(0.0))
        score = F.when(F.size("chosen") == 0, F.col("relevance")).otherwise((1 - diversity) * F.col("relevance") - diversity * near)
        best = open_.groupBy("group").agg(F.min_by(F.struct("term", "relevance", "vector"), F.struct(-score, F.col("term"))).alias("next"))
        chosen = chosen.join(sent(best), "group", "left").select("group", F.when(F.col("next").isNotNull(), F.concat("chosen", F.array("next"))).otherwise(F.col("chosen")).alias("chosen"))
        chosen = stored(chosen, "chosen")
    out = chosen.select(F.col("group.name").alias("group"), F.posexplode("chosen").alias("at", "c"))
    return out.select("group", (F.col("at") + 1).alias("rank"), "c.term", "c.relevance")


def mmr(df: DataFrame, group: str, key: str, vector: str, k: int = 15, diversity: float = 0.3) -> DataFrame:
    """Per group ``k`` rows near the mean direction of the group's vectors yet unlike each other: group, key, rank and relevance."""
    rows = df.select(F.struct(df[group].alias("name")).alias("group"), df[key].alias("term"), df[vector].cast("array<double>").alias("vector"))
    unit = F.transform("vector", lambda x: x / F.greatest(F.sqrt(dot(F.col("vector"), F.col("vector"))), F.lit(1e-12)))
    rows = stored(rows.select("group", "term", unit.alias("vector")), "units")
    # one number a row: means by position
    places = rows.select("group", F.posexplode("vector").alias("d", "x")).groupBy("group", "d").agg(F.avg("x").alias("x"))
    about = places.groupBy("group").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda v: v["x"]).alias("about"))
    relevance = dot(F.col("vector"), F.col("about")) / F.greatest(F.sqrt(dot(F.col("about"), F.col("about"))), F.lit(1e-12))
    scored = stored(rows.join(small(stored(about, "about")), "group").select("group", "term", "vector", relevance.alias("relevance")), "scored-rows")
    return marginal(scored, k, diversity).select(F.col("group").alias(group), F.col("term").alias(key), "rank", "relevance")
