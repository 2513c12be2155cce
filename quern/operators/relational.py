"""Joins and lookups beyond a plain equi-join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cascade(queries: DataFrame, key: str, term: str, tiers: list[tuple[DataFrame, Column | str, str]], order: str) -> DataFrame:
    """For each row of ``queries`` (its ``key`` is unique) the match of the first tier that has any: the first by ``order`` of it.

    Each tier is (candidates, what equals the term or a condition over q and c,
    name); the candidates all have the same columns. Where a term is to be
    equal, only the first candidate of each value is joined, so a frequent one is
    not expanded into pairs; a condition is tried only for rows without a match
    so far.
    """
    out, found = queries, []
    for n, (candidates, on, _) in enumerate(tiers):
        best = F.min_by(F.struct(*candidates.columns), order).alias(f"__{n}")
        if isinstance(on, str):
            rest = out.where(~reduce(Column.__or__, found, F.lit(False))).select(*queries.columns)
            first = rest.alias("q").join(candidates.alias("c"), F.expr(on)).groupBy(F.col(f"q.{key}").alias("__key"))
            first, same = first.agg(F.min_by(F.struct(*(F.col(f"c.{c}") for c in candidates.columns)), F.col(f"c.{order}")).alias(f"__{n}")), F.col(key)
        else:
            first, same = candidates.groupBy(on.alias("__key")).agg(best), F.col(term)
        out = out.join(first, same == F.col("__key"), "left").drop("__key")
        found.append(F.col(f"__{n}").isNotNull())
    pick = lambda values: F.coalesce(*(F.when(f, v) for f, v in zip(found, values, strict=True)))
    match = pick([F.col(f"__{n}") for n in range(len(tiers))])
    columns = [match[c].alias(f"match_{c}") for c in tiers[0][0].columns]
    return out.where(match.isNotNull()).select(*queries.columns, *columns, pick([F.lit(n + 1) for n in range(len(tiers))]).alias("tier"), pick([F.lit(x) for *_, x in tiers]).alias("tier_name"))


def match_decisions(refs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """References (ref_id, id, year, series) with the catalogue's records (cat_id, id, year, series).

    Ids are equal but for case and space; year and series count only where the reference has them.
    """
    key = lambda c: F.lower(F.trim(c))
    a = refs.select("ref_id", key("id").alias("k"), F.col("year").alias("ry"), key("series").alias("rs"))
    b = catalogue.select("cat_id", key("id").alias("k"), F.col("year").alias("cy"), key("series").alias("cs"))
    hit = a.join(b, "k").where("(ry is null or ry = cy) and (rs is null or rs = cs)")
    return hit.select("ref_id", "cat_id")


def first_match(refs: DataFrame, catalogue: DataFrame, on: list[str], order: str) -> DataFrame:
    """Each distinct reference with the first catalogue row by ``order``; those without match stay, with nulls."""
    nth = F.row_number().over(Window.partitionBy(*on).orderBy(order))
    first = catalogue.withColumn("__nth", nth).where("__nth = 1").drop("__nth")
    return refs.select(*on).distinct().join(first, on, "left")


def match_rate(refs: DataFrame, catalogue: DataFrame, on: list[str]) -> DataFrame:
    """One row: references, distinct ones, those of them in the catalogue, and their share in percent."""
    known = catalogue.select(*on).distinct().withColumn("__hit", F.lit(1))
    per = refs.groupBy(*on).agg(F.count("*").alias("n")).join(known, on, "left")
    return per.agg(F.sum("n").alias("total_refs"), F.count("*").alias("unique_refs"), F.count("__hit").alias("matched"), F.round(100.0 * F.count("__hit") / F.count("*"), 2).alias("match_rate"))


def unmatched(refs: DataFrame, catalogue: DataFrame, on: list[str], k: int = 10) -> DataFrame:
    """The ``k`` references that are made most often of those the catalogue doesn't have, with their number."""
    per = refs.groupBy(*on).agg(F.count("*").alias("n"))
    return per.join(catalogue.select(*on).distinct(), on, "left_anti").orderBy(F.desc("n"), *on).limit(k)


def child_counts(parents: DataFrame, key: str, children: DataFrame, foreign: str, name: str = "n_children") -> DataFrame:
    counts = children.groupBy(F.col(foreign).alias(key)).agg(F.count("*").alias(name))
    return parents.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))


def first_with_content(children: DataFrame, parent: str, text: str) -> DataFrame:
    """One row: the least parent that has a child with text; null if none has."""
    return children.where(F.trim(F.coalesce(F.col(text), F.lit(""))) != "").agg(F.min(parent).alias(parent))


def resume_page(stored: DataFrame, per_page: int = 12) -> DataFrame:
    """One row: the page of a listing to go on with, after as many rows as are stored."""
    return stored.agg((F.floor(F.count("*") / per_page) + 1).cast("int").alias("page"))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def side_texts(rows: DataFrame, filename: str, files: DataFrame) -> DataFrame:
    """``rows`` with the text of the file of the same name that ends in .md in place of .pdf; ``files`` has name and text."""
    stem = F.regexp_replace(filename, r"\.pdf$", ".md")
    return rows.withColumn("__name", stem).join(files.select(F.col("name").alias("__name"), F.col("text").alias("markdown")), "__name", "left").drop("__name")


def top_frequencies(df: DataFrame, value: str, position: str, k: int = 10) -> DataFrame:
    """The k most frequent values; of equally frequent ones those that come first."""
    return df.groupBy(value).agg(F.count("*").alias("n"), F.min(position).alias("first_at")).orderBy(F.desc("n"), "first_at").limit(k)


def sample_rows(df: DataFrame, n: int, seed: str, key: str) -> DataFrame:
    """n rows at random, the same for the same seed."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key).limit(n)
