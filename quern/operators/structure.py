"""Structure of texts: articles in one text, chunks under a budget, reduction of lists by pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import once, trim
from quern.session import stored

_HEADER = r"^\s*(?:#+\s*)?(?:\*{1,3}\s*)?(?:Άρθρο|ΑΡΘΡΟ|article)\s+(\d+)"
HEADER = f"(?imu){_HEADER}"
#: A header and what stands before the next one.
HEADED = rf"(?imu){_HEADER}(?s:.*?)(?={_HEADER}|\z)"
INLINE = r"(?iu)(?:Άρθρο|ΑΡΘΡΟ|article)\s+(\d+)"


def article_chunks(content: Column, title: Column) -> Column:
    """ARRAY of STRUCT(title_line, content, article_number): a text cut at its article headers.

    Text before the first header is dropped; without header the whole text is
    one chunk, numbered by its title. A blank text has no chunks.
    """
    def cut(chunk: Column) -> Column:
        read = lambda head: F.struct(trim(head).alias("title_line"), trim(F.substr(chunk, F.length(head) + 1)).alias("content"), F.regexp_extract(head, r"(\d+)$", 1).try_cast("int").alias("article_number"))
        return once(F.regexp_extract(chunk, HEADER, 0), read)

    whole = F.array(F.struct(trim(title).alias("title_line"), trim(content).alias("content"), F.regexp_extract(title, INLINE, 1).try_cast("int").alias("article_number")))
    # a text is searched once: headers are read again at the beginnings of what was found
    chunks_ = once(F.regexp_extract_all(content, F.lit(HEADED), F.lit(0)), lambda found: F.when(F.size(found) > 0, F.transform(found, cut)).otherwise(whole))
    return F.when(content.rlike(r"(?U)\S"), chunks_).otherwise(F.array().cast("array<struct<title_line:string,content:string,article_number:int>>"))


def chunk_starts(costs: Column, most: int) -> Column:
    """ARRAY of the 0-based places where a new chunk starts when items are put in a chunk until its cost would pass ``most``."""
    state = F.struct(F.array(F.lit(0)).alias("starts"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("i"))

    def step(s: Column, cost: Column) -> Column:
        full = (s["sum"] + cost > most) & (s["i"] > F.element_at(s["starts"], -1))
        return F.struct(F.when(full, F.array_append(s["starts"], s["i"])).otherwise(s["starts"]).alias("starts"), (F.when(full, 0).otherwise(s["sum"]) + cost).cast("long").alias("sum"), (s["i"] + 1).alias("i"))

    return F.when(F.size(costs) > 0, F.aggregate(costs, state, step)["starts"]).otherwise(F.array().cast("array<int>"))


def chunks(items: Column, costs: Column, most: int, overlap: int = 1) -> Column:
    """ARRAY of chunks (ARRAYs of items) under a budget, each but the first led by ``overlap`` items of the one before."""
    starts = chunk_starts(costs, most)
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(items)))
    both = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    return F.transform(both, lambda x, i: F.slice(items, F.greatest(x["a"] - F.when(i > 0, overlap).otherwise(0), F.lit(0)) + 1, x["b"] - F.greatest(x["a"] - F.when(i > 0, overlap).otherwise(0), F.lit(0))))


def pairwise_reduce(df: DataFrame, group: str, order: str, value: str, join: Callable[[str, str], str]) -> DataFrame:
    """One row per group: its values joined in order by pairs, and the results by pairs again, until one is left; also the number of rounds.

    A round deals pairs over all tasks, whatever group they are of; there are as
    many rounds as the longest group needs. Only places in the order are numbered
    by group, in a sort that spills. Null values count as empty.
    """
    place = Window.partitionBy(group).orderBy(order)
    rows = df.select(F.struct(F.col(group).alias("name")).alias("of"), F.coalesce(value, F.lit("")).alias("value"), (F.row_number().over(place) - 1).cast("long").alias("nth"))
    sizes = rows.groupBy("of").agg(F.count("*").alias("n"))
    rows = stored(rows.join(sizes, "of").withColumn("rounds", F.lit(0)), "values")

    def pairs_of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([join(x, y) for x, y in zip(a, b, strict=True)], dtype=object)

    joined = F.pandas_udf(pairs_of, "string")
    left = rows.agg(F.max("n")).first()[0] or 0
    while left > 1:
        pick = lambda k: F.max(F.when(F.col("nth") % 2 == k, F.col("value"))).alias(f"v{k}")
        pairs = rows.groupBy("of", F.floor(F.col("nth") / 2).alias("nth"), "n", "rounds").agg(pick(0), pick(1))
        # a group that is done has one value and takes no further round
        after = [F.ceil(F.col("n") / 2).alias("n"), (F.col("rounds") + (F.col("n") > 1).cast("int")).alias("rounds")]
        made = pairs.where("v1 is not null").select("of", joined("v0", "v1").alias("value"), "nth", *after)
        alone = pairs.where("v1 is null").select("of", F.col("v0").alias("value"), "nth", *after)
        rows, left = stored(made.unionByName(alone), "values"), -(-left // 2)
    return rows.select(F.col("of.name").alias(group), F.col("value").alias(value), "rounds")


def spans(df: DataFrame, id_col: str, text_col: str, pattern: str) -> DataFrame:
    """(doc, match, start, end) of a Python pattern; offsets count characters (Spark's expressions give no places of groups)."""
    import re

    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = re.compile(pattern)
        for batch in batches:
            rows = [(k, m[0], *m.span()) for k, t in zip(batch["k"], batch["t"], strict=True) for m in compiled.finditer(t or "")]
            yield pd.DataFrame(rows, columns=["doc", "match", "start", "end"])

    return df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInPandas(run, f"doc {kind}, match string, start int, end int")
