"""Finding stored records by tiers of keys, each with its own tie-break."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.convert import ministry_code, normalized_url, post_id

SPREAD = 1000


@dataclass(frozen=True)
class Tier:
    """A way to match: what of a query equals what of a candidate (several columns: all of them)."""

    name: str
    term: tuple[Column, ...]
    key: tuple[Column, ...]
    #: The first candidate of a key by these columns is its match; the last one should be unique.
    order: tuple[Column, ...]
    #: Whether keys that several candidates have are passed over.
    alone: bool = False


def resolve(queries: DataFrame, candidates: DataFrame, tiers: list[Tier]) -> DataFrame:
    """``queries`` with match (the candidate as a struct), tier (from 1) and tier_name: those of the first tier that has any; null if none has.

    A tier's candidates are reduced to one per key before the join, so no pairs
    are made, whatever is frequent on either side. Queries that are matched
    already, or have no term, take no part in a join: they are spread by a salt
    that no candidate has, instead of meeting in the partition of null. Terms
    that are null match nothing; repeated queries stay as they are.
    """
    out = queries.select(
        F.struct(*(queries[f"`{c}`"] for c in queries.columns)).alias("query"),
        *(F.struct(*(t.alias(f"_{i}") for i, t in enumerate(tier.term))).alias(f"term{n}") for n, tier in enumerate(tiers, 1)),
        F.lit(None).cast(candidates.schema).alias("match"),
        F.lit(None).cast("int").alias("tier"),
    )
    for n, tier in enumerate(tiers, 1):
        # a struct is never null, so that no filter of a join works the keys out once more; one with a null in it equals no term
        key = F.struct(*(k.alias(f"_{i}") for i, k in enumerate(tier.key))).alias("key")
        rows = candidates.select(key, F.struct(*tier.order).alias("order"), F.struct(*(candidates[f"`{c}`"] for c in candidates.columns)).alias("found"))
        best = rows.groupBy("key").agg(F.min_by("found", "order").alias("found"), F.count("*").alias("n_found"))
        best = (best.where("n_found = 1") if tier.alone else best).withColumn("salt", F.lit(-1))
        open_ = F.col("match").isNull()
        for i in range(len(tier.key)):
            open_ &= F.col(f"term{n}._{i}").isNotNull()
        out = out.withColumn("own_salt", F.when(open_, -1).otherwise(F.pmod(F.xxhash64("query"), F.lit(SPREAD)).cast("int")))
        same = (F.col("own_salt") == F.col("salt")) & (F.col(f"term{n}") == F.col("key"))
        out = out.join(best, same, "left").withColumn("tier", F.coalesce("tier", F.when(F.col("found").isNotNull(), n)))
        out = out.withColumn("match", F.coalesce("match", "found")).drop("own_salt", "salt", "found", "n_found", f"term{n}", "key")
    names = F.array(*(F.lit(t.name) for t in tiers))
    return out.select("query.*", "match", "tier", F.get(names, F.col("tier") - 1).alias("tier_name"))


def stored_consultations(listing: DataFrame, stored: DataFrame, url: str = "url", key: str = "id", stored_url: str = "url", finished: str = "is_finished") -> DataFrame:
    """The stored consultation of each address of a listing.

    By normalised address (the first by ``key``); else by post id: the only one
    that has it, the first of the same ministry, the first that isn't finished,
    the first.
    """
    post, ministry = post_id(listing[url]), ministry_code(listing[url])
    own_post, own_ministry = post_id(stored[stored_url]), ministry_code(stored[stored_url])
    first = stored[key]
    tiers = [
        Tier("address", (normalized_url(listing[url]),), (normalized_url(stored[stored_url]),), (first,)),
        Tier("post id", (post,), (own_post,), (first,), alone=True),
        Tier("ministry", (post, F.coalesce(ministry, F.lit(""))), (own_post, F.coalesce(own_ministry, F.lit(""))), (first,)),
        Tier("unfinished first", (post,), (own_post,), (F.coalesce(stored[finished], F.lit(False)), first)),
    ]
    return resolve(listing, stored, tiers)
