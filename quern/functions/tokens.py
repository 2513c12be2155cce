"""Exact token counts of texts, by byte-pair merges over a tokenizer's table of ranks.

The table is read from a file that the caller names. A text is cut into pieces
by the tokenizer's pattern; in a piece, the neighbours whose pair has the least
rank are joined, the leftmost first, until no pair is in the table.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Fixed value: how a byte-level vocabulary's pieces are cut.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Tables up to so many bytes are sent to the tasks.
LARGEST = 64 << 20


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The table of a file with a token in base 64 and its rank on each line."""
    rows = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    if (rows.agg(F.sum(F.length("value"))).first()[0] or 0) > LARGEST:
        raise ValueError(f"{path} is larger than a table of ranks may be")
    return {base64.b64decode(a): int(b) for a, b in (r[0].split() for r in rows.collect())}


def merged_length(piece: bytes, ranks: dict[bytes, int]) -> int:
    """Tokens of a piece; takes time in proportion to its length but for a logarithm."""
    n = len(piece)
    if n < 2 or piece in ranks:
        return min(n, 1)
    ends = list(range(1, n + 1))  # of the token that begins at each place
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # where the next and the last one begin
    heap = [(rank, i, 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, size = heapq.heappop(heap)
        j = ends[i]
        if j <= i or j >= n or ends[j] - i != size or ends[j] <= j:
            continue  # one of the two has been joined since
        ends[i], ends[j] = ends[j], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        left -= 1
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (rank := ranks.get(piece[a : ends[b]])) is not None:
                heapq.heappush(heap, (rank, a, ends[b] - a))
    return left


def token_lengths(text: Column, ranks: dict[bytes, int], pieces: str = PIECES) -> Column:
    """The number of tokens of each text, in Arrow batches; null has none. Pieces that occur again are counted once."""
    spark = SparkSession.active()
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cut, table = regex.compile(pieces), shared.value

        @lru_cache(1 << 16)
        def of(piece: str) -> int:
            return merged_length(piece.encode(), table)

        for texts in batches:
            yield texts.map(lambda t: sum(map(of, cut.findall(t or ""))))

    return F.pandas_udf(run, "long")(text)
