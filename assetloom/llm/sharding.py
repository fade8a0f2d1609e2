"""Reproducible shuffling into shards by a permutation of row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.llm.text import whole
from assetloom.operators.ordering import number_rows

ROUNDS = 4
#: Walk steps tried beyond the first; see ``permuted``.
WALK = 64


def _round_trip(x: Column, left_size: int, right_size: int, seed: int) -> Column:
    """One pass of the Feistel network over ``left_size * right_size`` numbers."""
    left, right = F.pmod(x, F.lit(left_size)), F.floor(x / F.lit(left_size))
    if left_size * right_size >= 1 << 52:  # a double division would no longer be exact
        right = ((x - left).cast("decimal(38,0)") / F.lit(left_size)).cast("bigint")
    for j in range(ROUNDS):
        size = F.lit(left_size if j % 2 == 0 else right_size).cast("bigint")
        drawn = F.pmod(F.xxhash64(F.lit(seed + j), right), size)
        left, right = right, F.pmod(left + drawn, size)
    return left + F.lit(left_size).cast("bigint") * right


def permuted(number: Column, n: int, seed: int) -> Column:
    """Place of row ``number`` (0 to n-1) in a pseudo-random order of n rows.

    A Feistel network permutes a*b >= n numbers, where a and b are about the
    root of n; a place of n or more is sent through again (cycle walking) until it
    falls below n. Fewer than a numbers lie above n, so a walk of ``WALK`` steps
    fails for none if n <= 4096 and with a chance below 10^-100 otherwise; it
    then raises. Only the few rows that land above n pay for the walk.
    """
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    first = _round_trip(number.cast("bigint"), a, b, seed)
    top = F.lit(n).cast("bigint")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), first,
        lambda at, _: F.when(at < top, at).otherwise(_round_trip(at, a, b, seed)))
    checked = F.when(walked < top, walked).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("bigint"))
    return F.when(first < top, first).otherwise(checked)


def shuffled_shards(rows: DataFrame, order: list[str], shards: int = 24, seed: int = 17) -> DataFrame:
    """Add ``shard`` and ``slot`` to ``rows``; counts of shards differ by one at most.

    ``order`` fixes the row numbers the permutation starts from, so the same table,
    seed and shard count give the same places on any cluster; row k of the order is in
    shard p mod ``shards``, slot p div ``shards``, where p is its permuted number, and
    both follow from k alone. Slots have no gaps. Nulls sort first; rows equal in all
    of ``order`` take neighbouring numbers, which of them takes which is open. An
    empty table gives an empty result. ``shard`` and ``slot`` of the input are replaced.
    """
    plain = rows.drop("shard", "slot", "_row")
    numbered = number_rows(plain, order, start=0, name="_row")
    n = numbered.count()
    place = permuted(F.col("_row"), n, seed)
    return (numbered.withColumn("_row", place)
            .withColumns({"shard": F.pmod("_row", F.lit(shards)).cast("int"),
                          "slot": F.floor(F.col("_row") / F.lit(shards)).cast("bigint")})
            .drop("_row"))


def document_shards(docs: DataFrame, shards: int = 24, seed: int = 17) -> DataFrame:
    """Shards of documents by the ``rows`` law, see ``shuffled_shards``. A null text has no
    bytes; the permutation looks at no text, so equal texts fall anywhere."""
    sized = docs.select(
        "doc_id", (F.octet_length(whole("text")) + 8).cast("bigint").alias("size"),
        F.crc32(whole("text").cast("binary")).cast("bigint").alias("text_crc32"))
    placed = shuffled_shards(sized, ["doc_id", "size", "text_crc32"], shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
