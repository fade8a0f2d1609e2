"""Joins whose key may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Parts a key's rows are dealt into.
SALTS = 64


def salt_of(*columns: str | Column, salts: int = SALTS) -> Column:
    """A part for each row, from its own values, so that a task that runs again deals alike."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def salted_lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], salt: Column) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each key in ``rows``.

    A row of ``table`` is repeated for those salts only that its key has in ``rows``, so a key of one
    row costs one row and a key with a third of all rows is spread over all salts. ``rows`` is
    read twice: pass a written table. Null keys are equal to each other.
    """
    keyed = rows.withColumns({"_key": F.struct(*keys), "_salt": salt})
    found = keyed.select("_key", "_salt").distinct()
    own = [c for c in table.columns if c not in keys]
    values = table.select(F.struct(*keys).alias("_key"), *own)
    spread = found.join(values, "_key")
    return keyed.join(spread, ["_key", "_salt"]).drop("_key", "_salt")
