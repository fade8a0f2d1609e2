"""Set logic on link tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_distinct(*parts: DataFrame) -> DataFrame:
    return bag_union(*parts).distinct()


def bag_union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` not in ``right``."""
    return left.subtract(right)


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` less the rows of ``right``, copies counted."""
    return left.exceptAll(right)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct() if columns else df.distinct()
