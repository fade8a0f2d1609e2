"""Joins against ledgers, lookups and target inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Quality names and their pixel heights.
QUALITY_HEIGHT = {
    "1080P": 1080, "720P": 720, "480P": 480, "360P": 360, "240P": 240,
    "1080p": 1080, "720p": 720, "480p": 480, "360p": 360, "240p": 240,
    "蓝光10M": 1080, "蓝光8M": 720, "蓝光4M": 480, "流畅": 360, "极速": 240,
}


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join where ``right`` has one row per key and ``left`` may have hot keys.

    A plain join: adaptive execution splits the skewed partitions of ``left`` for inner, left, semi
    and anti joins and broadcasts ``right`` only if its measured size allows it. No job
    runs while the plan is built. ``how``: inner, left, left_semi or left_anti.
    """
    return left.join(right, list(keys), how)


def drop_done(candidates: DataFrame, done: DataFrame, keys: Sequence[str], unique_done: bool = False) -> DataFrame:
    """Candidates (a bag) whose key is not in ``done``.

    ``unique_done`` says that ``done`` has one row per key, which saves its
    aggregation.
    """
    return keyed_join(candidates, _keys_of(done, keys, unique_done), keys, "left_anti")


def keep_listed(rows: DataFrame, listed: DataFrame, keys: Sequence[str], unique_listed: bool = False) -> DataFrame:
    """Rows whose key is in ``listed``."""
    return keyed_join(rows, _keys_of(listed, keys, unique_listed), keys, "left_semi")


def _keys_of(df: DataFrame, keys: Sequence[str], unique: bool) -> DataFrame:
    """Key columns, one row each; copies go before the shuffle, so a hot key of
    this side does not move as such."""
    return df.select(*keys) if unique else df.select(*keys).distinct()


def update_listed(rows: DataFrame, listed: DataFrame, keys: Sequence[str],
                  changes: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows whose key is in ``listed``; keep the others."""
    marks = listed.select(*keys).distinct().withColumn("_listed", F.lit(True))
    joined = keyed_join(rows, marks, keys, "left")
    changed = {name: F.when(F.col("_listed"), value).otherwise(F.col(name))
               for name, value in changes.items()}
    return joined.withColumns(changed).select(*rows.columns)


def with_default(rows: DataFrame, ledger: DataFrame, keys: Sequence[str], column: str,
                 default: object = 0) -> DataFrame:
    """Look ``column`` up in a ledger; absent keys get ``default``. Of several ledger rows
    of a key the largest value counts."""
    one_each = ledger.groupBy(*keys).agg(F.max(column).alias(column))
    found = keyed_join(rows, one_each, keys, "left")
    return found.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def map_values(df: DataFrame, column: str, lookup: Mapping, name: str) -> tuple[DataFrame, DataFrame]:
    """Translate through a fixed lookup. Second result: rows with unknown values.

    A map literal in the plan needs no join at all.
    """
    table = F.create_map(*(F.lit(x) for pair in lookup.items() for x in pair))
    mapped = df.withColumn(name, F.try_element_at(table, F.col(column)))
    return mapped.where(F.col(name).isNotNull()), mapped.where(F.col(name).isNull()).drop(name)


def drop_existing_names(plans: DataFrame, target: DataFrame, name: Column,
                        target_name: Column) -> DataFrame:
    """Plans whose output name does not exist at the target."""
    existing = target.select(target_name.alias("_name"))
    return drop_done(plans.withColumn("_name", name), existing, ["_name"]).drop("_name")


def reconcile_sizes(source: DataFrame, target: DataFrame, key: str = "path",
                    size: str = "length") -> DataFrame:
    """Per key: ``ok``, ``mismatch``, ``missing`` (no copy) or ``extra`` (no source).

    A key listed several times on one side counts once, with its largest size.
    """
    left = source.groupBy(key).agg(F.max(size).alias("source_size"))
    right = target.groupBy(key).agg(F.max(size).alias("target_size"))
    verdict = (F.when(F.col("target_size").isNull(), "missing")
                .when(F.col("source_size").isNull(), "extra")
                .when(F.col("source_size") == F.col("target_size"), "ok")
                .otherwise("mismatch"))
    return left.join(right, key, "full_outer").withColumn("verdict", verdict)
