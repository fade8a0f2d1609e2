"""Append-only sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from assetloom.functions import dates as D


def append_links(links: DataFrame, path: str, column: str = "url") -> None:
    """Append one link per line."""
    links.select(F.col(column).alias("value")).write.mode("append").text(path)


def write_done_paths(paths: DataFrame, path: str) -> None:
    paths.select("path").write.mode("append").csv(path)


def append_operations(operations: DataFrame, path: str) -> None:
    """Append operation records as JSON lines; nothing already written is touched."""
    stamped = operations.withColumn("timestamp", D.iso_text(F.col("timestamp")))
    stamped.select("timestamp", "operation", "status", "live_id", "details",
                   "computer").write.mode("append").json(path)


def append_ledger(events: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append ledger events as Parquet. With partition columns the rows are
    clustered by them first, so that not every task writes into every folder; the
    rebalance splits a value that is large."""
    if partition_by:
        events = events.hint("rebalance", *(F.col(c) for c in partition_by))
    events.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_by_keyword(rows: DataFrame, path: str, keyword: str = "keyword") -> None:
    """A folder per keyword."""
    append_ledger(rows, path, [keyword])


def write_jdbc(events: DataFrame, url: str, table: str, batch_rows: int = 10_000) -> None:
    """Append ledger rows to a database table in batches."""
    (events.write.format("jdbc").mode("append")
           .options(url=url, dbtable=table, batchsize=str(batch_rows)).save())
