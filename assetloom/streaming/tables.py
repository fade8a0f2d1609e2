"""Streams into tables: counts, links, upserts, gated release, stable files.

Micro-batches may be replayed after a failure. Every batch writes its own folder
``batch=<id>`` in overwrite mode, so a replay replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from assetloom.operators.filters import stable_flags
from assetloom.operators.ledger import insert_ignore
from assetloom.operators.ordering import latest_row, top_per_group
from assetloom.session import delete_path, file_system, scratch_path
from assetloom.streaming.arrivals import drain


def status_counts(events: DataFrame, ts: str, state: str, window: str = "1 day",
                  late_by: str = "1 day") -> DataFrame:
    """Rows per event-time window and state. A ``TIMESTAMP_NTZ`` time is cast:
    watermarks need ``TIMESTAMP``."""
    return (events.select(F.col(ts).cast("timestamp").alias("at"), F.col(state))
                  .withWatermark("at", late_by)
                  .groupBy(F.window("at", window).alias("w"), state)
                  .agg(F.count(F.lit(1)).alias("n"))
                  .select(F.col("w.start").alias("window_start"), state, "n"))


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def _written(spark: SparkSession, path: str, schema, before: int) -> DataFrame:
    """Rows of earlier batches; empty before the first one."""
    full = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, batch bigint"
    try:
        table = spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise  # only a missing path means that nothing is written yet
        return spark.createDataFrame([], full)
    return table.where(F.col("batch") < before)


# --- folders of batches that are merged from time to time --------------------------
#
# ``batch=<id>`` holds what a batch wrote. ``_merged/upto=<id>`` holds what all batches up to that id come to, and
# is valid once the marker ``_manifest/upto=<id>`` is there, which is made last. Readers take the newest valid merge
# and the batches after it, so they see the same rows before, while and after a merge.

#: Batches between two merges, and the files a merge writes.
MERGE_EVERY, MERGED_FILES = 20, 8


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers n of the children ``<name>=<n>`` of a folder, ascending."""
    fs, to_path = file_system(spark, path)
    if not fs.exists(to_path(path)):
        return []
    children = (c.getPath().getName() for c in fs.listStatus(to_path(path)))
    return sorted(int(c.partition("=")[2]) for c in children if c.startswith(f"{name}="))


def merged_upto(spark: SparkSession, path: str, before: int | None = None) -> int:
    """The last batch of the newest valid merge, of those that end before a batch if stated; -1 without any."""
    valid = [n for n in _numbers(spark, f"{path}/_manifest", "upto") if before is None or n < before]
    return valid[-1] if valid else -1


def read_batches(spark: SparkSession, path: str, schema: StructType | str, before: int | None = None,
                 buckets: Sequence[int] | None = None) -> DataFrame:
    """What batches (those before ``before`` if stated) wrote: the newest merge and the batches after it.
    With ``buckets`` only these ``bucket=<n>`` folders are listed and read."""
    upto = merged_upto(spark, path, before)
    folders = [_batch_folder(path, n) for n in _numbers(spark, path, "batch") if n > upto and (before is None or n < before)]
    if upto >= 0:
        folders.append(f"{path}/_merged/upto={upto}")
    parts = []
    for folder in folders:
        if buckets is None:
            parts.append(folder)
        else:
            there = set(_numbers(spark, folder, "bucket"))
            parts += [f"{folder}/bucket={n}" for n in buckets if n in there]
    if not parts:
        return spark.createDataFrame([], schema)
    # the folders' names hold no columns here
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*parts)


def merge_batches(spark: SparkSession, path: str, schema: StructType | str, before: int, merge,
                  bucketed: bool = False) -> None:
    """Write ``merge`` of all rows of the batches before ``before``, publish it, and remove what the merge before
    the last one and the last one replaced. A merge that fails half-way, or runs again, changes nothing for readers."""
    ids = [n for n in _numbers(spark, path, "batch") if n < before]
    last = merged_upto(spark, path, before)
    if not ids or ids[-1] <= last:
        return
    upto = ids[-1]
    rows = merge(read_batches(spark, path, schema, before))
    writer = rows.repartition(MERGED_FILES, *(["bucket"] if bucketed else [])).write.mode("overwrite")
    (writer.partitionBy("bucket") if bucketed else writer).parquet(f"{path}/_merged/upto={upto}")
    fs, to_path = file_system(spark, path)
    fs.mkdirs(to_path(f"{path}/_manifest/upto={upto}"))
    # readers that began with the last merge may still read it and the batches after it
    older = [n for n in _numbers(spark, f"{path}/_manifest", "upto") if n < last]
    for gone in ([_batch_folder(path, n) for n in ids if n <= last]
                 + [f"{path}/{kind}/upto={n}" for n in older for kind in ("_manifest", "_merged")]):
        delete_path(spark, gone)


def append_batches(path: str):
    """``foreachBatch`` writer: one replaceable folder per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(path, batch_id))
    return write


def upsert_batches(path: str, key: Sequence[str], newest: Sequence[str], merge_every: int = MERGE_EVERY):
    """``foreachBatch`` writer for state events: the newest row per key and batch.
    The current state is ``read_current``. Every ``merge_every`` batches the earlier ones are merged into
    the current row per key, so the number of folders stays bounded."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % merge_every == 0:
            merge_batches(batch.sparkSession, path, batch.schema, batch_id, lambda rows: latest_row(rows, key, newest))
        latest_row(batch, key, newest).write.mode("overwrite").parquet(_batch_folder(path, batch_id))
    return write


def read_current(spark: SparkSession, path: str, key: Sequence[str], newest: Sequence[str],
                 schema: StructType | str) -> DataFrame:
    """Current row per key over all batches."""
    return latest_row(read_batches(spark, path, schema), key, newest)


#: Folders by key hash that a history of links is kept in.
LINK_BUCKETS = 64


def _with_bucket(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def new_link_batches(path: str, key: str, first: Sequence[str], buckets: int = LINK_BUCKETS,
                     merge_every: int = MERGE_EVERY):
    """``foreachBatch`` writer: links never seen in an earlier batch, first copy of each. Read them with
    ``read_links``.

    The history lies in ``buckets`` folders by key hash, and a batch is joined with the folders of its own
    keys only. ``dedup_links`` with ``within=None`` does the same from state.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        if batch_id and batch_id % merge_every == 0:
            merge_batches(spark, path, schema, batch_id, lambda rows: _with_bucket(rows, key, buckets), bucketed=True)
        hashed = _with_bucket(batch, key, buckets).persist()
        try:
            hit = sorted(r[0] for r in hashed.select("bucket").distinct().collect())  # as many as there are buckets at most
            known = read_batches(spark, path, schema, batch_id, hit)
            fresh = insert_ignore(_with_bucket(known, key, buckets), hashed, key, first)
            fresh.write.mode("overwrite").partitionBy("bucket").parquet(_batch_folder(path, batch_id))
        finally:
            hashed.unpersist()
    return write


def read_links(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All links of ``new_link_batches``."""
    return read_batches(spark, path, schema)


def dedup_links(links: DataFrame, key: str, ts: str, within: str | None = "1 day") -> DataFrame:
    """First copy of a link. With ``within`` only copies that close are known and
    the state stays bounded; None remembers every link in the state store, which
    costs a batch only its own keys."""
    if within is None:
        return links.dropDuplicates([key])
    return links.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])


HELD = "held_from bigint, held_size double, released_from bigint, released_to bigint"


def hold_batches(rows: str, ledger: str, size: str, trigger_size: float, in_window: Column):
    """``foreachBatch`` writer: hold rows back until those held reach ``trigger_size`` or the window is open,
    then release all of them.

    A batch writes its rows once, and one row of the ledger that says which batches are held, how large they are
    and which it releases. Rows are never copied; ``read_released`` and ``read_held`` follow the ledger.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(_batch_folder(rows, batch_id))
        own = spark.read.schema(batch.schema).parquet(_batch_folder(rows, batch_id)).agg(
            F.coalesce(F.sum(size), F.lit(0)).cast("double").alias("own"))
        before = (spark.read.schema(HELD).parquet(_batch_folder(ledger, batch_id - 1)) if batch_id
                  else spark.createDataFrame([(0, 0.0, None, None)], HELD))
        both = own.unionByName(before.select("held_from", "held_size"), allowMissingColumns=True).agg(
            *(F.max(c).alias(c) for c in ("own", "held_from", "held_size")))
        this, total = F.lit(batch_id).cast("bigint"), F.col("held_size") + F.col("own")
        opened = (total >= trigger_size) | in_window
        both.select(F.when(opened, this + 1).otherwise(F.col("held_from")).alias("held_from"),
                    F.when(opened, 0.0).otherwise(total).alias("held_size"),
                    F.when(opened, F.col("held_from")).alias("released_from"),
                    F.when(opened, this).alias("released_to")).coalesce(1).write.mode("overwrite").parquet(
            _batch_folder(ledger, batch_id))
    return write


def read_released(spark: SparkSession, rows: str, ledger: str, schema: StructType | str) -> DataFrame:
    """Released rows, with the batch that brought them and the ``release`` that let them go."""
    spans = spark.read.schema(HELD).parquet(ledger).where("released_to IS NOT NULL")
    let_go = spans.select(F.explode(F.sequence("released_from", "released_to")).alias("batch"),
                          F.col("released_to").alias("release"))
    return _with_batch(spark, rows, schema).join(let_go, "batch")


def read_held(spark: SparkSession, rows: str, ledger: str, schema: StructType | str) -> DataFrame:
    """Rows that still wait, with the batch that brought them."""
    last = spark.read.schema(f"{HELD}, batch bigint").parquet(ledger).agg(
        F.max_by("held_from", "batch").alias("held_from")).scalar()
    return _with_batch(spark, rows, schema).where(F.col("batch") >= last)


def _with_batch(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of all batches with their ``batch``, a partition column, so batches that are not asked for are not read."""
    columns = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(f"{columns}, batch bigint").parquet(path)


def stable_batches(out: str, recent: str, checks: int = 4, key: str = "path",
                   ts: Sequence[str] = ("snapshot_ts",), size: str = "length",
                   pieces: int | None = None, forget_batches: int | None = None):
    """``foreachBatch`` writer: judge each snapshot row by the ``checks`` before it.

    The last ``checks`` rows per file go with the next batch. A batch is an
    ordinary table here, so a file with very many rows is cut like any hot group. A file not seen for
    ``forget_batches`` batches is forgotten; None remembers every file.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carried = StructType([*batch.schema.fields, StructField("_seen_in", LongType())])
        before = _written(spark, recent, carried, batch_id).where(F.col("batch") == batch_id - 1).drop("batch")
        if forget_batches is not None:
            before = before.where(F.col("_seen_in") >= batch_id - forget_batches)
        together = before.withColumn("_new", F.lit(False)).unionByName(
            batch.withColumns({"_seen_in": F.lit(batch_id).cast("bigint"), "_new": F.lit(True)})).persist()
        try:
            flagged = stable_flags(together, checks, key, ts, size, pieces)
            (flagged.where("_new").drop("_new", "_seen_in", "size_change")
                    .write.mode("overwrite").parquet(_batch_folder(out, batch_id)))
            seen = together.groupBy(key).agg(F.max("_seen_in").alias("_last_in"))
            kept = top_per_group(together.drop("_new"), [key], [F.desc(c) for c in ts], checks).drop("rank")
            (kept.join(seen, key).withColumn("_seen_in", F.col("_last_in")).select(*carried.names)
                 .write.mode("overwrite").parquet(_batch_folder(recent, batch_id)))
        finally:
            together.unpersist()
    return write


def drain_batches(stream: DataFrame, write, name: str, mode: str = "append") -> None:
    """Run a ``foreachBatch`` writer over all that is there."""
    drain(stream.writeStream.outputMode(mode).foreachBatch(write), stream.sparkSession, name)


def drained_counts(counts: DataFrame, keys: Sequence[str], name: str = "counts") -> DataFrame:
    """Run an aggregating stream in update mode; the newest value per key."""
    spark = counts.sparkSession
    path = scratch_path(spark, name)
    drain_batches(counts, append_batches(path), name, "update")
    return latest_row(spark.read.parquet(path), keys, ["batch"]).drop("batch")
