"""Streams of files and the runs that drain them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from assetloom.session import delete_path, scratch_path
from assetloom.sources.readers import INVENTORY_COLUMNS, file_inventory

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
POLL = "60 seconds"
#: A time after all others.
CLOSING = "9000-01-01"


def file_arrivals(spark: SparkSession, root: str, files_per_trigger: int = 10_000) -> DataFrame:
    """New files below ``root``, each path once. Contents are not read."""
    return (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
                 .option("recursiveFileLookup", True)
                 .option("maxFilesPerTrigger", files_per_trigger)
                 .load(root).select(*INVENTORY_COLUMNS))


def table_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                 bytes_per_trigger: int = 10 * 1024 ** 3) -> DataFrame:
    """A Parquet table, one file or a folder, as a stream with its present schema.

    A micro-batch takes a number of files if stated, else a volume.
    """
    limit = (("maxBytesPerTrigger", bytes_per_trigger) if files_per_trigger is None
             else ("maxFilesPerTrigger", files_per_trigger))
    # a stream takes a single file only through a glob
    glob = f"{path[:-1]}[{path[-1]}]"
    return (spark.readStream.schema(spark.read.parquet(path).schema)
                 .option(*limit).parquet(glob))


def start(writer, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Start with a checkpoint: every 60 s, or once over all that is there."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime=POLL)).start()


def drain(writer, spark: SparkSession, name: str) -> None:
    """Run over all that is there and wait."""
    query = start(writer, scratch_path(spark, f"{name}-checkpoint"), once=True)
    query.awaitTermination()


def drain_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run over all that is there into a Parquet table and read it back."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    drain(stream.writeStream.outputMode(mode).format("parquet").option("path", out), spark, name)
    return spark.read.schema(stream.schema).parquet(out)


def drain_closed_to_table(stream: DataFrame, ts: str, build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Run ``build(stream)`` over all that is there, then let the watermark pass all of it, and read the result.

    What waits for the watermark would stay in the state when a run ends. A second run with the same
    checkpoint reads one closing row, whose time lies after all others and whose other columns are null.
    """
    spark = stream.sparkSession
    closing, out = scratch_path(spark, f"{name}-closing"), scratch_path(spark, name)
    nothing = spark.createDataFrame([], stream.schema)
    nothing.write.parquet(closing)
    told = build(stream.unionByName(spark.readStream.schema(stream.schema).parquet(closing)))
    checkpoint = scratch_path(spark, f"{name}-checkpoint")
    for last in (False, True):
        if last:
            row = [F.lit(CLOSING if f.name == ts else None).cast(f.dataType).alias(f.name) for f in stream.schema]
            spark.range(1).select(*row).write.mode("append").parquet(closing)
        writer = told.writeStream.outputMode("append").format("parquet").option("path", out)
        start(writer, checkpoint, once=True).awaitTermination()
    return spark.read.schema(told.schema).parquet(out)


LOOK = "path string, length bigint, modificationTime timestamp"


def look_batches(root: str, looks: str, changes: str):
    """``foreachBatch`` writer: with every micro-batch, whatever it holds, look at all files below ``root`` and
    write what changed since the look before: ``new``, ``changed`` (another size or time) or ``gone``, with the
    size before. A file source takes a path once; this sees files grow. Only the last two looks are kept. Spark lists no
    files without bytes.
    """
    def write(_: DataFrame, batch_id: int) -> None:
        spark = _.sparkSession
        folder = lambda n: f"{looks}/look={n}"
        file_inventory(spark, root).write.mode("overwrite").parquet(folder(batch_id))
        now = spark.read.schema(LOOK).parquet(folder(batch_id))
        before = (spark.read.schema(LOOK).parquet(folder(batch_id - 1)) if batch_id
                  else spark.createDataFrame([], LOOK)).select("path", F.col("length").alias("length_before"),
                                                               F.col("modificationTime").alias("_time_before"))
        status = (F.when(F.col("_time_before").isNull(), "new").when(F.col("modificationTime").isNull(), "gone")
                   .when((F.col("length") != F.col("length_before"))
                         | (F.col("modificationTime") != F.col("_time_before")), "changed"))
        (now.join(before, "path", "full_outer").withColumn("status", status).where("status IS NOT NULL")
            .select("path", "length", "length_before", "status")
            .write.mode("overwrite").parquet(f"{changes}/batch={batch_id}"))
        if batch_id > 1:
            delete_path(spark, folder(batch_id - 2))
    return write


def ticks(spark: SparkSession) -> DataFrame:
    """A stream that always has a next micro-batch, for writers that only need the time."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()
