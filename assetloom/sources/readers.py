"""Inventories, lists, ledgers and payloads as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from assetloom.functions import documents as J, strings as S
from assetloom.operators.ordering import cut_groups
from assetloom.session import materialize

INVENTORY_COLUMNS = ("path", "length", "modificationTime")


def file_inventory(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Every file below ``root``: path, length, modification time.

    File contents are not read. ``pattern`` is a case-sensitive glob on names.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(*INVENTORY_COLUMNS)


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line; blank lines and ``#`` comments dropped after trimming."""
    lines = spark.read.text(path).select(S.strip(F.col("value")).alias("url"))
    return lines.where((F.col("url") != "") & ~F.col("url").startswith("#"))


def text_records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Records between separators of any length, trimmed; blank ones dropped."""
    records = (spark.read.option("lineSep", separator).text(path)
                    .select(S.strip(F.col("value")).alias("record")))
    return records.where(F.col("record") != "")


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: path and body (playlists, payload files)."""
    return (spark.read.text(path, wholetext=True)
                 .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")))


def map_ledger(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """JSON map ledgers (key -> record) as rows. Empty or malformed maps give no
    rows. ``whole_file``: one map per file; else one map per line."""
    if whole_file:
        return _file_maps(spark, path)
    bodies = spark.read.text(path).select(J.parse(F.col("value"), J.LEDGER_MAP).alias("_m"))
    return bodies.select(F.explode("_m").alias("key", "_r")).select("key", "_r.*")


#: A JSON string, and a line that begins with a key.
_STRING, _KEY_LINE = r'"(?:[^"\\]|\\.)*"', r'^\s*"(?:[^"\\]|\\.)*"\s*:'


def map_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Maps of any size, one per file, cut into chunks of whole entries: file, body, and how deep it stands
    ``before`` and ``after``.

    A JSON string holds no line break, so braces outside strings can be counted line by line; the running
    count says how deep a line stands. A line that begins a key of the outermost map starts a
    chunk, and each chunk is parsed on its own. So a map that is written with a line per entry or more is cut into its
    entries, and one on a single line stays one chunk.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    bare = F.regexp_replace("value", _STRING, "")
    step = F.length(F.regexp_replace(bare, r"[^{\[]", "")) - F.length(F.regexp_replace(bare, r"[^}\]]", ""))
    lines = spark.read.text(path).select(*place, F.monotonically_increasing_id().alias("line"), "value",
                                         step.cast("bigint").alias("step"))
    order = ["block", "line"]
    deep = cut_groups(lines, ["file"], order).running(sums={"after": F.col("step")}).rows()
    starts = (F.col("after") - F.col("step") == 1) & F.col("value").rlike(_KEY_LINE)
    cut = cut_groups(deep, ["file"], order).running(sums={"chunk": starts.cast("bigint")}).rows()
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "value"))), lambda x: x["value"]), "\n")
    return cut.groupBy("file", "chunk").agg(
        joined.alias("body"), F.max_by("after", F.struct(*order)).alias("after"),
        F.min_by(F.col("after") - F.col("step"), F.struct(*order)).alias("before"))


def _file_maps(spark: SparkSession, path: str) -> DataFrame:
    chunks = map_chunks(spark, path)
    # the first chunk has the opening brace of the map, the last one the closing one; commas end the others
    body = F.when(F.col("before") == 0, F.regexp_replace("body", r"^\s*\{", "")).otherwise(F.col("body"))
    body = F.when(F.col("after") == 0, F.regexp_replace(body, r"\}\s*$", "")).otherwise(F.regexp_replace(body, r",\s*$", ""))
    parsed = chunks.select("file", "before", "after", J.parse(F.concat(F.lit("{"), body, F.lit("}")), J.LEDGER_MAP).alias("_m"))
    parsed = materialize(parsed, "map_chunks")
    whole = parsed.groupBy("file").agg(
        F.bool_and(F.col("_m").isNotNull()).alias("good"), F.count_if(F.col("after") == 0).alias("ends"),
        F.count_if(F.col("before") == 0).alias("begins")).where("good AND ends = 1 AND begins = 1").select("file")
    kept = parsed.join(whole, "file", "left_semi")
    return kept.select(F.explode("_m").alias("key", "_r")).select("key", "_r.*")


def done_paths(spark: SparkSession, path: str) -> DataFrame:
    """Headerless one-column CSV of processed paths."""
    return spark.read.csv(path, schema="path string")


def operation_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, schema=OPERATION_LOG)


OPERATION_LOG = ("timestamp string, operation string, status string, live_id string, "
                 "details string, computer string")


def ledger_files(spark: SparkSession, path: str) -> DataFrame:
    """Parquet ledger whose later files may have more columns than earlier ones."""
    return spark.read.option("mergeSchema", True).parquet(path)


def jdbc_options(url: str, table: str, *, key: str | None = None, low: object = None,
                 high: object = None, partitions: int | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a ledger scan; with ``key`` the scan runs as range partitions
    instead of one connection."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if key is not None:
        if low is None or high is None or not partitions:
            raise ValueError("a partitioned scan needs key, low, high and partitions")
        options |= {"partitionColumn": key, "lowerBound": str(low), "upperBound": str(high),
                    "numPartitions": str(partitions)}
    return options


def ledger_table(spark: SparkSession, options: Mapping[str, str], where: Column | None = None,
                 columns: tuple[str, ...] = ()) -> DataFrame:
    """Ledger table over JDBC. Filter and columns are pushed to the database."""
    df = spark.read.format("jdbc").options(**options).load()
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df
