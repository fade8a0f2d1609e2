"""Registration, table access and the rows derived from the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class Tables:
    """Driver tables by name; a scan reads only the columns a query uses."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    @property
    def __name__(self) -> str:
        return self.name

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register the function under its name. ``covers`` lists operator ids."""
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = Query(build.__name__, tuple(covers.split()), build, sql)
        return build
    return register


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pick(values: list[str], index: Column) -> Column:
    """Value number ``index mod n`` of a list."""
    return F.element_at(F.array(*(F.lit(v) for v in values)),
                        (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def sql_pick(values: list[str], index: str) -> str:
    return f"([{', '.join(sql_text(v) for v in values)}])[(({index}) % {len(values)}) + 1]"


# --- a file inventory: every document is a file -----------------------------------

EXTENSIONS = [".mp4", ".MKV", ".txt", "", ".part", ".Mov", ".info.json"]

INVENTORY = f"""inventory AS (
  SELECT doc_id, source, lang, n_chars AS length,
         '/vault/' || source || '/' || lang || '/item_' || doc_id
           || {sql_pick(EXTENSIONS, 'doc_id')} AS path
  FROM documents)"""


def inventory(t: Tables) -> DataFrame:
    path = F.concat(F.lit("/vault/"), "source", F.lit("/"), "lang", F.lit("/item_"),
                    F.col("doc_id").cast("string"), pick(EXTENSIONS, F.col("doc_id")))
    return t.documents.select("doc_id", "source", "lang", F.col("n_chars").alias("length"),
                              path.alias("path"))


# --- task events: every event is a step of its user's task ------------------------

STATE_OF = {"view": "pending", "click": "queued", "signup": "running", "purchase": "done",
            "error": "retry"}

TASK_EVENTS = f"""task_events AS (
  SELECT user_id AS task_id, event_id AS seq, ts AS updated_at,
         CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_OF.items())} END
           AS state,
         'host' || (CAST(floor(value) AS BIGINT) % 4) AS host
  FROM events)"""


def task_events(t: Tables) -> DataFrame:
    table = F.create_map(*(F.lit(x) for kv in STATE_OF.items() for x in kv))
    host = F.concat(F.lit("host"), (F.floor("value") % 4).cast("string"))
    return t.events.select(F.col("user_id").alias("task_id"), F.col("event_id").alias("seq"),
                           F.col("ts").alias("updated_at"),
                           F.try_element_at(table, F.col("event_type")).alias("state"),
                           host.alias("host"))


# --- a tool log: every event is a line, eight lines are a run ----------------------

ERROR_LINES = [
    "ERROR: HTTP Error 404: Not Found", "WARNING: http error 403: forbidden",
    "ERROR: Unable to download webpage: timed out", "ERROR: Connection reset, timeout",
    "OSError: No space left on device", "Permission denied: /vault/out",
    "HTTP Error 502: Bad Gateway", "Too Many Requests, slow down",
    "AttributeError: 'NoneType' object has no attribute 'lower'",
    "AttributeError: 'NoneType' object has no attribute 'get'",
    "No such file or directory: clip.mp4.part-Frag12", "Postprocessing: ffmpeg failed",
    "Conversion failed!", "Private video. Sign in if you have been granted access",
    "Unable to extract player info", "Video unavailable", "This video is not available",
    "Sign in to confirm your age", "Requested format is not available",
    "\x1b[0;31mERROR:\x1b[0m something odd happened here", "a plain note of more than twenty signs",
    "short note", "[info] a bracketed note of more than twenty signs", "Access Denied by host",
]
SPEEDS = ["KiB", "MiB", "GiB", "kB", "MB", "GB", "B"]

_N = "CAST(floor(value) AS BIGINT)"
TOOL_LOG = f"""tool_log AS (
  SELECT event_id // 8 AS run_id, event_id AS pos, ts, (event_id // 8) % 5 AS attempt,
         CASE WHEN (event_id // 8) % 3 = 0 THEN 0 ELSE 1 END AS exit_code,
         CASE event_type
           WHEN 'click' THEN '[download]  ' || ({_N} % 101) || '.5% of ~ 12MiB at ' || {_N} || '.25'
             || {sql_pick(SPEEDS, _N)} || '/s ETA '
             || CASE WHEN {_N} % 2 = 0 THEN '01:' || ({_N} % 50 + 10) ELSE {_N} || 's' END
           WHEN 'view' THEN '[Merger] Merging formats into "/vault/out/clip_' || event_id || '.mp4"'
           WHEN 'purchase' THEN '[download] Destination: /vault/tmp/clip_' || event_id
             || {sql_pick(['.webm', '.m4a', '.mp4: part'], 'event_id')}
           WHEN 'signup' THEN {sql_pick(['Deleting original file clip.f137.mp4',
                                         '[download] clip.mp4 has already been downloaded',
                                         '  {"title": "clip"}  '], 'event_id')}
           ELSE {sql_pick(ERROR_LINES, 'event_id')} END AS line
  FROM events)"""


def tool_log(t: Tables) -> DataFrame:
    n, no, kind = F.floor("value"), F.col("event_id"), F.col("event_type")
    text = n.cast("string")
    eta = F.when(n % 2 == 0, F.concat(F.lit("01:"), (n % 50 + 10).cast("string"))).otherwise(
        F.concat(text, F.lit("s")))
    line = (
        F.when(kind == "click", F.concat(
            F.lit("[download]  "), (n % 101).cast("string"), F.lit(".5% of ~ 12MiB at "), text,
            F.lit(".25"), pick(SPEEDS, n), F.lit("/s ETA "), eta))
         .when(kind == "view", F.concat(F.lit('[Merger] Merging formats into "/vault/out/clip_'),
                                        no.cast("string"), F.lit('.mp4"')))
         .when(kind == "purchase", F.concat(
             F.lit("[download] Destination: /vault/tmp/clip_"), no.cast("string"),
             pick([".webm", ".m4a", ".mp4: part"], no)))
         .when(kind == "signup", pick(["Deleting original file clip.f137.mp4",
                                       "[download] clip.mp4 has already been downloaded",
                                       '  {"title": "clip"}  '], no))
         .otherwise(pick(ERROR_LINES, no)))
    run = F.floor(no / 8)
    return t.events.select(
        run.alias("run_id"), no.alias("pos"), "ts", (run % 5).alias("attempt"),
        F.when(run % 3 == 0, 0).otherwise(1).alias("exit_code"), line.alias("line"))


# --- size snapshots: every event is a look at its user's file ---------------------

SNAPSHOTS = """snapshots AS (
  SELECT user_id, '/vault/in/f' || user_id || CASE WHEN user_id % 3 = 0 THEN '.tmp' ELSE '.mp4' END
           AS path,
         ts AS snapshot_ts, event_id AS look,
         CAST(floor(value / 120) AS BIGINT) AS length
  FROM events)"""


def snapshots(t: Tables) -> DataFrame:
    path = F.concat(F.lit("/vault/in/f"), F.col("user_id").cast("string"),
                    F.when(F.col("user_id") % 3 == 0, ".tmp").otherwise(".mp4"))
    return t.events.select("user_id", path.alias("path"), F.col("ts").alias("snapshot_ts"),
                           F.col("event_id").alias("look"),
                           F.floor(F.col("value") / 120).alias("length"))


def exact_sum(col: Column | str) -> Column:
    """Sum of two-decimal amounts without rounding differences between engines."""
    return F.sum((F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")).cast("double")
