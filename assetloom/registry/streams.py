"""Streaming jobs run over all files that are there."""

from pyspark.sql import functions as F

from assetloom.functions import strings as S
from assetloom.registry.base import (SNAPSHOTS, TASK_EVENTS, STATE_OF, query)
from assetloom.registry.jobs import NEXT_KEPT
from assetloom.session import scratch_path
from assetloom.streaming import arrivals, state, tables


def _event_stream(t):
    return arrivals.table_stream(t.spark, t.path("events"))


#: Days of one file, and the files of a month.
DAYS, FILES = 5, 6
_BATCH = f"(CAST(extract(day FROM ts) AS BIGINT) - 1) // {DAYS}"


def _file_of(ts):
    return F.expr(f"(day({ts}) - 1) div {DAYS}")


def _in_files(rows, file_no):
    """The rows as a stream of one file after the other, one micro-batch each."""
    path = scratch_path(rows.sparkSession, "event-files")
    for n in range(FILES + 1):
        rows.where(file_no == n).repartition(1).write.mode("append").parquet(path)
    return arrivals.table_stream(rows.sparkSession, path, files_per_trigger=1)


@query("STM-5", """
SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_counts(t):
    counts = tables.status_counts(_event_stream(t), "ts", "event_type", late_by="60 days")
    drained = tables.drained_counts(counts, ["window_start", "event_type"])
    return drained.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("STM-5", """
SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events
WHERE NOT (extract(day FROM ts) <= 3 AND event_id % 7 = 0) GROUP BY 1, 2""")
def stream_final_counts(t):
    """Each window once, when it is final. Some rows of the first three days come last and are late."""
    late = (F.dayofmonth("ts") <= 3) & (F.col("event_id") % 7 == 0)
    events = t.events.select("ts", "event_type", "event_id")
    stream = _in_files(events, F.when(late, FILES).otherwise(_file_of("ts"))).select(
        F.col("ts").cast("timestamp").alias("at"), "event_type")
    counts = arrivals.drain_closed_to_table(
        stream, "at", lambda rows: tables.status_counts(rows, "at", "event_type", late_by="1 day"), "final-counts")
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("STM-1 SRC-1", f"""
SELECT {_BATCH} AS batch, event_type, CAST(sum(strlen(event_type || event_id) + 1) AS BIGINT) AS length
FROM events GROUP BY 1, 2""")
def stream_arrivals(t):
    """With every micro-batch files of its rows arrive, one per event type; the next look finds them."""
    root, looks, changes = (scratch_path(t.spark, name) for name in ("landed", "looks", "changes"))
    look = arrivals.look_batches(root, looks, changes)

    def land(batch, batch_id):
        lines = batch.select("event_type", F.concat("event_type", F.col("event_id").cast("string")).alias("value"))
        lines.repartition("event_type").write.partitionBy("event_type").mode("append").text(root)
        look(batch, batch_id)

    tables.drain_batches(_in_files(t.events.select("ts", "event_type", "event_id"), _file_of("ts")), land, "arrivals")
    return t.spark.read.parquet(changes).where("status = 'new' AND path LIKE '%.txt'").select(
        F.col("batch").cast("bigint").alias("batch"),
        F.regexp_extract("path", "event_type=([^/]+)/", 1).alias("event_type"), "length")


_STABLE = f"""
WITH {SNAPSHOTS}
SELECT path, snapshot_ts, length,
       count(*) OVER f = 3 AND min(length) OVER f = max(length) OVER f AND length > 0 AS stable
FROM snapshots
WINDOW f AS (PARTITION BY path ORDER BY snapshot_ts, look ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


def _stable(events):
    path = F.concat(F.lit("/vault/in/f"), F.col("user_id").cast("string"),
                    F.when(F.col("user_id") % 3 == 0, ".tmp").otherwise(".mp4"))
    looks = events.select(
        path.alias("path"), F.col("ts").cast("timestamp").alias("snapshot_ts"), F.col("event_id").alias("look"),
        F.floor(F.col("value") / 120).alias("length"))
    flagged = arrivals.drain_closed_to_table(
        looks, "snapshot_ts", lambda rows: state.stable_files(rows, 2, None, late_by="1 hour", slot="5 days", tie="look",
                                                                    buckets=state.BUCKETS),
        "stable")
    return flagged.select("path", F.col("snapshot_ts").cast("timestamp_ntz").alias("snapshot_ts"), "length", "stable")


@query("STM-2 FLT-10", _STABLE)
def stream_stable(t):
    return _stable(_event_stream(t))


@query("STM-2 FLT-10", _STABLE)
def stream_stable_files(t):
    """The same over six files, one micro-batch each."""
    return _stable(_in_files(t.events.select("user_id", "ts", "event_id", "value"), _file_of("ts")))


@query("STM-2 FLT-10", f"""
WITH {SNAPSHOTS}
SELECT path, look, length,
       count(*) OVER f = 4 AND min(length) OVER f = max(length) OVER f AND length > 0 AS stable
FROM snapshots
WINDOW f AS (PARTITION BY path ORDER BY snapshot_ts, look ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def stream_stable_batches(t):
    out, recent = scratch_path(t.spark, "stable"), scratch_path(t.spark, "recent")
    path = F.concat(F.lit("/vault/in/f"), F.col("user_id").cast("string"),
                    F.when(F.col("user_id") % 3 == 0, ".tmp").otherwise(".mp4"))
    looks = _event_stream(t).select(
        path.alias("path"), F.col("ts").alias("snapshot_ts"), F.col("event_id").alias("look"),
        F.floor(F.col("value") / 120).alias("length"))
    write = tables.stable_batches(out, recent, 3, ts=["snapshot_ts", "look"])
    tables.drain_batches(looks, write, "stable")
    return t.spark.read.parquet(out).select("path", "look", "length", "stable")


@query("STM-3 WIN-8", f"""
WITH RECURSIVE
p AS (SELECT user_id AS k, event_id AS pos, ts, value % 100 AS percent,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
kept AS (SELECT * FROM p WHERE rn = 1 UNION ALL {NEXT_KEPT})
SELECT k AS asset_id, pos, ts, percent FROM kept""")
def stream_throttle(t):
    progress = _in_files(t.events.select("user_id", "ts", "event_id", "value"), _file_of("ts")).select(
        F.col("user_id").alias("asset_id"), F.col("event_id").alias("pos"), F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") % 100).alias("percent"))
    kept = arrivals.drain_closed_to_table(
        progress, "ts", lambda rows: state.throttle_progress(rows, 3600, 20, None, late_by="1 hour", slot="5 days", tie="pos",
                                                             buckets=state.BUCKETS),
        "throttled")
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_FIRST_LINKS = "SELECT user_id AS link, min(event_id) AS event_id FROM events GROUP BY user_id"


def _links(events, merge_every):
    path = scratch_path(events.sparkSession, "links")
    found = events.select(F.col("user_id").alias("link"), "event_id")
    tables.drain_batches(found, tables.new_link_batches(path, "link", ["event_id"], merge_every=merge_every), "links")
    return tables.read_links(events.sparkSession, path, found.schema)


@query("STM-4 JN-1 SET-1", _FIRST_LINKS)
def stream_links(t):
    return _links(_event_stream(t), tables.MERGE_EVERY)


@query("STM-4 JN-1 SET-1", _FIRST_LINKS)
def stream_links_files(t):
    """The same over six files, whose links are merged every other batch."""
    return _links(_in_files(t.events.select("user_id", "event_id", "ts"), _file_of("ts")), 2)


@query("STM-4", "SELECT DISTINCT user_id AS link FROM events")
def stream_distinct_links(t):
    found = _event_stream(t).select(F.col("user_id").alias("link"), F.col("ts").cast("timestamp").alias("at"))
    return arrivals.drain_to_table(tables.dedup_links(found, "link", "at", "365 days"), "distinct").select("link")


_CURRENT = f"""
WITH {TASK_EVENTS}
SELECT task_id, state, updated_at, seq FROM task_events
QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY updated_at DESC, seq DESC) = 1"""


def _upserts(events, merge_every):
    spark, path = events.sparkSession, scratch_path(events.sparkSession, "upserts")
    table = F.create_map(*(F.lit(x) for kv in STATE_OF.items() for x in kv))
    steps = events.select(
        F.col("user_id").alias("task_id"), F.try_element_at(table, F.col("event_type")).alias("state"),
        F.col("ts").alias("updated_at"), F.col("event_id").alias("seq"))
    newest = ["updated_at", "seq"]
    tables.drain_batches(steps, tables.upsert_batches(path, ["task_id"], newest, merge_every=merge_every), "upserts")
    return tables.read_current(spark, path, ["task_id"], newest, steps.schema)


@query("STM-6 LED-1", _CURRENT)
def stream_upserts(t):
    return _upserts(_event_stream(t), tables.MERGE_EVERY)


@query("STM-6 LED-1", _CURRENT)
def stream_upserts_files(t):
    """The same over six files, merged every other batch; the files do not follow the time."""
    return _upserts(_in_files(t.events.select("user_id", "event_type", "ts", "event_id"), F.col("event_id") % FILES), 2)


@query("STM-7 FLT-11", f"""
WITH RECURSIVE rows AS (SELECT event_id, value, {_BATCH} AS batch FROM events),
sums AS (SELECT batch, sum(value) AS own FROM rows GROUP BY batch),
least AS (SELECT sum(value) * 0.6 AS least FROM events),
run AS (
  SELECT batch, own AS held, own >= (SELECT least FROM least) AS opened FROM sums WHERE batch = 0
  UNION ALL SELECT s.batch, own + CASE WHEN opened THEN 0 ELSE held END,
                   own + CASE WHEN opened THEN 0 ELSE held END >= (SELECT least FROM least)
            FROM run JOIN sums s ON s.batch = run.batch + 1)
SELECT event_id, batch, (SELECT min(batch) FROM run WHERE opened AND run.batch >= rows.batch) AS release FROM rows""")
def stream_release(t):
    """Files wait until three fifths of all value are there; what comes later still waits."""
    held, ledger = scratch_path(t.spark, "held"), scratch_path(t.spark, "held-ledger")
    trigger = t.events.agg(F.sum("value") * 0.6).first()[0]
    rows = _in_files(t.events.select("event_id", "value", "ts"), _file_of("ts")).select("event_id", "value")
    tables.drain_batches(rows, tables.hold_batches(held, ledger, "value", trigger, F.lit(False)), "release")
    waiting = tables.read_held(t.spark, held, ledger, rows.schema).withColumn("release", F.lit(None).cast("bigint"))
    return tables.read_released(t.spark, held, ledger, rows.schema).unionByName(waiting).drop("value")
