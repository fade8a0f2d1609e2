"""Eligibility rules over the driver tables."""

from datetime import time

from pyspark.sql import functions as F

from assetloom.functions import dates as D, strings as S
from assetloom.operators import filters as E
from assetloom.plans import transfer
from assetloom.registry.base import (INVENTORY, SNAPSHOTS, TASK_EVENTS, inventory, query,
                                     snapshots, task_events)


@query("FLT-3 FLT-4", """
SELECT doc_id, n_chars FROM documents
WHERE (text ILIKE '%the%' OR text ILIKE '%Mento%' OR text ILIKE '%schen%')
  AND n_chars BETWEEN 500 AND 5000""")
def keyword_filter(t):
    return (t.documents.where(E.any_keyword(F.col("text"), ["the", "Mento", "schen"])
                              & E.duration_between(F.col("n_chars"), 500, 5000))
             .select("doc_id", "n_chars"))


@query("FLT-6", """
SELECT doc_id, lang, regexp_matches(text, '[一-鿿]') AS has_cjk FROM documents""")
def cjk_flags(t):
    return t.documents.select("doc_id", "lang", S.has_cjk(F.col("text")).alias("has_cjk"))


@query("FLT-5", """
SELECT p_partkey, p_size * 40 AS height,
       CASE WHEN p_size * 40 >= 1080 THEN 'keep' ELSE 'reject' END AS verdict
FROM part""")
def height_gate(t):
    sized = t.part.select("p_partkey", (F.col("p_size") * 40).alias("height"))
    keep, reject = E.split_by_height(sized, "height", 1080)
    return (keep.withColumn("verdict", F.lit("keep"))
                .unionByName(reject.withColumn("verdict", F.lit("reject"))))


@query("FLT-1 FLT-2 FLT-8 FLT-14", f"""
WITH {INVENTORY}
SELECT path,
       regexp_matches(path, '(?i)\\.(mp4|avi|mov|mkv|m4v|wmv|rmvb|dat|vob)$') AS is_media,
       NOT (contains(path, '/src1') OR contains(path, '/fr/')) AS outside,
       NOT starts_with(path, '/vault/src1/') AS not_output,
       CASE WHEN path LIKE '%.part' THEN 'temp' WHEN path LIKE '%.json' THEN 'unwanted' END AS junk
FROM inventory""")
def inventory_labels(t):
    path = F.col("path")
    return inventory(t).select(
        "path", E.has_extension(path).alias("is_media"),
        E.outside_folders(path, ["/src1", "/fr/"]).alias("outside"),
        E.outside_prefix(path, "/vault/src1").alias("not_output"),
        E.junk_label(path).alias("junk"))


@query("FLT-15", """
SELECT event_id, ts FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 86400 SECOND""")
def recent_events(t):
    newest = t.events.agg(F.max("ts").alias("ts")).scalar()
    return (t.events.where(E.modified_within(F.col("ts"), newest, 86_400))
             .select("event_id", "ts"))


@query("FLT-9", """
SELECT event_id, ts FROM events
WHERE CAST(ts AS TIME) >= TIME '20:00:00' OR CAST(ts AS TIME) < TIME '09:00:00'""")
def night_window(t):
    return (t.events.where(D.in_day_window(F.col("ts"), time(20), time(9)))
             .select("event_id", "ts"))


@query("FLT-9", """
SELECT event_id, ts FROM events
WHERE CAST(ts AS TIME) >= TIME '09:30:00' AND CAST(ts AS TIME) < TIME '17:00:00'""")
def day_window(t):
    return (t.events.where(D.in_day_window(F.col("ts"), time(9, 30), time(17)))
             .select("event_id", "ts"))


@query("FLT-10 WIN-7", f"""
WITH {SNAPSHOTS}
SELECT look, path, length,
       length - lag(length) OVER (PARTITION BY path ORDER BY snapshot_ts, look) AS size_change,
       count(*) OVER f = 3 AND min(length) OVER f = max(length) OVER f AND length > 0 AS stable
FROM snapshots
WINDOW f AS (PARTITION BY path ORDER BY snapshot_ts, look ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def stable_rows(t):
    return (E.stable_flags(snapshots(t), 2, "path", ["snapshot_ts", "look"])
             .select("look", "path", "length", "size_change", "stable"))


@query("FLT-11", """
SELECT doc_id, n_chars FROM documents
WHERE (SELECT sum(n_chars) FROM documents) >= 200000""")
def size_gate(t):
    return E.release_gate(t.documents.select("doc_id", "n_chars"), "n_chars", 200_000,
                          F.lit(False))


@query("FLT-11 FLT-9", """
SELECT o_orderkey FROM orders
WHERE (SELECT sum(o_totalprice) FROM orders) >= 1e18
   OR (hour(o_orderdate) >= 20 OR hour(o_orderdate) < 9)""")
def window_gate(t):
    in_window = D.in_day_window(F.col("o_orderdate"), time(20), time(9))
    return E.release_gate(t.orders, "o_totalprice", 1e18, in_window).select("o_orderkey")


@query("FLT-12", """
SELECT user_id AS path FROM events WHERE event_id % 5 + 1 <= 3
GROUP BY user_id HAVING bool_or(event_type <> 'error' AND value > 250)""")
def probed_files(t):
    probes = t.events.select(
        F.col("user_id").alias("path"), (F.col("event_id") % 5 + 1).alias("attempt"),
        ((F.col("event_type") != "error") & (F.col("value") > 250)).alias("ok"))
    return E.passed_probe(probes)


@query("FLT-16", """
SELECT event_id, value > 120 AS feasible FROM events""")
def trim_feasible(t):
    return t.events.select("event_id",
                           E.trim_is_feasible(F.col("value"), 60, 60).alias("feasible"))


@query("FLT-17", """
SELECT doc_id, CASE WHEN quality IS NULL THEN 'reject' ELSE 'keep' END AS verdict
FROM documents LEFT JOIN labels USING (doc_id)""")
def required_fields(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    keep, reject = E.split_required(joined, "quality")
    return (keep.select("doc_id", F.lit("keep").alias("verdict"))
                .unionByName(reject.select("doc_id", F.lit("reject").alias("verdict"))))


@query("FLT-18", f"""
WITH {TASK_EVENTS}
SELECT task_id, seq, state, host FROM task_events
WHERE (state = 'queued' AND host = 'host2') OR state IN ('pending', 'retry')""")
def claimable_steps(t):
    return (task_events(t).where(E.is_claimable(F.col("state"), F.col("host"), "host2"))
            .select("task_id", "seq", "state", "host"))


@query("JOB-11 FLT-3 SRC-1", f"""
WITH {INVENTORY}
SELECT path, value AS duration
FROM inventory JOIN events ON doc_id = event_id
WHERE regexp_matches(path, '(?i)\\.(mp4|avi|mov|mkv|m4v|wmv|rmvb|dat|vob)$')
  AND value BETWEEN 5 AND 120""")
def duration_selection(t):
    files = inventory(t)
    probes = (files.join(t.events.select(F.col("event_id").alias("doc_id"),
                                         F.col("value").alias("duration")), "doc_id")
                   .select("path", "duration"))
    return transfer.select_by_duration(files, probes).select("path", "duration")


@query("JOB-10 FLT-1 FLT-10 FLT-11 FLT-12 JN-5", f"""
WITH {SNAPSHOTS},
flagged AS (
  SELECT *, count(*) OVER f = 2 AND min(length) OVER f = max(length) OVER f AND length > 0 AS stable,
         row_number() OVER (PARTITION BY path ORDER BY snapshot_ts DESC, look DESC) AS back
  FROM snapshots
  WINDOW f AS (PARTITION BY path ORDER BY snapshot_ts, look ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
last AS (SELECT * FROM flagged WHERE back = 1)
SELECT path, length FROM last
WHERE stable AND path LIKE '%.mp4' AND (SELECT sum(length) FROM last) >= 10
  AND path IN (SELECT path FROM snapshots WHERE look % 4 + 1 <= 3
               GROUP BY path HAVING bool_or(length >= 2))
  AND NOT EXISTS (SELECT 1 FROM supplier WHERE 'f' || s_suppkey || '.mp4' = split_part(path, '/', 4))
""")
def transfer_eligibility(t):
    looks = snapshots(t)
    probes = looks.select("path", (F.col("look") % 4 + 1).alias("attempt"),
                          (F.col("length") >= 2).alias("ok"))
    target = t.supplier.select(F.concat(F.lit("/vault/out/f"), F.col("s_suppkey").cast("string"),
                                        F.lit(".mp4")).alias("path"))
    return transfer.eligible_transfers(
        looks.select("path", "snapshot_ts", "look", "length"), probes, target, trigger_bytes=10,
        in_window=F.lit(False), checks=1, ts=["snapshot_ts", "look"])
