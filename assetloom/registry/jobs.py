"""Plans and log reports over the driver tables."""

from pyspark.sql import functions as F

from assetloom.operators import metrics as M
from assetloom.plans import logs, manifests, scenes, segments
from assetloom.registry.base import TOOL_LOG, query, sql_text, tool_log


@query("JOB-1 WIN-3", """
WITH RECURSIVE cuts AS (
  SELECT event_id, value, CAST(1 AS BIGINT) AS seg_no, 0.0::DOUBLE AS start,
         CASE WHEN value >= 180 THEN 90.0::DOUBLE ELSE value END AS length
  FROM events WHERE value >= 180
  UNION ALL
  SELECT event_id, value, seg_no + 1, start + length,
         CASE WHEN value - start - length >= 180 THEN 90 ELSE value - (start + length) END
  FROM cuts WHERE start + length < value)
SELECT event_id, value, seg_no, start, length,
       'clip' || event_id || '_' || printf('%03d', seg_no) || '.mp4' AS seg_name FROM cuts""")
def segment_plan(t):
    return segments.fixed_segments(
        t.events.select("event_id", "value"), "value",
        name=F.concat(F.lit("clip"), F.col("event_id").cast("string")))


@query("JOB-2 FLT-16 STR-13", """
SELECT event_id, value, 60.0::DOUBLE AS start, value - 60 - 60 AS length,
       'clip' || event_id || '_no_head_tail.mp4' AS out_name
FROM events WHERE value - 60 - 60 > 0""")
def trim_plan(t):
    return segments.trim_plan(t.events.select("event_id", "value"), "value",
                              name=F.concat(F.lit("clip"), F.col("event_id").cast("string")))


@query("JOB-3 WIN-6", """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, lines[i] AS line, lines[i + 1] AS next_line
FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM l)""")
def line_manifest(t):
    return manifests.numbered_lines(t.documents.select("doc_id", "text"), "text")


def _playlists(t):
    """A playlist per document: every text line is a segment named by its length."""
    marked = F.transform(F.split("text", "\n"), lambda x, i: F.concat(
        F.lit("#EXTINF:4.0,\n"), F.when(i % 3 == 0, "/media/").when(i % 3 == 1, "https://cdn.example.com/")
        .otherwise(""), F.lit("seg_"), i.cast("string"), F.lit("_"), F.length(x).cast("string"),
        F.when(i % 2 == 0, ".ts").otherwise(".ts?key=1"), F.lit(" \r")))
    body = F.concat(F.lit("#EXTM3U\n"), F.array_join(marked, "\n"), F.lit("\n#EXT-X-ENDLIST\n"))
    return t.documents.select(
        F.col("doc_id").alias("asset_id"),
        F.concat(F.lit("https://v.example.com/"), "source", F.lit("/list.m3u8?x=1")).alias("base_url"),
        body.alias("body"))


_SEGMENTS = """
WITH l AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
n AS (SELECT doc_id, source, unnest(range(0, len(lines))) AS i, unnest(lines) AS x FROM l)
SELECT doc_id AS asset_id, i + 1 AS seg_no,
       CASE i % 3 WHEN 0 THEN 'https://v.example.com/media/' WHEN 1 THEN 'https://cdn.example.com/'
         ELSE 'https://v.example.com/' || source || '/' END
         || 'seg_' || i || '_' || length(x) || CASE WHEN i % 2 = 0 THEN '.ts' ELSE '.ts?key=1' END AS seg_url,
       doc_id || '_' || printf('%05d', i + 1) || '.ts' AS seg_name
FROM n"""


@query("JOB-3 STR-9 WIN-3 WIN-6", _SEGMENTS)
def playlist_segments(t):
    return manifests.playlist_segments(_playlists(t))


@query("JOB-3 STR-9 WIN-3", _SEGMENTS)
def playlist_files(t):
    return manifests.playlist_segments(_playlists(t), by_mark=False)


@query("ORD-5", """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
n AS (SELECT doc_id, unnest(range(0, len(lines))) AS i, unnest(lines) AS x FROM l)
SELECT doc_id, 'v' || max(i) || '.m3u8' AS last_uri,
       'v' || arg_max(i, length(x) * 1000000 + i) || '.m3u8' AS widest_uri
FROM n GROUP BY doc_id""")
def best_variant(t):
    variants = F.transform(F.split("text", "\n"), lambda x, i: F.concat(
        F.lit("#EXT-X-STREAM-INF:PROGRAM-ID=1,BANDWIDTH="), F.length(x).cast("string"),
        F.lit(",CODECS=\"a\"\nv"), i.cast("string"), F.lit(".m3u8")))
    body = F.concat(F.lit("#EXTM3U\n"), F.array_join(variants, "\n"), F.lit("\n"))
    lists = t.documents.select("doc_id", body.alias("body"))
    return lists.select("doc_id", manifests.last_variant(F.col("body")).alias("last_uri"),
                        manifests.widest_variant(F.col("body")).alias("widest_uri"))


_UNITS = ("CASE regexp_extract(line, '([KMG]?i?B|kB)/s', 1) WHEN 'KiB' THEN 1024 WHEN 'kB' THEN 1024 "
          "WHEN 'MiB' THEN 1048576 WHEN 'MB' THEN 1048576 WHEN 'GiB' THEN 1073741824 "
          "WHEN 'GB' THEN 1073741824 ELSE 1 END")
_PROGRESS = f"""
  SELECT run_id, pos, ts, line LIKE '[download]%\\%%' ESCAPE '\\' AS loading,
         CASE WHEN line LIKE '[download]%\\%%' ESCAPE '\\'
           THEN CAST(regexp_extract(line, '([0-9.]+)%', 1) AS DOUBLE) END AS percent,
         CASE WHEN line LIKE '[download]%\\%%' ESCAPE '\\'
           THEN CAST(regexp_extract(line, 'at ([0-9.]+)', 1) AS DOUBLE) * {_UNITS} END AS speed,
         CASE WHEN line LIKE '[download]%\\%%' ESCAPE '\\'
           THEN CASE WHEN line LIKE '%ETA %:%' THEN 60 + CAST(regexp_extract(line, ':([0-9]+)$', 1) AS BIGINT)
                ELSE CAST(regexp_extract(line, 'ETA ([0-9]+)s', 1) AS BIGINT) END END AS eta,
         line
  FROM tool_log"""


@query("JOB-4 MTH-2 DT-4", f"""
WITH {TOOL_LOG}, p AS ({_PROGRESS})
SELECT run_id, pos, percent, speed, eta,
       CASE WHEN loading THEN 'downloading' WHEN starts_with(line, '[Merger]') THEN 'processing'
            WHEN line LIKE '%already been downloaded' OR line LIKE 'Deleting original%' THEN 'finished' END AS phase,
       CASE WHEN starts_with(line, '[Merger]') THEN 'clip_' || pos || '.mp4'
            WHEN line LIKE '%Destination%.webm' THEN 'clip_' || pos || '.webm'
            WHEN line LIKE '%Destination%: part' THEN 'clip_' || pos || '.mp4' END AS file_name
FROM p""")
def log_progress(t):
    return logs.progress_table(tool_log(t)).select("run_id", "pos", "percent", "speed", "eta", "phase",
                                                   "file_name")


#: The next row let through after the last one, of numbered rows ``p`` of keys ``k``.
NEXT_KEPT = """
  SELECT n.* FROM p n JOIN (
    SELECT p.k, min(p.rn) AS rn FROM kept l JOIN p ON p.k = l.k AND p.rn > l.rn
    WHERE epoch_us(p.ts) - epoch_us(l.ts) >= 3600000000 OR abs(p.percent - l.percent) >= 20 OR p.percent >= 99
    GROUP BY p.k) found ON n.k = found.k AND n.rn = found.rn"""


@query("WIN-8", f"""
WITH RECURSIVE {TOOL_LOG}, loads AS ({_PROGRESS}),
p AS (SELECT run_id AS k, pos, ts, percent, row_number() OVER (PARTITION BY run_id ORDER BY ts, pos) AS rn
      FROM loads WHERE loading),
kept AS (SELECT * FROM p WHERE rn = 1 UNION ALL {NEXT_KEPT})
SELECT k AS run_id, pos, percent FROM kept""")
def progress_throttle(t):
    loading = logs.progress_table(tool_log(t)).where(F.col("phase") == "downloading")
    return logs.throttled_progress(loading.select("run_id", "pos", "ts", "percent"), ["run_id"],
                                   ["ts", "pos"], min_seconds=3600, min_points=20).select(
        "run_id", "pos", "percent")


@query("WIN-8", f"""
WITH RECURSIVE keyed AS (
  SELECT CASE WHEN event_id % 3 > 0 THEN -1 ELSE user_id END AS k, event_id AS pos, ts, value % 100 AS percent FROM events),
p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, pos) AS rn FROM keyed),
kept AS (SELECT * FROM p WHERE rn = 1 UNION ALL {NEXT_KEPT})
SELECT k AS asset_id, pos, ts, percent FROM kept""")
def asset_throttle(t):
    """Two thirds of all rows are of one asset."""
    asset = F.when(F.col("event_id") % 3 > 0, F.lit(-1)).otherwise(F.col("user_id")).cast("bigint")
    progress = t.events.select(asset.alias("asset_id"), F.col("event_id").alias("pos"), "ts",
                               (F.col("value") % 100).alias("percent"))
    return logs.throttled_progress(progress, ["asset_id"], ["ts", "pos"], min_seconds=3600, min_points=20)


# Written out for the comparison, apart from the rules that the library uses.
_RULES = r"""
  WHEN line ILIKE '%AttributeError%''NoneType''%''lower''%' THEN 1
  WHEN regexp_matches(line, '(?i)no such file or directory.*frag[0-9]') THEN 2
  WHEN line ILIKE '%HTTP Error 502%' OR line ILIKE '%bad gateway%' THEN 3
  WHEN line ILIKE '%HTTP Error 404%' OR line ILIKE '%not found%' THEN 4
  WHEN line ILIKE '%HTTP Error 403%' OR line ILIKE '%forbidden%' THEN 5
  WHEN line ILIKE '%no space left on device%' THEN 6
  WHEN line ILIKE '%conversion failed%' THEN 7
  WHEN line ILIKE '%unable to download webpage%' THEN 8
  WHEN line ILIKE '%connection%timeout%' OR line ILIKE '%timed out%' THEN 9
  WHEN line ILIKE '%permission denied%' THEN 10
  WHEN line ILIKE '%postprocessing%failed%' THEN 11
  WHEN line ILIKE '%rate limit%' OR line ILIKE '%too many requests%' THEN 12
  WHEN line ILIKE '%private video%' OR line ILIKE '%access denied%' THEN 13
  WHEN line ILIKE '%unable to extract%info%' THEN 14
  WHEN line ILIKE '%video unavailable%' THEN 15
  WHEN line ILIKE '%this video is not available%' THEN 16
  WHEN line ILIKE '%sign in to confirm%' THEN 17
  WHEN line ILIKE '%requested format is not available%' THEN 18"""
_LABELS = """['info_missing', 'fragment_lost', 'server_unavailable', 'not_found', 'forbidden', 'disk_full',
  'conversion_failed', 'page_unreachable', 'timeout', 'permission_denied', 'postprocessing_failed', 'rate_limited',
  'private', 'extraction_failed', 'unavailable', 'this_unavailable', 'sign_in', 'format_unavailable']"""


@query("JOB-6 ORD-6 STR-11", f"""
WITH {TOOL_LOG},
judged AS (
  SELECT run_id, pos, trim(line) AS line, CASE {_RULES} END AS rule,
         regexp_replace(trim(line), '\x1b\\[[0-9;]*m', '', 'g') AS bare,
         row_number() OVER (PARTITION BY run_id ORDER BY pos DESC) AS back
  FROM tool_log),
marked AS (
  SELECT *, regexp_matches(upper(line), 'ERROR:|FAILED:|EXCEPTION:|WARNING:') AND length(bare) > 10 AS report,
         back <= 10 AND length(line) > 20 AND NOT starts_with(line, '[') AS telling FROM judged),
per_run AS (
  SELECT run_id, min(rule) AS rule_no, arg_min(bare, pos) FILTER (report) AS report_line,
         arg_min(line, pos) FILTER (telling) AS tail_line FROM marked GROUP BY run_id)
SELECT run_id, rule_no, {_LABELS}[rule_no] AS label,
       left(coalesce({_LABELS}[rule_no], left(report_line, 200), left(tail_line, 150), 'unknown error'), 400)
         AS message
FROM per_run""")
def error_report(t):
    return logs.error_report(tool_log(t))


_FINAL = " OR ".join(f"line ILIKE '%{part}%'" for part in (
    "http error 404", "not found", "private video", "access denied", "no space left on device", "permission denied",
    "video unavailable", "this video is not available", "sign in to confirm", "http error 403%forbidden"))


@query("JOB-7 MTH-5", f"""
WITH {TOOL_LOG}, r AS (
  SELECT run_id, max(attempt) AS attempt, bool_or({_FINAL}) AS final,
         bool_or(line ILIKE '%http error 502%' OR line ILIKE '%bad gateway%' OR line ILIKE '%rate limit%'
                 OR line ILIKE '%too many requests%') AS busy,
         bool_or(line ILIKE '%attributeerror%''nonetype''%') AS attribute
  FROM tool_log GROUP BY run_id)
SELECT run_id, attempt, NOT final AS retry,
       CAST(CASE WHEN final THEN 0 WHEN busy THEN least(30, 5 * pow(2, attempt))
            WHEN attribute THEN least(15, 3 * pow(2, attempt)) ELSE pow(2, attempt) END AS BIGINT)
         AS wait_seconds
FROM r""")
def retry_decision(t):
    return logs.retry_decision(tool_log(t))


_GOOD = " OR ".join(f"contains(line, '{mark}')" for mark in (
    "has already been downloaded", "100%", "download completed", "[Merger] Merging formats", "Deleting original file"))
_BAD = " OR ".join(f"contains(line, '{mark}')" for mark in (
    "ERROR:", "FAILED:", "No space left on device", "Permission denied", "Connection refused",
    "Unable to download webpage", "Video unavailable"))


@query("JOB-8 AGG-12", f"""
WITH {TOOL_LOG}
SELECT run_id, max(exit_code) AS exit_code,
       max(exit_code) = 0 OR (bool_or({_GOOD}) AND NOT bool_or({_BAD})) AS ok
FROM tool_log GROUP BY run_id""")
def run_outcomes(t):
    return logs.run_outcomes(tool_log(t))


_SCENES = """
marked AS (
  SELECT user_id AS video_id, event_id,
         row_number() OVER w AS frame_no, value >= 100 AND row_number() OVER w > 1 AS cut
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, 1 + count(*) FILTER (cut) OVER (PARTITION BY video_id ORDER BY frame_no
           ROWS UNBOUNDED PRECEDING) AS scene_no FROM marked)"""


def _scene_rows(t):
    frames = t.events.select(F.col("user_id").alias("video_id"), "event_id", "ts", "value")
    return scenes.number_scenes(frames, "video_id", ["ts", "event_id"], "value", threshold=100)


@query("WIN-9", f"WITH {_SCENES} SELECT video_id, event_id, scene_no FROM numbered")
def scene_cuts(t):
    return _scene_rows(t).select("video_id", "event_id", "scene_no")


@query("AGG-9 WIN-9", f"""
WITH {_SCENES}
SELECT video_id, max(scene_no) AS n_scenes, max(scene_no) > 1 AS multi_scene
FROM numbered GROUP BY video_id""")
def scene_counts(t):
    return M.scene_counts(_scene_rows(t))


def _code(frame: str) -> str:
    ms = f"({frame} * 40)"
    return (f"printf('%02d:%02d:%02d.%03d', {ms} // 3600000, {ms} % 3600000 // 60000, "
            f"{ms} % 60000 // 1000, {ms} % 1000)")


@query("JOB-14 WIN-9 DT-5 WIN-3 AGG-9", f"""
WITH {_SCENES.replace("value >= 100", "value >= 150")},
spans AS (SELECT video_id, scene_no, min(event_id) AS a, max(event_id) AS b FROM numbered GROUP BY 1, 2),
several AS (SELECT video_id, max(scene_no) AS n_scenes FROM spans GROUP BY 1 HAVING max(scene_no) > 1)
SELECT video_id, scene_no, a AS first_frame, b AS last_frame, {_code('a')} AS start_code,
       {_code('(b + 1)')} AS end_code, n_scenes,
       video_id || '_scene_' || printf('%03d', scene_no) || '.mp4' AS out_name
FROM spans JOIN several USING (video_id)""")
def scene_plan(t):
    frames = t.events.select(F.col("user_id").alias("video_id"), "event_id", "ts", "value",
                             F.lit(25.0).alias("fps"))
    numbered = scenes.number_scenes(frames, "video_id", ["ts", "event_id"], "value", threshold=150)
    return scenes.split_plan(scenes.scene_intervals(numbered, frame="event_id"))


@query("JOB-14 AGG-6 AGG-9", f"""
WITH {_SCENES}, spans AS (
  SELECT video_id, scene_no, bool_or(value_ok) AS ok FROM (
    SELECT n.*, e.event_type <> 'error' AS value_ok FROM numbered n JOIN events e USING (event_id)) GROUP BY 1, 2)
SELECT video_id, count(*) AS segments, count(*) FILTER (NOT ok) AS failed,
       count(*) FILTER (NOT ok) <= count(*) * 0.1::DOUBLE AS accepted, bool_and(ok) AS complete,
       CASE WHEN bool_and(ok) THEN 'all' WHEN bool_or(ok) THEN 'partial' ELSE 'none' END AS outcome
FROM spans GROUP BY video_id""")
def scene_outcomes(t):
    frames = t.events.select(F.col("user_id").alias("video_id"), "event_id", "ts", "value", "event_type")
    numbered = scenes.number_scenes(frames, "video_id", ["ts", "event_id"], "value", threshold=100)
    spans = numbered.groupBy("video_id", "scene_no").agg(
        F.bool_or(F.col("event_type") != "error").alias("ok"))
    return M.accept_by_failures(spans, ["video_id"], F.col("ok"))
