"""File names, URLs, times and numbers over the driver tables."""

from datetime import time

from pyspark.sql import functions as F

from assetloom.functions import dates as D, documents as J, numbers as N, strings as S
from assetloom.registry.base import INVENTORY, inventory, pick, query, sql_pick, sql_text

_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


@query("STR-7 STR-8", """
SELECT page_id, md5(url) AS key, nullif(regexp_extract(url, '/([0-9]+)(?:[^0-9/].*)?$', 1), '') AS id,
       string_split(url, '/')[-1] AS tail FROM pages""")
def url_parts(t):
    url = F.col("url")
    return t.pages.select("page_id", S.url_key(url).alias("key"),
                          S.url_id(url, r"/([0-9]+)(?:[^0-9/].*)?$").alias("id"),
                          S.last_part(url).alias("tail"))


@query("STR-5 STR-6 STR-13", """
SELECT page_id,
       CASE page_id % 4
         WHEN 0 THEN 'shot ' || page_id || '.png' WHEN 1 THEN page_id || '+a.jpg'
         WHEN 2 THEN 'é.jpg' ELSE NULL END AS name,
       CASE page_id % 4 WHEN 0 THEN 'png' WHEN 1 THEN 'jpg' WHEN 2 THEN 'webp' ELSE 'jpg' END AS format
FROM pages""")
def url_names(t):
    no = F.col("page_id").cast("string")
    url = (F.when(F.col("page_id") % 4 == 0, F.concat(
               F.lit("https://img.example.com/p/x.jpg?w=1&dl=shot%20"), no, F.lit(".png&fm=PNG#top")))
            .when(F.col("page_id") % 4 == 1, F.concat(
                F.lit("https://img.example.com/p/"), no, F.lit("+a.jpg?fm=gif&dl=")))
            .when(F.col("page_id") % 4 == 2, F.lit("https://img.example.com/p/%C3%A9.jpg?fm=webp"))
            .otherwise(F.col("page_id").cast("string")))
    return t.pages.select("page_id", S.url_file_name(url).alias("name"), S.url_format(url).alias("format"))


@query("STR-3 STR-4", """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE 'https://www.' || split_part(url, '//', 2) END AS clean,
       CASE WHEN page_id % 3 = 0 THEN url ELSE 'https://v.example.com/show/' || page_id END AS full_url
FROM pages""")
def url_forms(t):
    listed = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" \t"), "url", F.lit("_ _"))).otherwise(
        F.concat(F.element_at(F.split("url", "//"), 2), F.lit("__\n")))
    raw = F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.col("page_id").cast("string"))
    return t.pages.select("page_id", S.clean_url(listed, "example.").alias("clean"),
                          S.expand_id(raw, "https://v.example.com/show/").alias("full_url"))


@query("STR-9", """
SELECT page_id, regexp_replace(url, '/[^/]*$', '/') AS base,
       CASE page_id % 3 WHEN 0 THEN 'https://cdn.example.com/a.ts'
         WHEN 1 THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/root.ts'
         ELSE regexp_replace(url, '/[^/]*$', '/') || 'seg.ts?x=1' END AS joined
FROM pages""")
def joined_urls(t):
    ref = (F.when(F.col("page_id") % 3 == 0, "https://cdn.example.com/a.ts")
            .when(F.col("page_id") % 3 == 1, "/root.ts").otherwise("seg.ts?x=1"))
    return t.pages.select("page_id", S.base_url(F.col("url")).alias("base"),
                          S.join_url(F.col("url"), ref).alias("joined"))


# References and where they lead from /a/b/c/list.m3u8?old (RFC 3986).
_REFS = [("../s.ts", "/a/b/s.ts"), ("./s.ts?x=../y", "/a/b/c/s.ts?x=../y"), ("../../../../s.ts", "/s.ts"),
         ("x/./y/../s.ts", "/a/b/c/x/s.ts"), ("..", "/a/b/"), (".", "/a/b/c/"), ("/r/./q/../s.ts", "/r/s.ts"),
         ("?new", "/a/b/c/list.m3u8?new"), ("#part", "/a/b/c/list.m3u8?old#part"), ("..s.ts", "/a/b/c/..s.ts"),
         ("", "/a/b/c/list.m3u8?old")]


@query("STR-9", f"""
SELECT page_id, regexp_extract(url, '^https?://[^/?#]+') || {sql_pick([to for _, to in _REFS], 'page_id')} AS joined FROM pages""")
def dotted_urls(t):
    base = F.concat(F.regexp_extract("url", "^https?://[^/?#]+", 0), F.lit("/a/b/c/list.m3u8?old"))
    return t.pages.select("page_id", S.join_url(base, pick([ref for ref, _ in _REFS], F.col("page_id"))).alias("joined"))


@query("STR-10", f"""
WITH {INVENTORY}
SELECT path, 'item_' || doc_id
         || CASE WHEN path LIKE '%.info.json' THEN '.info' ELSE '' END AS stem,
       regexp_extract(path, '(\\.[a-zA-Z0-9]+)$', 1) AS ext,
       '/vault/' || source || '/' || lang AS parent, substr(path, 8) AS relative
FROM inventory""")
def path_parts(t):
    path = F.col("path")
    return inventory(t).select("path", S.stem(path).alias("stem"), S.extension(path).alias("ext"),
                               S.parent(path).alias("parent"),
                               S.relative_to(path, "/vault").alias("relative"))


@query("STR-1", f"""
WITH s AS (
  SELECT doc_id, text, regexp_replace(text, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS tight FROM documents),
c AS (
  SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(
           tight, '[<>:"/\\\\|?*]', '_', 'g'), '{_SPACE}+', ' ', 'g'), '^ | $', '', 'g') AS title FROM s)
SELECT doc_id,
       coalesce(nullif(regexp_replace(substr(title, 1, 100), '{_SPACE}+$', ''), ''), 'Unknown') AS title,
       md5(regexp_replace(text, '[<>:"/\\\\|?*]', '_', 'g')) AS plain_md5,
       md5(regexp_replace(regexp_replace(text, '[<>:"/\\\\|?*\\n\\r\\t]', '_', 'g'),
                          '^{_SPACE}+|{_SPACE}+$', '', 'g')) AS stripped_md5
FROM c""")
def safe_names(t):
    text = F.col("text")
    return t.documents.select("doc_id", S.safe_title(text).alias("title"),
                              F.md5(S.safe_name(text)).alias("plain_md5"),
                              F.md5(S.safe_name_stripped(text)).alias("stripped_md5"))


@query("STR-2", r"""
SELECT doc_id, md5(regexp_replace(text, '[^\x20-\x7E]', '', 'g')) AS ascii_md5,
       length(regexp_replace(text, '[^\x20-\x7E]', '', 'g')) AS n_ascii
FROM documents""")
def ascii_text(t):
    plain = S.ascii_only(F.col("text"))
    return t.documents.select("doc_id", F.md5(plain).alias("ascii_md5"),
                              F.length(plain).cast("bigint").alias("n_ascii"))


@query("STR-11", """
SELECT conv_id, turn, left('ERROR: ' || text, 200) AS message FROM conversations""")
def plain_messages(t):
    coloured = F.concat(F.lit("\x1b[0;31mERROR:\x1b[0m "), "text")
    return t.conversations.select("conv_id", "turn",
                                  F.left(S.strip_colour(coloured), F.lit(200)).alias("message"))


@query("STR-12", """
SELECT p_partkey, p_type || CASE WHEN p_size > 25 THEN ',' || p_brand ELSE '' END AS tags FROM part""")
def tag_names(t):
    def tag(col):
        return F.struct(col.alias("name"))
    tags = F.array(tag(F.col("p_type")), tag(F.when(F.col("p_size") > 25, F.col("p_brand"))))
    return t.part.select("p_partkey", S.tag_text(tags).alias("tags"))


@query("STR-13 WIN-3", """
SELECT p_partkey, p_name || '_' || p_size || 'P.mp4' AS out_name,
       printf('%03d', p_partkey) AS no3, printf('%05d', p_partkey) AS no5, printf('%07d', p_partkey) AS no7
FROM part""")
def output_names(t):
    quality = F.concat(F.col("p_size").cast("string"), F.lit("P"))
    no = F.col("p_partkey")
    return t.part.select("p_partkey", S.output_name(F.col("p_name"), quality, ext=".mp4").alias("out_name"),
                         S.padded(no).alias("no3"), S.padded(no, 5).alias("no5"), S.padded(no, 7).alias("no7"))


@query("DT-1", f"""
WITH {INVENTORY}
SELECT path, TIMESTAMP '2024-05-01 09:00:00' + to_seconds(CAST(
         ('0x' || substr(md5(path || '#7'), 1, 8))::BIGINT % 28801 AS BIGINT)) AS new_time
FROM inventory""")
def spread_times(t):
    at = D.spread_in_day(F.col("path"), "2024-05-01", time(9), time(17), seed=7)
    return inventory(t).select("path", at.cast("timestamp_ntz").alias("new_time"))


@query("DT-2", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, date_trunc('second', ts) AS parsed
FROM events""")
def stamp_texts(t):
    ts = F.col("ts")
    return t.events.select("event_id", D.stamp_text(ts).alias("stamp"), D.iso_text(ts).alias("iso"),
                           D.parse_stamp(D.stamp_text(ts)).cast("timestamp_ntz").alias("parsed"))


@query("DT-3 DT-4", """
SELECT event_id,
       CASE WHEN event_type = 'error' OR value = 0 THEN 'Unknown'
            ELSE printf('%02d:%02d', CAST(floor(value) AS BIGINT) // 60, CAST(floor(value) AS BIGINT) % 60) END
         AS clock,
       CASE WHEN event_id = 0 THEN '' WHEN event_id > 3600
              THEN (event_id // 3600) || 'h' || (event_id % 3600 // 60) || 'm'
            WHEN event_id > 60 THEN (event_id // 60) || 'm' || (event_id % 60) || 's'
            ELSE event_id || 's' END AS eta
FROM events""")
def duration_texts(t):
    seconds = F.when(F.col("event_type") != "error", F.col("value"))
    return t.events.select("event_id", D.minutes_seconds(seconds).alias("clock"),
                           D.eta_text(F.col("event_id")).alias("eta"))


@query("DT-5", """
WITH f AS (SELECT event_id, event_id * 37 * 40 AS ms FROM events)
SELECT event_id, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms % 3600000 // 60000,
                        ms % 60000 // 1000, ms % 1000) AS code
FROM f""")
def timecodes(t):
    return t.events.select("event_id", D.timecode(F.col("event_id") * 37, F.lit(25.0)).alias("code"))


@query("MTH-3 MTH-4", """
WITH p AS (
  SELECT event_id, value, CASE event_id % 4 WHEN 0 THEN 30000 / 1001.0::DOUBLE WHEN 1 THEN 25.0
           WHEN 2 THEN NULL ELSE value END AS fps FROM events)
SELECT event_id, fps, CASE WHEN event_id % 3 = 0 THEN event_id WHEN value > 0 AND fps > 0
         THEN CAST(floor(value * fps) AS BIGINT) END AS frames,
       CASE WHEN fps > 0 THEN event_id / fps ELSE 0 END AS seconds
FROM p""")
def frame_rates(t):
    text = (F.when(F.col("event_id") % 4 == 0, "30000/1001").when(F.col("event_id") % 4 == 1, "25")
             .when(F.col("event_id") % 4 == 2, "0/0")
             .otherwise(F.concat(F.col("value").cast("string"), F.lit("/1"))))
    staged = t.events.select("event_id", "value", N.frame_rate(text).alias("fps"))
    known = F.when(F.col("event_id") % 3 == 0, F.col("event_id"))
    return staged.select("event_id", "fps",
                         N.frame_count(known, F.col("value"), F.col("fps")).alias("frames"),
                         N.duration_from_frames(F.col("event_id"), F.col("fps")).alias("seconds"))


@query("JSN-3", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       coalesce(CAST(json_extract(props, '$.none') AS BIGINT), -1) AS none
FROM events""")
def json_props(t):
    props = J.parse(F.col("props"), "struct<k:bigint,none:bigint>")
    return t.events.select("event_id", props["k"].alias("k"),
                           F.coalesce(props["none"], F.lit(-1).cast("bigint")).alias("none"))


@query("JSN-3 DT-3", f"""
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'Unknown' ELSE p_name END AS title,
       CASE WHEN p_size % 3 = 0 THEN 'Unknown' ELSE (p_size * 16) || 'x' || (p_size * 9) END AS resolution,
       CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size * 16 END AS width, p_size * 9 AS height,
       p_retailprice AS duration, {sql_text('Unknown')} AS uploader, CAST(0 AS BIGINT) AS view_count
FROM part""")
def video_infos(t):
    size = F.col("p_size")
    body = F.to_json(F.struct(
        F.when(size % 5 != 0, F.col("p_name")).alias("title"),
        F.when(size % 3 != 0, size * 16).alias("width"), (size * 9).alias("height"),
        F.col("p_retailprice").alias("duration")))
    info = t.part.select("p_partkey", J.parse(body, J.VIDEO_INFO).alias("info"))
    return info.select("p_partkey", *J.video_info(F.col("info")))
