"""JSON payloads that Spark derives from the driver tables."""

from pyspark.sql import functions as F

from assetloom.functions import documents as J
from assetloom.plans import ingest
from assetloom.registry.base import query


def _asset_pages(t):
    """One payload page per line item, holding that one asset; a return flag of
    ``A`` stands for an asset without a link, a line status of ``O`` with a tax
    of 0 for a failed request."""
    item = F.struct(F.struct(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.array(F.struct(F.col("l_returnflag").alias("name")),
                F.struct(F.col("l_linestatus").alias("name"))).alias("tags"),
        F.struct(F.when(F.col("l_returnflag") != "A", F.concat(
            F.lit("https://v.example.com/"), F.col("l_partkey").cast("string"), F.lit(".mp4")))
            .alias("download_link")).alias("video")).alias("attributes"))
    status = F.when((F.col("l_linestatus") == "O") & (F.col("l_tax") == 0), 500).otherwise(200)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                             F.concat(F.lit("kw"), F.col("l_suppkey").cast("string")).alias("keyword"),
                             status.alias("http_status"),
                             F.to_json(F.struct(F.array(item).alias("data"))).alias("body"))


@query("SRC-7 STR-12 JSN-3 FLT-17", """
SELECT l_orderkey, l_linenumber, 'kw' || l_suppkey AS category,
       l_orderkey || '-' || l_linenumber AS datal_id, l_returnflag || ',' || l_linestatus AS tags,
       CASE WHEN l_returnflag <> 'A' THEN 'https://v.example.com/' || l_partkey || '.mp4' END AS download_link
FROM lineitem WHERE NOT (l_linestatus = 'O' AND l_tax = 0)""")
def asset_rows(t):
    return ingest.asset_rows(_asset_pages(t)).select(
        "l_orderkey", "l_linenumber", "category", "datal_id", "tags", "download_link")


@query("JOB-13 JN-1 LED-5 SRC-7 STR-12", """
WITH a AS (
  SELECT 'https://v.example.com/' || l_partkey || '.mp4' AS download_link, 'kw' || l_suppkey AS category,
         l_returnflag || ',' || l_linestatus AS tags, l_orderkey, l_linenumber, l_suppkey, l_quantity
  FROM lineitem WHERE NOT (l_linestatus = 'O' AND l_tax = 0) AND l_returnflag <> 'A'),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY download_link
     ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity, category, tags) AS n FROM a)
SELECT download_link, category, tags, false AS download_state FROM firsts
WHERE n = 1 AND download_link NOT IN (
  SELECT 'https://v.example.com/' || p_partkey || '.mp4' FROM part WHERE p_size < 10)""")
def discovery_ingest(t):
    ledger = t.part.where("p_size < 10").select(
        F.concat(F.lit("https://v.example.com/"), F.col("p_partkey").cast("string"), F.lit(".mp4"))
         .alias("download_link"))
    new, _ = ingest.discover(_asset_pages(t), ledger, ["l_orderkey", "l_linenumber", "l_suppkey",
                                                       "l_quantity", "category", "tags"])
    return new.select("download_link", "category", "tags", "download_state")


@query("SRC-7 JSN-3 FLT-3", """
SELECT p_partkey, 'c' || p_partkey AS id, p_name AS "clipName", CAST(p_size * 1000 AS BIGINT) AS duration,
       p_size * 16 AS width FROM part WHERE p_size * 1000 >= 10000""")
def clip_rows(t):
    clip = F.struct(
        F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("clipName"), (F.col("p_size") * 1000).alias("duration"),
        (F.col("p_size") * 16).alias("width"))
    body = F.to_json(F.struct(F.struct(F.struct(F.array(clip).alias("exactResults"))
                                       .alias("clipList")).alias("data")))
    return ingest.clip_rows(t.part.select("p_partkey", body.alias("body")), min_duration=10_000).select(
        "p_partkey", "id", "clipName", "duration", "width")


@query("SRC-7 STR-12", """
SELECT p_partkey, CAST(i AS INTEGER) AS item_no, CASE WHEN i = 1 THEN 'image' ELSE 'video' END AS kind,
       'https://i.example.com/' || p_partkey || CASE WHEN i = 1 THEN '.jpeg' ELSE '.mp4' END AS download_link,
       CASE WHEN p_size % 2 = 0 AND i = 1 THEN p_name ELSE '' END AS description, p_brand AS tags
FROM part, (SELECT unnest([0, 1]) AS i) WHERE i = 1 OR p_size % 3 = 0""")
def image_rows(t):
    """Pages whose items have an image, a video (which counts first), both, or neither."""
    link = lambda end: F.concat(F.lit("https://i.example.com/"), F.col("p_partkey").cast("string"), F.lit(end))
    source = lambda end: F.struct(link(end).alias("download_link"))
    tags = F.array(F.struct(F.col("p_brand").alias("name"))).alias("tags")
    first = F.struct(tags, F.when(F.col("p_size") % 3 == 0, source(".mp4")).alias("video"),
                     F.when(F.col("p_size") % 3 == 0, source(".png")).alias("image"), F.lit(None).cast("string").alias("description"))
    second = F.struct(tags, F.lit(None).cast("struct<download_link:string>").alias("video"), source(".jpeg").alias("image"),
                      F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("description"))
    body = F.to_json(F.struct(F.array(*(F.struct(x.alias("attributes")) for x in (first, second))).alias("data")))
    pages = t.part.select("p_partkey", F.lit("kw").alias("keyword"), body.alias("body"))
    return ingest.asset_rows(pages).where("download_link IS NOT NULL").select(
        "p_partkey", "item_no", "kind", "download_link", "description", "tags")


@query("SRC-7 JSN-3", """
SELECT p_partkey, 'c' || p_partkey AS id, CAST(i AS INTEGER) AS format_no, 'f' || i AS format_id,
       p_type || ' ' || i AS format_name
FROM (SELECT *, unnest(range(p_size % 4)) AS i FROM part)""")
def clip_formats(t):
    formats = F.transform(F.slice(F.sequence(F.lit(0), F.lit(3)), F.lit(1), F.col("p_size") % 4), lambda i: F.struct(
        F.concat(F.lit("f"), i.cast("string")).alias("id"), F.concat("p_type", F.lit(" "), i.cast("string")).alias("displayName")))
    clip = F.struct(F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("id"), formats.alias("availableFormats"))
    body = F.to_json(F.struct(F.struct(F.struct(F.array(clip).alias("exactResults")).alias("clipList")).alias("data")))
    clips = ingest.clip_rows(t.part.select("p_partkey", body.alias("body")))
    return ingest.clip_formats(clips).select("p_partkey", "id", "format_no", "format_id", "format_name")


@query("JSN-2 MTH-3 MTH-4 FLT-13 JSN-3", """
WITH p AS (
  SELECT event_id, event_type, value, CASE event_type WHEN 'click' THEN 30000 / 1001.0::DOUBLE
           WHEN 'view' THEN 25.0 WHEN 'signup' THEN NULL WHEN 'purchase' THEN 24.0 END AS fps,
         CASE WHEN event_type <> 'error' THEN value END AS duration FROM events),
q AS (
  SELECT event_id, fps, duration, CASE WHEN event_type = 'click' THEN event_id
           WHEN duration > 0 AND fps > 0 THEN CAST(floor(duration * fps) AS BIGINT) END AS frames FROM p)
SELECT event_id, fps, frames, duration, coalesce(fps > 0 AND frames > 0 AND duration > 0, false) AS sane
FROM q""")
def probe_facts(t):
    kind = F.col("event_type")
    rate = (F.when(kind == "click", "30000/1001").when(kind == "view", "25").when(kind == "signup", "0/0")
             .otherwise("24/1"))
    sound = F.struct(F.lit("audio").alias("codec_type"), F.lit("0/0").alias("avg_frame_rate"),
                     F.lit(None).cast("string").alias("nb_frames"), F.lit("9").alias("duration"))
    video = F.struct(F.lit("video").alias("codec_type"), rate.alias("avg_frame_rate"),
                     F.when(kind == "click", F.col("event_id").cast("string")).alias("nb_frames"),
                     F.col("value").cast("string").alias("duration"))
    body = F.when(kind == "error", F.lit('{"streams": [')).otherwise(
        F.to_json(F.struct(F.array(sound, video).alias("streams"))))
    return ingest.probe_facts(t.events.select("event_id", body.alias("body"))).select(
        "event_id", "fps", "frames", "duration", "sane")


_QUALITIES = "['1080P', '蓝光4M', '流畅', 'unheard of']"


def _moments(t):
    quality = F.element_at(F.array(*(F.lit(q) for q in ("1080P", "蓝光4M", "流畅", "unheard of"))),
                           (F.col("p_partkey") % 4 + 1).cast("int"))
    spare = F.struct(F.lit("240P").alias("defName"), F.lit("low").alias("url"), F.lit("low").alias("m3u8"))
    best = F.struct(quality.alias("defName"), F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("url"),
                    F.lit("m").alias("m3u8"))
    listed = F.when(F.col("p_size") < 5, F.array(best).cast("array<struct<defName:string,url:string,m3u8:string>>")
                    ).otherwise(F.array(best, spare))
    info = F.struct(F.col("p_name").alias("videoTitle"), listed.alias("definitions"))
    body = F.to_json(F.struct(F.struct(F.struct(info.alias("videoInfo")).alias("moment")).alias("data")))
    wrapped = (F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("jQuery12_3("), body, F.lit(")")))
                .when(F.col("p_size") % 3 == 1, body).otherwise(F.lit("jQuery(<junk")))
    return t.part.select("p_partkey", wrapped.alias("body"))


@query("JSN-1 ORD-4 JN-4 JSN-3 SRC-7", f"""
WITH m AS (SELECT p_partkey, p_size, p_name, {_QUALITIES}[p_partkey % 4 + 1] AS quality FROM part)
SELECT p_partkey, p_name AS title, quality, 'u' || p_partkey AS mp4_url,
       CASE quality WHEN '1080P' THEN 1080 WHEN '蓝光4M' THEN 480 ELSE 360 END AS resolution
FROM m WHERE p_size % 3 <> 2 AND quality <> 'unheard of'""")
def best_moments(t):
    known, _ = ingest.best_moments(_moments(t))
    return known.select("p_partkey", "title", "quality", "mp4_url", "resolution")


@query("JSN-1 JN-4", f"""
SELECT p_partkey, CASE WHEN p_size % 3 <> 2 THEN {_QUALITIES}[p_partkey % 4 + 1] END AS quality
FROM part WHERE p_size % 3 = 2 OR p_partkey % 4 = 3""")
def rejected_moments(t):
    _, rejects = ingest.best_moments(_moments(t))
    return rejects.select("p_partkey", "quality")


@query("JSN-1", """
SELECT p_partkey, CASE WHEN p_size % 3 <> 2 THEN p_name END AS title FROM part""")
def jsonp_titles(t):
    body = J.parse(J.unwrap_jsonp(F.col("body")), J.MOMENT)
    return _moments(t).select("p_partkey", body["data"]["moment"]["videoInfo"]["videoTitle"].alias("title"))
