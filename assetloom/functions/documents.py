"""JSON payload shapes and their columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Payload shapes as DDL.
PROBE = """struct<streams:array<struct<codec_type:string,avg_frame_rate:string,
nb_frames:string,duration:string>>>""".replace("\n", "")
ASSET_PAGE = """struct<data:array<struct<attributes:struct<id:string,
description:string,tags:array<struct<name:string>>,video:struct<download_link:string>,
image:struct<download_link:string>>>>>""".replace("\n", "")
CLIP_PAGE = """struct<data:struct<clipList:struct<exactResults:array<struct<id:string,
clipName:string,clipPath:string,duration:bigint,width:int,height:int,orientation:string,
availableFormats:array<struct<id:string,displayName:string>>>>>>>""".replace("\n", "")
MOMENT = """struct<data:struct<moment:struct<videoInfo:struct<videoTitle:string,
definitions:array<struct<defName:string,url:string,m3u8:string>>>>>>""".replace("\n", "")
LEDGER_MAP = """map<string,struct<url:string,status:int,title:string,
download_time:string,last_updated:string>>""".replace("\n", "")
VIDEO_INFO = """struct<title:string,width:int,height:int,duration:double,
uploader:string,view_count:bigint>""".replace("\n", "")


def parse(body: Column, shape: str) -> Column:
    """JSON text to ``shape``; malformed text gives null."""
    return F.from_json(body, shape, {"mode": "PERMISSIVE"})


def unwrap_jsonp(body: Column) -> Column:
    """``name(...)`` gives the part in brackets; other text stays."""
    inner = F.regexp_extract(body, r"(?s)^\w+\((.*)\)\s*;?\s*$", 1)
    return F.when(body.startswith("jQuery"), F.nullif(inner, F.lit(""))).otherwise(body)


def first_video_stream(probe: Column) -> Column:
    """First video stream of a parsed probe, null if there is none."""
    videos = F.filter(probe["streams"], lambda s: s["codec_type"] == "video")
    return F.try_element_at(videos, F.lit(1))


def best_definition(moment: Column) -> Column:
    """First listed definition, null for an empty list."""
    return F.try_element_at(moment["data"]["moment"]["videoInfo"]["definitions"], F.lit(1))


def video_info(info: Column) -> list[Column]:
    """Video info columns with their defaults."""
    width = F.coalesce(info["width"], F.lit(0))
    height = F.coalesce(info["height"], F.lit(0))
    size = F.when((width > 0) & (height > 0), F.concat_ws("x", width.cast("string"),
                                                          height.cast("string")))
    return [
        F.coalesce(F.nullif(info["title"], F.lit("")), F.lit("Unknown")).alias("title"),
        F.coalesce(size, F.lit("Unknown")).alias("resolution"),
        width.alias("width"), height.alias("height"),
        F.coalesce(info["duration"], F.lit(0.0)).alias("duration"),
        F.coalesce(F.nullif(info["uploader"], F.lit("")), F.lit("Unknown")).alias("uploader"),
        F.coalesce(info["view_count"], F.lit(0).cast("bigint")).alias("view_count"),
    ]
