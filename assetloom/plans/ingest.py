"""Landed API payloads to asset rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.functions import documents as J, numbers as N, strings as S
from assetloom.operators.filters import probe_is_sane, split_required
from assetloom.operators.joins import QUALITY_HEIGHT, map_values
from assetloom.operators.ledger import insert_ignore


def asset_rows(pages: DataFrame, body: str = "body", keyword: str = "keyword") -> DataFrame:
    """One row per listed asset: id, tags, link of the video or else of the image and which of them it is (``kind``),
    description (empty if there is none), and the keyword as category.

    Bad pages (``http_status`` other than 200, malformed JSON) give no rows.
    """
    keep = [c for c in pages.columns if c not in (body, keyword, "http_status")]
    item = F.col("_item")["attributes"]
    video, image = item["video"]["download_link"], item["image"]["download_link"]
    good = pages.where(F.col("http_status") == 200) if "http_status" in pages.columns else pages
    return (good.select(*keep, keyword, F.posexplode(
                J.parse(F.col(body), J.ASSET_PAGE)["data"]).alias("item_no", "_item"))
            .select(*keep, F.col(keyword).alias("category"), "item_no",
                    item["id"].alias("datal_id"), S.tag_text(item["tags"]).alias("tags"),
                    F.coalesce(video, image).alias("download_link"),
                    F.when(video.isNotNull(), "video").when(image.isNotNull(), "image").alias("kind"),
                    F.coalesce(item["description"], F.lit("")).alias("description")))


def discover(pages: DataFrame, ledger: DataFrame, first: list[str],
             link: str = "download_link") -> tuple[DataFrame, DataFrame]:
    """New ledger rows from payload pages, and the items without a link.

    ``first`` orders copies of a link; the first one is taken.
    """
    whole, rejects = split_required(asset_rows(pages), link)
    new = insert_ignore(ledger, whole, link, first)
    return new.withColumn("download_state", F.lit(False)), rejects


def clip_rows(pages: DataFrame, body: str = "body", min_duration: int | None = None) -> DataFrame:
    """Clips of a search payload, at least ``min_duration`` long if stated."""
    keep = [c for c in pages.columns if c != body]
    clips = pages.select(*keep, F.inline(
        J.parse(F.col(body), J.CLIP_PAGE)["data"]["clipList"]["exactResults"]))
    return clips if min_duration is None else clips.where(F.col("duration") >= min_duration)


def clip_formats(clips: DataFrame) -> DataFrame:
    """One row per format that a clip of ``clip_rows`` is offered in: format_no, format_id, format_name. Clips
    without formats have none."""
    keep = [c for c in clips.columns if c != "availableFormats"]
    return clips.select(*keep, F.posexplode("availableFormats").alias("format_no", "_f")).select(
        *keep, "format_no", F.col("_f.id").alias("format_id"), F.col("_f.displayName").alias("format_name"))


def probe_facts(probes: DataFrame, body: str = "body") -> DataFrame:
    """fps, frames and duration of the first video stream, and whether all are sane."""
    stream = J.first_video_stream(J.parse(F.col(body), J.PROBE))
    keep = [c for c in probes.columns if c != body]
    staged = probes.select(*keep, stream.alias("_s")).select(
        *keep, N.frame_rate(F.col("_s.avg_frame_rate")).alias("fps"),
        F.col("_s.nb_frames").try_cast("bigint").alias("_frames"),
        F.col("_s.duration").try_cast("double").alias("duration"))
    frames = N.frame_count(F.col("_frames"), F.col("duration"), F.col("fps"))
    return staged.select(
        *keep, "fps", frames.alias("frames"), "duration",
        probe_is_sane(F.col("fps"), frames, F.col("duration")).alias("sane"))


def best_moments(responses: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """First listed quality of each JSONP response with its height, and the rejects
    (no definition or unknown quality name)."""
    parsed = J.parse(J.unwrap_jsonp(F.col(body)), J.MOMENT)
    keep = [c for c in responses.columns if c != body]
    best: Column = J.best_definition(F.col("_m"))
    rows = responses.select(*keep, parsed.alias("_m")).select(
        *keep, F.col("_m.data.moment.videoInfo.videoTitle").alias("title"),
        best["defName"].alias("quality"), best["url"].alias("mp4_url"),
        best["m3u8"].alias("m3u8_url"))
    return map_values(rows, "quality", QUALITY_HEIGHT, "resolution")
