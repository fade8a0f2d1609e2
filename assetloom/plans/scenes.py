"""Scene intervals from per-frame change scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assetloom.functions import dates as D, strings as S
from assetloom.operators.joins import keyed_join
from assetloom.operators.metrics import scene_counts
from assetloom.operators.ordering import cut_groups
from assetloom.session import materialize


def number_scenes(frames: DataFrame, video: str, order: list[str], score: str,
                  threshold: float = 30.0, min_len: int = 0,
                  pieces: int | None = None) -> DataFrame:
    """Add ``scene_no`` (from 1); a frame scoring ``threshold`` or more starts a scene.

    The first frame of a video starts scene 1 whatever it scores. With
    ``min_len`` a frame that follows another such frame by fewer frames starts
    none (``order[0]`` is then the frame number).
    """
    cut = F.coalesce(F.col(score) >= threshold, F.lit(False))
    last_cut = {"_cut_before": F.when(cut, F.col(order[0]))} if min_len > 0 else {}
    groups = cut_groups(frames, [video], order, pieces).running(sums={"_nth": F.lit(1)}, earlier=last_cut)
    if min_len > 0:
        cut = cut & ~F.coalesce(F.col(order[0]) - F.col("_cut_before") < min_len, F.lit(False))
    starts = F.when(cut & (F.col("_nth") > 1), 1).otherwise(0)
    return (groups.running(sums={"_cuts": starts}).rows()
            .select(*frames.columns, (F.col("_cuts") + 1).cast("bigint").alias("scene_no")))


def scene_intervals(numbered: DataFrame, video: str = "video_id",
                    frame: str = "frame_no", fps: str = "fps") -> DataFrame:
    """First and last frame per scene, with the start and end timecodes."""
    spans = numbered.groupBy(video, "scene_no").agg(
        F.min(frame).alias("first_frame"), F.max(frame).alias("last_frame"),
        F.max(fps).alias("_fps"))
    return spans.select(
        video, "scene_no", "first_frame", "last_frame",
        D.timecode(F.col("first_frame"), F.col("_fps")).alias("start_code"),
        D.timecode(F.col("last_frame") + 1, F.col("_fps")).alias("end_code"))


def split_plan(scenes: DataFrame, video: str = "video_id", ext: str = ".mp4") -> DataFrame:
    """Output name per scene of the videos that have several.

    The intervals are written once: they are counted and joined.
    """
    placed = materialize(scenes, "scenes")
    several = scene_counts(placed, video).where("multi_scene").select(video, "n_scenes")
    name = S.output_name(F.col(video).cast("string"), F.lit("scene"),
                         S.padded(F.col("scene_no")), ext=ext)
    return (keyed_join(placed, several, [video], "inner")
            .withColumn("out_name", name))
