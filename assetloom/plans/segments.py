"""Cut plans for assets of known duration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.functions import strings as S


def fixed_segments(assets: DataFrame, duration: str, *, threshold: float = 180,
                   step: float = 90, min_duration: float | None = None,
                   name: Column | None = None, ext: str = ".mp4") -> DataFrame:
    """Parts of ``step`` seconds while at least ``threshold`` remain, then the rest.

    Closed form, one row in and its parts out, no shuffle. Assets shorter than
    ``min_duration`` (default ``threshold``) have no parts.
    """
    if not (step > 0 and threshold >= step):
        raise ValueError("need threshold >= step > 0")
    shortest = threshold if min_duration is None else min_duration
    d = F.col(duration)
    full = F.greatest(F.floor((d - threshold) / F.lit(float(step))) + 1, F.lit(0))
    parts = (assets.where((d >= shortest) & (d > 0))
                   .withColumn("_full", full)
                   .withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_full")))))
    start = F.col("_i") * float(step)
    length = F.when(F.col("_i") < F.col("_full"), F.lit(float(step))).otherwise(d - start)
    planned = parts.select(
        *assets.columns, (F.col("_i") + 1).alias("seg_no"),
        start.alias("start"), length.alias("length")).where(F.col("length") > 0)
    if name is None:
        return planned
    return planned.withColumn(
        "seg_name", S.output_name(name, S.padded(F.col("seg_no")), ext=ext))


def trim_plan(assets: DataFrame, duration: str, head: float = 60, tail: float = 60,
              name: Column | None = None) -> DataFrame:
    """Start and length without head and tail; assets too short are left out."""
    length = F.col(duration) - head - tail
    plan = assets.where(length > 0).withColumns(
        {"start": F.lit(float(head)), "length": length})
    if name is None:
        return plan
    return plan.withColumn("out_name", F.concat(name, F.lit("_no_head_tail.mp4")))
