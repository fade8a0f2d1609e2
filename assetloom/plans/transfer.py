"""Which files may be moved, and which match a duration range."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.functions import strings as S
from assetloom.operators import filters as E
from assetloom.operators.joins import drop_existing_names, keep_listed, keyed_join


def latest_stable(snapshots: DataFrame, checks: int = 4, key: str = "path",
                  ts: Sequence[str] = ("snapshot_ts",), size: str = "length",
                  pieces: int | None = None) -> DataFrame:
    """Files that are stable at their last snapshot."""
    flagged = E.stable_flags(snapshots, checks, key, ts, size, pieces)
    last = F.max_by(F.struct(size, "stable"), F.struct(*ts)).alias("_last")
    return flagged.groupBy(key).agg(last).where("_last.stable").select(key, f"_last.{size}")


def eligible_transfers(snapshots: DataFrame, probes: DataFrame, target: DataFrame, *,
                       trigger_bytes: float, in_window: Column,
                       extensions: Iterable[str] = E.VIDEO_EXTENSIONS, checks: int = 4,
                       ts: Sequence[str] = ("snapshot_ts",),
                       pieces: int | None = None) -> DataFrame:
    """Files to move now: size or window gate, extension, stable size, good
    probe, name not taken at the target. The gate counts all files of the folder
    at their last snapshot."""
    sizes = snapshots.groupBy("path").agg(
        F.max_by("length", F.struct(*ts)).alias("length"))
    total = sizes.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total")).scalar()
    media = snapshots.where(E.has_extension(F.col("path"), extensions))
    stable = latest_stable(media, checks, ts=ts, pieces=pieces)
    valid = keep_listed(stable, E.passed_probe(probes), ["path"])
    open_now = valid.where((total >= trigger_bytes) | in_window)
    return drop_existing_names(open_now, target, S.base_name(F.col("path")),
                               S.base_name(F.col("path")))


def select_by_duration(files: DataFrame, probes: DataFrame, low: float = 5, high: float = 120,
                       extensions: Iterable[str] = E.VIDEO_EXTENSIONS) -> DataFrame:
    """Media files whose probed duration lies in the range; unprobed ones drop out.
    Both tables have one row per path."""
    media = files.where(E.has_extension(F.col("path"), extensions))
    return (keyed_join(media, probes.select("path", "duration"), ["path"], "inner")
            .where(E.duration_between(F.col("duration"), low, high)))
