"""Sizes, speeds, frame rates and waits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Size units are powers of 1024, for ``kB`` and ``KiB`` alike.
UNIT_POWER = {"B": 0, "KB": 1, "MB": 2, "GB": 3}
SPEED_UNITS = {"B": 0, "kB": 1, "KiB": 1, "MB": 2, "MiB": 2, "GB": 3, "GiB": 3}
SPEED = r"(\d+(?:\.\d+)?)\s*(KiB|MiB|GiB|kB|MB|GB|B)/s"


def in_unit(n_bytes: Column, unit: str) -> Column:
    return n_bytes / float(1024 ** UNIT_POWER[unit])


def bytes_per_second(line: Column) -> Column:
    """Speed named in a log line; 0 when there is none."""
    amount = F.regexp_extract(line, SPEED, 1).try_cast("double")
    unit = F.regexp_extract(line, SPEED, 2)
    scale = F.lit(1.0)
    for name, power in SPEED_UNITS.items():
        scale = F.when(unit == name, F.lit(float(1024 ** power))).otherwise(scale)
    return F.coalesce(amount * scale, F.lit(0.0))


def frame_rate(text: Column) -> Column:
    """``30000/1001`` or ``25`` as a number; null on a zero denominator."""
    parts = F.split(text, "/")
    top = F.get(parts, F.lit(0)).try_cast("double")
    bottom = F.when(F.size(parts) > 1, F.get(parts, F.lit(1)).try_cast("double")).otherwise(F.lit(1.0))
    return F.try_divide(top, bottom)


def frame_count(nb_frames: Column, duration: Column, fps: Column) -> Column:
    """Stated frame count, else whole frames in ``duration`` if both are > 0."""
    derived = F.when((duration > 0) & (fps > 0), F.floor(duration * fps).cast("bigint"))
    return F.coalesce(nb_frames, derived)


def duration_from_frames(frames: Column, fps: Column) -> Column:
    return F.when(fps > 0, frames / fps).otherwise(F.lit(0.0))


def backoff(attempt: Column, base: int = 1, ceiling: int | None = None) -> Column:
    """``base * 2^attempt`` seconds, at most ``ceiling``."""
    wait = (F.lit(base) * F.pow(F.lit(2.0), attempt)).cast("bigint")
    return wait if ceiling is None else F.least(F.lit(ceiling).cast("bigint"), wait)


def linear_wait(attempt: Column, step: int = 5) -> Column:
    return (attempt * step).cast("bigint")
