"""Times, durations and timecodes."""

from __future__ import annotations

from datetime import time

from pyspark.sql import Column, functions as F

# Fixed value: text form of ledger timestamps.
STAMP = "yyyy-MM-dd HH:mm:ss"


def stamp_text(ts: Column) -> Column:
    return F.date_format(ts, STAMP)


def parse_stamp(text: Column) -> Column:
    """Ledger text to timestamp; anything else gives null."""
    return F.try_to_timestamp(text, F.lit(STAMP))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def seconds_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def in_day_window(ts: Column, start: time, end: time) -> Column:
    """Time of day within [start, end), across midnight if start > end; always
    false when they are equal."""
    at = seconds_of_day(ts)
    lo = start.hour * 3600 + start.minute * 60 + start.second
    hi = end.hour * 3600 + end.minute * 60 + end.second
    return (at >= lo) | (at < hi) if lo > hi else (at >= lo) & (at < hi)


def spread_in_day(key: Column, day: str, start: time, end: time, seed: int = 0) -> Column:
    """A second of ``day`` within [start, end], both included, fixed by ``key``."""
    lo = start.hour * 3600 + start.minute * 60 + start.second
    hi = end.hour * 3600 + end.minute * 60 + end.second
    if hi < lo:
        raise ValueError("end lies before start")
    drawn = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"#{seed}"))), 1, 8), 16, 10).cast("bigint")
    offset = F.lit(lo) + F.pmod(drawn, F.lit(hi - lo + 1))
    return F.timestamp_seconds(F.unix_timestamp(F.lit(day), "yyyy-MM-dd") + offset)


def minutes_seconds(seconds: Column) -> Column:
    """``MM:SS``; 0 or null gives ``Unknown``."""
    whole = F.floor(seconds)
    text = F.format_string("%02d:%02d", F.floor(whole / 60).cast("bigint"), whole % 60)
    return F.when(F.coalesce(seconds, F.lit(0)) == 0, F.lit("Unknown")).otherwise(text)


def eta_seconds(line: Column) -> Column:
    """``ETA m:s`` or ``ETA Ns`` as seconds; 0 when there is none."""
    clock = r"ETA\s+(\d+):(\d+)"
    by_clock = (F.regexp_extract(line, clock, 1).try_cast("bigint") * 60
                + F.regexp_extract(line, clock, 2).try_cast("bigint"))
    by_seconds = F.regexp_extract(line, r"ETA\s+(\d+)s", 1).try_cast("bigint")
    return F.coalesce(by_clock, by_seconds, F.lit(0).cast("bigint"))


def eta_text(seconds: Column) -> Column:
    """``1h2m``, ``3m4s`` or ``5s``; empty for 0 or null."""
    s = seconds.cast("bigint")
    return (F.when(s > 3600, F.format_string("%dh%dm", F.floor(s / 3600),
                                             F.floor((s % 3600) / 60)))
             .when(s > 60, F.format_string("%dm%ds", F.floor(s / 60), s % 60))
             .when(s > 0, F.format_string("%ds", s))
             .otherwise(F.lit("")))


def timecode(frame: Column, fps: Column) -> Column:
    """Frame position as ``HH:MM:SS.mmm``."""
    ms = F.round(F.try_divide(frame * 1000, fps)).cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d.%03d", F.floor(ms / 3_600_000), F.floor((ms % 3_600_000) / 60_000),
        F.floor((ms % 60_000) / 1000), ms % 1000)
