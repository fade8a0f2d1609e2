"""Eligibility rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_
import re

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.functions import strings as S
from assetloom.operators.ordering import cut_groups

# Extension sets, folders to leave out, clean-up patterns.
VIDEO_EXTENSIONS = (".mp4", ".avi", ".mov", ".mkv", ".m4v", ".wmv", ".rmvb", ".dat", ".vob")
SYSTEM_FOLDERS = ("$RECYCLE.BIN", "System Volume Information", "Windows",
                  "Program Files", "Program Files (x86)")
TEMP_GLOBS = ("*.part", "*.ytdl", "*.temp", "*.tmp", "*-Frag*", "*.part-Frag*",
              "*.f*-Frag*", "*_t[0-9]*-Frag*")
FRAGMENT_GLOBS = ("*.f[0-9]*", "*-Frag[0-9]*")
UNWANTED_GLOBS = ("*.description", "*.info.json", "*.annotations.xml", "*.live_chat.json",
                  "*.webp", "*.jpg", "*.png", "*.srt", "*.vtt", "*.ass", "*.ssa", "*.xml",
                  "*.json")


def has_extension(path: Column, extensions: Iterable[str] = VIDEO_EXTENSIONS) -> Column:
    """Extension in the set, in any case."""
    return F.lower(S.extension(path)).isin(*[e.lower() for e in extensions])


def outside_folders(path: Column, names: Iterable[str] = SYSTEM_FOLDERS) -> Column:
    """Path contains none of the texts."""
    return ~reduce(or_, (path.contains(n) for n in names))


def outside_prefix(path: Column, dest: str) -> Column:
    """Path does not lie under ``dest``; ``/out`` does not hide ``/out2``."""
    return ~path.startswith(dest.rstrip("/") + "/")


def duration_between(duration: Column, low: float = 5, high: float = 120) -> Column:
    return duration.between(low, high)


def any_keyword(text: Column, keywords: Iterable[str]) -> Column:
    """Text holds one of the keywords, in any case. Keywords are plain text."""
    lowered = F.lower(text)
    return reduce(or_, (lowered.contains(k.lower()) for k in keywords))


def split_by_height(df: DataFrame, height: str, minimum: int) -> tuple[DataFrame, DataFrame]:
    """Rows of at least ``minimum`` and the rest; null and 0 go to the rest."""
    enough = F.coalesce(F.col(height) >= minimum, F.lit(False))
    return df.where(enough), df.where(~enough)


def split_required(df: DataFrame, *required: str) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields and the rejects."""
    missing = reduce(or_, (F.col(c).isNull() for c in required))
    return df.where(~missing), df.where(missing)


def probe_is_sane(fps: Column, frames: Column, duration: Column) -> Column:
    return F.coalesce((fps > 0) & (frames > 0) & (duration > 0), F.lit(False))


def glob_pattern(globs: Iterable[str]) -> str:
    """One regular expression for a list of globs."""
    def one(glob: str) -> str:
        parts = re.split(r"(\*|\?|\[[^\]]*\])", glob)
        named = {"*": ".*", "?": "."}
        return "".join(named.get(p, p if p.startswith("[") else re.escape(p).replace("\\-", "-"))
                       for p in parts)
    return "(?s)^(?:" + "|".join(one(g) for g in globs) + ")$"


def junk_label(path: Column, keep_fragments: bool = False) -> Column:
    """``temp``, ``unwanted`` or null, judged on the file name."""
    temp = TEMP_GLOBS if keep_fragments else TEMP_GLOBS + FRAGMENT_GLOBS
    name = S.base_name(path)
    return (F.when(name.rlike(glob_pattern(temp)), F.lit("temp"))
             .when(name.rlike(glob_pattern(UNWANTED_GLOBS)), F.lit("unwanted")))


def modified_within(mtime: Column, now: Column, seconds: int = 300) -> Column:
    return mtime > now - F.expr(f"INTERVAL {int(seconds)} SECONDS")


def trim_is_feasible(duration: Column, head: float, tail: float) -> Column:
    return duration - head - tail > 0


def is_claimable(state: Column, host: Column, me: str) -> Column:
    """Queued for this host, or pending, or failed and retryable (canonical states)."""
    return ((state == "queued") & (host == me)) | state.isin("pending", "retry")


def passed_probe(probes: DataFrame, key: str = "path", ok: str = "ok",
                 attempts: int = 3) -> DataFrame:
    """Keys with a good probe among their first ``attempts`` attempts."""
    return (probes.where(F.col("attempt") <= attempts).groupBy(key)
                  .agg(F.bool_or(ok).alias("valid")).where("valid").select(key))


def stable_flags(snapshots: DataFrame, checks: int = 4, key: str = "path",
                 ts: Sequence[str] = ("snapshot_ts",), size: str = "length",
                 pieces: int | None = None) -> DataFrame:
    """Add ``size_change`` (against the previous snapshot) and ``stable``: the
    size is not 0 and has been the same for ``checks`` checks in a row."""
    moved = F.when(~F.col(size).eqNullSafe(F.col("_before")) | (F.col("_seen") == 1),
                   F.col("_seen"))
    traced = (cut_groups(snapshots, [key], ts, pieces)
              .running(sums={"_seen": F.lit(1)}, lags={"_before": F.col(size)})
              .running(maxes={"_moved": moved}).rows())
    return traced.select(
        *snapshots.columns,
        (F.col(size) - F.col("_before")).alias("size_change"),
        (F.coalesce(F.col(size) > 0, F.lit(False))
         & (F.col("_seen") - F.col("_moved") >= checks)).alias("stable"))


def release_gate(df: DataFrame, size: str, trigger_bytes: float, in_window: Column) -> DataFrame:
    """All rows if their total size reaches the trigger or the window is open,
    else none. The total is a scalar subquery: one row, no join."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("total")).scalar()
    return df.where((total >= trigger_bytes) | in_window)
