"""Counts, rates and roll-ups. All are partial aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.functions import strings as S
from assetloom.operators.ordering import cut_groups


def status_summary(ledger: DataFrame, done: Column, group: Sequence[str] = ()) -> DataFrame:
    """total, done, pending and percent done (0 for an empty ledger)."""
    n_done = F.count_if(done)
    total = F.count(F.lit(1))
    return ledger.groupBy(*group).agg(
        total.alias("total"), n_done.alias("done"), (total - n_done).alias("pending"),
        F.coalesce(F.try_divide(n_done * 100.0, total), F.lit(0.0)).alias("done_percent"))


def outcome_counts(runs: DataFrame, ok: str, group: Sequence[str] = ()) -> DataFrame:
    return runs.groupBy(*group).agg(
        F.count_if(F.col(ok)).alias("success"), F.count_if(~F.col(ok)).alias("failed"),
        F.count(F.lit(1)).alias("total"))


def failed_items(runs: DataFrame, ok: str, item: str) -> DataFrame:
    """The failed items as rows, not as one list."""
    return runs.where(~F.col(ok)).select(item)


def tree_size(files: DataFrame, path: str = "path", size: str = "length") -> DataFrame:
    """Bytes and GB per folder."""
    total = F.sum(size)
    return files.groupBy(S.parent(F.col(path)).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), total.alias("bytes"),
        (total / float(1024 ** 3)).alias("gb"))


def accept_by_failures(segments: DataFrame, key: Sequence[str], ok: Column,
                       ratio: float = 0.1) -> DataFrame:
    """Per asset: segment counts, ``accepted`` (failures within ``ratio``),
    ``complete`` (none failed) and the outcome all / partial / none."""
    failed, good, total = F.count_if(~ok), F.count_if(ok), F.count(F.lit(1))
    outcome = (F.when((failed == 0) & (good > 0), "all").when(good > 0, "partial")
                .otherwise("none"))
    return segments.groupBy(*key).agg(
        total.alias("segments"), failed.alias("failed"),
        (failed <= total * ratio).alias("accepted"),
        F.bool_and(ok).alias("complete"), outcome.alias("outcome"))


def best_resolution(formats: DataFrame, key: Sequence[str], width: str = "width",
                    height: str = "height") -> DataFrame:
    """Tallest, then widest size per asset, and the number of different sizes.

    Sizes are made distinct first, so a hot asset shuffles only its few sizes.
    """
    sizes = formats.select(*key, width, height).distinct()
    known = F.col(width).isNotNull() & F.col(height).isNotNull()
    best = F.max(F.when(known, F.struct(F.col(height), F.col(width))))
    return (sizes.groupBy(*key)
                 .agg(best.alias("_best"), F.count_if(known).alias("n_sizes"))
                 .select(*key, "n_sizes", F.col(f"_best.{width}").alias("best_width"),
                         F.col(f"_best.{height}").alias("best_height")))


def count_by_extension(files: DataFrame, path: str = "path") -> DataFrame:
    """Files per extension plus the total (null extension row)."""
    return (files.select(F.lower(S.extension(F.col(path))).alias("ext"))
                 .rollup("ext").agg(F.count(F.lit(1)).alias("n_files"),
                                    F.grouping("ext").cast("int").alias("is_total")))


def scene_counts(scenes: DataFrame, video: str = "video_id") -> DataFrame:
    n = F.max("scene_no")
    return scenes.groupBy(video).agg(n.alias("n_scenes"), (n > 1).alias("multi_scene"))


def throughput(runs: DataFrame, group: Sequence[str], ts: str) -> DataFrame:
    """Elapsed seconds and items per second; null rate when no time passed."""
    seconds = (F.max(ts).cast("timestamp").cast("double")
               - F.min(ts).cast("timestamp").cast("double"))
    return runs.groupBy(*group).agg(
        F.count(F.lit(1)).alias("items"), seconds.alias("elapsed_seconds"),
        F.try_divide(F.count(F.lit(1)), seconds).alias("items_per_second"))


def attempt_summary(attempts: DataFrame, key: Sequence[str], ok: Column,
                    attempt: str = "attempt") -> DataFrame:
    """Attempts per asset, whether one succeeded, and the first that did."""
    return attempts.groupBy(*key).agg(
        F.count(F.lit(1)).alias("attempts"), F.bool_or(ok).alias("succeeded"),
        F.min(F.when(ok, F.col(attempt))).alias("first_success"))


def page_marks(pages: DataFrame, key: Sequence[str], page: str, ok: Column, start: int = 1,
               pieces: int | None = None) -> DataFrame:
    """Last page of the unbroken run of good pages from ``start``.

    0 good pages give ``start - 1``. A failed page stops the mark. A key whose pages all lie before
    ``start`` keeps its row.
    """
    good = (pages.groupBy(*key, page)
                 .agg((F.bool_or(ok) & (F.col(page) >= start)).alias("_ok")))
    counted = (cut_groups(good, key, [page], pieces)
               .running(sums={"_n": F.when(F.col("_ok"), 1).otherwise(0)}).rows())
    unbroken = F.col("_ok") & (F.col(page) == F.col("_n") + start - 1)
    return counted.groupBy(*key).agg(
        F.coalesce(F.max(F.when(unbroken, F.col(page))), F.lit(start - 1)).cast("bigint")
         .alias("last_page"))


def pages_to_fetch(marks: DataFrame, add: int, start: int = 1) -> DataFrame:
    """Rows (key, page) still to fetch up to ``start + add - 1``."""
    first = F.greatest(F.lit(start).cast("bigint"), F.col("last_page") + 1)
    last = F.lit(start + add - 1).cast("bigint")
    return (marks.where(first <= last)
                 .withColumn("page", F.explode(F.sequence(first, last))).drop("last_page"))


def coverage(assets: DataFrame, parts: DataFrame, key: str, duration: str,
             length: str) -> DataFrame:
    """Seconds processed and left per asset."""
    sums = parts.groupBy(key).agg(F.sum(length).alias("processed"))
    processed = F.coalesce(F.col("processed"), F.lit(0.0))
    return assets.join(sums, key, "left").select(
        key, F.col(duration), processed.alias("processed"),
        (F.col(duration) - processed).alias("remaining"))
