"""Reports on what is pending, stuck, failed or done."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.functions import strings as S
from assetloom.operators import ledger as L
from assetloom.operators.joins import drop_done, keyed_join
from assetloom.plans.segments import fixed_segments


def cleaned_urls(urls: DataFrame, patterns: Iterable[str], url: str = "url",
                 host_mark: str | None = None) -> DataFrame:
    """Cleaned ``url`` and whether it is ``valid``."""
    clean = urls.withColumn(url, S.clean_url(F.col(url), host_mark))
    return clean.withColumn("valid", S.matches_any_prefix(F.col(url), patterns))


def pending_urls(cleaned: DataFrame, done: DataFrame, url: str = "url") -> DataFrame:
    """Valid URLs that are not done; copies are kept."""
    return drop_done(cleaned.where("valid"), done, [url]).drop("valid")


def pending_report(cleaned: DataFrame, done: DataFrame, url: str = "url",
                   group: Sequence[str] = ()) -> DataFrame:
    """listed, invalid, done, pending and percent done of the valid ones."""
    marks = done.select(url).distinct().withColumn("_done", F.lit(True))
    joined = keyed_join(cleaned, marks, [url], "left")
    is_done = F.coalesce(F.col("_done"), F.lit(False)) & F.col("valid")
    n_valid, n_done = F.count_if(F.col("valid")), F.count_if(is_done)
    return joined.groupBy(*group).agg(
        F.count(F.lit(1)).alias("listed"), F.count_if(~F.col("valid")).alias("invalid"),
        n_done.alias("done"), (n_valid - n_done).alias("pending"),
        F.coalesce(F.try_divide(n_done * 100.0, n_valid), F.lit(0.0)).alias("done_percent"))


def pending_cut_report(assets: DataFrame, done: DataFrame, key: str, duration: str,
                       group: Sequence[str], *, shortest: float = 180,
                       longest: float | None = None, threshold: float = 180,
                       step: float = 90) -> DataFrame:
    """Of the known assets: which are pending and eligible, and how would they be
    cut? Assets, parts and seconds per group. ``key`` is unique in both tables."""
    pending = drop_done(assets, done, [key], unique_done=True)
    span = F.col(duration) >= shortest
    if longest is not None:
        span = span & (F.col(duration) <= longest)
    parts = fixed_segments(pending.where(span).select(key, *group, duration), duration,
                           threshold=threshold, step=step)
    return parts.groupBy(*group).agg(
        F.count_if(F.col("seg_no") == 1).alias("n_assets"),
        F.count(F.lit(1)).alias("n_parts"), F.sum("length").alias("total_seconds"))


def ledger_health(events: DataFrame, now: Column, minutes: int, key: Sequence[str] = ("task_id",),
                  pieces: int | None = None) -> DataFrame:
    """Per host: tasks by state, done rate, stuck tasks and wrong transitions.

    ``events`` holds task keys, ``state`` (canonical), ``host``, ``updated_at``
    and ``seq``. Tasks count for the host of their last event, wrong transitions
    for the host that wrote them.
    """
    current = L.current_state(events, key)
    old = F.col("updated_at") <= now - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    held = F.col("state").isin("queued", "running")
    per_host = current.groupBy("host").agg(
        F.count(F.lit(1)).alias("tasks"),
        *(F.count_if(F.col("state") == s).alias(s) for s in L.STATES),
        F.count_if(held & old).alias("stuck"))
    wrong = (L.transitions(events, key, "state", pieces=pieces)
             .groupBy("host").agg(F.count_if(~F.col("allowed")).alias("wrong_steps")))
    return per_host.join(wrong, "host", "full_outer").select(
        "host", *(F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
                  for c in ("tasks", *L.STATES, "stuck", "wrong_steps")),
        F.coalesce(F.try_divide(F.col("done") * 100.0, F.col("tasks")), F.lit(0.0))
         .alias("done_percent"))
