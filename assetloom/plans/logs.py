"""Tables from the logs of download tools.

Log rows carry ``run_id``, ``pos`` and ``line``. Rules look at one line at a
time, so a run's verdict is an aggregate over its lines and no run is ever
collected: the first matching rule of a run is the smallest rule number among
its lines.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.functions import dates as D, numbers as N, strings as S
from assetloom.operators.ordering import top_per_group
from assetloom.operators.spacing import keep_spaced

# Patterns in order of precedence, with the label of each.
ERROR_RULES = (
    ("info_missing", r"AttributeError.*'NoneType'.*'lower'"),
    ("fragment_lost", r"No such file or directory.*Frag\d+"),
    ("server_unavailable", r"HTTP Error 502|Bad Gateway"),
    ("not_found", r"HTTP Error 404|Not Found"),
    ("forbidden", r"HTTP Error 403|Forbidden"),
    ("disk_full", r"No space left on device"),
    ("conversion_failed", r"Conversion failed"),
    ("page_unreachable", r"Unable to download webpage"),
    ("timeout", r"Connection.*timeout|timed out"),
    ("permission_denied", r"Permission denied"),
    ("postprocessing_failed", r"Postprocessing.*failed"),
    ("rate_limited", r"Rate limit|Too many requests"),
    ("private", r"Private video|Access denied"),
    ("extraction_failed", r"Unable to extract.*info"),
    ("unavailable", r"Video unavailable"),
    ("this_unavailable", r"This video is not available"),
    ("sign_in", r"Sign in to confirm"),
    ("format_unavailable", r"Requested format is not available"),
)
FINAL_ERRORS = (
    r"HTTP Error 404|Not Found", r"Private video|Access denied", r"No space left on device",
    r"Permission denied", r"Video unavailable", r"This video is not available",
    r"Sign in to confirm", r"HTTP Error 403.*Forbidden",
)
BUSY_ERRORS = r"HTTP Error 502|Bad Gateway|Rate limit|Too many requests"
ATTRIBUTE_ERRORS = r"AttributeError.*'NoneType'"
SUCCESS_MARKS = ("has already been downloaded", "[download] 100%", "download completed",
                 "[Merger] Merging formats", "Deleting original file", "100%")
SERIOUS_MARKS = ("ERROR:", "FAILED:", "No space left on device", "Permission denied",
                 "Connection refused", "Unable to download webpage", "Video unavailable")
REPORT_MARKS = ("ERROR:", "FAILED:", "EXCEPTION:", "WARNING:")
PROCESSING_MARKS = ("[Merger] Merging formats", "[ExtractAudio]", "[FixupM4a]", "[FixupM3u8]",
                    "[FixupWebm]", "[FixupMp4]", "Post-processing", "Converting")
FINISHED_MARKS = ("has already been downloaded", "Deleting original file")
MEDIA_ENDINGS = r"\.(?:mp4|mkv|webm)$"
PERCENT = r"(\d+(?:\.\d+)?)%"
RESOLUTION = r"(\d+)x(\d+)"


def _contains_any(line: Column, marks: Sequence[str]) -> Column:
    return reduce(or_, (line.contains(m) for m in marks))


def _mentions(lowered: Column, pattern: str) -> Column:
    """Whether a lower-cased line matches a pattern in any case.

    Alternatives that are plain words are looked up as such, which is several
    times faster than a pattern that ignores case.
    """
    def one(part: str) -> Column:
        plain = re.fullmatch(r"[\w ]+", part)
        return lowered.contains(part.lower()) if plain else lowered.rlike(part.lower())

    return reduce(or_, map(one, pattern.split("|")))


def first_rule(lowered: Column, rules: Sequence[tuple[str, str]] = ERROR_RULES) -> Column:
    """Number (from 1) of the first rule that a lower-cased line matches, or null.

    Rule patterns may use ``|`` at the top level and no upper-case escapes.
    """
    number = F.lit(None).cast("int")
    for i, (_, pattern) in reversed(list(enumerate(rules, 1))):
        number = F.when(_mentions(lowered, pattern), F.lit(i)).otherwise(number)
    return number


def rule_label(number: Column, rules: Sequence[tuple[str, str]] = ERROR_RULES) -> Column:
    return F.try_element_at(F.array(*(F.lit(label) for label, _ in rules)), number)


def progress_table(log: DataFrame, line: str = "line") -> DataFrame:
    """Add percent, speed, eta, phase and file name, read from each line.

    A line saying that the file was there already counts as finished.
    """
    text = S.strip(F.col(line))
    percent = F.regexp_extract(text, PERCENT, 1).try_cast("double")
    loading = text.contains("[download]") & percent.isNotNull()
    phase = (F.when(loading, "downloading")
              .when(_contains_any(text, PROCESSING_MARKS), "processing")
              .when(_contains_any(text, FINISHED_MARKS), "finished"))
    merged = F.regexp_extract(text, r'\[Merger\] Merging formats into "([^"]*)"', 1)
    target = F.regexp_extract(text, r"\[download\] Destination: (.*?)(?:: .*)?$", 1)
    name = (F.when(merged != "", S.base_name(merged))
             .when(target.rlike(MEDIA_ENDINGS), S.base_name(target)))
    return log.withColumns({
        "percent": F.when(loading, percent),
        "speed": F.when(loading, N.bytes_per_second(text)),
        "eta": F.when(loading, D.eta_seconds(text)),
        "phase": phase, "file_name": name})


def throttled_progress(progress: DataFrame, key: Sequence[str], order: Sequence[str], *,
                       min_seconds: float = 0.5, min_points: float = 0.5) -> DataFrame:
    """Rows at least ``min_seconds`` or ``min_points`` away from the last row let through, or at 99 % and
    above. ``order[0]`` is the time; the rest makes the order total."""
    return keep_spaced(progress, key, order, "percent", min_seconds=min_seconds, min_change=min_points,
                       always=F.col("percent") >= 99)


def error_report(log: DataFrame, run: str = "run_id", pos: str = "pos", line: str = "line",
                 rules: Sequence[tuple[str, str]] = ERROR_RULES) -> DataFrame:
    """One row per run: rule number, label, and a message of at most 400 characters.

    Without a matching rule the message is the first line with a report mark,
    else the first telling line of the last ten, else ``unknown error``.
    """
    text = S.strip(F.col(line))
    bare = S.strip_colour(text)
    lowered = log.select(run, pos, line, F.lower(line).alias("_low"))
    reports = (_contains_any(F.col("_low"), [m.lower() for m in REPORT_MARKS])
               & (F.length(bare) > 10))
    judged = lowered.select(run, pos, first_rule(F.col("_low"), rules).alias("_rule"),
                            F.when(reports, F.left(bare, F.lit(200))).alias("_bare"))
    verdicts = judged.groupBy(run).agg(
        F.min("_rule").alias("rule_no"),
        F.min_by("_bare", F.when(F.col("_bare").isNotNull(), F.col(pos))).alias("_report"))
    telling = (F.length(text) > 20) & ~text.startswith("[")
    tails = (top_per_group(log.select(run, pos, line), [run], [F.desc(pos)], 10)
             .where(telling).groupBy(run)
             .agg(F.min_by(F.left(text, F.lit(150)), pos).alias("_tail")))
    label = rule_label(F.col("rule_no"), rules)
    message = F.coalesce(label, F.col("_report"), F.col("_tail"), F.lit("unknown error"))
    return verdicts.join(tails, run, "left").select(
        run, "rule_no", label.alias("label"), F.left(message, F.lit(400)).alias("message"))


def retry_decision(log: DataFrame, run: Sequence[str] = ("run_id",), attempt: str = "attempt",
                   line: str = "line") -> DataFrame:
    """Per run: retry or not, and the wait in seconds for its attempt number."""
    low = F.col("_low")
    rank = (F.when(_mentions(low, "|".join(FINAL_ERRORS)), 1)
             .when(_mentions(low, BUSY_ERRORS), 2)
             .when(_mentions(low, ATTRIBUTE_ERRORS), 3).otherwise(4))
    ranked = log.select(*run, attempt, F.lower(line).alias("_low")).groupBy(*run).agg(F.min(rank).alias("_rank"), F.max(attempt).alias(attempt))
    tries = F.col(attempt)
    wait = (F.when(F.col("_rank") == 1, F.lit(0).cast("bigint"))
             .when(F.col("_rank") == 2, N.backoff(tries, 5, 30))
             .when(F.col("_rank") == 3, N.backoff(tries, 3, 15))
             .otherwise(N.backoff(tries)))
    return ranked.select(*run, attempt, (F.col("_rank") > 1).alias("retry"),
                         wait.alias("wait_seconds"))


def run_outcomes(log: DataFrame, run: Sequence[str] = ("run_id",), line: str = "line",
                 exit_code: str = "exit_code") -> DataFrame:
    """Per run: exit code 0, or a success mark and no serious error."""
    text = F.col(line)
    judged = log.groupBy(*run).agg(
        F.max(exit_code).alias(exit_code),
        F.bool_or(_contains_any(text, SUCCESS_MARKS)).alias("_good"),
        F.bool_or(_contains_any(text, SERIOUS_MARKS)).alias("_bad"))
    good = F.coalesce(F.col("_good"), F.lit(False)) & ~F.coalesce(F.col("_bad"), F.lit(False))
    return judged.select(*run, exit_code, ((F.col(exit_code) == 0) | good).alias("ok"))


def format_sizes(listing: DataFrame, line: str = "line") -> DataFrame:
    """Add width and height: the first ``WxH`` of each line; other lines drop out."""
    sized = listing.withColumn("_size", F.regexp_extract(line, RESOLUTION, 0)).where("_size <> ''")
    parts = F.split("_size", "x")
    return sized.withColumns({"width": F.get(parts, F.lit(0)).try_cast("int"),
                              "height": F.get(parts, F.lit(1)).try_cast("int")}).drop("_size")


def last_lines(log: DataFrame, run: str = "run_id", pos: str = "pos", n: int = 10) -> DataFrame:
    return top_per_group(log, [run], [F.desc(pos)], n, rank="from_end")


def first_json_line(log: DataFrame, run: str = "run_id", pos: str = "pos",
                    line: str = "line") -> DataFrame:
    """The first line per run that is a bracketed JSON object."""
    text = S.strip(F.col(line))
    return (log.where(text.startswith("{") & text.endswith("}")).groupBy(run)
               .agg(F.min_by(text, pos).alias("json_line")))
