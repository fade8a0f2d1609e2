"""Playlists to ordered segment lists. Each body is expanded in its own row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.functions import strings as S

SEGMENT_MARK = "#EXTINF"
VARIANT_MARK = "#EXT-X-STREAM-INF"


def _lines(body: Column) -> Column:
    return F.transform(F.split(body, "\n"), S.strip)


def _with_next(lines: Column) -> Column:
    """Pairs of a line and the one after it; zipping keeps this linear, while an
    index into ``lines`` inside a lambda would split the text for every line."""
    return F.zip_with(lines, F.slice(lines, F.lit(2), F.size(lines)),
                      lambda x, y: F.struct(x.alias("line"), y.alias("next_line")))


def _after(lines: Column, is_mark) -> Column:
    """Non-empty lines that follow a marker line."""
    marked = F.filter(_with_next(lines), lambda p: is_mark(p["line"]) & (p["next_line"] != ""))
    return F.transform(marked, lambda p: p["next_line"])


def numbered_lines(df: DataFrame, body: str) -> DataFrame:
    """One row per line with ``pos``, ``line`` and ``next_line``."""
    keep = [c for c in df.columns if c != body]
    pairs = df.select(*keep, F.posexplode(_with_next(F.split(F.col(body), "\n"))).alias("pos", "_p"))
    return pairs.select(*keep, "pos", "_p.*")


def playlist_segments(playlists: DataFrame, *, asset: str = "asset_id", body: str = "body",
                      base_url: str = "base_url", by_mark: bool = True) -> DataFrame:
    """Ordered segment URLs with their local names.

    ``by_mark`` takes the line after each segment mark; otherwise every line
    that names a ``.ts`` file, also with a query string.
    """
    lines = _lines(F.col(body))
    if by_mark:
        refs = _after(lines, lambda x: x.startswith(SEGMENT_MARK))
    else:
        refs = F.filter(lines, lambda x: ~x.startswith("#") & x.rlike(r"^[^?#]*\.ts(?:[?#].*)?$"))
    rows = playlists.select(F.col(asset), F.col(base_url), F.posexplode(refs).alias("_i", "_ref"))
    seg_no = (F.col("_i") + 1).cast("bigint")
    return rows.select(
        F.col(asset), seg_no.alias("seg_no"),
        S.join_url(F.col(base_url), F.col("_ref")).alias("seg_url"),
        F.concat(F.col(asset).cast("string"), F.lit("_"), S.padded(seg_no, 5), F.lit(".ts"))
         .alias("seg_name"))


def last_variant(body: Column) -> Column:
    """URI after the last variant mark, null if there is none."""
    return F.try_element_at(_after(_lines(body), lambda x: x.contains(VARIANT_MARK)), F.lit(-1))


def widest_variant(body: Column) -> Column:
    """URI of the variant with the largest declared bandwidth, the last on ties."""
    options = F.transform(_with_next(_lines(body)), lambda p, i: F.when(
        p["line"].contains(VARIANT_MARK) & (p["next_line"] != ""),
        F.struct(F.coalesce(F.regexp_extract(p["line"], r"[:,]BANDWIDTH=(\d+)", 1).try_cast("bigint"),
                            F.lit(0).cast("bigint")).alias("bandwidth"),
                 i.alias("pos"), p["next_line"].alias("uri"))))
    return F.array_max(options)["uri"]
