"""Keep a row only if it is far enough from the last row kept.

Whether a row is kept depends on the row kept before it, so on all rows before. Many rows are kept whatever came
before: the first of a key, one ``min_seconds`` after its predecessor, one that is always kept, and one that differs from
its predecessor by more than twice ``min_change`` (a row kept last that lets the predecessor drop is within ``min_change`` of
it). The rows of a key are cut at such rows into blocks that do not depend on each other.

A block that stays long is cut by time: after ``min_seconds`` any row is kept, so what a stretch of time does depends
only on which row of the last ``min_seconds`` before it was kept last. Each stretch is worked out for each of
these rows at once, as a list "row kept last before -> row kept last", and the lists of
neighbouring stretches are composed by doubling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.operators.ordering import cut_groups
from assetloom.session import materialize

#: Rows after which a block ends at the next row that is kept whatever came before, and rows of a block that is one array.
BLOCK, LONGEST = 128, 8192
#: Length of a stretch, in ``min_seconds``. The rows that a long block has in a stretch are one array.
SPAN = 8
#: Rows of an array whose kept rows are put together at once.
PART = 256


def keep_spaced(rows: DataFrame, key: Sequence[str], order: Sequence[str], value: str, *, min_seconds: float,
                min_change: float, always: Column, span: int = SPAN, longest: int = LONGEST) -> DataFrame:
    """The first row of each key, and then each row that is ``min_seconds`` after the last row kept, differs from
    it by ``min_change`` in ``value``, or is ``always`` kept.

    ``order`` is a total order of sortable columns that starts with the time; a null key is a key. Rows
    without time or value are left out. A hot key is cut into blocks; a task gets at most ``longest`` rows of one as an
    array, or of a longer block the rows in ``span`` times ``min_seconds``.
    """
    known = rows.where(F.col(order[0]).isNotNull() & F.col(value).isNotNull())
    least = round(min_seconds * 1_000_000)
    if least <= 0:
        return known
    blocks = materialize(_blocks(known, key, order, value, always, least, min_change), "blocks")
    sizes = blocks.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > longest)
    long = materialize(sizes.select("_key"), "long-blocks")
    if long.isEmpty():
        return _of_blocks(blocks, least, min_change)
    return _of_blocks(blocks.join(long, "_key", "left_anti"), least, min_change).unionByName(
        _of_long_blocks(blocks.join(long, "_key", "left_semi"), least, span * least, min_change))


def _blocks(rows: DataFrame, key: Sequence[str], order: Sequence[str], value: str, always: Column, least: int,
            min_change: float) -> DataFrame:
    """_key (the key and a block of it) and the row: its time, places in the order, value and columns."""
    at = F.unix_micros(F.col(order[0]).cast("timestamp"))
    places = [f"_o{i}" for i in range(len(order))]
    told = rows.select(
        F.struct(*key).alias("_of"), at.alias("_at"), *(F.col(c).alias(p) for c, p in zip(order, places, strict=True)),
        F.col(value).cast("double").alias("_value"), F.coalesce(always, F.lit(False)).alias("_always"),
        F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row"))
    sure = (F.col("_at_before").isNull() | F.col("_always") | (F.col("_at") - F.col("_at_before") >= least)
            | (F.abs(F.col("_value") - F.col("_value_before")) > 2 * min_change))
    cut = (cut_groups(told, ["_of"], ["_at", *places])
           .running(sums={"_n": F.lit(1)}, lags={"_at_before": F.col("_at"), "_value_before": F.col("_value")})
           .running(maxes={"_from": F.when(sure, F.col("_n"))}).rows())
    item = [F.col("_at").alias("at"), *(F.col(p).alias(p[1:]) for p in places), F.col("_value").alias("value"),
            F.col("_always").alias("always"), F.col("_row").alias("row")]
    return cut.select(F.struct("_of", F.expr(f"_from div {BLOCK}").alias("block")).alias("_key"),
                      F.struct(*item).alias("_own"))


def _of_blocks(blocks: DataFrame, least: int, min_change: float) -> DataFrame:
    """The kept rows of blocks; the first row of each is kept."""
    whole = blocks.groupBy("_key").agg(F.sort_array(F.collect_list("_own")).alias("own"))
    return whole.select(F.explode(_kept(_nothing(), least, min_change)).alias("_row")).select("_row.*")


def _of_long_blocks(blocks: DataFrame, least: int, width: int, min_change: float) -> DataFrame:
    stretches = materialize(_stretches(blocks, least, width, min_change), "stretches")
    entered = _entries(stretches.select("_key", "_stretch", "exits"))
    # a stretch without rows shortly before it is entered in one way only
    alone = stretches.where("size(tail) = 0").withColumn("_entry", F.lit(0))
    others = stretches.where("size(tail) > 0").join(entered, ["_key", "_stretch"])
    entry = F.when(F.col("_entry") > 0, _state(F.get("tail", F.col("_entry") - 1))).otherwise(_nothing())
    kept = alone.unionByName(others).select(F.explode(_kept(entry, least, min_change)).alias("_row"))
    return kept.select("_row.*")


def _passes(last: Column, row: Column, least: int, min_change: float) -> Column:
    return (last["at"].isNull() | (row["at"] - last["at"] >= least)
            | (F.abs(row["value"] - last["value"]) >= min_change) | row["always"])


def _stretches(blocks: DataFrame, least: int, width: int, min_change: float) -> DataFrame:
    """_key, _stretch, its own rows and the ``tail`` of the stretch before, both in order, and ``exits``."""
    told = blocks.select("_key", "_own", F.col("_own").dropFields("always", "row").alias("_tail"),
                         F.col("_own.at").alias("_at"))
    stretch = F.expr(f"(_at - pmod(_at, {width})) div {width}")
    near_end = F.pmod("_at", F.lit(width).cast("bigint")) >= width - least
    dealt = told.withColumn("_stretch", stretch).select("_key", "_tail", "_own", F.explode(F.concat(
        F.array(F.struct(F.col("_stretch").alias("no"), F.lit(True).alias("own"))),
        F.when(near_end, F.array(F.struct((F.col("_stretch") + 1).alias("no"), F.lit(False).alias("own"))))
         .otherwise(F.array().cast("array<struct<no:bigint,own:boolean>>")))).alias("_to"))
    grouped = (dealt.groupBy("_key", F.col("_to.no").alias("_stretch")).agg(
        F.sort_array(F.collect_list(F.when(F.col("_to.own"), F.col("_own")))).alias("own"),
        F.sort_array(F.collect_list(F.when(~F.col("_to.own"), F.col("_tail")))).alias("tail"))
        .where("size(own) > 0"))
    return grouped.withColumn("exits", _exits(least, width, min_change))


def _state(last: Column) -> Column:
    return F.struct(last["at"].alias("at"), last["value"].alias("value"))


def _nothing() -> Column:
    return F.struct(F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("double").alias("value"))


def _exits(least: int, width: int, min_change: float) -> Column:
    """For each way to enter a stretch how the next one is entered: 0 if its first row passes anyhow, else the
    place in the tail of the row kept last. Entry 0 is "no row near enough", entry i row i of the own tail.

    All ways are followed at once. Those for which a row passes have kept the same row last from then on, so
    they go on as one; soon few are left. Once all have met, the entries are no longer listed.
    """
    own = F.col("own")
    outside = F.size(F.filter(own, lambda x: F.pmod(x["at"], F.lit(width).cast("bigint")) < width - least))
    ways = F.transform(F.concat(F.array(_nothing()), F.transform("tail", _state)), lambda e, i: F.struct(
        e["at"].alias("at"), e["value"].alias("value"), F.lit(0).alias("last"), F.array(i).alias("entries")))

    def step(so_far: Column, row: Column) -> Column:
        n, now = so_far["n"] + 1, so_far["ways"]
        # written out instead of bound to a name: binding copies all ways with every row
        some = F.exists(now, lambda w: _passes(w, row, least, min_change))
        others = F.filter(now, lambda w: ~_passes(w, row, least, min_change))
        passing = F.filter(now, lambda w: _passes(w, row, least, min_change))
        met = F.forall(now, lambda w: _passes(w, row, least, min_change))
        entries = F.when(met, F.array(F.lit(-1))).otherwise(F.flatten(F.transform(passing, lambda w: w["entries"])))
        one = F.struct(row["at"].alias("at"), row["value"].alias("value"), n.alias("last"), entries.alias("entries"))
        return F.struct(n.alias("n"), F.when(some, F.concat(others, F.array(one))).otherwise(now).alias("ways"))

    def told(so_far: Column) -> Column:
        def exit_of(way: Column) -> Column:
            return F.greatest(way["last"] - outside, F.lit(0))

        pairs = F.flatten(F.transform(so_far["ways"], lambda w: F.transform(w["entries"], lambda i: F.struct(
            i.alias("entry"), exit_of(w).alias("exit")))))
        only = F.get(so_far["ways"], F.lit(0))
        return F.when(F.get(only["entries"], F.lit(0)) == -1, F.array_repeat(exit_of(only), F.size("tail") + 1)).otherwise(
            F.transform(F.array_sort(pairs), lambda p: p["exit"]))

    return F.aggregate(own, F.struct(F.lit(0).alias("n"), ways.alias("ways")), step, told)


def _entries(stretches: DataFrame) -> DataFrame:
    """_key, _stretch, _entry: how each stretch is entered.

    Where the stretch before is missing, or is left the same way however it was entered, that is known. The
    others follow it in a run; with every round they look back over twice as many stretches.
    """
    before = (cut_groups(stretches, ["_key"], ["_stretch"])
              .running(lags={"_last": F.col("_stretch"), "_exits": F.col("exits")}).rows())
    missing = F.col("_last").isNull() | (F.col("_last") < F.col("_stretch") - 1)
    fixed = (F.when(missing, F.lit(0))
              .when(F.array_min("_exits") == F.array_max("_exits"), F.get("_exits", F.lit(0))))
    placed = (cut_groups(before.select("_key", "_stretch", fixed.alias("_entry"), "_exits"), ["_key"], ["_stretch"])
              .running(maxes={"_from": F.when(F.col("_entry").isNotNull(), F.col("_stretch"))}).rows())
    now = materialize(placed.withColumn("_exits", F.when(F.col("_entry").isNull(), F.col("_exits"))), "entries")
    longest = now.agg(F.max(F.col("_stretch") - F.col("_from"))).first()[0] or 0
    back = 1
    while back <= longest:
        earlier = now.select("_key", (F.col("_stretch") + back).alias("_stretch"), F.col("_from").alias("_run"),
                             F.col("_entry").alias("_entry_before"), F.col("_exits").alias("_exits_before"))
        joined = now.join(earlier, ["_key", "_stretch"], "left")
        same_run = F.col("_run") == F.col("_from")
        entry = F.coalesce("_entry", F.when(same_run, F.get("_exits", F.col("_entry_before"))))
        composed = F.when(same_run, F.transform("_exits_before", lambda x: F.get("_exits", x)))
        now = materialize(joined.select("_key", "_stretch", "_from", entry.alias("_entry"),
                                        F.when(entry.isNull(), composed).alias("_exits")), "entries")
        back *= 2
    return now.select("_key", "_stretch", "_entry")


def _kept(entry: Column, least: int, min_change: float) -> Column:
    """The kept rows of an array that is entered by ``entry``, put together by parts, which keeps long arrays linear."""
    own = F.col("own")
    none = F.filter(F.transform(F.slice(own, 1, 1), lambda x: x["row"]), lambda x: F.lit(False))
    last_part = F.greatest(F.floor((F.size(own) - 1) / PART).cast("int"), F.lit(0))
    parts = F.transform(F.sequence(F.lit(0), last_part), lambda i: F.slice(own, i * PART + 1, F.lit(PART)))

    def step(so_far: Column, row: Column) -> Column:
        return F.when(_passes(so_far, row, least, min_change), F.struct(
            row["at"].alias("at"), row["value"].alias("value"),
            F.concat(so_far["rows"], F.array(row["row"])).alias("rows"), so_far["parts"].alias("parts"))).otherwise(so_far)

    def part_step(so_far: Column, part: Column) -> Column:
        begin = F.struct(so_far["at"].alias("at"), so_far["value"].alias("value"), none.alias("rows"),
                         so_far["parts"].alias("parts"))
        return F.aggregate(part, begin, step, lambda s: F.struct(
            s["at"].alias("at"), s["value"].alias("value"), F.concat(s["parts"], F.array(s["rows"])).alias("parts")))

    no_parts = F.filter(F.array(none), lambda x: F.lit(False))
    return F.aggregate(parts, F.struct(entry["at"].alias("at"), entry["value"].alias("value"), no_parts.alias("parts")),
                       part_step, lambda s: F.flatten(s["parts"]))
