"""Order-dependent operators that do not put a whole group in one task.

A plain ``Window.partitionBy(key).orderBy(...)`` sends all rows of a key to one
task. Here the rows are range-partitioned by key and the whole order and written once.
Each range is windowed on its own, and a summary per range carries the running state of
a key that crosses into the next one. Every size takes this path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from assetloom.session import materialize

#: Rows of a top-k that one task may merge.
MAX_TOP_ROWS = 10_000

_IN_PARTITION_BITS = 33  # documented layout of monotonically_increasing_id


#: Chained ``running`` calls that one plan holds; each computes its input twice.
CHAINED = 2


class CutGroups:
    """Rows of a table cut into ranges; see ``cut_groups``."""

    def __init__(self, rows: DataFrame, order: Sequence[str], chained: int):
        self._rows, self._order, self._chained = rows, list(order), chained

    def running(self, *, sums: dict[str, Column] | None = None,
                maxes: dict[str, Column] | None = None,
                earlier: dict[str, Column] | None = None,
                lags: dict[str, Column] | None = None) -> CutGroups:
        """Add running sums (inclusive, from 0), running maxima (inclusive; ``earlier``: of the rows
        before) and previous-row values.

        The rows are shuffled once, by group and range, for ``CHAINED`` calls in a row; before a further
        call they are written, so that longer chains do not multiply the plan.
        """
        sums, maxes, earlier, lags = sums or {}, maxes or {}, earlier or {}, lags or {}
        tops = {**maxes, **earlier}
        full = self._chained >= CHAINED
        rows = materialize(self._rows, "running") if full else self._rows
        cut = rows.withColumns(
            {f"_in_{name}": col for name, col in {**sums, **tops, **lags}.items()})
        by_piece = W.partitionBy("_group", "_piece").orderBy(*self._order)
        so_far = by_piece.rowsBetween(W.unboundedPreceding, 0)
        before = by_piece.rowsBetween(W.unboundedPreceding, -1)
        local = cut.withColumns({
            **{n: F.coalesce(F.sum(f"_in_{n}").over(so_far), F.lit(0)) for n in sums},
            **{n: F.max(f"_in_{n}").over(so_far) for n in maxes},
            **{n: F.max(f"_in_{n}").over(before) for n in earlier},
            **{n: F.lag(f"_in_{n}").over(by_piece) for n in lags},
        })
        inputs = [f"_in_{n}" for n in (*sums, *tops, *lags)]
        if lags:
            local = local.withColumn("_first", F.row_number().over(by_piece) == 1)
        totals = (
            [F.sum(f"_in_{n}").alias(f"_c_{n}") for n in sums]
            + [F.max(f"_in_{n}").alias(f"_c_{n}") for n in tops]
            + [F.max_by(F.struct(f"_in_{n}"), F.struct(*self._order)).alias(f"_c_{n}")
               for n in lags])
        in_order = W.partitionBy("_group").orderBy("_piece")
        pieces_before = in_order.rowsBetween(W.unboundedPreceding, -1)
        # only a key that crosses into a range has a row here, at most one per range
        carry = (cut.groupBy("_group", "_piece").agg(*totals)
                    .select("_group", "_piece", F.row_number().over(in_order).alias("_nth_piece"),
                            *(F.sum(f"_c_{n}").over(pieces_before).alias(f"_c_{n}") for n in sums),
                            *(F.max(f"_c_{n}").over(pieces_before).alias(f"_c_{n}") for n in tops),
                            *(F.last(f"_c_{n}").over(pieces_before).alias(f"_c_{n}") for n in lags))
                    .where("_nth_piece > 1").drop("_nth_piece"))
        joined = local.join(carry, ["_group", "_piece"], "left").withColumns({
            **{n: F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)) for n in sums},
            **{n: F.greatest(n, f"_c_{n}") for n in tops},
            **{n: F.when(F.col("_first"), F.col(f"_c_{n}")[f"_in_{n}"]).otherwise(F.col(n))
               for n in lags},
        })
        carried = [f"_c_{n}" for n in (*sums, *tops, *lags)]
        return CutGroups(joined.drop("_first", *inputs, *carried), self._order, 1 if full else self._chained + 1)

    def rows(self) -> DataFrame:
        return self._rows.drop("_group", "_piece")


def cut_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               pieces: int | None = None) -> CutGroups:
    """Prepare ``df`` for running values per key.

    ``order`` must be a total order within the key, of any sortable types; nulls come first.
    Ranges follow the key and the whole order, so ties and nulls in its first columns are
    split too. ``pieces`` sets the number of ranges, by default Spark does.
    """
    by = [*keys, *order]
    ranged = df.repartitionByRange(pieces, *by) if pieces else df.repartitionByRange(*by)
    piece = F.shiftright(F.monotonically_increasing_id(), _IN_PARTITION_BITS).cast("int")
    placed = materialize(ranged.withColumn("_piece", piece), "pieces")
    return CutGroups(placed.withColumn("_group", F.struct(*keys)), order, 0)


def number_rows(df: DataFrame, order: Sequence[str | Column], *, start: int = 1,
                group: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Consecutive numbers over the whole table, or per ``group``, in ``order``, a total order.

    Range partitioning spreads any key distribution over the tasks; the sorted
    table is written once, and each partition's offset comes from a count of one
    row per partition. Groups are numbered by ``cut_groups``, where only a group that crosses
    into a range needs an offset; ``order`` then names columns.
    """
    if group:
        counted = cut_groups(df, group, order).running(sums={"_nth": F.lit(1)}).rows()
        return counted.withColumn(name, (F.col("_nth") + (start - 1)).cast("bigint")).drop("_nth")
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
          .withColumn("_slot", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_slot", _IN_PARTITION_BITS)
    # one row per range partition, so both the window and broadcast are small
    sizes = placed.groupBy(part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_from"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", "_from", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.lit(start) + F.col("_before") + F.col("_slot") - F.col("_from")
    return numbered.withColumn(name, number.cast("bigint")).drop("_slot", "_part", "_from", "_before")


def shuffle_key(col: Column, seed: int) -> Column:
    """Sort key for a reproducible shuffle."""
    return F.md5(F.concat(col, F.lit(f"#{seed}")))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                  k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group. Spark trims each map task to k rows per group
    before the shuffle, so a hot group sends only k rows per task."""
    w = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows in a stated total order."""
    return _slice_rows(df, order, 0, n)


def page_rows(df: DataFrame, order: Sequence[Column], page: int, size: int = 24) -> DataFrame:
    """Page ``page`` (from 1) of ``size`` rows."""
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    return _slice_rows(df, order, (page - 1) * size, size)


def _slice_rows(df: DataFrame, order: Sequence[Column], skip: int, n: int) -> DataFrame:
    """A top-k ends in one task, which suits a few rows; deeper slices are
    numbered in parallel."""
    if skip + n <= MAX_TOP_ROWS:
        return df.orderBy(*order).offset(skip).limit(n)
    place = F.col("_place")
    return (number_rows(df, order, name="_place")
            .where((place > skip) & (place <= skip + n)).orderBy("_place").drop("_place"))


def latest_row(df: DataFrame, group: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The newest row per group; partial aggregation, one row per group shuffled."""
    others = [c for c in df.columns if c not in group]
    best = F.max_by(F.struct(*others), F.struct(*newest)).alias("_row")
    return df.groupBy(*group).agg(best).select(*group, "_row.*")
