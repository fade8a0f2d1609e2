"""Renumbering and collision-free names. Only plans; no file is touched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.functions import strings as S
from assetloom.operators.joins import drop_done, keep_listed
from assetloom.operators.ledger import duplicate_values
from assetloom.operators.ordering import cut_groups, number_rows, shuffle_key


def walk_order(path: str) -> list:
    """Files of a folder by name, then its subfolders: folder parts, then name."""
    return [F.split(S.parent(F.col(path)), "/"), S.base_name(F.col(path))]


def rename_plan(files: DataFrame, path: str = "path", start: int = 1, width: int = 7,
                shuffle_seed: int | None = None) -> DataFrame:
    """Number every file in walk order, or shuffled by a seed; keep extensions."""
    order = walk_order(path)
    if shuffle_seed is not None:
        order = [shuffle_key(F.col(path), shuffle_seed), F.col(path)]
    numbered = number_rows(files, order, start=start, name="number")
    new_name = F.concat(S.padded(F.col("number"), width), S.extension(F.col(path)))
    return numbered.withColumn("new_path", F.concat_ws("/", S.parent(F.col(path)), new_name))


def rename_clashes(plan: DataFrame, all_files: DataFrame, path: str = "path") -> DataFrame:
    """Planned names held by files that are not renamed themselves."""
    staying = drop_done(all_files.select(path), plan, [path])
    return keep_listed(plan, staying.select(F.col(path).alias("new_path")), ["new_path"])


def rename_stats(plan: DataFrame, clashes: DataFrame) -> DataFrame:
    """Total, renamed and error counts as one row."""
    bad = clashes.select("new_path").withColumn("_clash", F.lit(True))
    return plan.join(bad, "new_path", "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_clash").isNull()).alias("renamed"),
        F.count_if(F.col("_clash")).alias("errors"))


def suffixed(name: Column, number: Column) -> Column:
    """``a.x`` with number 2 is ``a_2.x``; 0 leaves the name."""
    ext = S.extension(name)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(ext))
    return F.when(number == 0, name).otherwise(F.concat(stem, F.lit("_"), number.cast("string"), ext))


def _split_suffix(name: Column) -> tuple[Column, Column]:
    """The name and number that ``suffixed`` makes ``name`` of; null without such a number."""
    ext = S.extension(name)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(ext))
    digits = F.regexp_extract(stem, r"_([1-9][0-9]{0,17})$", 1)
    base, number = F.concat(F.regexp_replace(stem, r"_[0-9]+$", ""), ext), digits.try_cast("bigint")
    made = suffixed(base, number) == name
    return F.when(made, base), F.when(made, number)


def suffix_collisions(df: DataFrame, name: str, order: str, out: str = "final_name",
                      taken: DataFrame | None = None) -> DataFrame:
    """``a.x``, ``a_1.x``, ``a_2.x`` … for rows that share a target name, each name once.

    The first row of a name (by ``order``, which is total within a name) keeps it unless it is among ``taken``, a table of names that
    are there already. The others get the next numbers whose names are neither taken nor wanted by other
    rows. A suffixed name has one reading as name and number, so no two rows get the same name.

    The q-th free number is q plus the taken numbers t with fewer than q free ones below them; the k-th
    taken number has t - k free ones below. Both are running counts, so a name
    that very many rows share is cut into ranges.
    """
    there = (taken.select(F.col(name).alias("_name")) if taken is not None else df.select(F.col(name).alias("_name")).limit(0))
    there = there.where("_name IS NOT NULL").distinct()
    wanted = df.select(F.col(name).alias("_name")).where("_name IS NOT NULL").distinct()
    base, number = _split_suffix(F.col("_name"))
    numbers = (there.union(wanted).select(base.alias("_base"), number.alias("_number")).where("_base IS NOT NULL").distinct())
    ranked = (cut_groups(numbers, ["_base"], ["_number"]).running(sums={"_k": F.lit(1)}).rows()
              .select("_base", (F.col("_number") - F.col("_k")).alias("_q"), F.lit(1).alias("_gap")))
    held = there.select(F.col("_name").alias("_held"))
    rows = df.select(F.struct("*").alias("_row"), F.col(name).alias("_base"), F.col(order).alias("_order")).join(
        held, F.col("_base") == F.col("_held"), "left")
    placed = (cut_groups(rows, ["_base"], ["_order"]).running(sums={"_nth": F.lit(1)}).rows()
              .select("_row", "_base", "_order", (F.col("_nth") - F.when(F.col("_held").isNull(), 1).otherwise(0)).alias("_q")))
    # a taken number counts for the rows whose q is larger, so at the same q it comes after the row
    both = placed.withColumn("_gap", F.lit(0)).unionByName(ranked, allowMissingColumns=True)
    counted = (cut_groups(both, ["_base"], ["_q", "_gap"]).running(sums={"_skipped": F.col("_gap")}).rows()
               .where("_gap = 0"))
    n = F.when(F.col("_q") == 0, F.lit(0)).otherwise(F.col("_q") + F.col("_skipped"))
    final = F.when(F.col("_base").isNotNull(), suffixed(F.col("_base"), n))
    return counted.select("_row.*", final.alias(out))


def name_clashes(renamed: DataFrame, out: str = "final_name") -> DataFrame:
    """Final names that several rows hold: none after ``suffix_collisions``."""
    return duplicate_values(renamed, out)
