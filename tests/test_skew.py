"""Hot groups give the same rows as a plain window or join, at any cut size."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from assetloom.operators import joins as J, ordering as O
from assetloom.operators.filters import stable_flags
from assetloom.plans.scenes import number_scenes


@pytest.fixture(scope="module")
def skewed(spark):
    """A key with a third of the rows, a null key, ties in time, null values."""
    draw = random.Random(7)
    rows = []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else (None if i % 10 == 1 else f"k{draw.randrange(30)}")
        value = None if draw.random() < 0.1 else draw.randrange(5)
        rows.append((key, draw.randrange(200) if draw.random() > 0.02 else None, i, value))
    return spark.createDataFrame(rows, "k string, t int, id int, v int").cache()


def as_set(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("pieces", [None, 1, 5, 40])
def test_running_equals_window(skewed, pieces):
    w = W.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    plain = skewed.select("k", "t", "id", "v", F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("s"),
                          F.max("v").over(upto).alias("m"), F.lag("v").over(w).alias("l"))
    cut = O.cut_groups(skewed, ["k"], ["t", "id"], pieces).running(
        sums={"s": F.col("v")}, maxes={"m": F.col("v")}, lags={"l": F.col("v")}).rows()
    assert as_set(cut.select(*plain.columns)) == as_set(plain)


@pytest.mark.parametrize("time", ["date'2024-01-01' + t", "CAST(t AS STRING)", "7", "CAST(NULL AS INT)"])
def test_hot_group_is_cut_by_any_order(skewed, time):
    """Dates, texts, ties and nulls: pieces stay within bound and the rows are right."""
    rows = skewed.where("k = 'hot'").withColumn("at", F.expr(time)).select("k", "at", "id", "v")
    groups = O.cut_groups(rows, ["k"], ["at", "id"], 8)
    assert groups._rows.groupBy("_group", "_piece").count().agg(F.max("count")).first()[0] < 150
    w = W.partitionBy("k").orderBy("at", "id")
    plain = rows.withColumns({"l": F.lag("v").over(w), "n": F.row_number().over(w)})
    got = groups.running(lags={"l": F.col("v")}, sums={"n": F.lit(1)}).rows().select(*plain.columns)
    assert as_set(got) == as_set(plain)


def test_chained_values_are_written_seldom(skewed, monkeypatch):
    """Two calls in a row take one write and one plan; a third one writes first."""
    written, write = [], O.materialize
    monkeypatch.setattr(O, "materialize", lambda df, name: written.append(name) or write(df, name))
    scenes = number_scenes(skewed, "k", ["t", "id"], "v", 3, min_len=2)
    assert written == ["pieces"] and scenes.count() == skewed.count()
    plan = scenes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") == 4
    written.clear()
    one = {"n": F.lit(1)}
    O.cut_groups(skewed, ["k"], ["t", "id"]).running(sums=one).running(maxes={"m": F.col("n")}).running(lags={"l": F.col("m")}).rows()
    assert written == ["pieces", "running"]


def test_building_joins_starts_no_job(spark, skewed):
    tracker, group = spark.sparkContext.statusTracker(), "planning"
    spark.sparkContext.setJobGroup(group, group)
    done = skewed.select("k", "id")
    J.drop_done(skewed, done, ["k"]), J.keep_listed(skewed, done, ["k"]), J.with_default(skewed.drop("v"), skewed, ["k"], "v")
    assert not tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("pieces", [None, 30])
def test_stable_and_scenes(skewed, pieces):
    rows = skewed.where("t IS NOT NULL").select("k", "t", "id", F.coalesce("v", F.lit(0)).alias("v"))
    f = W.partitionBy("k").orderBy("t", "id").rowsBetween(-2, 0)
    plain = rows.select("k", "id", ((F.count("v").over(f) == 3) & (F.min("v").over(f) == F.max("v").over(f))
                                    & (F.col("v") > 0)).alias("stable"))
    mine = stable_flags(rows, 2, "k", ["t", "id"], "v", pieces).select("k", "id", "stable")
    assert as_set(mine) == as_set(plain)

    w = W.partitionBy("k").orderBy("t", "id")
    plain = rows.withColumn("n", F.row_number().over(w)).select(
        "k", "id", (1 + F.sum(F.when((F.col("v") >= 3) & (F.col("n") > 1), 1).otherwise(0)).over(w))
        .alias("scene_no"))
    mine = number_scenes(rows, "k", ["t", "id"], "v", 3, pieces=pieces)
    assert as_set(mine.select("k", "id", "scene_no")) == as_set(plain)


def test_hot_group_without_times(spark):
    rows = spark.range(40).select(F.lit("a").alias("k"), F.lit(None).cast("int").alias("t"), "id")
    got = O.cut_groups(rows, ["k"], ["t", "id"], 10).running(sums={"n": F.lit(1)}).rows()
    assert sorted((r.id, r.n) for r in got.collect()) == [(i, i + 1) for i in range(40)]


def test_min_scene_length(spark):
    frames = spark.createDataFrame([(1, n, 40.0 if n in (5, 7, 20, 31) else 0.0) for n in range(40)],
                                   "video int, frame int, score double")
    for pieces in (None, 6):
        got = number_scenes(frames, "video", ["frame"], "score", 30, min_len=10, pieces=pieces)
        starts = got.groupBy("scene_no").agg(F.min("frame")).collect()
        assert sorted(r[1] for r in starts) == [0, 5, 20, 31]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_keyed_join(spark, skewed, how):
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("zz", 3)], "k string, x int")
    plain = skewed.join(right, ["k"], how)
    cut = J.keyed_join(skewed, right, ["k"], how)
    assert as_set(cut.select(*plain.columns)) == as_set(plain)


def test_anti_and_semi_make_the_whole(skewed, spark):
    done = spark.createDataFrame([("hot",), ("k3",), ("k3",)], "k string")
    gone, kept = J.drop_done(skewed, done, ["k"]), J.keep_listed(skewed, done, ["k"])
    assert as_set(gone.unionByName(kept)) == as_set(skewed)
    assert gone.where("k IS NULL").count() == skewed.where("k IS NULL").count()


def test_number_rows(skewed):
    numbered = O.number_rows(skewed, ["t", "id"], start=10)
    plain = skewed.withColumn("n", (F.row_number().over(W.orderBy("t", "id")) + 9).cast("bigint"))
    assert as_set(numbered.select(*plain.columns)) == as_set(plain)
    per_key = O.number_rows(skewed, ["t", "id"], group=["k"])
    plain = skewed.withColumn("n", F.row_number().over(W.partitionBy("k").orderBy("t", "id")).cast("bigint"))
    assert as_set(per_key.select(*plain.columns)) == as_set(plain)


def test_deep_slices(skewed, monkeypatch):
    order = [F.desc_nulls_last("t"), F.asc("id")]
    small = O.page_rows(skewed, order, page=6, size=50), O.first_rows(skewed, order, 120)
    monkeypatch.setattr(O, "MAX_TOP_ROWS", 10)
    deep = O.page_rows(skewed, order, page=6, size=50), O.first_rows(skewed, order, 120)
    assert [as_set(d.select(skewed.columns)) for d in deep] == [as_set(d) for d in small]


def test_number_rows_of_nothing(skewed):
    assert O.number_rows(skewed.where("id < 0"), ["id"]).count() == 0
    assert O.number_rows(skewed.where("id < 0"), ["id"], group=["k"]).count() == 0
