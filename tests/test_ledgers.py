"""Ledger operators on small tables."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from assetloom.operators import filters as E, joins as J, ledger as L, metrics as M, sets
from assetloom.plans import reports

T0 = datetime(2024, 5, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_canonical_states(spark):
    df = spark.createDataFrame([("queue", "4"), ("playlist", "4"), ("queue", "3"), ("playlist", "3"),
                                ("json", None), ("worker", "completed"), ("image", "9")], "d string, c string")
    got = [r[0] for r in df.select(L.canonical_state(F.col("d"), F.col("c"))).collect()]
    assert got == ["retry", "queued", "failed", "retry", "pending", "done", None]


def test_upsert_twice_is_once(spark):
    table = spark.createDataFrame([("a", "old", "u1", True), ("b", "keep", "u2", False)],
                                  "id string, name string, url string, done boolean")
    batch = spark.createDataFrame([("a", None, "u9", False, 1), ("c", "new", "u3", None, 1),
                                   ("c", "newer", "u3", None, 2)],
                                  "id string, name string, url string, done boolean, v int")
    once = L.upsert(table, batch, "id", ["name", "url"], ["v"])
    assert rows(once) == [("a", None, "u9", True), ("b", "keep", "u2", False), ("c", "newer", "u3", None)]
    assert rows(L.upsert(once, batch, "id", ["name", "url"], ["v"])) == rows(once)


def test_insert_ignore(spark):
    table = spark.createDataFrame([("u1", 0)], "link string, n int")
    batch = spark.createDataFrame([("u1", 1), ("u2", 3), ("u2", 2), (None, 4)], "link string, n int")
    assert rows(L.insert_ignore(table, batch, "link", ["n"])) == [("u2", 2)]


def test_transitions_and_stuck(spark):
    events = spark.createDataFrame(
        [(1, s, "h1", T0 + timedelta(minutes=i), i) for i, s in enumerate(["pending", "running", "done", "failed"])]
        + [(2, "running", "h2", T0, 1)],
        "task_id int, state string, host string, updated_at timestamp, seq int")
    got = rows(L.transitions(events, ["task_id"], "state").select("task_id", "seq", "from_state", "allowed"))
    assert got == [(1, 0, None, True), (1, 1, "pending", True), (1, 2, "running", True), (1, 3, "done", False),
                   (2, 1, None, True)]
    current = L.current_state(events, ["task_id"])
    now = F.lit(T0 + timedelta(minutes=30)).cast("timestamp")
    assert rows(L.stuck_tasks(current, now, 30).select("task_id")) == [(2,)]
    assert L.stuck_tasks(current, now, 31).count() == 0
    assert L.stuck_tasks(current, now, 0, host="h1").count() == 0
    health = {r.host: r for r in reports.ledger_health(events, now, 10).collect()}
    assert (health["h1"].failed, health["h1"].wrong_steps, health["h2"].stuck) == (1, 1, 1)


def test_advance(spark):
    current = spark.createDataFrame([(1, "pending", 1), (2, "done", 5), (3, "running", 2), (4, None, 1)],
                                    "task_id int, state string, seq int")
    current = current.withColumn("updated_at", F.lit(T0).cast("timestamp"))
    steps, refused = L.advance(current, "running", F.lit(T0 + timedelta(hours=1)).cast("timestamp"))
    assert rows(steps) == [(1, "running", 2, T0 + timedelta(hours=1))]
    assert sorted(r.task_id for r in refused.collect()) == [2, 3, 4]


def test_failures_end(spark, col):
    states = [col(L.state_after_failure(F.col("x"), 3), "x int", n) for n in (1, 2, 3, 4)]
    assert states == ["retry", "retry", "failed", "failed"]


@pytest.mark.parametrize("limit", [None, 10, 1000])
def test_assign_hosts(spark, limit):
    tasks = spark.range(37).withColumn("at", F.lit(5) - F.col("id") % 5)
    dealt = L.assign_hosts(tasks, 4, ["at", "id"], limit)
    loads = [r[0] for r in dealt.groupBy("host_no").count().select("count").collect()]
    assert sum(loads) == min(limit or 37, 37) and max(loads) - min(loads) <= 1
    assert dealt.select("id").distinct().count() == dealt.count()


def test_resets_and_defaults(spark):
    ledger = spark.createDataFrame([("a", 1), ("b", 1), ("c", 0)], "url string, status int")
    assert rows(L.reset_done(ledger)) == [("a", 0), ("b", 0), ("c", 0)]
    one = spark.createDataFrame([("a",)], "url string")
    assert rows(L.reset_done(ledger, keys=one)) == [("a", 0), ("b", 1), ("c", 0)]
    assert L.count_resets(ledger).first()[0] == 2
    asked = spark.createDataFrame([("a",), ("z",), (None,)], "url string")
    assert rows(J.with_default(asked, ledger, ["url"], "status")) == [("a", 1), ("z", 0), (None, 0)]
    assert rows(L.done_rows(ledger)) == [("a",), ("b",)]


def test_added_columns(spark):
    df = spark.range(1).toDF("id")
    wide = L.with_columns_added(df, {"id": "string", "computer": "string"})
    assert wide.dtypes == [("id", "bigint"), ("computer", "string")]
    assert L.append_evolving(df, wide).count() == 2


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "status int")
    assert tuple(M.status_summary(empty, F.col("status") == 1).first()) == (0, 0, 0, 0.0)


@pytest.mark.parametrize("failed,accepted", [(0, True), (1, True), (2, False)])
def test_failure_ratio(spark, failed, accepted):
    segments = spark.range(10).select(F.lit(1).alias("a"), (F.col("id") >= failed).alias("ok"))
    got = M.accept_by_failures(segments, ["a"], F.col("ok")).first()
    assert (got.accepted, got.complete, got.outcome) == (accepted, failed == 0, "partial" if failed else "all")


def test_best_resolution(spark):
    df = spark.createDataFrame([(1, 1920, 1080), (1, 1280, 720), (2, 640, 360), (3, None, None),
                                (4, 100, 720), (4, 1280, 720)], "a int, width int, height int")
    got = {r.a: (r.n_sizes, r.best_width, r.best_height) for r in M.best_resolution(df, ["a"]).collect()}
    assert got == {1: (2, 1920, 1080), 2: (1, 640, 360), 3: (0, None, None), 4: (2, 1280, 720)}


def test_page_marks_stop_at_a_failed_page(spark):
    pages = spark.createDataFrame([("a", 1, True), ("a", 2, True), ("a", 2, False), ("a", 4, True),
                                   ("b", 1, False), ("b", 2, True)], "k string, page int, ok boolean")
    for pieces in (None, 3):
        marks = M.page_marks(pages, ["k"], "page", F.col("ok"), pieces=pieces)
        assert rows(marks) == [("a", 2), ("b", 0)]
    assert rows(M.pages_to_fetch(marks, add=3)) == [("a", 3), ("b", 1), ("b", 2), ("b", 3)]


def test_page_marks_from_a_later_page(spark):
    pages = spark.createDataFrame([("before", p, True) for p in range(1, 31)] + [("after", 40, True)]
                                  + [("across", p, p != 33) for p in range(29, 36)], "k string, page int, ok boolean")
    marks = M.page_marks(pages, ["k"], "page", F.col("ok"), start=31)
    assert rows(marks) == [("across", 32), ("after", 30), ("before", 30)]
    assert rows(M.pages_to_fetch(marks, add=2, start=31)) == [("after", 31), ("after", 32), ("before", 31), ("before", 32)]


def test_reconcile_counts_a_repeated_path_once(spark):
    a = spark.createDataFrame([("x", 1)] * 3, "path string, length int")
    assert [r["verdict"] for r in J.reconcile_sizes(a, a).collect()] == ["ok"]


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "path string, length int")
    b = spark.createDataFrame([("x", 1), ("y", 9), ("w", 3)], "path string, length int")
    got = {r.path: r.verdict for r in J.reconcile_sizes(a, b).collect()}
    assert got == {"x": "ok", "y": "mismatch", "z": "missing", "w": "extra"}


def test_gate(spark):
    df = spark.createDataFrame([(1, 5), (2, 6)], "id int, length int")
    assert E.release_gate(df, "length", 11, F.lit(False)).count() == 2
    assert E.release_gate(df, "length", 12, F.lit(False)).count() == 0
    assert E.release_gate(df, "length", 12, F.lit(True)).count() == 2
    assert E.release_gate(df.where("id > 9"), "length", 1, F.lit(False)).count() == 0


@pytest.mark.parametrize("sizes,stable", [
    ([5, 5, 5, 5, 5], True), ([5, 5, 6, 6, 6], False), ([0, 0, 0, 0, 0], False), ([5, 5, 5, 5], False)])
def test_stability(spark, sizes, stable):
    looks = spark.createDataFrame([("f", i, n) for i, n in enumerate(sizes)],
                                  "path string, snapshot_ts int, length int")
    last = E.stable_flags(looks, 4).orderBy(F.desc("snapshot_ts")).first()
    assert last.stable is stable


def test_pending_report(spark):
    urls = spark.createDataFrame([("http://a/1_",), ("http://a/1",), ("http://a/2",), ("x",)], "url string")
    done = spark.createDataFrame([("http://a/1",)], "url string")
    clean = reports.cleaned_urls(urls, ["http://a/"])
    assert tuple(reports.pending_report(clean, done).first()) == (4, 1, 2, 1, 200 / 3)
    assert rows(reports.pending_urls(clean, done)) == [("http://a/2",)]


def test_sets(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(sets.union_distinct(a, b)) == [(1,), (2,), (3,)]
    assert sets.bag_union(a, b).count() == 5
    assert rows(sets.difference(a, b)) == [(2,)]
    assert rows(sets.bag_difference(a, b)) == [(1,), (2,)]


def test_pending_pages_go_by_clean_url(spark, tmp_path):
    """A URL is done for every page that lists it, however it is written there."""
    from assetloom.registry import QUERIES
    urls = ["https://a.example.com/x", "https://a.example.com/x_ ", "https://a.example.com/y_", "https://a.example.com/z"]
    spark.createDataFrame(list(enumerate(urls, 1)), "page_id bigint, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([(1, 1), (3, 1), (4, 0)], "doc_id bigint, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [(r["page_id"], r["url"]) for r in QUERIES["pending_pages"](spark, str(tmp_path)).collect()] == [(4, urls[3])]
    report = QUERIES["pending_report"](spark, str(tmp_path)).first()
    assert (report["listed"], report["done"], report["pending"]) == (4, 3, 1)
