"""Streams equal their batch forms, whatever the micro-batches."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from assetloom.operators.filters import stable_flags
from assetloom.streaming import arrivals, state, tables

T0 = datetime(2024, 5, 1)


def as_files(spark, rows, schema, n, path):
    """Write rows in order as n files, oldest first, and stream one file per batch."""
    step = -(-len(rows) // n)
    for i in range(n):
        part = rows[i * step:(i + 1) * step]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return arrivals.table_stream(spark, path, files_per_trigger=1)


SNAPSHOT = "path string, snapshot_ts timestamp, look bigint, length bigint"


def test_stable(spark, tmp_path):
    rows = [(f"f{i % 4}", T0 + timedelta(seconds=i // 3), i, (i // 12) % 3) for i in range(96)]
    rows[40:48] = reversed(rows[40:48])  # out of order within and across files
    stream = as_files(spark, rows, SNAPSHOT, 3, str(tmp_path / "in"))
    got = arrivals.drain_closed_to_table(
        stream, "snapshot_ts", lambda s: state.stable_files(s, 2, None, late_by="20 seconds", slot="3 seconds", tie="look"), "stable")
    batch = stable_flags(spark.createDataFrame(rows, SNAPSHOT), 2, ts=("snapshot_ts", "look")).drop("size_change")
    assert sorted(map(str, got.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_silent_files_are_forgotten(spark, tmp_path):
    rows = [("a", T0 + timedelta(seconds=s), s, 5) for s in (0, 1, 2, 9, 10, 11)] 
    rows += [("b", T0 + timedelta(seconds=s), s, 1) for s in (60, 120)]
    stream = as_files(spark, rows, SNAPSHOT, 8, str(tmp_path / "in"))
    checkpoint, out = str(tmp_path / "checkpoint"), str(tmp_path / "out")
    told = state.stable_files(stream, 2, "5 seconds", late_by="0 seconds", slot="1 second", tie="look")
    query = arrivals.start(told.writeStream.format("parquet").option("path", out), checkpoint, once=True)
    query.awaitTermination()
    got = {r.look: r.stable for r in spark.read.parquet(out).collect()}
    assert got == {0: False, 1: False, 2: True, 9: False, 10: False, 11: True, 60: False}  # 9 starts anew
    kept = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last").load())
    assert [r["key"]["key"] for r in kept.collect()] == ["b"]  # a's record is gone, b's last row still waits
    waiting = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "held").load()
    assert waiting.count() == 1


@pytest.mark.parametrize("pieces", [None, 5])
def test_stable_batches(spark, tmp_path, pieces):
    rows = [(f"f{i % 4 if i % 2 else 0}", T0 + timedelta(seconds=i), (i // 12) % 3) for i in range(96)]
    schema = "path string, snapshot_ts timestamp, length bigint"
    stream = as_files(spark, rows, schema, 4, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    write = tables.stable_batches(out, str(tmp_path / "recent"), 2, pieces=pieces)
    tables.drain_batches(stream, write, "stable")
    batch = stable_flags(spark.createDataFrame(rows, schema), 2).drop("size_change")
    got = spark.read.parquet(out).select(*batch.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))


def test_throttle(spark, tmp_path):
    rows = [("a", T0 + timedelta(milliseconds=100 * i), 0.1 * i if i < 20 else 99.0 + i / 100) for i in range(25)]
    rows += [("b", T0 + timedelta(milliseconds=200 * i), 2.0) for i in range(9)]
    rows.sort(key=lambda r: r[1])
    stream = as_files(spark, rows, "asset_id string, ts timestamp, percent double", 3, str(tmp_path / "in"))
    kept = arrivals.drain_closed_to_table(stream, "ts", lambda s: state.throttle_progress(s, forget_after=None, slot="1 second"), "kept")
    expected, last = [], {}
    for key, ts, percent in rows:
        if key in last:
            at, before = last[key]
            if (ts - at).total_seconds() < 0.5 and abs(percent - before) < 0.5 and percent < 99:
                continue
        last[key] = (ts, percent)
        expected.append((key, ts, percent))
    assert sorted(map(tuple, kept.collect())) == sorted(expected)


def test_throttle_by_buckets(spark, tmp_path):
    """Many keys share a record of the state; nulls, ties and late times keep their meaning."""
    rows = [(i % 150 if i % 7 else None, T0 + timedelta(milliseconds=40 * i - 300 * (i % 2)), i, (i * 37 % 1001) / 10 if i % 11 else None)
            for i in range(3000)] + [(1, datetime(2500, 1, 1), 3000, 5.0)]
    stream = as_files(spark, rows, "asset_id bigint, ts timestamp, pos bigint, percent double", 3, str(tmp_path / "in"))
    kept = arrivals.drain_closed_to_table(stream, "ts", lambda s: state.throttle_progress(
        s, 20, 15, None, late_by="10 seconds", slot="3 seconds", tie="pos", buckets=4), "kept")
    expected, last = [], {}
    for key, ts, pos, percent in sorted((r for r in rows if None not in (r[0], r[3])), key=lambda r: r[1:3]):
        at, before = last.get(key, (datetime(1, 1, 1), 0))
        if (ts - at).total_seconds() >= 20 or abs(percent - before) >= 15 or percent >= 99:
            last[key] = ts, percent
            expected.append((key, ts, pos, percent))
    assert sorted(map(tuple, kept.collect())) == sorted(expected)
    assert kept.dtypes == [("asset_id", "bigint"), ("ts", "timestamp"), ("pos", "bigint"), ("percent", "double")]


def test_stable_by_buckets(spark, tmp_path):
    """As ``test_silent_files_are_forgotten``, and the state has far fewer records than there are paths."""
    rows = [(f"f{i}", T0 + timedelta(seconds=s), s, 5) for s in (0, 1, 2, 9, 10, 11) for i in range(200)]
    rows += [(f"g{i}", T0 + timedelta(seconds=s), s, None if s == 61 else 1) for s in (60, 61, 62, 120) for i in range(200)]
    stream = as_files(spark, rows, SNAPSHOT, 8, str(tmp_path / "in"))
    checkpoint, out = str(tmp_path / "checkpoint"), str(tmp_path / "out")
    told = state.stable_files(stream, 2, "5 seconds", late_by="0 seconds", slot="1 second", tie="look", buckets=2)
    arrivals.start(told.writeStream.format("parquet").option("path", out), checkpoint, once=True).awaitTermination()
    got = sorted((r.look, r.length, r.stable, r["n"]) for r in spark.read.parquet(out).groupBy("look", "length", "stable").agg(
        F.count(F.lit(1)).alias("n")).collect() if r.look != 61)
    assert got == [(0, 5, False, 200), (1, 5, False, 200), (2, 5, True, 200), (9, 5, False, 200), (10, 5, False, 200),
                   (11, 5, True, 200), (60, 1, False, 200), (62, 1, False, 200)]
    assert spark.read.parquet(out).where("look = 61 AND length IS NULL AND NOT stable").count() == 200
    for name in ("last", "held"):
        records = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()
        assert 0 < records.count() <= 2 * state.SHARDS


def folders(path):
    return {p.name for p in path.iterdir()}


def test_links_once_over_all_batches(spark, tmp_path):
    rows = [(f"u{i % 7}", i) for i in range(40)]
    schema = "link string, n bigint"
    stream = as_files(spark, rows, schema, 4, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    write = tables.new_link_batches(out, "link", ["n"])
    tables.drain_batches(stream, write, "links")
    known = lambda: sorted((r.link, r.n) for r in tables.read_links(spark, out, schema).collect())
    got = known()
    assert got == [(f"u{i}", i) for i in range(7)]
    write(spark.createDataFrame(rows[:10], schema), 0)  # a replayed batch changes nothing
    assert known() == got


def test_a_batch_reads_the_buckets_of_its_links(spark, tmp_path):
    schema = "link string, n bigint"
    out = str(tmp_path / "out")
    write = tables.new_link_batches(out, "link", ["n"], buckets=16, merge_every=3)
    for batch in range(8):
        write(spark.createDataFrame([(f"u{i}", batch) for i in range(batch, batch + 40)], schema), batch)
    assert sorted((r.link, r.n) for r in tables.read_links(spark, out, schema).collect()) == sorted(
        [(f"u{i}", 0) for i in range(40)] + [(f"u{39 + b}", b) for b in range(1, 8)])
    one = tables._with_bucket(spark.createDataFrame([("u5", 9)], schema), "link", 16).first()["bucket"]
    known = tables.read_batches(spark, out, schema, 8, [one])
    assert known.inputFiles() and all(f"bucket={one}/" in f for f in known.inputFiles())
    assert {r.link for r in known.collect()} >= {"u5"}
    assert len([f for f in folders(tmp_path / "out") if f.startswith("batch=")]) <= 6


@pytest.mark.parametrize("crash", [False, True])
def test_merged_upserts(spark, tmp_path, monkeypatch, crash):
    out, newest = str(tmp_path / "out"), ["seq"]
    schema = "task bigint, state string, seq bigint"
    write = tables.upsert_batches(out, ["task"], newest, merge_every=5)
    most = 0
    for batch in range(50):
        rows = spark.createDataFrame([(t, f"s{batch}", batch) for t in range(batch % 4, 20, 4)], schema)
        if crash and batch in (10, 25):  # a merge that breaks off is not seen, and is done again
            monkeypatch.setattr(tables, "file_system", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                write(rows, batch)
            monkeypatch.undo()
        write(rows, batch)
        most = max(most, len([f for f in folders(tmp_path / "out") if f.startswith("batch=")]))
    expected = [(t, f"s{b}", b) for t, b in ((t, max(b for b in range(50) if b % 4 == t % 4)) for t in range(20))]
    for _ in range(2):
        current = tables.read_current(spark, out, ["task"], newest, schema)
        assert sorted(map(tuple, current.select("task", "state", "seq").collect())) == expected
        write(spark.createDataFrame([(t, "s49", 49) for t in range(1, 20, 4)], schema), 49)  # replayed
    assert most <= 11 and len(folders(tmp_path / "out" / "_merged")) <= 2


def test_upserts_survive_replay(spark, tmp_path):
    rows = [(i % 5, f"s{i}", i) for i in range(30)]
    schema = "task bigint, state string, seq bigint"
    stream = as_files(spark, rows, schema, 3, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    write = tables.upsert_batches(out, ["task"], ["seq"])
    tables.drain_batches(stream, write, "upserts")
    expected = [(i % 5, f"s{i}", i) for i in range(25, 30)]
    for _ in range(2):
        current = tables.read_current(spark, out, ["task"], ["seq"], schema).select("task", "state", "seq")
        assert sorted(map(tuple, current.collect())) == expected
        write(spark.createDataFrame(rows[20:], schema), 2)


def test_rows_are_held_by_reference(spark, tmp_path):
    held, ledger, schema = str(tmp_path / "rows"), str(tmp_path / "ledger"), "id int, n int"
    write = tables.hold_batches(held, ledger, "n", 10, F.lit(False))
    for batch_id, n in enumerate([4, 5, 3, 2]):
        for _ in range(2):  # each batch is replayed
            write(spark.createDataFrame([(batch_id, n)], schema), batch_id)
    got = sorted((r.id, r.batch, r.release) for r in tables.read_released(spark, held, ledger, schema).collect())
    assert got == [(0, 0, 2), (1, 1, 2), (2, 2, 2)]
    assert [(r.id, r.batch) for r in tables.read_held(spark, held, ledger, schema).collect()] == [(3, 3)]
    tables.hold_batches(held, ledger, "n", 10, F.lit(True))(spark.createDataFrame([(4, 1)], schema), 4)
    assert tables.read_held(spark, held, ledger, schema).count() == 0
    assert {r.release for r in tables.read_released(spark, held, ledger, schema).where("id > 2").collect()} == {4}


def test_held_rows_are_written_once(spark, tmp_path):
    held, ledger, schema = tmp_path / "rows", str(tmp_path / "ledger"), "id int, n int"
    write = tables.hold_batches(str(held), ledger, "n", 10 ** 9, F.lit(False))
    sizes = []
    for batch_id in range(20):
        write(spark.range(500).selectExpr("CAST(id AS INT) AS id", "1 AS n").coalesce(1), batch_id)
        sizes.append(sum(f.stat().st_size for f in held.rglob("*.parquet")))
    assert sizes[19] == 20 * sizes[0]
    assert tables.read_held(spark, str(held), ledger, schema).count() == 10_000


def test_counts_and_late_rows(spark, tmp_path):
    rows = [(T0 + timedelta(hours=h), "done") for h in (1, 2, 30, 60, 100, 3)]
    stream = as_files(spark, rows, "at timestamp, state string", 6, str(tmp_path / "in"))
    counts = tables.status_counts(stream.withColumnRenamed("at", "ts"), "ts", "state", "1 day", "1 day")
    got = {r.window_start: r.n for r in tables.drained_counts(counts, ["window_start", "state"]).collect()}
    # hour 3 arrives when the watermark stands at hour 76: late, not counted
    assert got == {T0: 2, T0 + timedelta(days=1): 1, T0 + timedelta(days=2): 1, T0 + timedelta(days=4): 1}
    stream = arrivals.table_stream(spark, str(tmp_path / "in"), 1)
    counts = tables.status_counts(stream.withColumnRenamed("at", "ts"), "ts", "state", "1 day", "30 days")
    got = {r.window_start: r.n for r in tables.drained_counts(counts, ["window_start", "state"]).collect()}
    assert got[T0] == 3


def test_arrivals(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.mp4").write_bytes(b"123")
    found = arrivals.drain_to_table(arrivals.file_arrivals(spark, str(tmp_path / "in")), "arrivals")
    assert [r.length for r in found.collect()] == [3]


def test_looks_see_files_grow_and_go(spark, tmp_path):
    root, changes = tmp_path / "in", tmp_path / "changes"
    root.mkdir()
    look = arrivals.look_batches(str(root), str(tmp_path / "looks"), str(changes))
    tick = spark.range(0)
    told = lambda n: sorted((r.path[-1], r.status, r.length_before, r.length) for r in
                            spark.read.parquet(str(changes / f"batch={n}")).collect())
    (root / "a").write_bytes(b"123")
    (root / "b").write_bytes(b"1")
    look(tick, 0)
    (root / "a").write_bytes(b"12345")
    (root / "b").unlink()
    (root / "c").write_bytes(b"1")
    (root / "d").write_bytes(b"")  # not listed
    look(tick, 1)
    look(tick, 1)
    look(tick, 2)
    assert told(0) == [("a", "new", None, 3), ("b", "new", None, 1)]
    assert told(1) == [("a", "changed", 3, 5), ("b", "gone", 1, None), ("c", "new", None, 1)]
    assert told(2) == [] and folders(tmp_path / "looks") == {"look=1", "look=2"}


def test_final_counts_leave_late_rows_out(spark, tmp_path):
    rows = [(T0 + timedelta(hours=h), "done") for h in (1, 2, 30, 60, 100, 3)]
    stream = as_files(spark, rows, "at timestamp, state string", 6, str(tmp_path / "in"))
    got = arrivals.drain_closed_to_table(stream, "at", lambda s: tables.status_counts(s, "at", "state"), "final")
    assert {r.window_start: r.n for r in got.collect()} == {
        T0: 2, T0 + timedelta(days=1): 1, T0 + timedelta(days=2): 1, T0 + timedelta(days=4): 1}


def test_dedup_within_watermark(spark, tmp_path):
    rows = [(f"u{i % 3}", T0 + timedelta(minutes=i)) for i in range(12)]
    stream = as_files(spark, rows, "link string, at timestamp", 2, str(tmp_path / "in"))
    got = arrivals.drain_to_table(tables.dedup_links(stream, "link", "at"), "dedup")
    assert sorted(r.link for r in got.collect()) == ["u0", "u1", "u2"]
    stream = arrivals.table_stream(spark, str(tmp_path / "in"), 1)
    got = arrivals.drain_to_table(tables.dedup_links(stream, "link", "at", None), "dedup")
    assert sorted(r.link for r in got.collect()) == ["u0", "u1", "u2"]
