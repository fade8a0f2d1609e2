"""Readers and sinks on written files."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from assetloom.sources import readers as R, sinks
from assetloom.session import materialize, scratch_path


def test_inventory(spark, tmp_path):
    (tmp_path / "深 x").mkdir()
    (tmp_path / "深 x" / "a%20b.MP4").write_bytes(b"12345")
    (tmp_path / "c.txt").write_text("x")
    found = {r.path.rsplit("/", 1)[1]: r.length for r in R.file_inventory(spark, str(tmp_path)).collect()}
    assert found == {"a%20b.MP4": 5, "c.txt": 1}
    assert R.file_inventory(spark, str(tmp_path), "*.MP4").count() == 1


def test_inventory_reads_no_contents(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    plan = R.file_inventory(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_lists(spark, tmp_path):
    (tmp_path / "urls.txt").write_text(" http://a \n\n# c\n  # d\n\thttp://b\n")
    assert sorted(r.url for r in R.url_list(spark, str(tmp_path / "urls.txt")).collect()) == ["http://a", "http://b"]
    (tmp_path / "rec.txt").write_text("one\ntwo\n---\n\n \n---\n three\t")
    got = [r.record for r in R.text_records(spark, str(tmp_path / "rec.txt"), "---").collect()]
    assert sorted(got) == ["one\ntwo", "three"]


def test_map_ledger(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k1": {"url": "u1", "status": 1,\n "title": "t"}, "k2": {"url": "u2"}}')
    (tmp_path / "b.json").write_text("")
    (tmp_path / "c.json").write_text('{"k3": ')
    got = sorted((r.key, r.url, r.status) for r in R.map_ledger(spark, str(tmp_path)).collect())
    assert got == [("k1", "u1", 1), ("k2", "u2", None)]


def test_appends(spark, tmp_path):
    out = str(tmp_path / "links")
    sinks.append_links(spark.createDataFrame([("a",)], "url string"), out)
    sinks.append_links(spark.createDataFrame([("b",)], "url string"), out)
    assert sorted(r.url for r in R.url_list(spark, out).collect()) == ["a", "b"]
    done = str(tmp_path / "done")
    sinks.write_done_paths(spark.createDataFrame([('/x,"y.mp4',)], "path string"), done)
    assert [r.path for r in R.done_paths(spark, done).collect()] == ['/x,"y.mp4']
    ops = str(tmp_path / "ops")
    row = spark.createDataFrame([(datetime(2024, 5, 1, 10), "get", "ok", "1", "d", "pc")], R.OPERATION_LOG.replace(
        "timestamp string", "timestamp timestamp"))
    sinks.append_operations(row, ops)
    sinks.append_operations(row, ops)
    assert [r.timestamp for r in R.operation_log(spark, ops).collect()] == ["2024-05-01T10:00:00.000000"] * 2


def test_ledger_with_a_later_column(spark, tmp_path):
    out = str(tmp_path / "ledger")
    sinks.append_ledger(spark.createDataFrame([(1,)], "id int"), out)
    sinks.append_ledger(spark.createDataFrame([(2, "pc")], "id int, computer string"), out)
    got = R.ledger_files(spark, out).select("id", "computer").collect()
    assert sorted(map(tuple, got)) == [(1, None), (2, "pc")]


def test_keyword_folders(spark, tmp_path):
    rows = spark.range(90).select("id", F.when(F.col("id") < 60, "hot").otherwise(
        (F.col("id") % 5).cast("string")).alias("keyword"))
    sinks.write_by_keyword(rows, str(tmp_path / "k"))
    assert spark.read.parquet(str(tmp_path / "k")).count() == 90
    assert len(list((tmp_path / "k").glob("keyword=*"))) == 6


def test_jdbc_options():
    plain = R.jdbc_options("jdbc:x", "t")
    assert "partitionColumn" not in plain
    ranged = R.jdbc_options("jdbc:x", "t", key="id", low=0, high=9, partitions=3)
    assert ranged["numPartitions"] == "3" and ranged["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x", "t", key="id")


def test_scratch_is_shared_and_new(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert one != two and one.startswith(shared)
    assert materialize(spark.range(5), "t").count() == 5
