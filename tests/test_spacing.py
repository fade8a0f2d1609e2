"""The exact throttle, claims by quota and free suffixes against plain loops."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from assetloom.functions import strings as S
from assetloom.operators import ledger as L, spacing
from assetloom.operators.spacing import keep_spaced
from assetloom.plans import logs, renames
from assetloom.sources import readers

T0 = datetime(2024, 5, 1)


def plain_throttle(rows, seconds, points):
    kept, last = [], {}
    for key, at, pos, percent in sorted((r for r in rows if r[1] is not None and r[3] is not None), key=lambda r: r[1:3]):
        if key in last:
            before, value = last[key]
            if (at - before).total_seconds() < seconds and abs(percent - value) < points and percent < 99:
                continue
        last[key] = at, percent
        kept.append((key, at, pos, percent))
    return sorted(map(str, kept))


def run_throttle(spark, rows, seconds, points, **options):
    frame = spark.createDataFrame(rows, "key string, at timestamp, pos int, percent double").withColumn("own", F.lit("x"))
    kept = keep_spaced(frame, ["key"], ["at", "pos"], "percent", min_seconds=seconds, min_change=points,
                       always=F.col("percent") >= 99, **options)
    assert kept.columns == frame.columns
    return sorted(str(tuple(r)[:4]) for r in kept.collect())


@pytest.mark.parametrize("span", [1, 2, 8])
@pytest.mark.parametrize("steady", [True, False])
def test_throttle_of_a_hot_key(spark, span, steady):
    draw = random.Random(span)
    at, rows, percent = 0.0, [], 0.0
    for i in range(900):  # stretch after stretch of one key, without a gap that would cut the chain
        at += 0.1 if steady else draw.choice([0, 0.05, 0.1, 0.3, 0.6, 3])
        percent = (percent + 0.11) % 99.5 if steady else draw.choice([1.0, 1.2, 1.4, 1.6, 2.0, 99.0])
        rows.append(("hot" if i % 5 else draw.choice(["a", None]), T0 + timedelta(seconds=at), i, percent))
    rows += [("hot", None, -1, 5.0), ("hot", T0, -2, None), ("early", T0 - timedelta(days=20_000), -3, 1.0)]
    for seconds, points in ((0.5, 0.5), (0.7, 3)):
        got = run_throttle(spark, rows, seconds, points, span=span)
        assert got == plain_throttle(rows, seconds, points)


def test_throttle_of_odd_tables(spark):
    assert run_throttle(spark, [], 1, 1) == []
    same = [("k", T0, i, 5.0) for i in range(40)]
    assert run_throttle(spark, same, 1, 1) == [str(("k", T0, 0, 5.0))]
    assert len(run_throttle(spark, same, 0, 1)) == 40


def test_progress_is_throttled_by_the_last_row_let_through(spark):
    rows = [("k", T0 + timedelta(seconds=i / 10), i, i / 10) for i in range(30)]  # neighbours never differ enough
    frame = spark.createDataFrame(rows, "run string, at timestamp, pos int, percent double")
    kept = logs.throttled_progress(frame, ["run"], ["at", "pos"])
    assert [r.pos for r in kept.orderBy("pos").collect()] == [0, 5, 10, 15, 20, 25]


@pytest.mark.parametrize("top_up", [False, True])
def test_claims_by_quota(spark, monkeypatch, top_up):
    monkeypatch.setattr(L, "SLOTS", 7)
    draw = random.Random(7)
    tasks = [(i, T0 + timedelta(minutes=draw.randint(0, 30)), draw.choice(["queued", "pending", "retry", "running", "done"]),
              draw.choice(["a", "b", "full", "zero", "unknown", None])) for i in range(400)]
    quotas = {"a": 200, "b": 3, "c": 41, "d": 2, "zero": 0, "none": None, "full": 5}
    hosts = spark.createDataFrame([(h, q, "own") for h, q in quotas.items()], "host string, quota int, state string")
    frame = spark.createDataFrame(tasks, "task int, at timestamp, state string, host string")
    got = sorted(tuple(r) for r in L.claim_by_quota(frame, hosts, ["at", "task"], top_up=top_up).select(
        "task", "host", "claim").collect())
    ordered = sorted(tasks, key=lambda r: (r[1], r[0]))
    expected, taken = [], defaultdict(int)
    for task, _, state, host in ordered:
        if state == "queued" and taken[host] < (quotas.get(host) or 0):
            taken[host] += 1
            expected.append((task, host, "own"))
    waiting = [r[0] for r in ordered if r[2] in ("pending", "retry")]
    for host in sorted(h for h, q in quotas.items() if q):
        free = 0 if taken[host] and not top_up else quotas[host] - taken[host]
        expected += [(task, host, "new") for task in waiting[:free]]
        waiting = waiting[free:]
    assert taken["full"] == 5 and got == sorted(expected)
    assert L.claim_by_quota(frame.where("1 = 0"), hosts, ["at", "task"]).count() == 0


def test_suffixes_are_the_next_free_ones(spark):
    draw = random.Random(3)
    names = ["a.mp4", "a_1.mp4", "a_3.mp4", "a_1_1.mp4", "b", "b_2", "b_02", "a_0.mp4", "x.tar.gz", "_1.y", ".z", "c_9" + "9" * 20]
    rows = [(i, draw.choice(names), i) for i in range(160)] + [(500, None, 0)]
    there = ["a.mp4", "a_2.mp4", "a_2.mp4", "a_5.mp4", "b_1_1", "x_1.tar.gz", "x.tar_1.gz", None]
    frame = spark.createDataFrame(rows, "id int, name string, final_name int")
    taken = spark.createDataFrame([(n,) for n in there], "name string")
    got = {r["id"]: r["out"] for r in renames.suffix_collisions(frame, "name", "id", "out", taken).collect()}
    used = {n for _, n, _ in rows} | set(there)
    first, expected = set(there), {500: None}
    for i, name, _ in rows[:-1]:
        if name not in first:
            first.add(name)
            expected[i] = name
            continue
        dot = name.rfind(".")
        stem, ext = (name[:dot], name[dot:]) if dot > 0 and name[dot + 1:].isalnum() else (name, "")
        k = next(k for k in range(1, 999) if f"{stem}_{k}{ext}" not in used)
        used.add(f"{stem}_{k}{ext}")
        expected[i] = f"{stem}_{k}{ext}"
    assert got == expected
    given = [n for n in got.values() if n]
    assert len(set(given)) == len(given) and not set(given) & set(there)


# The examples of RFC 3986, 5.4, for the base below.
BASE = "http://a/b/c/d;p?q"
EXAMPLES = [
    ("g:h", "g:h"), ("g", "http://a/b/c/g"), ("./g", "http://a/b/c/g"), ("g/", "http://a/b/c/g/"), ("/g", "http://a/g"),
    ("//g", "http://g"), ("?y", "http://a/b/c/d;p?y"), ("g?y", "http://a/b/c/g?y"), ("#s", "http://a/b/c/d;p?q#s"),
    ("g#s", "http://a/b/c/g#s"), ("g?y#s", "http://a/b/c/g?y#s"), (";x", "http://a/b/c/;x"), ("g;x", "http://a/b/c/g;x"),
    ("g;x?y#s", "http://a/b/c/g;x?y#s"), ("", "http://a/b/c/d;p?q"), (".", "http://a/b/c/"), ("./", "http://a/b/c/"),
    ("..", "http://a/b/"), ("../", "http://a/b/"), ("../g", "http://a/b/g"), ("../..", "http://a/"), ("../../", "http://a/"),
    ("../../g", "http://a/g"), ("../../../g", "http://a/g"), ("../../../../g", "http://a/g"), ("/./g", "http://a/g"),
    ("/../g", "http://a/g"), ("g.", "http://a/b/c/g."), (".g", "http://a/b/c/.g"), ("g..", "http://a/b/c/g.."),
    ("..g", "http://a/b/c/..g"), ("./../g", "http://a/b/g"), ("./g/.", "http://a/b/c/g/"), ("g/./h", "http://a/b/c/g/h"),
    ("g/../h", "http://a/b/c/h"), ("g;x=1/./y", "http://a/b/c/g;x=1/y"), ("g;x=1/../y", "http://a/b/c/y"),
    ("g?y/./x", "http://a/b/c/g?y/./x"), ("g?y/../x", "http://a/b/c/g?y/../x"), ("g#s/./x", "http://a/b/c/g#s/./x"),
    ("g#s/../x", "http://a/b/c/g#s/../x"), ("http:g", "http:g")]


def test_references(spark):
    rows = spark.createDataFrame(EXAMPLES, "ref string, joined string")
    got = {r["ref"]: r["got"] for r in rows.select("ref", S.join_url(F.lit(BASE), F.col("ref")).alias("got")).collect()}
    assert got == dict(EXAMPLES)


def test_whole_file_maps_are_read_by_entry(spark, tmp_path):
    import json
    ledger = {f'k"{{{i}': {"url": f"u{i}", "status": i % 2, "title": '},\n  "x": {'} for i in range(300)}
    (tmp_path / "a.json").write_text(json.dumps(ledger, indent=2, ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps({"one": {"url": "line", "status": 1}}))
    (tmp_path / "c.json").write_text(json.dumps(ledger, indent=2)[:-40])
    (tmp_path / "d.json").write_text("")
    (tmp_path / "e.json").write_text("{\n}\n")
    (tmp_path / "f.json").write_text('{\n"a":\n{"url": "far"}, "b": {"url": "same line"}\n}')
    rows = readers.map_ledger(spark, str(tmp_path))
    got = {r["key"]: (r["url"], r["status"], r["title"]) for r in rows.collect()}
    expected = {k: (v["url"], v["status"], v["title"]) for k, v in ledger.items()}
    assert got == expected | {"one": ("line", 1, None), "a": ("far", None, None), "b": ("same line", None, None)}
    # an entry is a row of its own, whatever the size of the map
    assert readers.map_chunks(spark, str(tmp_path / "a.json")).where("length(body) < 100").count() >= 300


@pytest.mark.parametrize("longest", [0, 40, 8192])
def test_throttle_cuts_where_a_row_is_kept_anyhow(spark, longest):
    """Blocks of all lengths, with jumps, runs of equal rows, marked rows and odd values between them."""
    draw = random.Random(longest)
    at, rows, percent = 0.0, [], 0.0
    for i in range(1500):
        at += draw.choice([0, 0, 0, 0.01, 0.01, 0.02, 0.3])
        percent = draw.choice([percent, percent, percent, min(percent + 0.4, 98.0), draw.random() * 100, 98.0 - percent / 2])
        rows.append(("hot" if i % 6 else draw.choice(["a", None]), T0 + timedelta(seconds=at), i, percent))
    rows += [("odd", T0 + timedelta(seconds=i / 100), i, v) for i, v in enumerate([1.0, float("inf"), 2.0, 2.0, -5.0])]
    for seconds, points in ((0.5, 20), (2, 35), (0.2, 0.4)):
        assert run_throttle(spark, rows, seconds, points, longest=longest, span=2) == plain_throttle(rows, seconds, points)


def test_throttle_puts_a_dense_hot_key_in_blocks(spark):
    """All rows of one key within min_seconds: no array of the plan holds more than a block of them."""
    frame = spark.range(20_000).select(F.lit("k").alias("key"), F.timestamp_micros(F.lit(10 ** 15) + F.col("id")).alias("at"),
                                       "id", (F.col("id") * 37 % 98).cast("double").alias("percent"))
    told = spacing._blocks(frame, ["key"], ["at", "id"], "percent", F.col("percent") >= 99, 10 ** 9, 20)
    sizes = [r["count"] for r in told.groupBy("_key").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 2 * spacing.BLOCK
