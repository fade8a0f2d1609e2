"""Segment plans, manifests, renames, logs and payloads."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from assetloom.operators import joins as J, metrics as M
from assetloom.plans import ingest, logs, manifests, renames, scenes, segments, transfer


def cut_by_loop(duration, threshold=180, step=90):
    parts, done = [], 0.0
    while done < duration:
        left = duration - done
        parts.append((done, float(step) if left >= threshold else left))
        done += parts[-1][1]
    return parts if duration >= threshold else []


@pytest.mark.parametrize("duration,n", [(10, 0), (179.99, 0), (180, 2), (180.5, 2), (269.9, 2), (270, 3),
                                        (300, 3), (1000, 11), (3601.25, 40)])
def test_segment_counts(spark, duration, n):
    df = spark.createDataFrame([(1, float(duration))], "id int, d double")
    parts = segments.fixed_segments(df, "d").orderBy("seg_no").collect()
    assert len(parts) == n
    assert [(p.start, p.length) for p in parts] == cut_by_loop(float(duration))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 5000).map(lambda x: round(x, 2)), min_size=1, max_size=20))
def test_segments_tile(spark, durations):
    df = spark.createDataFrame(list(enumerate(durations)), "id int, d double")
    parts = segments.fixed_segments(df, "d", threshold=90, step=90)
    got = {}
    for p in parts.orderBy("id", "seg_no").collect():
        got.setdefault(p.id, []).append(p)
    for i, d in enumerate(durations):
        mine = got.get(i, [])
        assert bool(mine) == (d >= 90)
        at = 0.0
        for k, p in enumerate(mine):
            assert (p.seg_no, p.start) == (k + 1, at) and p.length > 0
            at += p.length
        if mine:
            assert math.isclose(at, d)


def test_segment_arguments(spark):
    df = spark.createDataFrame([(1, 100.0)], "id int, d double")
    with pytest.raises(ValueError):
        segments.fixed_segments(df, "d", threshold=10, step=20)
    assert segments.fixed_segments(df, "d", min_duration=10).count() == 1
    assert segments.trim_plan(df, "d").count() == 0
    assert segments.trim_plan(df, "d", 10, 10).first().length == 80.0


def test_playlists(spark):
    body = "#EXTM3U\n#EXTINF:4,\n a.ts?k=1 \r\n#EXTINF:4,\n\n#EXTINF:4,\n/b.ts\nnote.txt\n#EXTINF:9,"
    df = spark.createDataFrame([("v", "https://h/p/l.m3u8", body)], "asset_id string, base_url string, body string")
    expected = [(1, "https://h/p/a.ts?k=1", "v_00001.ts"), (2, "https://h/b.ts", "v_00002.ts")]
    for by_mark in (True, False):
        got = manifests.playlist_segments(df, by_mark=by_mark).orderBy("seg_no").collect()
        assert [(r.seg_no, r.seg_url, r.seg_name) for r in got] == expected


def test_variants(spark):
    master = ("#EXTM3U\n#EXT-X-STREAM-INF:AVERAGE-BANDWIDTH=99,BANDWIDTH=900\nhigh.m3u8\n"
              "#EXT-X-STREAM-INF:BANDWIDTH=100\nlow.m3u8\n")
    df = spark.createDataFrame([(master,), ("#EXTM3U",)], "b string")
    got = df.select(manifests.last_variant(F.col("b")), manifests.widest_variant(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("low.m3u8", "high.m3u8"), (None, None)]


FILES = ["/r/b.mp4", "/r/a.mp4", "/r/z/1.mp4", "/r/a/2.mp4", "/r/a/k/3.mp4", "/r/a/1"]


def test_walk_order(spark):
    df = spark.createDataFrame([(f,) for f in FILES], "path string")
    plan = {r.path: (r.number, r.new_path) for r in renames.rename_plan(df, start=5).collect()}
    assert sorted(plan, key=lambda p: plan[p][0]) == [
        "/r/a.mp4", "/r/b.mp4", "/r/a/1", "/r/a/2.mp4", "/r/a/k/3.mp4", "/r/z/1.mp4"]
    assert plan["/r/a.mp4"] == (5, "/r/0000005.mp4") and plan["/r/a/1"][1] == "/r/a/0000007"


def test_shuffle_is_a_reproducible_bijection(spark):
    df = spark.createDataFrame([(f"/r/{i}.mp4",) for i in range(50)], "path string")
    one, two, other = ({r.path: r.number for r in renames.rename_plan(df, shuffle_seed=s).collect()}
                       for s in (1, 1, 2))
    assert one == two != other and sorted(one.values()) == list(range(1, 51))


def test_rename_clashes(spark):
    files = spark.createDataFrame([("/r/x.mp4",), ("/r/1.mp4",), ("/r/2.txt",)], "path string")
    media = files.where("path = '/r/x.mp4'")
    plan = renames.rename_plan(media, width=1)
    clashes = renames.rename_clashes(plan, files)
    assert [r.new_path for r in clashes.collect()] == ["/r/1.mp4"]
    assert tuple(renames.rename_stats(plan, clashes).first()) == (1, 0, 1)
    both = renames.rename_plan(files.where("path LIKE '%.mp4'"), width=1)
    assert renames.rename_clashes(both, files).count() == 0  # renamed files make room


def test_suffixes(spark):
    df = spark.createDataFrame([(1, "a.mp4"), (2, "a.mp4"), (3, "a.mp4"), (4, "b"), (5, "b")], "id int, name string")
    got = [r.final_name for r in renames.suffix_collisions(df, "name", "id").orderBy("id").collect()]
    assert got == ["a.mp4", "a_1.mp4", "a_2.mp4", "b", "b_1"]
    df = df.union(spark.createDataFrame([(6, "a_1.mp4")], df.schema))
    renamed = renames.suffix_collisions(df, "name", "id")
    assert [r.final_name for r in renamed.orderBy("id").collect()] == ["a.mp4", "a_2.mp4", "a_3.mp4", "b", "b_1", "a_1.mp4"]
    assert renames.name_clashes(renamed).count() == 0


def log_frame(spark, lines, exit_code=1, attempt=0):
    return spark.createDataFrame([(1, i, x, attempt, exit_code) for i, x in enumerate(lines)],
                                 "run_id int, pos int, line string, attempt int, exit_code int")


@pytest.mark.parametrize("lines,rule,message", [
    (["x", "Video unavailable", "http error 404"], 4, "not_found"),
    (["[info] nothing of note in here", "\x1b[31mERROR: strange thing\x1b[0m", "error: later line"], None,
     "ERROR: strange thing"),
    (["ERROR: x", "a plain line with more than twenty", "another plain line with more"], None,
     "a plain line with more than twenty"),
    (["a plain line with more than twenty"] + ["x"] * 10, None, "unknown error"), (["ok"], None, "unknown error")])
def test_error_report(spark, lines, rule, message):
    got = logs.error_report(log_frame(spark, lines)).first()
    assert (got.rule_no, got.message) == (rule, message)


def test_each_error_rule(spark):
    samples = ["AttributeError: 'NoneType' object has no attribute 'lower'", "No such file or directory: a-Frag7",
               "Bad Gateway", "Not Found", "Forbidden", "No space left on device", "Conversion failed",
               "Unable to download webpage", "Connection: read timeout", "Permission denied", "Postprocessing has failed",
               "Too many requests", "Access denied", "Unable to extract player info", "Video unavailable",
               "This video is not available", "Sign in to confirm", "Requested format is not available"]
    df = spark.createDataFrame([(i, s.lower()) for i, s in enumerate(samples, 1)], "i int, line string")
    got = df.select("i", logs.first_rule(F.col("line")).alias("n")).collect()
    assert [r.n for r in got] == [r.i for r in got]


@pytest.mark.parametrize("line,attempt,expected", [
    ("Private video", 1, (False, 0)), ("HTTP Error 403: Forbidden", 1, (False, 0)), ("HTTP Error 403", 1, (True, 2)),
    ("Bad Gateway", 3, (True, 30)), ("AttributeError: 'NoneType'", 1, (True, 6)), ("timed out", 2, (True, 4)),
    ("Bad Gateway; Permission denied", 0, (False, 0))])
def test_retry(spark, line, attempt, expected):
    got = logs.retry_decision(log_frame(spark, ["x", line], attempt=attempt)).first()
    assert (got.retry, got.wait_seconds) == expected


@pytest.mark.parametrize("lines,code,ok", [
    (["boom"], 0, True), (["[download] 100% of 1MiB"], 1, True), (["[download] 100%", "ERROR: late"], 1, False),
    (["nothing"], 1, False), (["x has already been downloaded"], 2, True)])
def test_outcome(spark, lines, code, ok):
    assert logs.run_outcomes(log_frame(spark, lines, code)).first().ok is ok


def test_progress(spark):
    lines = ["[download]  12.5% of 9MiB at 1.5MiB/s ETA 01:10", '[Merger] Merging formats into "/o/f.mp4"',
             "[download] Destination: /o/x.webm", "[download] Destination: /o/x.m4a", "Deleting original file x",
             "[download] x has already been downloaded", "plain 50%", ""]
    got = logs.progress_table(log_frame(spark, lines)).orderBy("pos").collect()
    assert [r.phase for r in got] == ["downloading", "processing", None, None, "finished", "finished", None, None]
    assert (got[0].percent, got[0].speed, got[0].eta) == (12.5, 1.5 * 1024 ** 2, 70)
    assert [r.file_name for r in got][:4] == [None, "f.mp4", "x.webm", None]
    assert got[6].percent is None


def test_formats(spark):
    df = spark.createDataFrame([(1, "137 mp4 1920x1080 2x2"), (1, "ID"), (1, "22 640x360")], "a int, line string")
    best = M.best_resolution(logs.format_sizes(df), ["a"]).first()
    assert tuple(best) == (1, 2, 1920, 1080)


def test_scene_plan(spark):
    frames = spark.createDataFrame([(v, n, 25.0, 50.0 if v == 1 and n in (0, 50) else 1.0)
                                    for v in (1, 2) for n in range(100)],
                                   "video_id int, frame_no int, fps double, score double")
    numbered = scenes.number_scenes(frames, "video_id", ["frame_no"], "score")
    plan = scenes.split_plan(scenes.scene_intervals(numbered)).orderBy("scene_no").collect()
    assert [(r.video_id, r.start_code, r.end_code, r.out_name) for r in plan] == [
        (1, "00:00:00.000", "00:00:02.000", "1_scene_001.mp4"),
        (1, "00:00:02.000", "00:00:04.000", "1_scene_002.mp4")]


def test_quality_rejects(spark):
    df = spark.createDataFrame([("720P",), ("流畅",), ("odd",), (None,)], "q string")
    known, rejects = J.map_values(df, "q", J.QUALITY_HEIGHT, "h")
    assert sorted(r.h for r in known.collect()) == [360, 720] and rejects.count() == 2


def test_discovery(spark):
    good = ('{"data":[{"attributes":{"id":"1","tags":[{"name":"a"},{"name":null},{"name":"b"}],'
            '"video":{"download_link":"u1"}}},{"attributes":{"id":"2","video":{"download_link":"u2"}}},'
            '{"attributes":{"id":"3"}},{"attributes":{"id":"4","video":{"download_link":"u1"}}}]}')
    pages = spark.createDataFrame([("sky", 1, 200, good), ("sky", 2, 500, good), ("sea", 1, 200, "{")],
                                  "keyword string, page int, http_status int, body string")
    ledger = spark.createDataFrame([("u2",)], "download_link string")
    new, rejects = ingest.discover(pages, ledger, ["page", "item_no"])
    row = new.collect()
    assert [(r.download_link, r.category, r.tags, r.datal_id, r.download_state) for r in row] == [
        ("u1", "sky", "a,b", "1", False)]
    assert [r.datal_id for r in rejects.collect()] == ["3"]


def test_transfer(spark):
    looks = spark.createDataFrame(
        [(p, i, n) for p, sizes in {"/i/a.MP4": [3, 3, 3], "/i/b.mp4": [3, 3, 4], "/i/c.mp4": [3, 3, 3],
                                    "/i/d.mp4": [3, 3, 3], "/i/e.txt": [9, 9, 9]}.items()
         for i, n in enumerate(sizes)], "path string, snapshot_ts int, length int")
    probes = spark.createDataFrame([("/i/a.MP4", 1, False), ("/i/a.MP4", 2, True), ("/i/b.mp4", 1, True),
                                    ("/i/c.mp4", 4, True), ("/i/d.mp4", 1, True)], "path string, attempt int, ok boolean")
    target = spark.createDataFrame([("/o/d.mp4",)], "path string")
    def run(trigger):
        return [r.path for r in transfer.eligible_transfers(looks, probes, target, trigger_bytes=trigger,
                                                            in_window=F.lit(False), checks=2).collect()]
    assert run(22) == ["/i/a.MP4"] and run(23) == []
