"""Golden rows of the column functions."""

from datetime import datetime, time

import pytest
from pyspark.sql import functions as F

from assetloom.functions import dates as D, documents as J, numbers as N, strings as S
from assetloom.operators import filters as E



@pytest.fixture(autouse=True)
def _input(spark):
    global X
    X = F.col("x")


@pytest.mark.parametrize("text,expected", [
    ("a/b:c", "a_b_c"), ("", "Unknown"), (None, "Unknown"), ("  \t\n", "Unknown"),
    ("a  \n b", "a b"), ("　wide　", "wide"), ("z" * 120, "z" * 100),
    ("y" * 99 + " zz", "y" * 99), ("<>|", "___")])
def test_safe_title(col, text, expected):
    assert col(S.safe_title(X), "x string", text) == expected


def test_other_names(col):
    assert col(S.safe_name(X), "x string", 'a?b"c') == "a_b_c"
    assert col(S.safe_name_stripped(X), "x string", " a\nb\t") == "a_b_"
    assert col(S.ascii_only(X), "x string", "añb\x07c~") == "abc~"
    assert col(S.strip_colour(X), "x string", "\x1b[0;31mred\x1b[0m") == "red"
    assert col(S.has_cjk(X), "x string", "abc中") is True
    assert col(S.has_cjk(X), "x string", "añ、") is False


@pytest.mark.parametrize("url,expected", [
    ("https://h/p/a.jpg?dl=n%20b.jpg", "n b.jpg"), ("https://h/p/a.jpg", "a.jpg"),
    ("https://h/p/a.jpg?dl=", "a.jpg"), ("https://h/p/a+b.jpg", "a+b.jpg"),
    ("https://h/p/x?a=1&dl=one+two.jpg&dl=three", "one two.jpg"), ("https://h/p/a b|c.jpg", "a b|c.jpg"),
    ("https://h/x?dl=up%2Fdown.jpg", "down.jpg"), ("not a url", None), (None, None)])
def test_url_file_name(col, url, expected):
    assert col(S.url_file_name(X), "x string", url) == expected


@pytest.mark.parametrize("url,expected", [
    ("https://h/a?fm=PNG", "png"), ("https://h/a?fm=gif", "jpg"), ("https://h/a", "jpg"),
    ("https://h/a?w=1&fm=webp#t", "webp"), (None, "jpg")])
def test_url_format(col, url, expected):
    assert col(S.url_format(X), "x string", url) == expected


def test_urls(col):
    assert col(S.clean_url(X, "v.example/"), "x string", " v.example/1_ _") == "https://www.v.example/1"
    assert col(S.clean_url(X, "v.example/"), "x string", "http://v.example/1__") == "http://v.example/1"
    assert col(S.expand_id(X, "https://h/"), "x string", "77") == "https://h/77"
    assert col(S.expand_id(X, "https://h/"), "x string", "http://a/1") == "http://a/1"
    assert col(S.matches_any_prefix(X, [r"https?://a/\d+", "ftp:"]), "x string", " http://a/1x") is True
    assert col(S.matches_any_prefix(X, [r"https?://a/\d+"]), "x string", "see http://a/1") is False
    assert col(S.url_id(X, r"play/(\d+)\.html"), "x string", "http://h/play/12.html") == "12"
    assert col(S.url_id(X, r"play/(\d+)\.html"), "x string", "http://h/x") is None
    base = F.lit("https://h/a/b.m3u8?k=1")
    for ref, joined in [("s.ts", "https://h/a/s.ts"), ("/s.ts", "https://h/s.ts"),
                        ("http://o/s.ts", "http://o/s.ts")]:
        assert col(S.join_url(base, X), "x string", ref) == joined


@pytest.mark.parametrize("path,stem,ext", [
    ("/a/b/x.tar.gz", "x.tar", ".gz"), ("/a/.bashrc", ".bashrc", ""), ("/a.b/plain", "plain", ""),
    ("a.", "a", "."), ("/p/x.MP4", "x", ".MP4"), ("/p/..x.y", "..x", ".y"), ("/p/a", "a", "")])
def test_paths(col, path, stem, ext):
    assert col(S.stem(X), "x string", path) == stem
    assert col(S.extension(X), "x string", path) == ext


def test_path_parts(col):
    assert col(S.parent(X), "x string", "/a/b/c.mp4") == "/a/b"
    assert col(S.relative_to(X, "/a"), "x string", "/a/b/c.mp4") == "b/c.mp4"
    assert col(S.relative_to(X, "/a"), "x string", "/ab/c.mp4") is None


@pytest.mark.parametrize("n,width,expected", [(7, 3, "007"), (1234, 3, "1234"), (12, 5, "00012")])
def test_padded(col, n, width, expected):
    assert col(S.padded(X, width), "x bigint", n) == expected


@pytest.mark.parametrize("path,kept", [
    ("x.MP4", True), ("z.txt", False), ("plain", False), ("/a/b.mkv", True)])
def test_extension_filter(col, path, kept):
    assert col(E.has_extension(X), "x string", path) is kept


@pytest.mark.parametrize("value,kept", [(5.0, True), (120.0, True), (4.99, False), (None, None)])
def test_duration(col, value, kept):
    assert col(E.duration_between(X), "x double", value) is kept


@pytest.mark.parametrize("at,inside", [("20:00:00", True), ("08:59:59", True), ("09:00:00", False),
                                       ("19:59:59", False)])
def test_night_window(col, at, inside):
    ts = datetime.fromisoformat(f"2024-05-01 {at}")
    assert col(D.in_day_window(X, time(20), time(9)), "x timestamp", ts) is inside
    assert col(D.in_day_window(X, time(9), time(9)), "x timestamp", ts) is False


@pytest.mark.parametrize("name,label", [
    ("a.part", "temp"), ("a-Frag3", "temp"), ("a.f137.mp4", "temp"), ("a_t12-Frag", "temp"),
    ("a.info.json", "unwanted"), ("a.jpg", "unwanted"), ("a.mp4", None), ("part", None)])
def test_junk(col, name, label):
    assert col(E.junk_label(X), "x string", f"/v/{name}") == label


def test_junk_keeps_fragments(col):
    assert col(E.junk_label(X, keep_fragments=True), "x string", "a.f137.mp4") is None


@pytest.mark.parametrize("text,expected", [("30000/1001", 30000 / 1001), ("0/0", None), ("25", 25.0),
                                           ("x/1", None), (None, None)])
def test_frame_rate(col, text, expected):
    assert col(N.frame_rate(X), "x string", text) == expected


def test_numbers(col):
    assert [col(N.backoff(X, 5, 30), "x bigint", a) for a in range(4)] == [5, 10, 20, 30]
    assert [col(N.backoff(X, 3, 15), "x bigint", a) for a in range(4)] == [3, 6, 12, 15]
    assert col(N.linear_wait(X), "x bigint", 3) == 15
    assert col(N.bytes_per_second(X), "x string", "at 2.5KiB/s") == 2560.0
    assert col(N.bytes_per_second(X), "x string", "at 2kB/s") == 2048.0
    assert col(N.bytes_per_second(X), "x string", "at once") == 0.0
    assert col(N.in_unit(X, "MB"), "x bigint", 1024 * 1024) == 1.0
    assert col(N.duration_from_frames(F.lit(50), X), "x double", 0.0) == 0.0
    assert col(N.frame_count(F.lit(None).cast("bigint"), F.lit(2.5), X), "x double", 30.0) == 75
    assert col(N.frame_count(F.lit(None).cast("bigint"), F.lit(2.5), X), "x double", None) is None


@pytest.mark.parametrize("seconds,text", [(65.9, "01:05"), (0.0, "Unknown"), (None, "Unknown"),
                                          (6000.0, "100:00")])
def test_minutes_seconds(col, seconds, text):
    assert col(D.minutes_seconds(X), "x double", seconds) == text


def test_times(col):
    assert col(D.eta_seconds(X), "x string", "ETA 01:05") == 65
    assert col(D.eta_seconds(X), "x string", "ETA  7s") == 7
    assert col(D.eta_seconds(X), "x string", "soon") == 0
    assert [col(D.eta_text(X), "x bigint", s) for s in (0, 5, 60, 65, 3600, 3725)] == [
        "", "5s", "60s", "1m5s", "60m0s", "1h2m"]
    assert col(D.timecode(X, F.lit(25.0)), "x bigint", 90_000 + 26) == "01:00:01.040"
    assert col(D.parse_stamp(X), "x string", "2024-05-01 10:00:00") == datetime(2024, 5, 1, 10)
    assert col(D.parse_stamp(X), "x string", "junk") is None


def test_spread_in_day(spark):
    keys = spark.range(500).select(F.col("id").cast("string").alias("x"))
    at = keys.select(D.spread_in_day(X, "2024-05-01", time(9), time(9, 0, 3)).alias("at"))
    seen = {r[0] for r in at.distinct().collect()}
    assert seen == {datetime(2024, 5, 1, 9, 0, s) for s in range(4)}
    with pytest.raises(ValueError):
        D.spread_in_day(X, "2024-05-01", time(9), time(8))


@pytest.mark.parametrize("body,title", [
    ('jQuery12_3({"data":{"moment":{"videoInfo":{"videoTitle":"t"}}}})', "t"),
    ('{"data":{"moment":{"videoInfo":{"videoTitle":"t"}}}}', "t"), ("junk", None),
    ("jQuery(", None), (None, None)])
def test_jsonp(col, body, title):
    parsed = J.parse(J.unwrap_jsonp(X), J.MOMENT)
    assert col(parsed["data"]["moment"]["videoInfo"]["videoTitle"], "x string", body) == title


def test_first_video_stream(col):
    stream = J.first_video_stream(J.parse(X, J.PROBE))
    body = '{"streams":[{"codec_type":"audio"},{"codec_type":"video","nb_frames":"7"}]}'
    assert col(stream["nb_frames"], "x string", body) == "7"
    assert col(stream["nb_frames"], "x string", '{"streams":[]}') is None
    assert col(stream["nb_frames"], "x string", "{") is None
