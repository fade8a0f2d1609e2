"""Counts, rates and roll-ups over the driver tables."""

from pyspark.sql import functions as F

from assetloom.functions import numbers as N
from assetloom.operators import metrics as M
from assetloom.plans import logs, segments
from assetloom.registry.base import INVENTORY, TOOL_LOG, exact_sum, inventory, query, tool_log


@query("AGG-2", """
SELECT l_linestatus, count(*) FILTER (l_returnflag <> 'R') AS success,
       count(*) FILTER (l_returnflag = 'R') AS failed, count(*) AS total
FROM lineitem GROUP BY l_linestatus""")
def outcome_counts(t):
    runs = t.lineitem.select("l_linestatus", (F.col("l_returnflag") != "R").alias("ok"))
    return M.outcome_counts(runs, "ok", ["l_linestatus"])


@query("AGG-2", "SELECT l_orderkey || '/' || l_linenumber AS item FROM lineitem WHERE l_returnflag = 'R'")
def failed_items(t):
    item = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    runs = t.lineitem.select(item.alias("item"), (F.col("l_returnflag") != "R").alias("ok"))
    return M.failed_items(runs, "ok", "item")


@query("AGG-3 MTH-1 STR-10", f"""
WITH {INVENTORY}
SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, count(*) AS n_files,
       CAST(sum(length) AS BIGINT) AS bytes, CAST(sum(length) AS BIGINT) / 1073741824.0::DOUBLE AS gb
FROM inventory GROUP BY 1""")
def folder_sizes(t):
    return M.tree_size(inventory(t))


@query("AGG-8", f"""
WITH {INVENTORY}, e AS (SELECT lower(regexp_extract(path, '(\\.[^./]*)$', 1)) AS ext FROM inventory)
SELECT ext, count(*) AS n_files, CAST(grouping(ext) AS INTEGER) AS is_total FROM e GROUP BY ROLLUP (ext)""")
def extension_counts(t):
    return M.count_by_extension(inventory(t))


@query("AGG-3 AGG-8", """
SELECT lang, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS bytes
FROM documents GROUP BY ROLLUP (lang)""")
def size_by_group(t):
    return t.documents.rollup("lang").agg(F.count(F.lit(1)).alias("n_files"),
                                          F.sum("n_chars").alias("bytes"))


@query("AGG-4 AGG-5 AGG-6", """
SELECT l_orderkey, count(*) AS segments, count(*) FILTER (l_returnflag = 'R') AS failed,
       count(*) FILTER (l_returnflag = 'R') <= count(*) * 0.1::DOUBLE AS accepted,
       bool_and(l_returnflag <> 'R') AS complete,
       CASE WHEN bool_and(l_returnflag <> 'R') THEN 'all'
            WHEN bool_or(l_returnflag <> 'R') THEN 'partial' ELSE 'none' END AS outcome
FROM lineitem GROUP BY l_orderkey""")
def failure_ratio(t):
    return M.accept_by_failures(t.lineitem.select("l_orderkey", "l_returnflag"), ["l_orderkey"],
                                F.col("l_returnflag") != "R")


@query("AGG-7 ORD-7 JOB-5", """
WITH f AS (SELECT l_suppkey, CAST(l_quantity AS INTEGER) * 32 AS width,
                  CAST(l_quantity AS INTEGER) % 7 * 180 AS height FROM lineitem
           WHERE l_linenumber > 1)
SELECT l_suppkey, count(DISTINCT (width, height)) AS n_sizes,
       arg_max(width, height * 100000 + width) AS best_width, max(height) AS best_height
FROM f GROUP BY l_suppkey""")
def format_table(t):
    q = F.col("l_quantity").cast("int")
    size = F.concat((q * 32).cast("string"), F.lit("x"), (q % 7 * 180).cast("string"))
    line = F.when(F.col("l_linenumber") > 1, F.concat(F.lit("137  mp4  "), size, F.lit("  24 | 1x1")))
    listing = t.lineitem.select("l_suppkey", F.coalesce(line, F.lit("ID EXT RESOLUTION")).alias("line"))
    return M.best_resolution(logs.format_sizes(listing), ["l_suppkey"])


@query("AGG-10 JOB-8", f"""
WITH {TOOL_LOG}, r AS (
  SELECT run_id, min(exit_code) = 0
         OR (bool_or(contains(line, 'already been downloaded') OR contains(line, '100%')
                     OR contains(line, '[Merger] Merging formats') OR contains(line, 'Deleting original'))
             AND NOT bool_or(contains(line, 'ERROR:') OR contains(line, 'No space left on device')
                             OR contains(line, 'Permission denied') OR contains(line, 'Video unavailable')
                             OR contains(line, 'Unable to download webpage'))) AS ok
  FROM tool_log GROUP BY run_id)
SELECT count(*) FILTER (ok) AS success, count(*) FILTER (NOT ok) AS failed, count(*) AS total FROM r""")
def run_totals(t):
    return M.outcome_counts(logs.run_outcomes(tool_log(t)), "ok")


@query("AGG-11", """
SELECT user_id, count(*) AS items, epoch(max(ts)) - epoch(min(ts)) AS elapsed_seconds,
       count(*) / nullif(epoch(max(ts)) - epoch(min(ts)), 0) AS items_per_second
FROM events GROUP BY user_id""")
def throughput(t):
    return M.throughput(t.events, ["user_id"], "ts")


@query("AGG-12", """
SELECT conv_id, count(*) AS attempts, bool_or(role = 'assistant') AS succeeded,
       min(turn) FILTER (role = 'assistant') AS first_success
FROM conversations GROUP BY conv_id""")
def attempt_summary(t):
    return M.attempt_summary(t.conversations, ["conv_id"], F.col("role") == "assistant", "turn")


_PAGES = """
pages_seen AS (SELECT l_suppkey AS keyword, l_partkey % 50 + 1 AS page,
                      bool_or(l_returnflag <> 'R') AS ok FROM lineitem GROUP BY 1, 2),
good AS (SELECT keyword, page, row_number() OVER (PARTITION BY keyword ORDER BY page) AS n
         FROM pages_seen WHERE ok),
marks AS (SELECT keyword, coalesce(max(page) FILTER (page = n), 0) AS last_page
          FROM (SELECT DISTINCT keyword FROM pages_seen) LEFT JOIN good USING (keyword)
          GROUP BY keyword)"""


def _page_marks(t):
    seen = t.lineitem.select(F.col("l_suppkey").alias("keyword"),
                             (F.col("l_partkey") % 50 + 1).alias("page"), "l_returnflag")
    return M.page_marks(seen, ["keyword"], "page", F.col("l_returnflag") != "R")


@query("AGG-13", f"WITH {_PAGES} SELECT keyword, last_page FROM marks")
def page_marks(t):
    return _page_marks(t)


@query("AGG-13 ORD-8", f"""
WITH {_PAGES}
SELECT keyword, unnest(range(last_page + 1, 61)) AS page FROM marks WHERE last_page < 60""")
def pages_to_fetch(t):
    return M.pages_to_fetch(_page_marks(t), add=60)


_LATER = """
WITH seen AS (SELECT l_suppkey AS keyword, l_partkey % 50 + 1 AS page,
                     bool_or(l_returnflag <> 'R' AND (l_partkey % 50 >= 2 OR l_suppkey % 2 = 0)) AS ok
              FROM lineitem GROUP BY 1, 2),
good AS (SELECT keyword, page, row_number() OVER (PARTITION BY keyword ORDER BY page) AS n FROM seen WHERE ok AND page >= 4),
marks AS (SELECT keyword, coalesce(max(page) FILTER (page = n + 3), 3) AS last_page
          FROM (SELECT DISTINCT keyword FROM seen) LEFT JOIN good USING (keyword) GROUP BY keyword)"""


def _later_marks(t):
    """From page 4 on; the first two pages of every other keyword have failed, which does not matter then."""
    page = F.col("l_partkey") % 50 + 1
    seen = t.lineitem.select(F.col("l_suppkey").alias("keyword"), page.alias("page"), "l_returnflag")
    good = (F.col("l_returnflag") != "R") & ((F.col("page") >= 3) | (F.col("keyword") % 2 == 0))
    return M.page_marks(seen, ["keyword"], "page", good, start=4)


@query("AGG-13", f"{_LATER} SELECT keyword, last_page FROM marks")
def later_page_marks(t):
    return _later_marks(t)


@query("AGG-13 ORD-8", f"""
{_LATER} SELECT keyword, unnest(range(last_page + 1, 31)) AS page FROM marks WHERE last_page < 30""")
def later_pages_to_fetch(t):
    return M.pages_to_fetch(_later_marks(t), add=27, start=4)


@query("AGG-14 JOB-1", """
SELECT event_id, value, CASE WHEN value >= 180 THEN value ELSE 0 END AS processed,
       CASE WHEN value >= 180 THEN 0 ELSE value END AS remaining
FROM events""")
def segment_coverage(t):
    assets = t.events.select("event_id", "value")
    parts = segments.fixed_segments(assets, "value")
    covered = M.coverage(assets, parts, "event_id", "value", "length")
    # parts are binary fractions; cents are what the assets were given in
    return covered.select("event_id", "value", F.round("processed", 2).alias("processed"),
                          (F.round("remaining", 2) + F.lit(0.0)).alias("remaining"))


@query("MTH-1 MTH-5", """
SELECT event_id, n_chars / 1024.0::DOUBLE AS kb, n_chars / 1048576.0::DOUBLE AS mb,
       CAST(pow(2, event_id % 6) AS BIGINT) AS wait_plain,
       least(30, CAST(5 * pow(2, event_id % 6) AS BIGINT)) AS wait_busy,
       least(15, CAST(3 * pow(2, event_id % 6) AS BIGINT)) AS wait_attribute,
       5 * (event_id % 6) AS wait_linear
FROM events JOIN documents ON doc_id = event_id""")
def sizes_and_waits(t):
    attempt = F.col("event_id") % 6
    docs = t.documents.select(F.col("doc_id").alias("event_id"), "n_chars")
    return t.events.select("event_id").join(docs, "event_id").select(
        "event_id", N.in_unit(F.col("n_chars"), "KB").alias("kb"),
        N.in_unit(F.col("n_chars"), "MB").alias("mb"),
        N.backoff(attempt).alias("wait_plain"), N.backoff(attempt, 5, 30).alias("wait_busy"),
        N.backoff(attempt, 3, 15).alias("wait_attribute"),
        N.linear_wait(attempt).alias("wait_linear"))


@query("AGG-3", """
SELECT user_id, count(*) AS n_files, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM events GROUP BY user_id""")
def volume_by_user(t):
    return t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_files"),
                                           exact_sum("value").alias("amount"))
