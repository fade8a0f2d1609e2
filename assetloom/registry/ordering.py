"""Numbering, ranks, limits and pages over the driver tables."""

from pyspark.sql import functions as F

from assetloom.functions import strings as S
from assetloom.operators import ordering as O
from assetloom.plans import logs, renames
from assetloom.registry.base import INVENTORY, TOOL_LOG, inventory, query, tool_log


@query("ORD-3", """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders) WHERE rank <= 3""")
def topk_per_group(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return O.top_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("ORD-1", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 50""")
def first_pending(t):
    return O.first_rows(t.orders.where("o_orderstatus = 'P'").select("o_orderkey", "o_orderdate"),
                        [F.asc("o_orderkey")], 50)


@query("ORD-8", "SELECT doc_id, source FROM documents ORDER BY n_chars DESC, doc_id LIMIT 24 OFFSET 72")
def page_of_rows(t):
    return O.page_rows(t.documents.select("doc_id", "source", "n_chars"),
                       [F.desc("n_chars"), F.asc("doc_id")], page=4).select("doc_id", "source")


@query("WIN-5", """
SELECT event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY 1""")
def newest_per_type(t):
    return O.latest_row(t.events.select("event_type", "event_id", "ts"), ["event_type"],
                        ["ts", "event_id"])


@query("ORD-6", f"""
WITH {TOOL_LOG}
SELECT run_id, pos, line FROM tool_log
QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY pos DESC) <= 3""")
def last_lines(t):
    return logs.last_lines(tool_log(t).select("run_id", "pos", "line"), n=3).drop("from_end")


@query("ORD-6", f"""
WITH {TOOL_LOG}
SELECT run_id, arg_min(trim(line), pos) AS json_line FROM tool_log
WHERE trim(line) LIKE '{{%}}' GROUP BY run_id""")
def json_lines(t):
    return logs.first_json_line(tool_log(t))


@query("WIN-6", f"""
WITH {TOOL_LOG}, s AS (
  SELECT run_id, pos, line, lag(line) OVER (PARTITION BY run_id ORDER BY pos) AS line_before FROM tool_log)
SELECT run_id, pos, line FROM s WHERE starts_with(line_before, '[Merger]')""")
def line_after_marker(t):
    log = tool_log(t).select("run_id", "pos", "line")
    return (O.cut_groups(log, ["run_id"], ["pos"]).running(lags={"line_before": F.col("line")}).rows()
             .where(F.col("line_before").startswith("[Merger]")).drop("line_before"))


@query("WIN-1 WIN-3", """
SELECT doc_id, source, printf('%05d', n) AS number FROM (
  SELECT doc_id, source, 99 + row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents)""")
def renumber(t):
    counted = (O.cut_groups(t.documents.select("doc_id", "source"), ["source"], ["doc_id"])
                .running(sums={"n": F.lit(1)}).rows())
    return counted.select("doc_id", "source", S.padded(F.col("n") + 99, 5).alias("number"))


@query("JOB-12 WIN-1 WIN-3", f"""
WITH {INVENTORY}
SELECT path, 999 + row_number() OVER (ORDER BY source, lang, path) AS number,
       '/vault/' || source || '/' || lang || '/'
         || printf('%07d', 999 + row_number() OVER (ORDER BY source, lang, path))
         || regexp_extract(path, '(\\.[a-zA-Z0-9]+)$', 1) AS new_path
FROM inventory""")
def rename_plan(t):
    return renames.rename_plan(inventory(t).select("path"), start=1000)


@query("JOB-12 WIN-2", f"""
WITH {INVENTORY}
SELECT path, row_number() OVER (ORDER BY md5(path || '#42'), path) AS number FROM inventory""")
def shuffled_numbers(t):
    return renames.rename_plan(inventory(t).select("path"), shuffle_seed=42).select("path", "number")


@query("JOB-12 AGG-10", f"""
WITH {INVENTORY}, plan AS (
  SELECT path, '/vault/' || source || '/' || lang || '/'
           || printf('%d', row_number() OVER (ORDER BY source, lang, path))
           || regexp_extract(path, '(\\.[a-zA-Z0-9]+)$', 1) AS new_path
  FROM inventory),
other AS (
  SELECT '/vault/' || source || '/' || lang || '/' || (doc_id % 100) || '.Mov' AS new_path FROM inventory)
SELECT count(*) AS total, count(*) FILTER (new_path NOT IN (SELECT new_path FROM other)) AS renamed,
       count(*) FILTER (new_path IN (SELECT new_path FROM other)) AS errors
FROM plan""")
def rename_stats(t):
    files = inventory(t)
    plan = renames.rename_plan(files.select("path"), width=1)
    staying = files.select(F.concat(S.parent(F.col("path")), F.lit("/"),
                                    (F.col("doc_id") % 100).cast("string"), F.lit(".Mov")).alias("path"))
    return renames.rename_stats(plan, renames.rename_clashes(plan, staying.distinct()))


@query("WIN-4", """
WITH n AS (SELECT p_partkey, p_name || '.mp4' AS name,
                  row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS n, p_name FROM part)
SELECT p_partkey, name, CASE WHEN n = 1 THEN name ELSE p_name || '_' || (n - 1) || '.mp4' END AS final_name
FROM n""")
def name_suffixes(t):
    named = t.part.select("p_partkey", F.concat("p_name", F.lit(".mp4")).alias("name"))
    return renames.suffix_collisions(named, "name", "p_partkey")


_SUFFIX_ROWS = """
wanted AS (
  SELECT p_partkey, 'part_' || (p_size % 5) || CASE WHEN p_partkey % 11 = 0 THEN '_' || (p_partkey % 40 + 1) ELSE '' END AS stem
  FROM part),
there AS (
  SELECT DISTINCT 'part_' || (s_suppkey % 4) || CASE WHEN s_suppkey % 3 = 0 THEN '_' || s_suppkey ELSE '' END AS stem
  FROM supplier)"""


def _suffix_rows(t):
    number = lambda c: c.cast("string")
    extra = F.when(F.col("p_partkey") % 11 == 0, F.concat(F.lit("_"), number(F.col("p_partkey") % 40 + 1))).otherwise("")
    rows = t.part.select("p_partkey", F.concat(F.lit("part_"), number(F.col("p_size") % 5), extra, F.lit(".mp4")).alias("name"))
    extra = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("_"), number(F.col("s_suppkey")))).otherwise("")
    there = t.supplier.select(F.concat(F.lit("part_"), number(F.col("s_suppkey") % 4), extra, F.lit(".mp4")).alias("name"))
    return rows, there


@query("WIN-4", f"""
WITH {_SUFFIX_ROWS},
numbered AS (
  SELECT p_partkey, w.stem, row_number() OVER (PARTITION BY w.stem ORDER BY p_partkey)
           - CASE WHEN t.stem IS NULL THEN 1 ELSE 0 END AS q
  FROM wanted w LEFT JOIN there t ON t.stem = w.stem),
used AS (SELECT stem FROM there UNION SELECT stem FROM wanted),
tried AS (
  SELECT stem, unnest(range(1, (SELECT count(*) FROM used) + max(q) + 1)) AS n FROM numbered GROUP BY stem),
free AS (
  SELECT stem, n, row_number() OVER (PARTITION BY stem ORDER BY n) AS q FROM tried
  WHERE stem || '_' || n NOT IN (SELECT stem FROM used))
SELECT p_partkey, w.stem || '.mp4' AS name, w.stem || CASE WHEN w.q = 0 THEN '' ELSE '_' || n END || '.mp4' AS final_name
FROM numbered w LEFT JOIN free f ON f.stem = w.stem AND f.q = w.q""")
def free_suffixes(t):
    rows, there = _suffix_rows(t)
    return renames.suffix_collisions(rows, "name", "p_partkey", taken=there)


@query("WIN-4", "SELECT CAST('' AS VARCHAR) AS final_name, CAST(0 AS BIGINT) AS n_rows WHERE false")
def suffix_clashes(t):
    """No name is given twice, nor one that is there."""
    rows, there = _suffix_rows(t)
    renamed = renames.suffix_collisions(rows, "name", "p_partkey", taken=there).select("final_name")
    return renames.name_clashes(renamed.unionByName(there.distinct().toDF("final_name")))
