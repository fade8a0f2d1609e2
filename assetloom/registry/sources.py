"""Sources and sinks: the driver tables written in each format and read back."""

from pyspark.sql import functions as F

from assetloom.functions import strings as S
from assetloom.operators import ordering as O
from assetloom.registry.base import query
from assetloom.session import scratch_path
from assetloom.sources import readers as R, sinks


@query("SRC-1", """
SELECT lang, CAST(sum(strlen(doc_id || source) + 1) AS BIGINT) AS length FROM documents WHERE lang <> 'de' GROUP BY lang""")
def table_files(t):
    """One text file per language, listed with its size; others are not listed."""
    root = scratch_path(t.spark, "files")
    lines = t.documents.select("lang", F.concat(F.col("doc_id").cast("string"), "source").alias("value"))
    lines.where("lang <> 'de'").repartition("lang").write.partitionBy("lang").text(root)
    lines.where("lang = 'de'").repartition("lang").write.mode("append").partitionBy("lang").json(root)
    files = R.file_inventory(t.spark, root, "*.txt")
    return files.select(F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang"), "length")


@query("SRC-2 SRC-8", "SELECT url FROM pages")
def url_list(t):
    path = scratch_path(t.spark, "urls")
    noisy = t.pages.select(F.explode(F.array(
        F.concat(F.lit("  "), "url", F.lit(" \t")), F.lit("  # "), F.lit("   "),
        F.concat(F.lit("\t#"), "url"))).alias("url"))
    sinks.append_links(noisy, path)
    return R.url_list(t.spark, path)


@query("SRC-3", """
SELECT doc_id, md5(regexp_replace(text, '^[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+|[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+$', '', 'g'))
         AS text_md5 FROM documents""")
def text_records(t):
    path = scratch_path(t.spark, "records")
    (t.documents.select(F.concat(F.col("doc_id").cast("string"), F.lit("\t"), "text").alias("value"))
      .write.option("lineSep", "\n=====\n").text(path))
    parts = R.text_records(t.spark, path, "\n=====\n").select(F.split("record", "\t", 2).alias("p"))
    return parts.select(F.col("p")[0].cast("bigint").alias("doc_id"),
                        F.md5(S.strip(F.col("p")[1])).alias("text_md5"))


@query("SRC-5 STR-8", """
SELECT md5(url) AS key, url, CAST(page_id % 2 AS INTEGER) AS status, CAST(NULL AS VARCHAR) AS title
FROM pages WHERE url NOT LIKE '%page=%'""")
def map_ledger(t):
    path = scratch_path(t.spark, "map-ledger")
    record = F.struct("url", (F.col("page_id") % 2).cast("int").alias("status"))
    body = F.when(F.col("url").contains("page="), F.lit('{"broken": {')).otherwise(
        F.to_json(F.create_map(S.url_key(F.col("url")), record)))
    t.pages.select(body.alias("value")).write.text(path)
    return R.map_ledger(t.spark, path, whole_file=False).select("key", "url", "status", "title")


@query("SRC-5", """
SELECT md5(url) AS key, url, CAST(page_id % 2 AS INTEGER) AS status, '},"{' || page_id AS title FROM pages""")
def whole_map_ledger(t):
    """All pages in one map in one file, an entry over several lines, and a file that breaks off."""
    path = scratch_path(t.spark, "whole-map-ledger")
    quoted = F.concat(F.lit('},"{'), F.col("page_id").cast("string"))
    record = F.to_json(F.struct("url", (F.col("page_id") % 2).cast("int").alias("status"), quoted.alias("title")))
    entry = F.concat(F.lit('  "'), S.url_key(F.col("url")), F.lit('": {\n    '), F.substring(record, F.lit(2), F.length(record) - 2),
                     F.lit("\n  }"), F.when(F.col("n") == F.col("last"), "").otherwise(","))
    numbered = O.number_rows(t.pages.select("page_id", "url"), ["page_id"]).withColumn(
        "last", t.pages.agg(F.count(F.lit(1)).alias("n")).scalar())
    body = numbered.select("n", entry.alias("value"))
    ends = t.spark.range(2).select((F.col("id") * (1 << 60)).alias("n"), F.when(F.col("id") == 0, "{").otherwise("}").alias("value"))
    (body.unionByName(ends).coalesce(1).sortWithinPartitions("n").select("value").write.text(path))
    body.where("n <= 5").coalesce(1).select("value").write.mode("append").text(path)
    return R.map_ledger(t.spark, path).select("key", "url", "status", "title")


@query("SRC-6", "SELECT url AS path FROM pages")
def done_paths(t):
    path = scratch_path(t.spark, "done")
    sinks.write_done_paths(t.pages.select(F.col("url").alias("path")), path)
    return R.done_paths(t.spark, path)


@query("SRC-9 DT-2", """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, event_type AS operation,
       CASE WHEN value > 100 THEN 'success' ELSE 'failed' END AS status, CAST(user_id AS VARCHAR) AS live_id,
       props AS details, CAST(NULL AS VARCHAR) AS computer FROM events""")
def operation_log(t):
    path = scratch_path(t.spark, "operations")
    records = t.events.select(
        F.col("ts").alias("timestamp"), F.col("event_type").alias("operation"),
        F.when(F.col("value") > 100, "success").otherwise("failed").alias("status"),
        F.col("user_id").cast("string").alias("live_id"), F.col("props").alias("details"),
        F.lit(None).cast("string").alias("computer"))
    sinks.append_operations(records.where("status = 'success'"), path)
    sinks.append_operations(records.where("status = 'failed'"), path)
    return R.operation_log(t.spark, path)


@query("SRC-10 FLT-4 SRC-4", "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'")
def ledger_table(t):
    path = scratch_path(t.spark, "ledger")
    sinks.append_ledger(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus"), path, ["o_orderstatus"])
    return t.spark.read.parquet(path).where("o_orderstatus <> 'O'").select(
        "o_orderkey", "o_orderdate", "o_orderstatus")


@query("SRC-11 SRC-1", """
SELECT source AS keyword, count(*) AS n_assets FROM documents GROUP BY source""")
def keyword_folders(t):
    path = scratch_path(t.spark, "folders")
    sinks.write_by_keyword(t.documents.select("doc_id", F.col("source").alias("keyword")), path)
    rows = (t.spark.read.schema("doc_id bigint, keyword string").parquet(path)
             .groupBy("keyword").agg(F.count(F.lit(1)).alias("n_assets")))
    folders = (R.file_inventory(t.spark, path, "*.parquet")
               .select(S.url_id(F.col("path"), "/keyword=([^/]*)/").alias("keyword")).distinct())
    return rows.join(folders, "keyword", "left_semi")
