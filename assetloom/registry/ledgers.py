"""Ledger joins, states and claims over the driver tables."""

from pyspark.sql import functions as F

from assetloom.functions import strings as S
from assetloom.operators import joins as J, ledger as L, metrics as M, sets
from assetloom.plans import reports
from assetloom.registry.base import TASK_EVENTS, query, sql_text, task_events


@query("JN-1 SET-3 AGG-1", """
SELECT source, count(*) AS n_pending, CAST(sum(n_chars) AS BIGINT) AS n_chars
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
GROUP BY source""")
def pending_docs(t):
    docs = t.documents.select("doc_id", "source", "n_chars")
    return (J.drop_done(docs, t.labels, ["doc_id"], unique_done=True)
             .groupBy("source").agg(F.count(F.lit(1)).alias("n_pending"),
                                    F.sum("n_chars").alias("n_chars")))


@query("JN-1 FLT-3 JOB-1", """
WITH pending AS (
  SELECT source, CAST(n_chars AS DOUBLE) AS d FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND n_chars BETWEEN 180 AND 20000),
parts AS (SELECT source, d, CAST(floor((d - 180) / 90) AS BIGINT) + 2 AS n FROM pending)
SELECT source, count(*) AS n_assets, CAST(sum(n) AS BIGINT) AS n_parts, sum(d) AS total_seconds
FROM parts GROUP BY source""")
def pending_cuts(t):
    assets = t.documents.select("doc_id", "source", F.col("n_chars").cast("double").alias("seconds"))
    return reports.pending_cut_report(assets, t.labels, "doc_id", "seconds", ["source"],
                                      longest=20_000)


@query("JN-3", """
SELECT doc_id, coalesce(quality, 0) AS quality FROM documents LEFT JOIN labels USING (doc_id)""")
def status_default(t):
    return J.with_default(t.documents.select("doc_id"), t.labels, ["doc_id"], "quality")


@query("JN-2", """
SELECT o_orderkey,
       CASE WHEN c_acctbal < 0 THEN 'Q' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN c_acctbal < 0 THEN 'host1' END AS computer
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def claim_listed(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                             F.lit(None).cast("string").alias("computer"))
    listed = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return (J.update_listed(orders, listed, ["o_custkey"],
                            {"o_orderstatus": F.lit("Q"), "computer": F.lit("host1")})
             .select("o_orderkey", "o_orderstatus", "computer"))


@query("JN-2", """
SELECT o_orderkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def listed_orders(t):
    listed = t.customer.where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"))
    return J.keep_listed(t.orders.select("o_orderkey", "o_custkey"), listed,
                         ["o_custkey"]).select("o_orderkey")


@query("JN-4", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1080 WHEN '2-HIGH' THEN 720
         WHEN '3-MEDIUM' THEN 480 WHEN '4-NOT SPECIFIED' THEN 360 END AS height,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
         THEN 'known' ELSE 'reject' END AS verdict
FROM orders""")
def quality_lookup(t):
    heights = {"1-URGENT": 1080, "2-HIGH": 720, "3-MEDIUM": 480, "4-NOT SPECIFIED": 360}
    known, rejects = J.map_values(t.orders.select("o_orderkey", "o_orderpriority"),
                                  "o_orderpriority", heights, "height")
    return L.append_evolving(known.withColumn("verdict", F.lit("known")),
                             rejects.withColumn("verdict", F.lit("reject"))).select(
        "o_orderkey", "height", "verdict")


@query("JN-5", """
SELECT event_id, 'out_' || event_id || '.mp4' AS name FROM events
WHERE NOT EXISTS (SELECT 1 FROM documents
                  WHERE 'out_' || (doc_id * 3) || '.mp4' = 'out_' || event_id || '.mp4')""")
def free_names(t):
    def named(n):
        return F.concat(F.lit("out_"), n.cast("string"), F.lit(".mp4"))
    plans = t.events.select("event_id", named(F.col("event_id")).alias("name"))
    taken = t.documents.select(named(F.col("doc_id") * 3).alias("name"))
    return J.drop_existing_names(plans, taken, F.col("name"), F.col("name"))


@query("JN-6", """
WITH a AS (SELECT l_orderkey AS path, CAST(sum(l_quantity) AS BIGINT) AS source_size
           FROM lineitem GROUP BY 1),
     b AS (SELECT o_orderkey AS path, CAST(o_custkey AS BIGINT) AS target_size FROM orders
           WHERE o_orderstatus <> 'P')
SELECT path, source_size, target_size,
       CASE WHEN target_size IS NULL THEN 'missing' WHEN source_size IS NULL THEN 'extra'
            WHEN source_size = target_size THEN 'ok' ELSE 'mismatch' END AS verdict
FROM a FULL JOIN b USING (path)""")
def size_reconcile(t):
    source = t.lineitem.groupBy(F.col("l_orderkey").alias("path")).agg(
        F.sum("l_quantity").cast("bigint").alias("length"))
    target = t.orders.where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("path"), F.col("o_custkey").alias("length"))
    return J.reconcile_sizes(source, target)


@query("LED-1", f"""
WITH {TASK_EVENTS}
SELECT task_id, state, host, seq, updated_at FROM task_events
QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY updated_at DESC, seq DESC) = 1""")
def latest_state(t):
    return (L.current_state(task_events(t), ["task_id"])
             .select("task_id", "state", "host", "seq", "updated_at"))


# Written out for the comparison, apart from the tables that the library uses.
_STEPS = """'pending>queued', 'pending>running', 'queued>running', 'running>done', 'running>retry', 'running>failed',
  'running>pending', 'retry>queued', 'retry>running', 'done>pending'"""
_STATES = ("pending", "queued", "running", "done", "retry", "failed")


@query("LED-2", f"""
WITH {TASK_EVENTS}, stepped AS (
  SELECT *, lag(state) OVER (PARTITION BY task_id ORDER BY updated_at, seq) AS from_state
  FROM task_events)
SELECT task_id, seq, from_state, state,
       from_state IS NULL OR from_state || '>' || state IN ({_STEPS}) AS allowed
FROM stepped""")
def transitions(t):
    return (L.transitions(task_events(t), ["task_id"], "state")
             .select("task_id", "seq", "from_state", "state", "allowed"))


_FROM = "'pending', 'queued', 'retry'"


@query("LED-2 LED-1", f"""
WITH {TASK_EVENTS}, cur AS (
  SELECT * FROM task_events
  QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY updated_at DESC, seq DESC) = 1)
SELECT task_id, CASE WHEN state IN ({_FROM}) THEN 'running' ELSE state END AS state,
       CASE WHEN state IN ({_FROM}) THEN 'host9' ELSE host END AS host,
       CASE WHEN state IN ({_FROM}) THEN seq + 1 ELSE seq END AS seq, state IN ({_FROM}) AS taken
FROM cur""")
def advanced_tasks(t):
    now = t.events.agg(F.max("ts").alias("ts")).scalar()
    steps, refused = L.advance(L.current_state(task_events(t), ["task_id"]), "running", now,
                               F.lit("host9"))
    both = steps.withColumn("taken", F.lit(True)).unionByName(refused.withColumn("taken", F.lit(False)))
    return both.select("task_id", "state", "host", "seq", "taken")


@query("LED-2 AGG-12", """
SELECT conv_id, CASE WHEN count(*) FILTER (role = 'user') >= 3 THEN 'failed' ELSE 'retry' END AS state
FROM conversations GROUP BY conv_id""")
def failed_attempts(t):
    counted = t.conversations.groupBy("conv_id").agg(
        F.count_if(F.col("role") == "user").alias("attempts"))
    return counted.select("conv_id", L.state_after_failure(F.col("attempts"), 3).alias("state"))


@query("FLT-4 ORD-1 JN-3", """
SELECT doc_id, source FROM documents LEFT JOIN labels USING (doc_id)
WHERE (text ILIKE '%mento%' OR text ILIKE '%the%') AND coalesce(quality, 0) = 0
ORDER BY doc_id LIMIT 50""")
def keyword_batch(t):
    docs = t.documents.select("doc_id", "source", "text")
    tasks = J.with_default(docs, t.labels, ["doc_id"], "quality")
    return L.pending_by_keyword(tasks, "text", ["mento", "the"], ["doc_id"], "quality").select(
        "doc_id", "source")


@query("LED-3", f"""
WITH {TASK_EVENTS}, cur AS (
  SELECT * FROM task_events
  QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY updated_at DESC, seq DESC) = 1)
SELECT task_id, state, host FROM cur
WHERE state IN ('queued', 'running')
  AND updated_at <= (SELECT max(ts) FROM events) - INTERVAL 60 MINUTE""")
def stuck_tasks(t):
    now = t.events.agg(F.max("ts").alias("ts")).scalar()
    current = L.current_state(task_events(t), ["task_id"])
    return L.stuck_tasks(current, now, 60).select("task_id", "state", "host")


@query("LED-4", """
WITH batch AS (
  SELECT c_custkey, upper(c_name) AS c_name, CAST(NULL AS VARCHAR) AS c_mktsegment, 1.5 AS c_acctbal
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT 1000000000 + s_suppkey, s_name, 'NEW', s_acctbal FROM supplier)
SELECT c_custkey,
       CASE WHEN b.c_custkey IS NOT NULL THEN b.c_name ELSE c.c_name END AS c_name,
       CASE WHEN b.c_custkey IS NOT NULL THEN b.c_mktsegment ELSE c.c_mktsegment END AS c_mktsegment,
       CASE WHEN c.c_custkey IS NULL THEN CAST(b.c_acctbal AS DOUBLE) ELSE c.c_acctbal END AS c_acctbal
FROM customer c FULL JOIN batch b USING (c_custkey)""")
def upsert_customers(t):
    table = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    changed = t.customer.where("c_acctbal < 0").select(
        "c_custkey", F.upper("c_name").alias("c_name"),
        F.lit(None).cast("string").alias("c_mktsegment"), F.lit(1.5).alias("c_acctbal"))
    new = t.supplier.select(
        (F.lit(1_000_000_000) + F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.lit("NEW").alias("c_mktsegment"), F.col("s_acctbal").alias("c_acctbal"))
    stale = table.withColumn("c_name", F.lit("stale")).join(changed, "c_custkey", "left_semi")
    batch = sets.bag_union(changed.withColumn("version", F.lit(2)),
                           stale.withColumn("version", F.lit(1)),
                           new.withColumn("version", F.lit(1)))
    return L.upsert(table, batch, "c_custkey", ["c_name", "c_mktsegment"], ["version"])


@query("LED-4", """
SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def key_clashes(t):
    return L.duplicate_values(t.orders.select("o_custkey"), "o_custkey")


_HOST = "regexp_extract(url, '^[a-z]+://([^/]*)', 1)"


@query("LED-5", f"""
WITH b AS (SELECT page_id, {_HOST} AS host FROM pages)
SELECT host, min(page_id) AS page_id FROM b
WHERE host NOT IN (SELECT {_HOST} FROM pages WHERE starts_with(url, 'http://'))
GROUP BY host""")
def insert_ignore(t):
    batch = t.pages.select("page_id", "url", S.url_id(F.col("url"), "^[a-z]+://([^/]*)").alias("host"))
    table = batch.where(F.col("url").startswith("http://"))
    return L.insert_ignore(table, batch, "host", ["page_id"]).select("host", "page_id")


@query("LED-6", """
SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS computer FROM supplier
UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def added_column(t):
    old = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    new = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                            F.col("c_mktsegment").alias("computer"))
    return L.append_evolving(L.with_columns_added(old, {"computer": "string"}), new)


@query("LED-7 JN-2", """
SELECT l.doc_id, CASE WHEN d.lang = 'en' AND quality = 1 THEN 0 ELSE quality END AS quality
FROM labels l LEFT JOIN documents d USING (doc_id)""")
def reset_done(t):
    keys = t.documents.where("lang = 'en'").select("doc_id")
    return L.reset_done(t.labels.select("doc_id", "quality"), "quality", keys, "doc_id")


@query("LED-7", "SELECT count(*) FILTER (quality = 1) AS n_reset FROM labels")
def reset_counts(t):
    return L.count_resets(t.labels, "quality")


@query("FLT-19", "SELECT doc_id FROM labels WHERE quality = 1")
def done_docs(t):
    return L.done_rows(t.labels, "doc_id", "quality")


@query("LED-8 ORD-2", """
SELECT o_orderkey, claim_no, CAST((claim_no - 1) % 8 AS INTEGER) AS host_no FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS claim_no
  FROM orders WHERE o_orderstatus = 'P')
WHERE claim_no <= 1000""")
def oldest_claims(t):
    waiting = t.orders.where("o_orderstatus = 'P'").select("o_orderkey", "o_orderdate")
    return (L.assign_hosts(waiting, 8, ["o_orderdate", "o_orderkey"], limit=1000)
             .select("o_orderkey", "claim_no", "host_no"))


@query("LED-8 WIN-1", """
SELECT o_orderkey, claim_no, CAST((claim_no - 1) % 8 AS INTEGER) AS host_no FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS claim_no
  FROM orders WHERE o_orderstatus = 'P')""")
def all_claims(t):
    waiting = t.orders.where("o_orderstatus = 'P'").select("o_orderkey", "o_orderdate")
    return (L.assign_hosts(waiting, 8, ["o_orderdate", "o_orderkey"])
             .select("o_orderkey", "claim_no", "host_no"))


def _quota_sql(idle_only: bool) -> str:
    return f"""
WITH tasks AS (
  SELECT o_orderkey AS task, o_orderdate AS updated_at,
         CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_orderkey % 7 = 0 THEN 'queued'
              WHEN o_orderkey % 7 = 1 THEN 'retry' ELSE 'done' END AS state,
         'host' || (o_custkey % 60) AS host FROM orders),
hosts AS (SELECT 'host' || s_suppkey AS host, CASE s_suppkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 10 ELSE 90 END AS slots
          FROM supplier),
own AS (
  SELECT q.task, q.state, q.host FROM (
    SELECT *, row_number() OVER (PARTITION BY host ORDER BY updated_at, task) AS n FROM tasks WHERE state = 'queued') q
  JOIN hosts ON hosts.host = q.host AND n <= slots),
free AS (
  SELECT h.host, h.slots - count(own.task) AS n_free FROM hosts h LEFT JOIN own ON own.host = h.host
  GROUP BY h.host, h.slots HAVING h.slots > count(own.task) {"AND count(own.task) = 0" if idle_only else ""}),
spans AS (SELECT host, sum(n_free) OVER (ORDER BY host) AS upto, n_free FROM free),
waiting AS (
  SELECT *, row_number() OVER (ORDER BY updated_at, task) AS n FROM tasks WHERE state IN ('pending', 'retry'))
SELECT task, state, host, 'own' AS claim FROM own
UNION ALL SELECT w.task, w.state, s.host, 'new' FROM waiting w JOIN spans s ON w.n <= s.upto AND w.n > s.upto - s.n_free"""


def _quota_claims(t, top_up):
    key = F.col("o_orderkey")
    state = (F.when(F.col("o_orderstatus") == "P", "pending").when(key % 7 == 0, "queued")
              .when(key % 7 == 1, "retry").otherwise("done"))
    tasks = t.orders.select(key.alias("task"), F.col("o_orderdate").alias("updated_at"), state.alias("state"),
                            F.concat(F.lit("host"), (F.col("o_custkey") % 60).cast("string")).alias("host"))
    slots = F.element_at(F.array(*map(F.lit, (0, 3, 10, 90))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    hosts = t.supplier.select(F.concat(F.lit("host"), F.col("s_suppkey").cast("string")).alias("host"), slots.alias("quota"))
    return L.claim_by_quota(tasks, hosts, ["updated_at", "task"], top_up=top_up).select("task", "state", "host", "claim")


@query("LED-8", _quota_sql(True))
def quota_claims(t):
    return _quota_claims(t, False)


@query("LED-8", _quota_sql(False))
def quota_top_up(t):
    return _quota_claims(t, True)


@query("LED-9", f"""
WITH {TASK_EVENTS}, cur AS (
  SELECT * FROM task_events
  QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY updated_at DESC, seq DESC) = 1)
SELECT host, {', '.join(f"count(*) FILTER (state = '{s}') AS {s}" for s in _STATES)}
FROM cur GROUP BY host""")
def host_backlog(t):
    return L.host_backlog(L.current_state(task_events(t), ["task_id"]))


_DIALECTS = ["queue", "worker", "playlist", "image", "json"]
_CODES = """
  WHEN 'queue:0' THEN 'pending' WHEN 'queue:1' THEN 'done' WHEN 'queue:2' THEN 'running' WHEN 'queue:3' THEN 'failed'
  WHEN 'queue:4' THEN 'retry' WHEN 'worker:pending' THEN 'pending' WHEN 'worker:downloading' THEN 'running'
  WHEN 'worker:completed' THEN 'done' WHEN 'worker:failed' THEN 'failed' WHEN 'playlist:0' THEN 'pending'
  WHEN 'playlist:1' THEN 'done' WHEN 'playlist:2' THEN 'running' WHEN 'playlist:3' THEN 'retry'
  WHEN 'playlist:4' THEN 'queued' WHEN 'image:0' THEN 'pending' WHEN 'image:1' THEN 'done' WHEN 'image:2' THEN 'running'
  WHEN 'json:0' THEN 'pending' WHEN 'json:1' THEN 'done'"""


@query("LED-2", f"""
WITH coded AS (
  SELECT event_id, ({_DIALECTS})[event_id % 5 + 1] AS dialect,
         CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'view' THEN NULL
              ELSE CAST(CAST(floor(value) AS BIGINT) % 6 AS VARCHAR) END AS code
  FROM events)
SELECT event_id, dialect, code,
       CASE WHEN dialect = 'json' AND code IS NULL THEN 'pending'
            ELSE CASE dialect || ':' || code {_CODES} END END AS state
FROM coded""")
def canonical_states(t):
    dialect = F.element_at(F.array(*(F.lit(d) for d in _DIALECTS)),
                           (F.col("event_id") % 5 + 1).cast("int"))
    code = (F.when(F.col("event_type") == "error", "failed")
             .when(F.col("event_type") != "view", (F.floor("value") % 6).cast("string")))
    coded = t.events.select("event_id", dialect.alias("dialect"), code.alias("code"))
    return coded.withColumn("state", L.canonical_state(F.col("dialect"), F.col("code")))


@query("JOB-15 LED-2 LED-3 LED-9 AGG-1", f"""
WITH {TASK_EVENTS}, stepped AS (
  SELECT *, lag(state) OVER (PARTITION BY task_id ORDER BY updated_at, seq) AS from_state,
         row_number() OVER (PARTITION BY task_id ORDER BY updated_at DESC, seq DESC) AS back
  FROM task_events),
per_host AS (
  SELECT host, count(*) AS tasks,
         {', '.join(f"count(*) FILTER (state = '{s}') AS {s}" for s in _STATES)},
         count(*) FILTER (state IN ('queued', 'running')
           AND updated_at <= (SELECT max(ts) FROM events) - INTERVAL 120 MINUTE) AS stuck
  FROM stepped WHERE back = 1 GROUP BY host),
wrong AS (
  SELECT host, count(*) FILTER (from_state IS NOT NULL
           AND from_state || '>' || state NOT IN ({_STEPS})) AS wrong_steps
  FROM stepped GROUP BY host)
SELECT host, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('tasks', *_STATES, 'stuck', 'wrong_steps'))},
       coalesce(done * 100.0::DOUBLE / tasks, 0) AS done_percent
FROM per_host FULL JOIN wrong USING (host)""")
def ledger_health(t):
    now = t.events.agg(F.max("ts").alias("ts")).scalar()
    return reports.ledger_health(task_events(t), now, 120)


@query("JOB-9 STR-3 FLT-7 JN-1 AGG-1", """
WITH u AS (SELECT page_id, regexp_replace(url, '[_\\s]+$', '') AS url FROM pages),
v AS (SELECT *, regexp_matches(url, '^(https?://[a-z.]*example\\.(com|org)/)') AS valid,
             page_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS is_done FROM u)
SELECT count(*) AS listed, count(*) FILTER (NOT valid) AS invalid,
       count(*) FILTER (valid AND is_done) AS done,
       count(*) FILTER (valid AND NOT is_done) AS pending,
       coalesce(count(*) FILTER (valid AND is_done) * 100.0::DOUBLE / nullif(count(*) FILTER (valid), 0), 0)
         AS done_percent
FROM v""")
def pending_report(t):
    listed = t.pages.select("page_id", F.concat(F.lit("  "), "url", F.lit("__ ")).alias("url"))
    clean = reports.cleaned_urls(listed, [r"https?://[a-z.]*example\.(?:com|org)/"])
    done_ids = L.done_rows(t.labels, "doc_id", "quality")
    done = (t.pages.join(done_ids, F.col("page_id") == F.col("doc_id"), "left_semi")
             .select(S.clean_url(F.col("url")).alias("url")))
    return reports.pending_report(clean, done)


@query("JOB-9 JN-1", """
SELECT page_id, url FROM pages
WHERE regexp_matches(url, '^https?://[a-z.]*example\\.(com|org)/')
  AND page_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def pending_pages(t):
    clean = reports.cleaned_urls(t.pages.select("page_id", "url"),
                                 [r"https?://[a-z.]*example\.(?:com|org)/"])
    done_ids = L.done_rows(t.labels, "doc_id", "quality")
    done = (t.pages.join(done_ids, F.col("page_id") == F.col("doc_id"), "left_semi")
             .select(S.clean_url(F.col("url")).alias("url")))
    return reports.pending_urls(clean, done)


@query("AGG-1", """
SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done,
       count(*) FILTER (o_orderstatus <> 'F') AS pending,
       count(*) FILTER (o_orderstatus = 'F') * 100.0::DOUBLE / count(*) AS done_percent
FROM orders GROUP BY o_orderpriority""")
def status_summary(t):
    return M.status_summary(t.orders, F.col("o_orderstatus") == "F", ["o_orderpriority"])


@query("SET-1 SET-4", """
SELECT url AS link FROM pages UNION SELECT 'doc:' || doc_id FROM documents
UNION SELECT 'doc:' || doc_id FROM labels""")
def link_union(t):
    def tagged(df):
        return df.select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("link"))
    return sets.union_distinct(t.pages.select(F.col("url").alias("link")), tagged(t.documents),
                               tagged(t.labels))


@query("SET-2 SET-4", """
SELECT source, count(*) AS n, count(DISTINCT lang) AS n_langs FROM (
  SELECT source, lang FROM documents WHERE lang = 'en'
  UNION ALL SELECT source, lang FROM documents WHERE lang <> 'en') GROUP BY source""")
def bag_union(t):
    docs = t.documents.select("source", "lang")
    both = sets.bag_union(docs.where("lang = 'en'"), docs.where("lang <> 'en'"))
    langs = sets.distinct_rows(both).groupBy("source").agg(F.count(F.lit(1)).alias("n_langs"))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n")).join(langs, "source")


@query("SET-3", "SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def key_difference(t):
    return sets.difference(t.orders.select("o_custkey"),
                           t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")))


@query("SET-3", """
SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer WHERE c_acctbal > 0""")
def bag_difference(t):
    return sets.bag_difference(
        t.orders.select("o_custkey"),
        t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")))
