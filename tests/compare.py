"""Run a named query and its SQL on the same tables and compare rows and types."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def difference(spark, con, query, folder: str) -> str | None:
    """None if equal, else what differs."""
    mine = query(spark, folder)
    names = sorted(mine.columns)
    types = dict(mine.dtypes)
    rows = Counter(tuple(plain(r[n]) for n in names) for r in mine.collect())
    other = con.sql(query.sql)
    if sorted(other.columns) != names:
        return f"columns {names} against {sorted(other.columns)}"
    other_types = dict(zip(other.columns, map(str, other.types)))
    odd = {n: (types[n], other_types[n]) for n in names if DUCK_TYPE.get(types[n]) != other_types[n]}
    at = [other.columns.index(n) for n in names]
    expected = Counter(tuple(plain(r[i]) for i in at) for r in other.fetchall())
    if rows != expected:
        extra, missing = list((rows - expected).items())[:3], list((expected - rows).items())[:3]
        return (f"rows {sum(rows.values())} against {sum(expected.values())}; columns {names}; "
                f"only here {extra}; only there {missing}")
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    from assetloom.registry import QUERIES
    from assetloom.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8",
                                                   "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in wanted:
        began = time.time()
        try:
            q = QUERIES[name]
            what = difference(spark, con, q, folder) if q.sql else f"(no sql) {q(spark, folder).count()} rows"
        except Exception as error:  # report and go on to the next query
            what = f"{type(error).__name__}: {str(error)[:700]}"
        if what:
            bad += 1
        print(f"{'ok ' if not what else 'BAD'} {name} {time.time() - began:.1f}s {what or ''}", flush=True)
    print(f"{len(wanted)} queries, {bad} to look at")
