"""Run registered queries and their SQL side by side: ``python -m verification.compare [sf] [names]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
import traceback
from collections import Counter
from decimal import Decimal

import duckdb

from fleetpulse.session import build_session
from verification import oracles, queries

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str:
    """'' when equal, otherwise what differs."""
    df = queries.queries()[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    sql = oracles.oracle_sql().get(name)
    if sql is None:
        return "" if ours else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    wrong = [(c, t, kinds[c]) for c, t in df.dtypes if t != kinds[c]]
    if wrong:
        return f"types {wrong}"
    theirs = rows_of(columns, result.fetchall())
    if ours != theirs:
        return (
            f"{sum(ours.values())} against {sum(theirs.values())} rows; "
            f"only here {list((ours - theirs).items())[:2]}; only there {list((theirs - ours).items())[:2]}"
        )
    return ""


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(queries.queries())
    sf_dir = f"/root/testdata/sf{sf}"
    partitions = os.environ.get("COMPARE_PARTITIONS", "8")
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": partitions,
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception:
            problem = traceback.format_exc()[-1500:]
        bad += bool(problem)
        kind = "sql" if name in oracles.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {kind:4s} {time.time() - began:6.2f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
