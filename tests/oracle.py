"""Compare registered queries with their SQL in DuckDB.

``python tests/oracle.py [name ...]`` checks the named queries, or all.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    return value


def spark_rows(df):
    names = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [tuple(plain(v) for v in r) for r in df.select(*names).collect()]
    return names, types, rows


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def compare(df, connection, sql: str) -> list[str]:
    """Differences between a DataFrame and the result of ``sql``."""
    names, types, got = spark_rows(df)
    cursor = connection.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    order = [d[0] for d in cursor.description]
    if sorted(described) != names:
        return [f"columns {names} != {sorted(described)}"]
    problems = [
        f"type of {n}: {types[n]} != {described[n]}"
        for n in names
        if KINDS.get(types[n]) != described[n] and not {types[n], described[n]} <= {"int", "bigint", "INTEGER", "BIGINT"}
    ]
    at = [order.index(n) for n in names]
    want = [tuple(plain(r[i]) for i in at) for r in cursor.fetchall()]
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    left, right = sorted(got, key=repr), sorted(want, key=repr)
    if left != right:
        missing = list(set(map(repr, right)) - set(map(repr, left)))
        extra = list(set(map(repr, left)) - set(map(repr, right)))
        problems.append(f"{len(extra)} rows only in Spark, {len(missing)} only in SQL")
        problems += [f"  spark {r[:400]}" for r in sorted(extra)[:2]]
        problems += [f"  sql   {r[:400]}" for r in sorted(missing)[:2]]
    return problems


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from eventlens.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "check", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    checks = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in checks:
                problems = compare(df, connection, checks[name])
                size = ""
            else:
                problems, size = [], f"rows only: {df.count()}"
        except Exception as error:
            problems, size = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        took = time.time() - start
        print(f"{'ok ' if not problems else 'BAD'} {name} {took:.2f}s {size}", flush=True)
        for p in problems:
            print("    ", p, flush=True)
        bad += bool(problems)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
