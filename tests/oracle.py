"""Run registered queries against their SQL on the same tables.

``python tests/oracle.py [name …]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def cell(value):
    """One spelling per value: whole floats as they print, nested values as tuples."""
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def kind(name: str) -> str:
    name = name.lower()
    same = {"long": "bigint", "integer": "int", "varchar": "string", "timestamp_ntz": "timestamp"}
    return same.get(name, name)


def compare(spark, connection, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: kind(str(d[1])) for d in result.description}
    want = rows_of(names, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    for name, spark_type in df.dtypes:
        if name in types and kind(spark_type) != types[name]:
            problems.append(f"type of {name}: {spark_type} vs {types[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    elif got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        problems.append(f"{len(bad)} rows differ, first: {str(bad[0][0])[:300]} vs {str(bad[0][1])[:300]}")
    return len(got), problems


def main(argv):
    from winnowry.session import local_session
    import __spark_entry__ as entry

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    queries, sql = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv)]
    spark, connection = local_session(), duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in sql:
                count, problems = compare(spark, connection, sf_dir, queries[name], sql[name])
            else:
                count, problems = len(queries[name](spark, sf_dir).collect()), ["(no SQL)"]
        except Exception as error:
            text = str(error) if os.environ.get("FULL") else str(error)[:700]
            count, problems = -1, [f"{type(error).__name__}: {text}"]
            if os.environ.get("FULL"):
                traceback.print_exc()
        bad = problems and problems != ["(no SQL)"]
        failed += bool(bad)
        print(f"{'FAIL' if bad else 'ok  '} {name:28s} {count:7d} rows {time.time() - start:6.2f}s {'; '.join(problems)}", flush=True)
    print(f"{len(names) - failed} of {len(names)} match")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
