"""Compare registered queries with their SQL on the same tables.

    python tests/compare.py [sf_dir] [name-part ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registered  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(row[i]) for i in order)) for row in rows)


_SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, sf_dir: str, name: str):
    """The frame, and how its rows differ from the SQL result (empty when equal)."""
    frame = registered.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in frame.collect()]
    sql = registered.oracle_sql().get(name)
    if sql is None:
        return frame, []
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    problems = []
    if sorted(columns) != sorted(frame.columns):
        return frame, [f"columns {sorted(frame.columns)} != {sorted(columns)}"]
    for column, spark_type in frame.dtypes:
        if _SAME_TYPE.get(spark_type, types[column]) != types[column]:
            problems.append(f"type of {column}: {spark_type} != {types[column]}")
    left, right = _rows(frame.columns, got), _rows(columns, want)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows != {len(right)} rows")
    if left != right:
        only_left = [r for r in left if r not in set(right)][:3]
        only_right = [r for r in right if r not in set(left)][:3]
        problems.append(f"values: spark {only_left} sql {only_right}")
    return frame, problems


def main(argv: list[str]) -> int:
    from ledgerlark.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", 8, spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in registered.queries():
        if argv[1:] and not any(part in name for part in argv[1:]):
            continue
        start = time.time()
        try:
            _, problems = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        note = "" if name in registered.oracle_sql() else " (no sql)"
        print(f"{'BAD ' if problems else 'ok  '}{name}{note} {time.time() - start:.1f}s", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
    print(f"{bad} differing")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
