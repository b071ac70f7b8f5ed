"""Runs registered queries beside their SQL and compares rows, types and names.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# Spark type name by DuckDB type name.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP_NS": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _key(row):
    return tuple((value is None, str(value)) for value in row)


def differences(frame, connection, sql: str) -> list[str]:
    """What differs between a Spark frame and a SQL result; nothing when they agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    found = []
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} but {sorted(names)}"]
    for field in frame.schema:
        if TYPES.get(types[field.name], types[field.name]) != field.dataType.simpleString():
            found.append(f"type of {field.name}: {field.dataType.simpleString()} but {types[field.name]}")
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    want = sorted((tuple(row[i] for i in at) for row in result.fetchall()), key=_key)
    got = sorted((tuple(row) for row in frame.select(*columns).collect()), key=_key)
    if len(want) != len(got):
        found.append(f"{len(got)} rows but {len(want)}")
    if want != got:
        wrong = [(g, w) for g, w in zip(got, want) if g != w][:3]
        found.append(f"rows differ, first (ours, SQL): {str(wrong)[:800]}")
    return found


def main() -> None:
    from rowloom.plans import ORACLES, QUERIES
    from rowloom.session import build_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name, function in QUERIES.items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            frame = function(spark, folder)
            if name in ORACLES:
                found = differences(frame, connection, ORACLES[name])
            else:
                found = [] if frame.count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
