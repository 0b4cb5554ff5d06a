"""Compares registered queries with their SQL: columns, types, row counts and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def sql_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con.sql(sql).arrow()


def canonical(rows, columns):
    """Sorted rows with columns in name order; None sorts first."""
    ordered = [tuple(r[c] for c in columns) for r in rows]
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    return sorted(ordered, key=key)


def differences(spark, sf_dir: str, name: str, function, sql: str) -> list[str]:
    df = function(spark, sf_dir)
    mine = df.toArrow()
    theirs = sql_rows(sf_dir, sql)
    if hasattr(theirs, "read_all"):
        theirs = theirs.read_all()
    problems = []
    if sorted(mine.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(mine.column_names)} against {sorted(theirs.column_names)}"]
    for column in mine.column_names:
        a, b = mine.schema.field(column).type, theirs.schema.field(column).type
        if str(a).replace("large_", "") != str(b).replace("large_", ""):
            problems.append(f"type of {column}: {a} against {b}")
    if mine.num_rows != theirs.num_rows:
        problems.append(f"{mine.num_rows} rows against {theirs.num_rows}")
        return problems
    if mine.num_rows == 0:
        problems.append("no rows")
    columns = sorted(mine.column_names)
    left, right = canonical(mine.to_pylist(), columns), canonical(theirs.to_pylist(), columns)
    unequal = [(a, b) for a, b in zip(left, right, strict=True) if a != b and not _both_nan(a, b)]
    if unequal:
        problems.append(f"{len(unequal)} rows differ, first {str(unequal[0])[:600]}")
    return problems


def _both_nan(a, b) -> bool:
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
               for x, y in zip(a, b, strict=True))


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from habispark.session import build_session

    directory = sys.argv[1]
    chosen = sys.argv[2:]
    session = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    sql = oracle_sql()
    failed = 0
    for query, function in queries().items():
        if chosen and query not in chosen:
            continue
        started = time.time()
        try:
            found = differences(session, directory, query, function, sql[query]) if query in sql else ["no SQL"]
        except Exception as error:  # noqa: BLE001
            found = [f"error {str(error)[:1200]}"]
        failed += bool(found)
        print(f"{query:28s} {time.time() - started:6.2f}s {'ok' if not found else found}", flush=True)
    print("failed:", failed)
