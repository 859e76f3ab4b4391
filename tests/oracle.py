"""Run a registered query against its SQL twin: names, types, rows and values."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return ("f", repr(value + 0.0))
    if isinstance(value, decimal.Decimal):
        return ("d", format(value.normalize(), "f"))
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, dt.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    return (type(value).__name__, str(value))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, folder) -> tuple[str, float]:
    begin = time.perf_counter()
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.perf_counter() - begin
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}", took
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}", took
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        first = next((x, y) for x, y in zip(a, b) if x != y)
        return f"values differ ({sum(x != y for x, y in zip(a, b))}): {first}", took
    return ("ok" if got else "ok but empty"), took


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from lakeops.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    conf["spark.sql.warehouse.dir"] = "/tmp/lakeops-tests-warehouse"
    conf["spark.sql.session.timeZone"] = os.environ.get("ORACLE_ZONE", "UTC")
    if os.environ.get("ORACLE_PARTITIONS"):
        conf["spark.sql.shuffle.partitions"] = os.environ["ORACLE_PARTITIONS"]
    spark = build_session("oracle", master="local[8]", **conf)
    spark.sparkContext.setLogLevel("OFF")
    con, oracle = connect(folder), e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if wanted and name not in wanted and fn.__module__.rsplit(".", 1)[-1] not in wanted:
            continue
        try:
            if name in oracle:
                verdict, took = compare(spark, con, name, fn, oracle[name], folder)
            else:
                begin = time.perf_counter()
                verdict, took = f"rows only: {fn(spark, folder).count()}", 0.0
                took = time.perf_counter() - begin
        except Exception as error:  # noqa: BLE001
            verdict, took = f"ERROR {type(error).__name__}: {str(error)[:700]}", 0.0
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{took:6.2f}s  {name}: {verdict}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
