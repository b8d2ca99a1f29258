"""Compare every query with its DuckDB statement.

Usage: python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from netvigil import oracle, registry  # noqa: E402
from netvigil.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    return value


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in registry.DRIVER_TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def spark_rows(df):
    columns = sorted(df.columns)
    rows = Counter(tuple(plain(row[c]) for c in columns) for row in df.collect())
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return columns, rows, types


def duck_rows(con, sql: str):
    result = con.sql(sql)
    order = sorted(range(len(result.columns)), key=lambda i: result.columns[i])
    columns = [result.columns[i] for i in order]
    rows = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    return columns, rows, {c: str(t) for c, t in zip(result.columns, result.types)}


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def difference(spark_side, duck_side) -> str | None:
    """None when both sides agree, else what differs."""
    columns, rows, types = spark_side
    duck_columns, duck, duck_types = duck_side
    if columns != duck_columns:
        return f"columns {columns} vs {duck_columns}"
    odd = [f"{c}: {types[c]} vs {duck_types[c]}" for c in columns if SAME_TYPE.get(types[c]) != duck_types[c]]
    if odd:
        return f"types {odd}"
    if rows != duck:
        return (f"rows {sum(rows.values())} vs {sum(duck.values())}; only spark "
                f"{list((rows - duck).items())[:2]}; only duckdb {list((duck - rows).items())[:2]}")
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle.oracle_sql(), 0
    for name, query in registry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        try:
            ours = spark_rows(query(spark, sf_dir))
            verdict = difference(ours, duck_rows(con, sqls[name])) if name in sqls else None
        except Exception as error:  # report and go on with the next query
            ours, verdict = None, f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None
        count = sum(ours[1].values()) if ours else -1
        kind = "sql" if name in sqls else "rows"
        print(f"{'FAIL' if verdict else 'ok':5}{name:28}{kind:5}{count:8}  {time.perf_counter() - started:6.2f}s  {verdict or ''}", flush=True)
    print("missing queries:", sorted(set(sqls) - set(registry.queries())), "failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
