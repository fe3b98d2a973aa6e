"""Runs the registered queries beside their SQL: python tests/oracle_check.py SF_DIR [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if hasattr(value, "to_pydatetime"):
        value = value.to_pydatetime()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    start = time.time()
    got = queries()[name](spark, sf_dir)
    columns, rows = got.columns, got.collect()
    spark_sec, start = time.time() - start, time.time()
    cursor = con.execute(oracle_sql()[name])
    want_columns = [d[0] for d in cursor.description]
    want = rows_of(want_columns, cursor.fetchall())
    mine = rows_of(columns, rows)
    return {
        "same": sorted(columns) == sorted(want_columns) and mine == want,
        "rows": len(mine),
        "want_rows": len(want),
        "columns": (sorted(columns), sorted(want_columns)),
        "types": (got.dtypes, [(d[0], str(d[1])) for d in cursor.description]),
        "differ": [pair for pair in zip(mine, want) if pair[0] != pair[1]][:3],
        "plan": got._jdf.queryExecution().executedPlan().toString(),
        "spark_sec": round(spark_sec, 2),
        "sql_sec": round(time.time() - start, 2),
    }


def main() -> None:
    from weftgraph.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session("oracle-check", "8")
    con = connect(sf_dir)
    failed = []
    for name in names or queries():
        try:
            result = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            result = {"same": False, "error": str(error)[:1500]}
        print(name, "ok" if result["same"] else "FAILED", result.get("rows"), result.get("spark_sec"), result.get("sql_sec"), flush=True)
        if not result["same"]:
            failed.append(name)
            result.pop("plan", None)
            print(result, flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
