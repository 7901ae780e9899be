"""Runs named queries next to their SQL: ``python tests/compare.py [sf] [name …]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(dtype: pa.DataType) -> str:
    return str(dtype).replace("large_", "")


def rows_of(table: pa.Table) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in sorted(table.column_names)]
    return sorted(zip(*columns), key=repr)


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    """What differs in columns, types and rows; order is not compared."""
    found = []
    ours = {f.name: _plain(f.type) for f in spark_table.schema}
    theirs = {f.name: _plain(f.type) for f in sql_table.schema}
    if ours != theirs:
        found.append(f"schema {sorted(ours.items() ^ theirs.items())}")
        if ours.keys() != theirs.keys():
            return found
    a, b = rows_of(spark_table), rows_of(sql_table)
    if len(a) != len(b):
        found.append(f"{len(a)} rows, not {len(b)}")
    for x, y in zip(a, b):
        if x != y:
            found.append(f"first difference\n    {str(x)[:400]}\n    {str(y)[:400]}")
            break
    return found


def main(sf: str, names: list[str]) -> int:
    from corpusmill.session import session
    from corpusmill.workload import REGISTRY

    sf_dir = f"/root/testdata/sf{sf}"
    spark = session(
        spark__master="local[8]", spark__driver__memory="8g", spark__sql__shuffle__partitions="8"
    )
    spark.sparkContext.setLogLevel("OFF")
    con, bad = database(sf_dir), 0
    for name, query in REGISTRY.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            ours = query.run(spark, sf_dir).toArrow()
            t1 = time.time()
            if query.sql is None:
                print(f"{name}: {ours.num_rows} rows, no SQL, {t1 - t0:.1f}s", flush=True)
                continue
            theirs = con.sql(query.sql).to_arrow_table()
            problems = differences(ours, theirs)
        except Exception as e:  # noqa: BLE001
            problems, t1 = [f"{type(e).__name__}: {str(e)[:1200]}"], time.time()
            ours = None
        bad += bool(problems)
        n = "?" if ours is None else ours.num_rows
        print(
            f"{name}: {'OK' if not problems else 'DIFFERS ' + '; '.join(problems)} "
            f"{n} rows {t1 - t0:.1f}s sql {time.time() - t1:.1f}s",
            flush=True,
        )
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "0.01", args[1:]))
