"""Run queries in Spark and their oracle in DuckDB, and compare the results row by row.

    python -m checks.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import math
import time
from collections import Counter

TABLES = "region nation customer supplier part orders lineitem events".split()


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.10g}")
    return value.item() if hasattr(value, "item") else value


def rows(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(_cell(v) for v in row) for row in zip(*columns, strict=True))


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def compare(spark, con, sf: str, query, sql: str) -> tuple[str, int]:
    """Empty text if equal, else what differs; and the row count."""
    got = query(spark, sf).toArrow()
    want = con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}", got.num_rows
    types = [(n, str(got.schema.field(n).type), str(want.schema.field(n).type)) for n in got.column_names]
    odd = [t for t in types if t[1] != t[2] and {t[1], t[2]} != {"string", "large_string"}]
    if odd:
        return f"types {odd}", got.num_rows
    a, b = rows(got), rows(want)
    if a != b:
        return f"{got.num_rows} vs {want.num_rows} rows; only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}", got.num_rows
    return "", got.num_rows


def main() -> None:
    from checks.oracle import ORACLE
    from checks.session import local_session
    from checks.spark_queries import QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con, bad = local_session(), duck(args.sf), 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            diff, n = compare(spark, con, args.sf, QUERIES[name], ORACLE[name])
        except Exception as error:  # noqa: BLE001 - report and go on to the next query
            diff, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name:32} {n:8} rows {time.time() - start:6.1f}s  {diff}", flush=True)
    print(f"{bad} of {len(args.names or QUERIES)} differ")
    spark.stop()


if __name__ == "__main__":
    main()
