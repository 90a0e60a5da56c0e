"""Compare queries with their SQL: same rows, whatever their order."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime

import duckdb
import pandas as pd

from farelake.plans.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """One form per value for both engines."""
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, pd.Timestamp):
        value = value.to_pydatetime()
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat() + "T00:00:00"
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def canon(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    got_cols, got = canon(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want_cols, want = canon([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. {set(got) - set(want) and list(set(got) - set(want))[:2]} vs {list(set(want) - set(got))[:2]}"
    if got != want:
        extra, lack = list(set(got) - set(want)), list(set(want) - set(got))
        return f"{len(extra)} rows differ, e.g. {sorted(extra, key=repr)[:2]} vs {sorted(lack, key=repr)[:2]}"
    if not got:
        return "no rows at all"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from farelake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names:
        t0 = time.time()
        try:
            df = entry.queries()[name](spark, sf)
            if name in entry.oracle_sql():
                problem = compare(df, con, entry.oracle_sql()[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t0:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
