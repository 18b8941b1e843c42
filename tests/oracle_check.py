"""Run registered Spark queries against their DuckDB oracle SQL and compare
(row count, column names, order-insensitive values with a float tolerance).

    python tests/oracle_check.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    out = []
    for v in row:
        if v is None:
            out.append((0, ""))
        elif isinstance(v, bool):
            out.append((1, str(v)))
        elif isinstance(v, (int, float)):
            out.append((2, f"{v:.6e}" if isinstance(v, float) else f"{float(v):.6e}"))
        else:
            out.append((3, str(v)))
    return tuple(out)


STRICT = False


def _close(a, b) -> bool:
    if STRICT:
        return a == b and (a is None) == (b is None)
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, bool) or isinstance(b, bool):
        return bool(a) == bool(b) and type(a) is type(b)
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-6)
    return a == b


def compare(spark_cols, spark_rows, duck_cols, duck_rows):
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns differ: spark={sorted(spark_cols)} duck={sorted(duck_cols)}"
    if len(spark_rows) != len(duck_rows):
        return False, f"row count spark={len(spark_rows)} duck={len(duck_rows)}"
    idx = [duck_cols.index(c) for c in spark_cols]
    s = sorted((tuple(_norm(v) for v in r) for r in spark_rows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in idx) for r in duck_rows), key=_key)
    bad = 0
    first = None
    for a, b in zip(s, d):
        if not all(_close(x, y) for x, y in zip(a, b)):
            bad += 1
            if first is None:
                first = (a, b)
    if bad:
        return False, f"{bad} rows differ; first spark={first[0]} duck={first[1]}"
    return True, f"{len(s)} rows"


def run(names: list[str], sf_dir: str, plain: bool = False) -> int:
    import __spark_entry__ as E
    if plain:  # a bare session, as a caller of __spark_entry__ would build it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
                 .getOrCreate())
    else:
        from tesoro.session import build_session
        spark = build_session()
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    failures = 0
    for name in sorted(qs):
        if names and not any(name.startswith(n) for n in names):
            continue
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = df.collect()
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            failures += 1
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(oracle[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            failures += 1
            print(f"FAIL {name}: duckdb error {str(e)[:400]}", flush=True)
            continue
        ok, msg = compare(cols, rows, dcols, drows)
        failures += 0 if ok else 1
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {msg} {ts:.1f}s", flush=True)
    return failures


if __name__ == "__main__":
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--strict", action="store_true", help="floats must be bit-identical")
    ap.add_argument("--plain", action="store_true", help="bare SparkSession instead of build_session()")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    STRICT = a.strict
    sys.exit(1 if run(a.names, a.sf, a.plain) else 0)
