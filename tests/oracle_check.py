"""Run registered queries against their DuckDB twins and report mismatches.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for rec in df.itertuples(index=False, name=None):
        out = []
        for v in rec:
            if v is None or (isinstance(v, float) and math.isnan(v)):
                out.append("NULL")
            elif isinstance(v, float):
                out.append(f"{v:.6f}")
            elif isinstance(v, pd.Timestamp):
                out.append(v.strftime("%Y-%m-%d %H:%M:%S"))
            elif hasattr(v, "strftime"):
                out.append(v.strftime("%Y-%m-%d %H:%M:%S"))
            elif isinstance(v, bool):
                out.append(str(v))
            elif isinstance(v, (int,)):
                out.append(str(int(v)))
            else:
                out.append(str(v))
        rows.append(tuple(out))
    return sorted(rows)


def main() -> int:
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    import __spark_entry__ as entry
    from tspanel.session import get_spark

    spark = get_spark()
    con = duck(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = args or list(queries)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = queries[name](spark, sf_dir)
            spd = sdf.toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(spd)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            dpd = con.execute(sqls[name]).df()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            bad += 1
            continue
        if sorted(spd.columns) != sorted(dpd.columns):
            print(f"FAIL {name}: columns {sorted(spd.columns)} vs {sorted(dpd.columns)}")
            bad += 1
            continue
        a, b = canon(spd), canon(dpd)
        if a == b:
            print(f"OK   {name}: {len(a)} rows {ts:.1f}s")
        else:
            bad += 1
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {name}: rows {len(a)} vs {len(b)}; first diffs {diff}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
