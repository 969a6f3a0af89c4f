"""Local correctness check: every registered query against its DuckDB oracle.

Usage: python tools_check.py [sf_dir] [name ...]
Mirrors the driver's compare: row count, column names, order-insensitive values.
"""
import math
import sys
import time

import duckdb

sys.path.insert(0, __import__("os").path.dirname(__file__))
from pitlane.plans import catalog  # noqa: E402
from pitlane.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return v


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    catalog.load_all()
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, fn in catalog.QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            cols = sorted(sdf.columns)
            srows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        sql = catalog.ORACLE.get(name)
        if sql is None:
            print(f"rows {name}: {len(srows)} rows ({dt:.2f}s), no oracle")
            continue
        try:
            cur = con.execute(sql)
            ocols = [d[0] for d in cur.description]
            orows_raw = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(ocols) != cols:
            print(f"FAIL {name}: columns spark={cols} oracle={sorted(ocols)}")
            bad += 1
            continue
        stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        otypes = {d[0]: str(d[1]) for d in cur.description}
        tmap = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
        tdiff = [(c, stypes[c], otypes[c]) for c in cols if tmap.get(stypes[c], stypes[c]) != otypes[c]]
        if tdiff:
            print(f"TYPES {name}: {tdiff}")
        idx = [ocols.index(c) for c in cols]
        orows = sorted((tuple(norm(r[i]) for i in idx) for r in orows_raw), key=repr)
        if srows == orows:
            print(f"ok   {name}: {len(srows)} rows ({dt:.2f}s)")
        else:
            bad += 1
            print(f"FAIL {name}: spark {len(srows)} rows, oracle {len(orows)} rows")
            so, ss = set(orows), set(srows)
            diff_s = [r for r in srows if r not in so][:3]
            diff_o = [r for r in orows if r not in ss][:3]
            print("   spark-only:", diff_s)
            print("   oracle-only:", diff_o)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
