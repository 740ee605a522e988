"""Side-by-side check of a registered query: Spark result vs its DuckDB oracle SQL.

Row count, column names and an order-insensitive hash of the values (floats
rounded to 6 places) must agree.
"""

from __future__ import annotations

import hashlib
import math
import sys

import duckdb

from comparo.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def table_hash(cols, rows) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name, spark_fn, sql, sf_dir, show_diff: int = 5) -> dict:
    sdf = spark_fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols)}
    if out["cols_match"]:
        out["hash_match"] = table_hash(scols, srows) == table_hash(dcols, drows)
    else:
        out["hash_match"] = False
        out["spark_cols"], out["oracle_cols"] = scols, dcols
    if not out["hash_match"] and out["cols_match"] and show_diff:
        order_s = sorted(range(len(scols)), key=lambda i: scols[i])
        order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
        a = {"|".join(_norm(r[i]) for i in order_s) for r in srows}
        b = {"|".join(_norm(r[i]) for i in order_d) for r in drows}
        out["only_spark"] = sorted(a - b)[:show_diff]
        out["only_oracle"] = sorted(b - a)[:show_diff]
    return out


if __name__ == "__main__":
    import time

    sys.path.insert(0, ".")
    from comparo.registry import ORACLE, QUERIES
    from comparo.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]")
    con = duck(sf)
    bad = 0
    for n in names:
        t = time.time()
        if n not in ORACLE:
            rows = QUERIES[n](spark, sf).count()
            print(f"{n:32s} rows-only {rows} ({time.time() - t:.1f}s)")
            continue
        try:
            r = compare(spark, con, n, QUERIES[n], ORACLE[n], sf)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{n:32s} ERROR {type(e).__name__}: {str(e)[:600]}")
            continue
        ok = r["hash_match"] and r["spark_rows"] == r["oracle_rows"]
        bad += not ok
        print(f"{n:32s} {'OK ' if ok else 'BAD'} spark={r['spark_rows']} oracle={r['oracle_rows']} "
              f"({time.time() - t:.1f}s)")
        if not ok:
            for key in ("spark_cols", "oracle_cols", "only_spark", "only_oracle"):
                if key in r:
                    print("   ", key, [str(x)[:300] for x in r[key]])
    print("FAILED" if bad else "ALL OK", bad)
