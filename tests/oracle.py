"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver does
(row count, column names, order-insensitive value hash after sorting columns by name)."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

from foldwise.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def digest(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, entry, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = entry.run(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    out = {"name": entry.name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    sql = entry.oracle()
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    out["duck_rows"] = len(drows)
    same_cols = sorted(c.lower() for c in scols) == sorted(c.lower() for c in dcols)
    same_hash = same_cols and digest(scols, srows) == digest(dcols, drows)
    out["status"] = "ok" if (same_hash and len(srows) == len(drows)) else "MISMATCH"
    if not same_cols:
        out["cols"] = (scols, dcols)
    elif not same_hash:
        order_s = sorted(range(len(scols)), key=lambda i: scols[i].lower())
        order_d = sorted(range(len(dcols)), key=lambda i: dcols[i].lower())
        ss = sorted(repr(tuple(_norm(r[i]) for i in order_s)) for r in srows)
        dd = sorted(repr(tuple(_norm(r[i]) for i in order_d)) for r in drows)
        diff_s = [x for x in ss if x not in set(dd)][:3]
        diff_d = [x for x in dd if x not in set(ss)][:3]
        out["diff"] = {"spark": diff_s, "duck": diff_d}
    return out


def main(argv: list[str]) -> int:
    from foldwise.catalog import REGISTRY
    from foldwise.plans.joins import release
    from foldwise.plans.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf_dir = a.split("=", 1)[1]
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name, entry in REGISTRY.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        if "--sql-only" in argv and entry.sql is None:
            continue
        try:
            r = compare(spark, con, entry, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "error": str(e).splitlines()[0][:300]}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
        release()
    print(f"mismatches/errors: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
