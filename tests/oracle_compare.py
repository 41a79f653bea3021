"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's check: columns sorted by name, row count, and an
order-insensitive hash of the values.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def frame_digest(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    rows = sorted(repr(tuple(_norm(v) for v in r)) for r in pdf.itertuples(index=False, name=None))
    return cols, len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest(), rows


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    s = fn(spark, sf_dir).toPandas()
    con.execute(f"CREATE OR REPLACE VIEW oracle_{name} AS {sql}")     # as the driver does
    d = con.execute(f"SELECT * FROM oracle_{name}").df()
    sc, sn, sh, srows = frame_digest(s)
    dc, dn, dh, drows = frame_digest(d)
    ok = sc == dc and sn == dn and sh == dh
    detail = ""
    if not ok:
        if sc != dc:
            detail = f"columns spark={sc} duck={dc}"
        elif sn != dn:
            detail = f"rows spark={sn} duck={dn}"
        else:
            a, b = set(srows), set(drows)
            detail = f"values differ: spark-only {sorted(a - b)[:3]} duck-only {sorted(b - a)[:3]}"
    return ok, detail


def main(sf_dir: str, names: list[str]):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from abx.session import build_session
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names or list(qs):
        if n not in sqls:
            print(f"{n:24s} (no oracle)")
            continue
        try:
            ok, detail = compare(spark, n, qs[n], sqls[n], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            ok, detail = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{n:24s} {'OK' if ok else 'MISMATCH'} {detail}"[:1500])
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
