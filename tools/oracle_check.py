"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
Compares column names, row counts and values (order-insensitive; floats
to 1e-9 relative), and reports whether an exact value hash also matches.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from haulage.plans import bindings  # noqa: E402
from haulage.plans.catalog import oracle_sql, queries  # noqa: E402
from haulage.session import get_session  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, repr(round(v, 6)) if isinstance(v, float) else repr(v)) for v in row)


def rows_of(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=_key)


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        try:
            return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)
        except (TypeError, ValueError):
            return False
    if hasattr(a, "isoformat") and hasattr(b, "isoformat"):
        return a.replace(tzinfo=None) == b.replace(tzinfo=None) if hasattr(a, "tzinfo") else a == b
    return a == b


def spark_family(t) -> str:
    n = t.simpleString()
    if n in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        return {"tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64",
                "float": "float32", "double": "float64"}[n]
    if n.startswith("decimal"):
        return "decimal"
    if n.startswith("timestamp"):
        return "timestamp"
    return n.split("<")[0]


def duck_family(t: str) -> str:
    t = t.upper()
    widths = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64",
              "HUGEINT": "int128", "FLOAT": "float32", "DOUBLE": "float64"}
    if t in widths:
        return widths[t]
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t == "VARCHAR":
        return "string"
    if t == "BOOLEAN":
        return "boolean"
    if t == "DATE":
        return "date"
    return t.lower()


def duck(sf_dir):
    con = duckdb.connect()
    for t in bindings.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    scols = sorted(sdf.columns)
    t1 = time.time()
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    dcols = sorted(rel.columns)
    drecs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    if scols != dcols:
        return {"name": name, "status": "COLUMNS", "spark": scols, "oracle": dcols}
    sf_types = {f.name: spark_family(f.dataType) for f in sdf.schema.fields}
    df_types = {c: duck_family(str(t)) for c, t in zip(rel.columns, rel.types)}
    bad_types = {c: (sf_types[c], df_types[c]) for c in scols if sf_types[c] != df_types[c]}
    if bad_types:
        return {"name": name, "status": "TYPES", "diff": bad_types}
    a, b = rows_of(srows, scols), rows_of(drecs, scols)
    if len(a) != len(b):
        return {"name": name, "status": "ROWCOUNT", "spark": len(a), "oracle": len(b)}
    bad = [(x, y) for x, y in zip(a, b) if not all(close(p, q) for p, q in zip(x, y))]
    exact = hashlib.md5(repr(a).encode()).hexdigest() == hashlib.md5(repr(b).encode()).hexdigest()
    status = "OK" if not bad else "VALUES"
    out = {"name": name, "status": status, "rows": len(a), "exact": exact, "spark_s": round(t1 - t0, 2)}
    if bad:
        out["first_diff"] = [scols, bad[0]]
        out["n_diff"] = len(bad)
    return out


def main():
    sf_dir = "/root/testdata/sf0.01"
    args = sys.argv[1:]
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    names = [n for n in sorted(qs) if not args or any(a in n for a in args)]
    fails = 0
    for n in names:
        try:
            r = check(spark, con, sf_dir, n, qs[n], sqls.get(n))
        except Exception as e:  # report and go on
            r = {"name": n, "status": "ERROR", "error": f"{type(e).__name__}: {str(e)[:600]}"}
        if r["status"] not in ("OK", "rows-only"):
            fails += 1
        print(r, flush=True)
    print(f"checked {len(names)} queries, {fails} failing")


if __name__ == "__main__":
    main()
