"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

    python tools/oracle_check.py [sf_dir] [query_id ...]

Per query: row counts, column names and types, and an order-insensitive
hash of the values.  Prints one line per query and a JSON summary.
"""

from __future__ import annotations

import datetime
import decimal
import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"  # compare doubles bit for bit


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if EXACT else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{canon(k)}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return str(v)


def digest(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted("|".join(canon(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]
    return h, lines


def spark_type(dt):
    n = dt.simpleString()
    return {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
            "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}.get(n, n)


def check(spark, sf_dir, names=None, verbose=True):
    from tessera.plans import registry
    qs = registry.queries()
    sql = registry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or sorted(qs)):
        rec = {}
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_names = df.columns
            s_types = [spark_type(f.dataType) for f in df.schema.fields]
            s_rows = [tuple(r) for r in df.collect()]
            rec["spark_rows"] = len(s_rows)
            rec["spark_sec"] = round(time.time() - t0, 2)
        except Exception as e:  # noqa: BLE001
            rec["error"] = f"spark: {type(e).__name__}: {str(e)[:400]}"
            results[name] = rec
            if verbose:
                print(f"{name:32s} SPARK ERROR {rec['error']}", flush=True)
            continue
        if name not in sql:
            rec["status"] = "rows-only"
            results[name] = rec
            if verbose:
                print(f"{name:32s} rows-only  rows={len(s_rows)} {rec['spark_sec']}s", flush=True)
            continue
        try:
            cur = con.execute(sql[name])
            d_names = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
            d_types = [str(c[1]) for c in cur.description]
        except Exception as e:  # noqa: BLE001
            rec["error"] = f"duckdb: {type(e).__name__}: {str(e)[:400]}"
            results[name] = rec
            if verbose:
                print(f"{name:32s} DUCK ERROR {rec['error']}", flush=True)
            continue
        sh, sl = digest(s_names, s_rows)
        dh, dl = digest(d_names, d_rows)
        rec.update(duck_rows=len(d_rows), names_ok=sorted(s_names) == sorted(d_names),
                   types_ok=dict(zip(s_names, s_types)) == dict(zip(d_names, d_types)),
                   hash_ok=sh == dh)
        rec["status"] = "ok" if rec["names_ok"] and rec["hash_ok"] and len(s_rows) == len(d_rows) else "MISMATCH"
        if not rec["types_ok"]:
            rec["types"] = {"spark": dict(zip(s_names, s_types)), "duck": dict(zip(d_names, d_types))}
        if rec["status"] != "ok":
            ds, ss = set(dl), set(sl)
            only_s = [x[:300] for x in sl if x not in ds][:3]
            only_d = [x[:300] for x in dl if x not in ss][:3]
            rec["diff"] = {"spark_only": only_s, "duck_only": only_d,
                           "spark_cols": s_names, "duck_cols": d_names}
        results[name] = rec
        if verbose:
            flag = rec["status"] + ("" if rec["types_ok"] else " (types differ)")
            print(f"{name:32s} {flag:10s} rows={len(s_rows)}/{len(d_rows)} {rec['spark_sec']}s", flush=True)
            if rec["status"] != "ok" or not rec["types_ok"]:
                print("    ", json.dumps({k: rec[k] for k in ("diff", "types") if k in rec}, default=str)[:1500])
    return results


def main():
    args = [a for a in sys.argv[1:] if a != "--plain"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or None
    if "--plain" in sys.argv:
        # a session with Spark's defaults, as an outside caller would build it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from tessera.session import get_session
        spark = get_session("local[8]", 8)
    res = check(spark, sf_dir, names)
    bad = {k: v for k, v in res.items() if v.get("status") not in ("ok", "rows-only") or not v.get("types_ok", True)}
    print(json.dumps({"total": len(res), "bad": sorted(bad)}))


if __name__ == "__main__":
    main()
