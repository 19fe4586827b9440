"""Run every registered query against its DuckDB oracle (like the driver).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ERROR with row counts.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return f"{v:.6g}" if abs(v) >= 1e6 else f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}" if v == v else None
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.6f}"
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    return str(v)


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def spark_type_name(dt_) -> str:
    n = dt_.simpleString()
    return {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
            "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "double": "DOUBLE",
            "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}.get(n, n.upper())


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute(f"SET TimeZone='{os.environ.get('WY_DUCKDB_TZ', 'UTC')}'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from walletyield.session import get_session
    if os.environ.get("WY_DEFAULT_SESSION"):
        # a plain session, as a driver might build it (200 shuffle partitions, no extra conf)
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false") \
            .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    else:
        spark = get_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR-SPARK {name}: {type(e).__name__}: {str(e)[:400]}")
            traceback.print_exc(limit=2)
            continue
        ts = time.time() - t0
        sql = sqls.get(name)
        if sql is None:
            print(f"ROWS-ONLY {name}: spark={len(srows)} ({ts:.1f}s)")
            continue
        try:
            res = con.sql(sql)
            dcols = res.columns
            dtypes = [str(t) for t in res.types]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR-SQL {name}: {str(e)[:600]}")
            continue
        if sorted(scols) != sorted(dcols):
            bad += 1
            print(f"SCHEMA {name}: spark={scols} sql={dcols}")
            continue
        st = {f.name: spark_type_name(f.dataType) for f in sdf.schema.fields}
        bad_types = [(c, st[c], t) for c, t in zip(dcols, dtypes) if st.get(c) != t]
        if bad_types:
            print(f"TYPES {name}: {bad_types}")
        a, b = canon(srows, scols), canon(drows, dcols)
        if a == b:
            print(f"OK {name}: rows={len(a)} ({ts:.1f}s)")
        else:
            bad += 1
            print(f"MISMATCH {name}: spark={len(a)} sql={len(b)}")
            sa, sb = set(a), set(b)
            print("   only spark:", list(sa - sb)[:3])
            print("   only sql:  ", list(sb - sa)[:3])
    print("FAILURES", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
