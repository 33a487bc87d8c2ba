"""Runs registered Spark queries and their DuckDB oracle SQL and compares results.

Order-insensitive: columns sorted by name, rows sorted after normalising
values (floats to 9 significant digits, timestamps / dates to ISO text).

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create or replace view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def spark_rows(df):
    rows = df.collect()
    return df.columns, [tuple(r) for r in rows]


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, sf_dir, name, query, sql, con=None):
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    s_cols, s_rows = spark_rows(query(spark, sf_dir))
    t1 = time.time()
    d_cols, d_rows = duck_rows(con, sql)
    t2 = time.time()
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    result = {
        "name": name,
        "spark_rows": len(sr),
        "oracle_rows": len(dr),
        "columns_match": sc == dc,
        "values_match": sc == dc and sr == dr,
        "spark_sec": round(t1 - t0, 2),
        "oracle_sec": round(t2 - t1, 2),
    }
    if not result["values_match"]:
        result["spark_columns"] = sc
        result["oracle_columns"] = dc
        diff_s = [r for r in sr if r not in set(dr)][:3] if sc == dc else []
        diff_d = [r for r in dr if r not in set(sr)][:3] if sc == dc else []
        result["only_spark"] = diff_s
        result["only_oracle"] = diff_d
    return result


def main(argv):
    import __spark_entry__ as entry
    from fleetspark.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connection(sf_dir)
    ok = True
    for name in names or sorted(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print({"name": name, "rows_only": df.count()}, flush=True)
            continue
        r = compare(spark, sf_dir, name, qs[name], sqls[name], con)
        ok &= r["values_match"]
        print(r, flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
