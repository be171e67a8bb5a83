"""Run a Spark query and its DuckDB oracle side by side and compare.

Order-insensitive: columns are sorted by name, rows by their normalised
text.  Used by the tests and by ``python -m recunify.checks.compare``.
"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    try:
        if isinstance(v, float) and math.isnan(v):
            return "NULL"
    except TypeError:
        pass
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return f"{v:.9g}"
    if hasattr(v, "item"):          # numpy scalar
        return _norm(v.item())
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def oracle_rows(con, sql):
    rel = con.sql(sql)
    return list(rel.columns), rel.fetchall()


def compare(df, con, sql) -> dict:
    sc, sr = spark_rows(df)
    oc, orows = oracle_rows(con, sql)
    res = {
        "spark_rows": len(sr), "oracle_rows": len(orows),
        "columns_match": sorted(sc) == sorted(oc),
        "spark_columns": sc, "oracle_columns": oc,
    }
    res["rows_match"] = len(sr) == len(orows)
    res["values_match"] = res["columns_match"] and rows_of(sc, sr) == rows_of(oc, orows)
    if not res["values_match"] and res["columns_match"]:
        a, b = rows_of(sc, sr), rows_of(oc, orows)
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb)[:3]
        res["only_oracle"] = sorted(sb - sa)[:3]
    return res


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from recunify.session import local_session
    from recunify.plans.queries import QUERIES
    from recunify.checks.oracle import SQL
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = argv or sorted(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t0 = time.time()
        df = QUERIES[n](spark, sf_dir)
        if n not in SQL:
            c = df.count()
            print(f"{n:28s} rows-only {c} ({time.time()-t0:.1f}s)")
            continue
        r = compare(df, con, SQL[n])
        ok = r["values_match"] and r["rows_match"]
        bad += not ok
        extra = "" if ok else f" {r}"
        print(f"{n:28s} {'OK ' if ok else 'BAD'} spark={r['spark_rows']} oracle={r['oracle_rows']}"
              f" ({time.time()-t0:.1f}s){extra}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
