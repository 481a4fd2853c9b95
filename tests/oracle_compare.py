"""Runs a registered query in Spark and its oracle statement in DuckDB and
compares row count, column names and the multiset of rounded values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(data_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def rows_key(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


SPARK_TO_DUCK = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "StringType()": "VARCHAR",
                 "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN"}


def compare(spark, con, name, qfn, sql, data_dir):
    t0 = time.time()
    sdf = qfn(spark, data_dir)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    res = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "spark_sec": round(t1 - t0, 2)}
    if sorted(cols) != sorted(dcols):
        res["ok"] = False
        res["why"] = f"columns {cols} vs {dcols}"
        return res
    stypes = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in sdf.schema.fields}
    dtypes = {c: str(t) for c, t in zip(dcols, rel.types)}
    if stypes != dtypes:
        res["ok"] = False
        res["why"] = f"types {stypes} vs {dtypes}"
        return res
    order = [dcols.index(c) for c in cols]
    drows = [tuple(r[i] for i in order) for r in drows]
    a, b = rows_key(srows), rows_key(drows)
    res["ok"] = a == b
    if not res["ok"]:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        res["spark_only"] = sorted(sa - sb)[:2]
        res["oracle_only"] = sorted(sb - sa)[:2]
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tunemill.session import get_session
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]")
    con = duck(data_dir)
    qs, sq = E.queries(), E.oracle_sql()
    for n in names or list(qs):
        if n not in sq:
            df = qs[n](spark, data_dir)
            print({"name": n, "rows_only": df.count()}, flush=True)
            continue
        try:
            r = compare(spark, con, n, qs[n], sq[n], data_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "ok": False, "error": repr(e)[:600]}
        print(r, flush=True)
