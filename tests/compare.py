"""Run a named query on Spark and its SQL twin on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def key(row):
    return tuple((x is None, str(type(x)) if x is None else "", str(x)) for x in row)


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=key)


def compare(spark, con, sf, fn, sql):
    df = fn(spark, sf)
    cols, rows = table_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(rows), None
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = [str(d[1]) for d in cur.description]
    ocols, orows = table_of(names, cur.fetchall())
    if cols != ocols:
        return len(rows), f"columns {cols} vs {ocols}"
    if len(rows) != len(orows):
        return len(rows), f"rows {len(rows)} vs {len(orows)}"
    bad = [(a, b) for a, b in zip(rows, orows) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
        return len(rows), f"{len(bad)} rows differ, first: {diff[:4]} in {a}"
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    loose = [f"{n}:{spark_kinds[n]}/{k}" for n, k in zip(names, kinds) if not same_kind(spark_kinds[n], k)]
    return len(rows), f"types {loose}" if loose else None


KINDS = {
    "double": {"DOUBLE"}, "bigint": {"BIGINT"}, "int": {"INTEGER"}, "string": {"VARCHAR"},
    "date": {"DATE"}, "boolean": {"BOOLEAN"}, "timestamp_ntz": {"TIMESTAMP"}, "timestamp": {"TIMESTAMP WITH TIME ZONE"},
}


def same_kind(spark_kind, duck_kind):
    return duck_kind.upper() in KINDS.get(spark_kind, {duck_kind.upper()})


if __name__ == "__main__":
    from tests.sparktest import session

    import __spark_entry__ as entry

    sf = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = session()
    con = connect(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sorted(qs):
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            n, err = compare(spark, con, sf, qs[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            n, err = -1, f"{type(e).__name__}: {str(e)[:600]}"
        failed += err is not None
        tag = "FAIL" if err else ("ok" if name in sqls else "ok (rows only)")
        print(f"{tag:5s} {name} rows={n} {time.time() - t:.2f}s {err or ''}", flush=True)
    print("failed:", failed)
