"""Spark-vs-DuckDB result comparison (the same check the driver runs).

Both results are normalised to plain Python values (decimals and floats
rounded, dates as ISO text), columns sorted by name, rows sorted, then
compared as multisets.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib

from pyspark.sql import DataFrame


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (decimal.Decimal, float)):
        f = float(v)
        if f != f:
            return "nan"
        r = round(f, 6)
        return int(r) if r == int(r) else r
    if isinstance(v, int):
        return v
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df: DataFrame, sql: str, con) -> dict:
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    res = {
        "spark_rows": len(sr), "duck_rows": len(dr),
        "schema_match": sc == dc, "spark_cols": sc, "duck_cols": dc,
        "values_match": sr == dr,
    }
    if not res["values_match"] and sc == dc:
        ss, ds = set(sr), set(dr)
        res["only_spark"] = list(ss - ds)[:5]
        res["only_duck"] = list(ds - ss)[:5]
    res["hash"] = hashlib.sha1(repr(sr).encode()).hexdigest()[:12]
    res["ok"] = res["schema_match"] and res["values_match"] and res["spark_rows"] == res["duck_rows"]
    return res
