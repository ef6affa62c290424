"""Compare a Spark result with a DuckDB SQL result (row count, columns, order-free values)."""

from __future__ import annotations

import math
from collections import Counter

DRIVER_VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_VIEWS:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if digits is None else round(v, digits)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):  # Decimal
        return float(v) if digits is None else round(float(v), digits)
    return v


def rows_of(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i], digits) for i in order) for r in rows]


def compare(spark_df, con, sql: str, digits: int = 9, show: int = 5) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_only_cols"] = sorted(set(s_cols) - set(d_cols))
        out["oracle_only_cols"] = sorted(set(d_cols) - set(s_cols))
        out["match"] = False
        return out
    a = Counter(rows_of(s_cols, s_rows, digits))
    b = Counter(rows_of(d_cols, d_rows, digits))
    out["match"] = a == b
    if a != b:
        out["cols"] = sorted(s_cols)
        out["spark_not_oracle"] = list((a - b).elements())[:show]
        out["oracle_not_spark"] = list((b - a).elements())[:show]
    return out
