"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's gate).

Both results become pandas frames; columns are sorted by name, values are
normalised (timestamps, decimals, NaN) and rows sorted, then compared.
"""

from __future__ import annotations

import decimal
import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    try:
        import numpy as np
        if isinstance(v, np.generic):
            v = v.item()
    except ImportError:  # pragma: no cover
        pass
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return None if math.isnan(f) else round(f, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_pdf = pd.DataFrame([r.asDict() for r in spark_df.collect()], columns=spark_df.columns)
    d_pdf = con.sql(sql).df()
    if sorted(s_pdf.columns) != sorted(d_pdf.columns):
        return False, f"columns differ: {sorted(s_pdf.columns)} vs {sorted(d_pdf.columns)}"
    if len(s_pdf) != len(d_pdf):
        return False, f"row counts differ: spark {len(s_pdf)} vs duckdb {len(d_pdf)}"
    a, b = rows_of(s_pdf), rows_of(d_pdf)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if x != y:
            return False, f"first difference at sorted row {i}: spark {x} vs duckdb {y}"
    return True, f"{len(a)} rows match"
