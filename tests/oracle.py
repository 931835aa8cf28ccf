"""Compare registered queries with their SQL in DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (pd.Timestamp, np.datetime64)):
        return str(pd.Timestamp(v).tz_localize(None) if pd.Timestamp(v).tzinfo else pd.Timestamp(v))
    if isinstance(v, (float, np.floating)):
        return float(f"{v:.9g}")
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    return int(v) if isinstance(v, (int, np.integer)) else str(v)


def bag(frame: pd.DataFrame) -> Counter:
    return Counter(tuple(map(_cell, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for f in Path(folder).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def differs(spark, query, sql: str, folder: str) -> str | None:
    ours, theirs = query(spark, folder).toPandas(), connect(folder).sql(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    a, b = bag(ours), bag(theirs)
    return None if a == b else f"only here {list((a - b).items())[:3]}, only in SQL {list((b - a).items())[:3]}"
