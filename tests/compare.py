"""Runs a registered query and its SQL on the same tables and compares all rows."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def sql_session(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(df: pd.DataFrame) -> list[tuple]:
    ordered = df[sorted(df.columns)]
    plain = [tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r) for r in ordered.itertuples(index=False)]
    return sorted(plain, key=repr)


def differences(spark_df: pd.DataFrame, sql_df: pd.DataFrame, tolerance: float = 0.0) -> list[str]:
    """Empty if both hold the same rows; floats may differ by ``tolerance``."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"]
    if len(spark_df) != len(sql_df):
        return [f"{len(spark_df)} rows != {len(sql_df)} rows"]
    out = []
    for a, b in zip(_rows(spark_df), _rows(sql_df)):
        for x, y in zip(a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= tolerance)
            if not same or type(x) is not type(y):
                out.append(f"{a} != {b}")
                break
    return out
