"""Comparing a registered query with its SQL on the same parquet files."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, values as text that both engines agree on."""
    frame = frame[sorted(frame.columns)]
    text = pd.DataFrame({name: [_text(value) for value in frame[name]] for name in frame.columns})
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _text(value: object) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "<null>"
    if isinstance(value, float):
        return repr(round(value, 6))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def spark_frame(df: DataFrame) -> pd.DataFrame:
    return pd.DataFrame([tuple(row) for row in df.collect()], columns=df.columns, dtype=object)


def oracle_frame(connection: duckdb.DuckDBPyConnection, sql: str) -> pd.DataFrame:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return pd.DataFrame(cursor.fetchall(), columns=names, dtype=object)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, in words; None when nothing does."""
    mine, theirs = canonical(spark_frame(df)), canonical(oracle_frame(connection, sql))
    if list(mine.columns) != list(theirs.columns):
        return f"columns {list(mine.columns)} against {list(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    unequal = (mine != theirs).any(axis=1)
    if unequal.any():
        return f"{int(unequal.sum())} rows differ, first:\n{mine[unequal].head(2)}\n{theirs[unequal].head(2)}"
    return None
