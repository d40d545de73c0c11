"""Compares a query's rows with those of its SQL twin in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

SF_DIR = "/root/testdata/sf0.001"


def rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or value is pd.NA or value is pd.NaT or isinstance(value, float) and value != value:
            return None
        if hasattr(value, "item"):
            value = value.item()
        return int(value) if isinstance(value, float) and value.is_integer() else round(value, 9) if isinstance(value, float) else value

    return sorted((tuple(plain(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False)), key=str)


def assert_equal(spark, query, sql: str) -> None:
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    got, want = query(spark, SF_DIR).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    for one, other in zip(rows(got), rows(want), strict=True):
        assert one == other
