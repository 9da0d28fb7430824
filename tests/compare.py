"""Comparison of rows from Spark and DuckDB, whatever their order."""

import decimal

import pandas as pd


def norm(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6) if abs(v) < 2**53 else int(v)
    return str(v)


def rows(frame, columns):
    return sorted(map(repr, (tuple(norm(x) for x in r) for r in frame[columns].astype(object).itertuples(index=False))))


def same(spark_frame, duck_frame):
    columns = sorted(spark_frame.columns)
    assert columns == sorted(duck_frame.columns)
    assert rows(spark_frame, columns) == rows(duck_frame, columns)
