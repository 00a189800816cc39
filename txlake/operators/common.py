"""Small shared building blocks for operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """Top-``n`` rows by ``order`` (TakeOrderedAndProject); ``n=None`` keeps all rows unsorted."""
    if n is None:
        return df
    return df.orderBy(*order).limit(int(n))
