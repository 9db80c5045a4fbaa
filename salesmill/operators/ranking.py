"""Orderings with stated null order and ties, and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_measure(measure: str, key: str, nulls_first: bool = False) -> list[Column]:
    """Largest measure first, equal measures by key.

    ``nulls_first`` ranks a null measure above all others, as PostgreSQL's ``DESC`` does;
    Spark's own ``desc`` ranks it last.
    """
    column = F.col(measure)
    first = column.desc_nulls_first() if nulls_first else column.desc_nulls_last()
    return [first, F.col(key).asc_nulls_last()]


def top_k(df: DataFrame, measure: str, key: str, k: int, nulls_first: bool = False) -> DataFrame:
    """The k rows with the largest measure: each task keeps k rows, no full sort."""
    return df.orderBy(*by_measure(measure, key, nulls_first)).limit(k)
