"""Each row's share of a table-wide total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.functions import percent_of


def share_of_total(df: DataFrame, measure: str, output: str) -> DataFrame:
    """Add ``output``, the row's percentage of the sum of ``measure`` over all rows.

    The total is a scalar subquery (one row), so rows keep their partitions; a window over
    the whole table would move every row into one task. Where ``df`` is itself an aggregate,
    Spark reuses its shuffle for the subquery and the input is read once.
    """
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(output, percent_of(F.col(measure), total))
