"""Growth of a measure from the first to the last key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.functions import percent_of


def first_last_growth(
    df: DataFrame, key: str, measure: str, key_label: str, measure_label: str
) -> DataFrame:
    """One row: first and last key, their measures, and the growth in percent.

    A null key counts as the largest (PostgreSQL's order), so an undated row becomes the
    last one. The smallest and the largest (key, measure) are found in one aggregate with
    partial results per task, without ranking the rows in a single partition.
    """
    entry = F.struct(
        F.col(key).isNull().alias("unkeyed"),
        F.col(key).alias("key"),
        F.col(measure).alias("measure"),
    )
    ends = df.agg(F.min(entry).alias("first"), F.max(entry).alias("last"))
    first, last = F.col("first.measure"), F.col("last.measure")
    return ends.select(
        F.col("first.key").alias(f"first_{key_label}"),
        first.alias(f"first_{measure_label}"),
        F.col("last.key").alias(f"last_{key_label}"),
        last.alias(f"last_{measure_label}"),
        percent_of(last - first, first).alias(f"{measure_label}_growth_pct"),
    )
