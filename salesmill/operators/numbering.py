"""Row numbers over a whole table without moving it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmill.sources.scratch import scratch_dir

#: Spark numbers the rows of a partition in the low bits of its increasing ids.
_PLACE_BITS = 33


def row_numbers(
    df: DataFrame, order: Sequence[Column], ascending: str = "rn_asc", descending: str = "rn_desc"
) -> DataFrame:
    """``df`` with each row's number in the given order, and in the reverse order.

    The reverse of an order also reverses where nulls go and what breaks ties, so both numbers come
    from one sort: ``asc_nulls_last`` becomes ``desc_nulls_first``. Rows are dealt to range
    partitions and sorted there; ties in ``order`` are dealt on by a hash of the whole row, so a
    key that holds many rows takes many partitions. The sorted rows are written to the shared folder
    with their place, and the sizes of the partitions before are added to it: a window over as many
    rows as there are partitions. An empty table gives no rows.
    """
    spark = df.sparkSession
    columns = df.columns
    ties = F.xxhash64(*(F.col("`" + c.replace("`", "``") + "`") for c in columns))
    ranged = df.repartitionByRange(*order, ties).sortWithinPartitions(*order, ties)
    path = scratch_dir(spark, "row_numbers")
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).select(
        *columns,
        F.shiftright("_at", _PLACE_BITS).alias("_part"),
        (F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1) + 1).alias("_place"),
    )
    # One row per partition.
    sizes = placed.groupBy("_part").agg(F.max("_place").alias("size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "_part",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_before"),
        F.sum("size").over(Window.partitionBy()).alias("_rows"),
    )
    number = F.col("_before") + F.col("_place")
    return placed.join(F.broadcast(sizes), "_part").select(
        *columns, number.alias(ascending), (F.col("_rows") + 1 - number).alias(descending)
    )
