"""Profile and quality jobs; each reads the table at most once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
    )


def column_profile(df: DataFrame, null_texts: Sequence[str] = ()) -> DataFrame:
    """One row per column: position, name, nulls, and the number of rows, from one scan.

    Fields of text columns that equal one of ``null_texts``, to the letter, count as nulls too.
    """

    def present(field: T.StructField) -> Column:
        column = _quoted(field.name)
        if not null_texts or not isinstance(field.dataType, T.StringType):
            return column
        return F.when(~column.isin(*null_texts), column)

    # count(*) - count(c) rather than a conditional count: a Parquet reader that pushes
    # aggregates down can answer it from the file footers.
    one_row = df.agg(
        F.count("*").alias("row_count"),
        *[(F.count("*") - F.count(present(f))).alias(f"{i}") for i, f in enumerate(df.schema, 1)],
    )
    nulls = one_row.unpivot(
        ["row_count"], [f"{i}" for i in range(1, len(df.columns) + 1)], "position", "nulls"
    )
    position = F.col("position").cast("int")
    names = F.array(*[F.lit(c) for c in df.columns])
    return nulls.select(
        position.alias("position"),
        F.element_at(names, position).alias("column_name"),
        "nulls",
        "row_count",
    )


def column_list(df: DataFrame, null_texts: Sequence[str] = ()) -> DataFrame:
    """One row per column in schema order, with the column's null count."""
    return column_profile(df, null_texts).select("position", "column_name", "nulls")


def null_counts(df: DataFrame, k: int = 10, null_texts: Sequence[str] = ()) -> DataFrame:
    """The k columns with the most nulls."""
    return top_nulls(column_profile(df, null_texts), k)


def top_nulls(profile: DataFrame, k: int = 10) -> DataFrame:
    return (
        profile.select("column_name", "nulls")
        .orderBy(F.desc("nulls"), F.asc("column_name"))
        .limit(k)
    )


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def sample(df: DataFrame, n: int = 3, order: Sequence[Column | str] = ()) -> DataFrame:
    """The first n rows: in the given order, or as Spark meets them when none is given."""
    if order:
        df = df.orderBy(*[_quoted(c) if isinstance(c, str) else c for c in order])
    return df.limit(n)


def first_rows(files: DataFrame, n: int = 3) -> DataFrame:
    """The first n rows of a frame as read from files, in file order; files by their path.

    A block of a file is read by one task from its start on, so rows are in order by path, start
    of the block, and the order in which the task meets them. Each task keeps n rows: nothing is
    sorted as a whole. ``files`` is what a reader returned, before any other step.
    """
    order = ["_path", "_start", "_place"]
    placed = files.select(
        *(_quoted(c) for c in files.columns),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"),
    )
    return placed.orderBy(*order).limit(n).drop(*order)


def null_dates(fact: DataFrame) -> DataFrame:
    """Rows without a valid order date and without a valid ship date, in one scan."""
    return fact.agg(
        F.count_if(F.col("order_date").isNull()).alias("null_order_dates"),
        F.count_if(F.col("ship_date").isNull()).alias("null_ship_dates"),
    )
