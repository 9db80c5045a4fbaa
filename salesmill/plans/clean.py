"""Raw sales rows to the cleaned fact: names, types, dates, calendar and margin columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.functions import margin_pct, parse_sales_date
from salesmill.schema import CLEAN_TYPES, DATE_COLUMNS, RENAME


def normalize_columns(raw: DataFrame) -> DataFrame:
    """Snake-case names and fixed types; unknown columns pass through unchanged.

    The casts matter only for a frame read with inference: under an explicit schema the
    types are already these. Dates are left to ``parse_dates``.
    """
    renamed = raw.withColumnsRenamed(RENAME)
    fixed = {name: dtype for name, dtype in CLEAN_TYPES.items() if name not in DATE_COLUMNS}
    casts = {
        field.name: F.col(field.name).try_cast(fixed[field.name])
        for field in renamed.schema
        if field.dataType != fixed.get(field.name, field.dataType)
    }
    return renamed.withColumns(casts) if casts else renamed


def parse_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({name: parse_sales_date(F.col(name)) for name in DATE_COLUMNS})


def add_time_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
            "order_year_month": F.date_format("order_date", "yyyy-MM"),
        }
    )


def add_profit_margin(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "profit_margin_pct", margin_pct(F.col("total_profit"), F.col("total_revenue"))
    )


def clean(raw: DataFrame) -> DataFrame:
    """The cleaned fact. No shuffle: every step is a projection of the scan."""
    return add_profit_margin(add_time_features(parse_dates(normalize_columns(raw))))
