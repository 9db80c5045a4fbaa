"""Column names and types of the raw sales file, the cleaned fact and the KPI tables."""

from __future__ import annotations

from pyspark.sql import types as T

#: Twenty digits before the point hold any amount that a double holds to the unit; a sum has ten more.
MONEY = T.DecimalType(28, 8)

# Raw header, cleaned name, type.
SALES_COLUMNS: list[tuple[str, str, T.DataType]] = [
    ("Region", "region", T.StringType()),
    ("Country", "country", T.StringType()),
    ("Item Type", "item_type", T.StringType()),
    ("Sales Channel", "sales_channel", T.StringType()),
    ("Order Priority", "order_priority", T.StringType()),
    ("Order Date", "order_date", T.StringType()),
    ("Order ID", "order_id", T.LongType()),
    ("Ship Date", "ship_date", T.StringType()),
    ("Units Sold", "units_sold", T.LongType()),
    ("Unit Price", "unit_price", MONEY),
    ("Unit Cost", "unit_cost", MONEY),
    ("Total Revenue", "total_revenue", MONEY),
    ("Total Cost", "total_cost", MONEY),
    ("Total Profit", "total_profit", MONEY),
]

# Fixed value: how the raw file writes dates.
DATE_FORMAT = "M/d/yyyy"

# Texts of a raw field that a profile of the raw file counts as null.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

RENAME = {header: name for header, name, _ in SALES_COLUMNS}
RAW_TYPES = {header: dtype for header, _, dtype in SALES_COLUMNS}
CLEAN_TYPES = {name: dtype for _, name, dtype in SALES_COLUMNS}
DATE_COLUMNS = ("order_date", "ship_date")

CLEANED_SCHEMA = T.StructType(
    [
        T.StructField(name, T.DateType() if name in DATE_COLUMNS else dtype)
        for _, name, dtype in SALES_COLUMNS
    ]
    + [
        T.StructField("order_year", T.IntegerType()),
        T.StructField("order_month", T.IntegerType()),
        T.StructField("order_year_month", T.StringType()),
        T.StructField("profit_margin_pct", T.DoubleType()),
    ]
)
