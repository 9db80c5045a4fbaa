from salesmill.functions.columns import (
    margin_pct,
    parse_sales_date,
    percent_of,
    plain_number,
    sales_date_text,
)

__all__ = [
    "margin_pct",
    "parse_sales_date",
    "percent_of",
    "plain_number",
    "sales_date_text",
]
