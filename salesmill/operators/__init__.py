from salesmill.operators.growth import first_last_growth
from salesmill.operators.numbering import row_numbers
from salesmill.operators.profile import (
    column_list,
    column_profile,
    first_rows,
    null_counts,
    null_dates,
    sample,
    shape,
    top_nulls,
)
from salesmill.operators.ranking import by_measure, top_k
from salesmill.operators.share import share_of_total

__all__ = [
    "by_measure",
    "column_list",
    "column_profile",
    "first_last_growth",
    "first_rows",
    "null_counts",
    "null_dates",
    "row_numbers",
    "sample",
    "shape",
    "share_of_total",
    "top_k",
    "top_nulls",
]
