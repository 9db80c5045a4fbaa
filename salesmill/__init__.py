"""Sales KPI analytics on Spark: clean flat sales records, build KPI tables, query them."""

from salesmill.plans.clean import clean
from salesmill.plans.kpi import KPIS, kpi_table, one_pass, tables_from_one_pass
from salesmill.plans.build import run
from salesmill.sources.sales_csv import read_sales_csv

__all__ = [
    "KPIS",
    "clean",
    "kpi_table",
    "one_pass",
    "read_sales_csv",
    "run",
    "tables_from_one_pass",
]
