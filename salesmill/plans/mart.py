"""Analytical queries over the KPI tables.

Rankings put a null measure first and a null key last, the order of the PostgreSQL mart
these queries are meant for.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from salesmill.operators import by_measure, first_last_growth, share_of_total, top_k
from salesmill.plans.kpi import (
    CHANNELS,
    COUNTRIES,
    ITEMS,
    MONTHLY,
    PRIORITIES,
    SUMMARY,
    Kpi,
    fact_columns,
    kpi_table,
)


@dataclass(frozen=True)
class MartQuery:
    """A query, the table it reads and, where not all, the columns of it."""

    kpi: Kpi
    run: Callable[[DataFrame], DataFrame]
    columns: tuple[str, ...] | None = None


def _best(kpi: Kpi, measure: str) -> MartQuery:
    return MartQuery(kpi, lambda table: top_k(table, measure, kpi.key, 1, nulls_first=True))


def _ranking(kpi: Kpi, measure: str, *columns: str) -> MartQuery:
    def run(table: DataFrame) -> DataFrame:
        ranked = table.orderBy(*by_measure(measure, kpi.key, nulls_first=True))
        return ranked.select(*columns) if columns else ranked

    return MartQuery(kpi, run, columns or None)


def _share(kpi: Kpi, measure: str, ordered: bool = True) -> MartQuery:
    def run(table: DataFrame) -> DataFrame:
        pair = table.select(kpi.key, measure)
        shares = share_of_total(pair, measure, f"{measure}_share_pct")
        if not ordered:
            return shares
        return shares.orderBy(*by_measure(measure, kpi.key, nulls_first=True))

    return MartQuery(kpi, run, (kpi.key, measure))


def _growth(table: DataFrame) -> DataFrame:
    return first_last_growth(table, "order_year_month", "monthly_revenue", "month", "revenue")


MART_QUERIES: dict[str, MartQuery] = {
    "q01_best_month_revenue": _best(MONTHLY, "monthly_revenue"),
    "q02_best_month_profit": _best(MONTHLY, "monthly_profit"),
    "q03_channel_revenue_share": _share(CHANNELS, "revenue"),
    "q04_channel_profit_share": _share(CHANNELS, "profit"),
    "q05_most_profitable_country": _best(COUNTRIES, "profit"),
    "q06_countries_by_profit": _ranking(COUNTRIES, "profit"),
    "q07_items_by_revenue": _ranking(
        ITEMS, "revenue", "item_type", "revenue", "profit", "avg_profit_margin_pct"
    ),
    "q08_most_profitable_item": _best(ITEMS, "profit"),
    "q09_priority_revenue_share": _share(PRIORITIES, "revenue"),
    "q10_priority_profit_share": _share(PRIORITIES, "profit"),
    "q11_snapshot": MartQuery(SUMMARY, lambda table: table.select(*SUMMARY.measures)),
    "q12_growth_first_last": MartQuery(
        MONTHLY, _growth, ("order_year_month", "monthly_revenue")
    ),
    "q13_share_unordered": _share(CHANNELS, "revenue", ordered=False),
}


def query_tables(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run a query on KPI tables, such as those read from a mart database."""
    query = MART_QUERIES[name]
    return query.run(tables[query.kpi.name])


def query_columns(name: str) -> list[str]:
    """The fact columns that ``query_fact`` reads."""
    query = MART_QUERIES[name]
    return fact_columns(query.kpi, query.columns, ordered=False)


def query_fact(name: str, fact: DataFrame) -> DataFrame:
    """Run a query straight on the fact, aggregating only the columns it needs."""
    query = MART_QUERIES[name]
    return query.run(kpi_table(fact, query.kpi, query.columns, ordered=False))
