"""The KPI tables of the cleaned fact.

Every measure is built from parts that add up exactly (counts and sums of decimals), so a table can
be aggregated from the fact directly (``kpi_table``) or taken out of one shared scan (``one_pass``),
with the same result bit for bit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmill.operators.ranking import by_measure
from salesmill.schema import MONEY


@dataclass(frozen=True)
class Kpi:
    """One table: its key column, its output columns by measure, and its row limit."""

    name: str
    key: str | None
    measures: dict[str, str]
    limit: int | None = None


SUMMARY = Kpi(
    "summary",
    None,
    {
        "rows": "orders",
        "total_revenue": "revenue",
        "total_profit": "profit",
        "avg_profit_margin_pct": "margin",
    },
)
MONTHLY = Kpi(
    "monthly_kpi",
    "order_year_month",
    {
        "monthly_revenue": "revenue",
        "monthly_profit": "profit",
        "avg_profit_margin_pct": "margin",
    },
)
COUNTRIES = Kpi("top_countries", "country", {"revenue": "revenue", "profit": "profit"}, limit=10)
CHANNELS = Kpi(
    "channel_kpi",
    "sales_channel",
    {
        "orders": "orders",
        "revenue": "revenue",
        "profit": "profit",
        "avg_profit_margin_pct": "margin",
    },
)
ITEMS = Kpi(
    "item_kpi",
    "item_type",
    {
        "orders": "orders",
        "units_sold": "units",
        "revenue": "revenue",
        "profit": "profit",
        "avg_profit_margin_pct": "margin",
    },
    limit=10,
)
PRIORITIES = Kpi(
    "priority_kpi",
    "order_priority",
    {"orders": "orders", "revenue": "revenue", "profit": "profit"},
)

KPIS = {k.name: k for k in (SUMMARY, MONTHLY, COUNTRIES, CHANNELS, ITEMS, PRIORITIES)}

# Measure -> the additive parts it is made of.
_MEASURE_PARTS = {
    "orders": ("n",),
    "units": ("units",),
    "revenue": ("revenue",),
    "profit": ("profit",),
    "margin": ("margin_total", "margin_n"),
}
# Part -> the fact column it reads.
_PART_INPUT = {
    "n": None,
    "units": "units_sold",
    "revenue": "total_revenue",
    "profit": "total_profit",
    "margin_total": "profit_margin_pct",
    "margin_n": "profit_margin_pct",
    "null_order_dates": "order_date",
    "null_ship_dates": "ship_date",
}
# Parts summed as decimals -> their type. Margins have two decimals.
_PART_TYPES = {"revenue": MONEY, "profit": MONEY, "margin_total": T.DecimalType(38, 2)}


def _part_value(name: str) -> Column:
    """What a part aggregates, computed once per row."""
    if name == "n":
        return F.lit(1).alias(name)
    value = F.col(_PART_INPUT[name])
    if name in _PART_TYPES:
        value = value.cast(_PART_TYPES[name])
    elif name.startswith("null_"):
        value = value.isNull()
    return value.alias(name)


def _part(name: str) -> Column:
    if name.startswith("null_"):
        part = F.count_if(F.col(name))
    else:
        part = F.sum(name) if name == "units" or name in _PART_TYPES else F.count(name)
    return part.alias(name)


def _measure(name: str) -> Column:
    if name == "margin":
        return F.try_divide(F.col("margin_total").cast("double"), F.col("margin_n"))
    (part,) = _MEASURE_PARTS[name]
    return F.col(part).cast("double") if part in _PART_TYPES else F.col(part)


def _group_column(key: str) -> Column:
    """The value rows are grouped by: months as dates, formatted once per group."""
    return F.trunc("order_date", "MM") if key == "order_year_month" else F.col(key)


def _key_column(key: str) -> Column:
    column = F.col(f"group_{key}")
    if key == "order_year_month":
        column = F.date_format(column, "yyyy-MM")
    return column.alias(key)


def _outputs(kpi: Kpi, columns: Sequence[str] | None) -> list[str]:
    return list(kpi.measures) if columns is None else [c for c in columns if c != kpi.key]


def _rank_column(kpi: Kpi) -> str:
    return next(column for column, measure in kpi.measures.items() if measure == "revenue")


def kpi_order(kpi: Kpi) -> list[Column]:
    """The row order of a table: months ascending, other keys by revenue."""
    if kpi.key is None:
        return []
    return [F.col(kpi.key)] if kpi is MONTHLY else by_measure(_rank_column(kpi), kpi.key)


def _needed(kpi: Kpi, columns: Sequence[str] | None, ordered: bool) -> list[str]:
    """Output columns to compute: those asked for, and revenue where it ranks the rows."""
    outputs = _outputs(kpi, columns)
    ranked = kpi.limit or (ordered and kpi not in (SUMMARY, MONTHLY))
    rank = _rank_column(kpi)
    return outputs + [rank] if ranked and rank not in outputs else outputs


def _parts_of(kpi: Kpi, columns: Sequence[str]) -> list[str]:
    parts = [part for c in columns for part in _MEASURE_PARTS[kpi.measures[c]]]
    return list(dict.fromkeys(parts)) or ["n"]


def fact_columns(
    kpi: Kpi, columns: Sequence[str] | None = None, ordered: bool = True
) -> list[str]:
    """The fact columns that ``kpi_table`` reads for the same arguments."""
    inputs = [_PART_INPUT[part] for part in _parts_of(kpi, _needed(kpi, columns, ordered))]
    if kpi.key:
        inputs.insert(0, "order_date" if kpi is MONTHLY else kpi.key)
    return list(dict.fromkeys(i for i in inputs if i))


def one_pass_columns() -> list[str]:
    """The fact columns that ``one_pass`` reads."""
    columns = [c for kpi in KPIS.values() for c in fact_columns(kpi)]
    return list(dict.fromkeys([*columns, *filter(None, _PART_INPUT.values())]))


def _finish(
    grouped: DataFrame, kpi: Kpi, columns: Sequence[str] | None, ordered: bool
) -> DataFrame:
    """From the parts of each group to the table's columns, order and limit."""
    keys = [_key_column(kpi.key)] if kpi.key else []
    needed = _needed(kpi, columns, ordered)
    table = grouped.select(*keys, *[_measure(kpi.measures[c]).alias(c) for c in needed])
    if kpi.limit or (ordered and kpi.key):
        table = table.orderBy(*kpi_order(kpi))
    if kpi.limit:
        table = table.limit(kpi.limit)
    outputs = _outputs(kpi, columns)
    return table if needed == outputs else table.select(*table.columns[: len(keys)], *outputs)


def kpi_table(
    fact: DataFrame, kpi: Kpi, columns: Sequence[str] | None = None, ordered: bool = True
) -> DataFrame:
    """One KPI table from the fact.

    Each task aggregates its own rows first, so the shuffle carries one row per task and
    key whatever the size or skew of the groups. ``columns`` narrows the output (and so
    the scan); ``ordered=False`` leaves out the sort where the caller ranks by itself.
    """
    parts = _parts_of(kpi, _needed(kpi, columns, ordered))
    keys = [kpi.key] if kpi.key else []
    rows = fact.select(
        *[_group_column(key).alias(f"group_{key}") for key in keys], *map(_part_value, parts)
    )
    grouped = rows.groupBy(*[f"group_{key}" for key in keys]).agg(*map(_part, parts))
    return _finish(grouped, kpi, columns, ordered)


def order_level_columns(kpi: Kpi) -> tuple[list[str], list[str]]:
    """The columns ``kpi_below_join`` needs of lines and of orders, if orders have the key."""
    key = "order_date" if kpi is MONTHLY else kpi.key
    return [c for c in fact_columns(kpi) if c != key], [key]


def kpi_below_join(
    lines: DataFrame, orders: DataFrame, kpi: Kpi, line_key: str, order_key: str
) -> DataFrame:
    """A KPI table whose key is an order's, with the lines summed up before they meet the orders.

    The sums of each order are additive parts, so the table equals the one of the joined fact bit for
    bit. What is shuffled to the orders is one row per task and order instead of every line, and the
    join uses the aggregate's own partitioning. An order that holds very many lines is one row by
    then, so no key is hot. Lines without an order count under a null key. Worth it where orders are
    too many to broadcast; where they fit, ``kpi_table`` over the joined fact shuffles nothing.
    """
    parts = _parts_of(kpi, _needed(kpi, None, True))
    rows = lines.select(line_key, *map(_part_value, parts))
    summed = rows.groupBy(line_key).agg(*map(_part, parts))
    # Fetching the key adds no rows: orders are unique.
    joined = summed.join(orders, F.col(line_key) == F.col(order_key), "left")
    again = joined.select(_group_column(kpi.key).alias(f"group_{kpi.key}"), *parts)
    grouped = again.groupBy(f"group_{kpi.key}").agg(*(F.sum(part).alias(part) for part in parts))
    return _finish(grouped, kpi, None, True)


#: Keys that ``one_pass`` first groups by together: all three have few values, whatever the data.
_FEW = (MONTHLY.key, CHANNELS.key, PRIORITIES.key)


def one_pass(fact: DataFrame) -> DataFrame:
    """The parts of all KPI tables, and the null-date counts, from one scan of the fact.

    The groups number in the hundreds or few thousands, so each task reduces its rows to that many
    before the shuffle. A row is added up once for the keys of ``_FEW`` together and once for each
    other key, not once per table; the tables and the total come from these sums, which are additive.
    Write the result, then read the tables off it with ``tables_from_one_pass``.
    """
    keys = [kpi.key for kpi in KPIS.values() if kpi.key]
    groups = [f"group_{key}" for key in keys]
    rows = fact.select(
        *[_group_column(key).alias(group) for key, group in zip(keys, groups)],
        *map(_part_value, _PART_INPUT),
    )
    sets = [[key for key in keys if key in _FEW], *([key] for key in keys if key not in _FEW)]
    columns = [[F.col(f"group_{key}") for key in own] for own in sets]
    which = F.lit(0)
    for i, own in enumerate(sets[1:], 1):
        which = F.when(F.grouping(f"group_{own[0]}") == 0, i).otherwise(which)
    summed = rows.groupingSets(columns, *groups).agg(which.alias("which"), *map(_part, _PART_INPUT))
    types = {f.name: f.dataType for f in rows.schema}

    def group(key: str | None) -> Column:
        """The group of one table that a sum belongs to; other keys are null."""
        name = next(name for name, kpi in KPIS.items() if kpi.key == key)
        own = (
            (F.col(g) if g == f"group_{key}" else F.lit(None).cast(types[g])).alias(g)
            for g in groups
        )
        return F.struct(F.lit(name).alias("grain"), *own)

    targets = F.array(*map(group, [None, *sets[0]]))
    for i, own in enumerate(sets[1:], 1):
        targets = F.when(F.col("which") == i, F.array(*map(group, own))).otherwise(targets)
    dealt = summed.select(F.explode(targets).alias("target"), *_PART_INPUT)
    dealt = dealt.select("target.*", *_PART_INPUT)
    added = [
        (F.coalesce(F.sum(part), F.lit(0)) if _is_count(part) else F.sum(part)).alias(part)
        for part in _PART_INPUT
    ]
    return dealt.groupBy(*groups, "grain").agg(*added)


def _is_count(part: str) -> bool:
    """Whether a part is a count, which is never null."""
    return part in ("n", "margin_n") or part.startswith("null_")


def _total_parts(parts: DataFrame) -> DataFrame:
    """The grand total, which Spark leaves out of grouping sets over no rows at all."""
    row = parts.filter(F.col("grain") == SUMMARY.name)
    return row.agg(
        *[
            (F.coalesce(F.max(name), F.lit(0)) if _is_count(name) else F.max(name)).alias(name)
            for name in _PART_INPUT
        ]
    )


def tables_from_one_pass(parts: DataFrame, ordered: bool = True) -> dict[str, DataFrame]:
    """Every KPI table out of the rows written from ``one_pass``."""
    return {
        name: _finish(
            parts.filter(F.col("grain") == name) if kpi.key else _total_parts(parts),
            kpi,
            None,
            ordered,
        )
        for name, kpi in KPIS.items()
    }


def one_pass_report(parts: DataFrame) -> DataFrame:
    """All groups of all tables, untruncated, under common column names."""
    keys = [_key_column(kpi.key) for kpi in KPIS.values() if kpi.key]
    return parts.select(
        "grain",
        F.coalesce(*keys).alias("key"),
        *[_measure(name).alias(name) for name in _MEASURE_PARTS],
        "null_order_dates",
        "null_ship_dates",
    )


def null_dates_from_one_pass(parts: DataFrame) -> DataFrame:
    return _total_parts(parts).select("null_order_dates", "null_ship_dates")


def kpi_schema(kpi: Kpi) -> T.StructType:
    """The columns of a table, so that reading one back needs no look into its files."""
    whole = ("orders", "units")
    fields = [T.StructField(kpi.key, T.StringType())] if kpi.key else []
    return T.StructType(
        fields
        + [
            T.StructField(column, T.LongType() if measure in whole else T.DoubleType())
            for column, measure in kpi.measures.items()
        ]
    )
