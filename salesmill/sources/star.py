"""A sales fact assembled from a star schema of order lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.functions import sales_date_text
from salesmill.plans.clean import add_profit_margin, add_time_features
from salesmill.schema import CLEANED_SCHEMA, DATE_COLUMNS, MONEY, RENAME

# Prices have two decimals: products of whole cents and percents are exact, and far cheaper
# than decimals made from doubles, which go through text.
_REVENUE = (
    "cast(rint(l_extendedprice * 100) as bigint) * (100 - cast(rint(l_discount * 100) as bigint))"
)
_COST = "cast(rint(p_retailprice * 100) as bigint) * cast(l_quantity as bigint) * 100"


def _money(units: str) -> str:
    return f"cast(cast({units} as decimal(18,0)) * 0.0001BD as {MONEY.simpleString()})"


# Fact column -> expression over the star schema, and the lookup tables it needs.
_COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "region": ("r_name", ("orders", "customer", "nation", "region")),
    "country": ("n_name", ("orders", "customer", "nation")),
    "item_type": ("p_brand", ("part",)),
    "sales_channel": ("l_linestatus", ()),
    "order_priority": ("o_orderpriority", ("orders",)),
    "order_date": ("cast(o_orderdate as date)", ("orders",)),
    "order_id": ("l_orderkey", ()),
    "ship_date": ("cast(l_shipdate as date)", ()),
    "units_sold": ("cast(l_quantity as bigint)", ()),
    "unit_price": (f"cast(l_extendedprice as {MONEY.simpleString()})", ()),
    "unit_cost": (f"cast(p_retailprice as {MONEY.simpleString()})", ("part",)),
    "total_revenue": (_money(_REVENUE), ()),
    "total_cost": (_money(_COST), ("part",)),
    "total_profit": (_money(f"{_REVENUE} - {_COST}"), ("part",)),
}
_FEATURES = {
    "order_year": ("order_date",),
    "order_month": ("order_date",),
    "order_year_month": ("order_date",),
    "profit_margin_pct": ("total_profit", "total_revenue"),
}


def sales_fact(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The cleaned fact, or the given columns of it, one row per order line.

    Lookups are left joins on primary keys, so they neither drop nor add lines, and those
    no column asks for are left out of the plan: at scale each saves a shuffle of the lines.
    The small lookups are joined to each other first and the lines last. No join is forced
    to broadcast; Spark does so by table size, and adaptive execution splits hot keys in
    the sort-merge joins it uses otherwise.
    """
    wanted = list(columns) if columns is not None else CLEANED_SCHEMA.names
    base = set(wanted) - set(_FEATURES)
    for feature in set(wanted) & set(_FEATURES):
        base.update(_FEATURES[feature])
    lookups = {lookup for name in base for lookup in _COLUMNS[name][1]}

    def read(table: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet")

    def look_up(rows: DataFrame, table: DataFrame, left: str, right: str) -> DataFrame:
        return rows.join(table, F.col(left) == F.col(right), "left")

    lines = read("lineitem")
    if "orders" in lookups:
        orders = read("orders")
        if "customer" in lookups:
            places = read("nation")
            if "region" in lookups:
                places = look_up(places, read("region"), "n_regionkey", "r_regionkey")
            customers = look_up(read("customer"), places, "c_nationkey", "n_nationkey")
            orders = look_up(orders, customers, "o_custkey", "c_custkey")
        lines = look_up(lines, orders, "l_orderkey", "o_orderkey")
    if "part" in lookups:
        lines = look_up(lines, read("part"), "l_partkey", "p_partkey")

    fact = lines.select(
        *[F.expr(expr).alias(name) for name, (expr, _) in _COLUMNS.items() if name in base]
    )
    if {"order_year", "order_month", "order_year_month"} & set(wanted):
        fact = add_time_features(fact)
    if "profit_margin_pct" in wanted:
        fact = add_profit_margin(fact)
    return fact.select(*wanted)


def line_facts(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """``l_orderkey`` and columns of the fact that order lines and their parts have by themselves."""
    return sales_fact(spark, sf_dir, ["order_id", *columns]).withColumnRenamed("order_id", "l_orderkey")


def order_facts(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """``o_orderkey`` and columns of the fact that depend on the order alone."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if {"country", "region"} & set(columns):
        places = spark.read.parquet(f"{sf_dir}/nation.parquet")
        if "region" in columns:
            regions = spark.read.parquet(f"{sf_dir}/region.parquet")
            places = places.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
        customers = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    return orders.select("o_orderkey", *(F.expr(_COLUMNS[c][0]).alias(c) for c in columns))


def raw_sales(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The same lines as a raw file has them: headers with spaces, dates as text."""
    wanted = {h: n for h, n in RENAME.items() if columns is None or h in columns}
    fact = sales_fact(spark, sf_dir, list(wanted.values()))
    texts = {name: sales_date_text(F.col(name)) for name in wanted.values() if name in DATE_COLUMNS}
    return fact.withColumns(texts).withColumnsRenamed({n: h for h, n in wanted.items()})
