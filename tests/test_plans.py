"""The physical plans: what is read, shuffled and sorted."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from helpers import collect, final_plan
from salesmill.operators import share_of_total
from salesmill.plans.clean import clean
from salesmill.plans.kpi import (
    CHANNELS,
    COUNTRIES,
    ITEMS,
    KPIS,
    PRIORITIES,
    fact_columns,
    kpi_table,
    one_pass,
    one_pass_columns,
)
from salesmill.plans.mart import query_columns, query_fact
from salesmill.sources.star import raw_sales, sales_fact


def _kpi_plan(spark, sf_dir, kpi):
    return final_plan(kpi_table(sales_fact(spark, sf_dir, fact_columns(kpi)), kpi))


def _read_columns(plan, table):
    """Columns of each scan of a table, by its Parquet name."""
    scans = re.findall(rf"FileScan parquet \[([^\]]*)\][^\n]*{table}\.parquet", plan)
    return [set(re.findall(r"(\w+)#", scan)) for scan in scans]


@pytest.mark.parametrize("kpi", [COUNTRIES, ITEMS])
def test_top_ten_needs_no_full_sort(spark, sf_dir, kpi):
    plan = _kpi_plan(spark, sf_dir, kpi)
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("kpi", KPIS.values())
def test_aggregates_before_the_shuffle_in_generated_code(spark, sf_dir, kpi):
    plan = _kpi_plan(spark, sf_dir, kpi)
    assert "partial_sum" in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("name", ["q03_channel_revenue_share", "q12_growth_first_last"])
def test_no_window_over_one_partition(spark, sf_dir, name):
    plan = final_plan(query_fact(name, sales_fact(spark, sf_dir, query_columns(name))))
    assert "Window" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_share_reuses_the_shuffle_of_its_table(spark, sf_dir):
    channels = kpi_table(sales_fact(spark, sf_dir), CHANNELS, ["revenue"], ordered=False)
    assert "ReusedExchange" in final_plan(share_of_total(channels, "revenue", "share"))


def test_lookups_that_no_column_needs_are_not_joined(spark, sf_dir):
    name = "q03_channel_revenue_share"
    plan = final_plan(query_fact(name, sales_fact(spark, sf_dir, query_columns(name))))
    assert "Join" not in plan
    for columns in _read_columns(plan, "lineitem"):
        assert columns == {"l_extendedprice", "l_discount", "l_linestatus"}
    plan = _kpi_plan(spark, sf_dir, PRIORITIES)
    assert _read_columns(plan, "orders")
    for columns in _read_columns(plan, "orders"):
        assert columns == {"o_orderkey", "o_orderpriority"}
    assert _read_columns(plan, "customer") == []


def test_one_pass_reads_the_lines_once(spark, sf_dir):
    df = one_pass(sales_fact(spark, sf_dir, one_pass_columns()))
    initial = df._jdf.queryExecution().sparkPlan().toString()
    assert len(_read_columns(initial, "lineitem")) == 1
    assert _read_columns(initial, "region") == []
    assert initial.count("Expand") == 1


def test_cleaning_does_not_shuffle(spark, sf_dir):
    columns = ["Order ID", "Ship Date", "Units Sold", "Sales Channel"]
    raw = raw_sales(spark, sf_dir, columns + ["Total Revenue"])
    assert "Exchange" not in final_plan(raw)
    full = raw_sales(spark, sf_dir)
    joins = full._jdf.queryExecution().sparkPlan().toString().count("Join")
    cleaned = clean(full)._jdf.queryExecution().sparkPlan().toString()
    assert cleaned.count("Join") == joins
    assert "Aggregate" not in cleaned and "Sort [" not in cleaned


def test_hot_keys_are_split_in_large_joins(spark, sf_dir, tmp_path, conf):
    """A third of the lines on one part and one order, no side small enough to broadcast."""
    for table in ("orders", "customer", "nation", "region", "part"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    first = lines.select("l_orderkey", "l_partkey").orderBy("l_orderkey", "l_partkey").first()
    copies = lines.crossJoin(spark.range(20).withColumnRenamed("id", "copy"))
    hot = F.col("copy") % 3 == 0
    copies = copies.withColumns(
        {
            name: F.when(hot, value).otherwise(F.col(name))
            for name, value in first.asDict().items()
        }
    ).drop("copy")
    copies.repartition(8).write.parquet(f"{tmp_path}/lineitem.parquet")

    expected = collect(queries()["kpi_item_top10"](spark, str(tmp_path)))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    df = queries()["kpi_item_top10"](spark, str(tmp_path))
    plan = final_plan(df)
    assert "SortMergeJoin(skew=true)" in plan
    assert collect(df) == expected


def test_one_pass_adds_a_row_up_once_for_all_keys_of_few_values(spark, sf_dir):
    df = one_pass(sales_fact(spark, sf_dir, one_pass_columns()))
    (expand,) = (
        line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Expand" in line
    )
    # Months, channels and priorities together, countries, items; the last bracket names the columns.
    assert expand.split("Expand ")[1].split("]], [")[0].count("[") - 1 == 3
