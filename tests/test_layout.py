"""Aggregation below the join, bucketed tables, partitions that are replaced, and published runs."""

import os
import re

import pytest

from __spark_entry__ import queries
from helpers import collect, csv_row, final_plan, write_raw_csv
from salesmill.plans.build import run
from salesmill.plans.kpi import (
    COUNTRIES,
    KPIS,
    MONTHLY,
    PRIORITIES,
    fact_columns,
    kpi_below_join,
    kpi_table,
    order_level_columns,
)
from salesmill.sources.bucketed import bucket_count, write_bucketed
from salesmill.sources.sinks import (
    mart_tables,
    publish_run,
    publish_steps,
    replace_partitions,
    write_parquet,
)
from salesmill.sources.star import line_facts, order_facts, sales_fact


def below(spark, sf_dir, kpi):
    of_lines, of_orders = order_level_columns(kpi)
    lines, orders = line_facts(spark, sf_dir, of_lines), order_facts(spark, sf_dir, of_orders)
    return kpi_below_join(lines, orders, kpi, "l_orderkey", "o_orderkey")


def executed(plan):
    return plan.split("== Initial Plan")[0]


@pytest.mark.parametrize("kpi", [MONTHLY, COUNTRIES, PRIORITIES])
def test_lines_are_summed_before_they_meet_the_orders(spark, sf_dir, conf, kpi):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    df = below(spark, sf_dir, kpi)
    plan = df._jdf.queryExecution().executedPlan().toString()
    join = plan.index("o_orderkey", plan.index("SortMergeJoin [l_orderkey"))
    # Below that join the lines are aggregated in each task, shuffled once, and not again to join.
    lines = plan[join : plan.index("lineitem")]
    assert re.search(r"HashAggregate\(keys=\[l_orderkey#\d+L\], functions=\[partial_", lines)
    assert lines.count("Exchange hashpartitioning(l_orderkey") == 1
    above = final_plan(kpi_table(sales_fact(spark, sf_dir, fact_columns(kpi)), kpi))
    assert "partial_" not in above[above.index("o_orderkey", above.index("SortMergeJoin [l_orderkey")) :].split("lineitem")[0]


def test_lines_without_an_order_count_under_a_null_key(spark):
    lines = spark.createDataFrame(
        [(1, 2.0, 1.0, 50.0), (1, 3.0, 1.0, None), (2, 4.0, 2.0, 50.0), (None, 8.0, 1.0, 12.5)],
        "k long, total_revenue double, total_profit double, profit_margin_pct double",
    )
    orders = spark.createDataFrame([(1, "A")], "o long, order_priority string")
    found = kpi_below_join(lines, orders, PRIORITIES, "k", "o")
    assert collect(found) == [(None, 2, 12.0, 3.0), ("A", 2, 5.0, 2.0)]
    assert collect(kpi_below_join(lines.limit(0), orders, PRIORITIES, "k", "o")) == []


def test_a_hot_order_is_one_row_at_the_join(spark):
    lines = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 0, id) AS k", "1.0D AS total_revenue", "0.5D AS total_profit"
    )
    orders = spark.range(30_000).selectExpr("id AS o", "cast(id % 2 AS string) AS order_priority")
    found = collect(kpi_below_join(lines, orders, PRIORITIES, "k", "o"))
    assert found == [("0", 20_000, 20_000.0, 10_000.0), ("1", 10_000, 10_000.0, 5_000.0)]


def test_bucketed_tables_are_joined_where_they_lie(spark, sf_dir, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    of_lines, of_orders = order_level_columns(MONTHLY)
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}'")
    assert bucket_count(spark.read.parquet(f"{sf_dir}/lineitem.parquet")) == 8
    assert bucket_count(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), 5000) > 20
    for name, df, key in (
        ("lines", line_facts(spark, sf_dir, of_lines), "l_orderkey"),
        ("orders", order_facts(spark, sf_dir, of_orders), "o_orderkey"),
    ):
        write_bucketed(df, f"bucketed.{name}", key, 4, f"{tmp_path}/{name}")
        files = [f for f in os.listdir(tmp_path / name) if f.endswith(".parquet")]
        assert len(files) == 4  # one a bucket
    tables = spark.table("bucketed.lines"), spark.table("bucketed.orders")
    df = kpi_below_join(*tables, MONTHLY, "l_orderkey", "o_orderkey")
    plan = executed(final_plan(df))
    # Two shuffles are left: to the months, and to sort them.
    assert plan.count("Exchange ") == 2 and "l_orderkey" not in "".join(re.findall(r"Exchange [^\n]*", plan))
    assert collect(df) == collect(below(spark, sf_dir, MONTHLY))
    spark.sql("DROP DATABASE bucketed CASCADE")


def test_replaced_partitions_leave_others_alone(spark, sf_dir, tmp_path):
    path = str(tmp_path / "fact")
    fact = sales_fact(spark, sf_dir, ["order_id", "order_year", "units_sold"])
    write_parquet(fact, path, partition_by="order_year")

    def files():
        return {p.parent.name: {q.name for q in p.parent.glob("*.parquet")}
                for p in (tmp_path / "fact").glob("*/*.parquet")}

    before = files()
    replace_partitions(fact.where("order_year = 1996").selectExpr("order_id", "order_year", "0 AS units_sold"), path, "order_year")
    after = files()
    assert {y for y in before if before[y] != after[y]} == {"order_year=1996"}
    replace_partitions(fact.limit(0), path, "order_year")
    assert files() == after
    year = spark.read.schema(fact.schema).parquet(path).where("order_year = 1996")
    assert year.agg({"units_sold": "sum"}).first()[0] == 0
    assert re.search(r"PartitionFilters: \[[^\]]*order_year[^\]]*1996", final_plan(year))
    assert year.count() == fact.where("order_year = 1996").count()


def test_partition_query_reads_two_years(spark, sf_dir):
    plan = final_plan(queries()["partition_overwrite"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[[^\]]*order_year[^\]]*(1996,1997|1996, 1997)", plan)


def test_a_reader_between_any_two_steps_sees_one_run(spark, tmp_path):
    for n in (1, 2, 3):
        path = write_raw_csv(tmp_path / f"s{n}.csv", [csv_row()] * n)
        run(spark, path, str(tmp_path / f"it's {n}"))

    def seen():
        """The number of rows that each table of the published run speaks of."""
        tables = mart_tables(spark, "kpi_runs")
        counts = [tables[k].first()["rows" if k == "summary" else "orders"]
                  for k in ("summary", "channel_kpi", "item_kpi", "priority_kpi")]
        counts += [tables[k].first()[r] / 25 for k, r in (("monthly_kpi", "monthly_revenue"), ("top_countries", "revenue"))]
        return set(counts)

    publish_run(spark, str(tmp_path / "it's 1"), "one's", "kpi_runs", str(tmp_path / "db"))
    assert seen() == {1}
    steps = publish_steps(spark, str(tmp_path / "it's 2"), "two", "kpi_runs")
    states = [seen() for _ in steps]
    assert states == [{1}] * (len(states) - 1) + [{2}] and len(states) == 3 * len(KPIS) + 1
    # A run that fails half way is never seen, and does not stop the next.
    broken = publish_steps(spark, str(tmp_path / "it's 3"), "broken", "kpi_runs")
    for _ in range(5):
        next(broken)
    assert seen() == {2}
    publish_run(spark, str(tmp_path / "it's 3"), "three", "kpi_runs")
    assert seen() == {3}
    spark.sql("DROP DATABASE kpi_runs CASCADE")
