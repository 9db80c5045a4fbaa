import os
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import salesmill.__main__ as cli
from golden import CSV, golden  # noqa: F401
from helpers import collect, csv_row, write_raw_csv
from salesmill.plans.kpi import KPIS, kpi_table
from salesmill.plans.clean import clean
from salesmill.plans.build import run
from salesmill.sources.sales_csv import read_sales_csv
from salesmill.sources.scratch import scratch_dir
from salesmill.sources.sinks import (
    mart_tables,
    read_csv,
    read_tables_parquet,
    write_csv,
    write_parquet,
    write_tables_csv,
    write_tables_parquet,
)
from salesmill.sources.star import raw_sales, sales_fact


def _files(path, suffix):
    return sorted(p for p in Path(path).rglob(f"*{suffix}") if not p.name.startswith("."))


def test_csv_text_is_the_published_text(spark, golden, tmp_path):  # noqa: F811
    write_tables_csv(golden, str(tmp_path))
    for name, text in CSV.items():
        file = tmp_path / "csv" / f"{name}.csv"
        assert file.read_text(encoding="utf-8") == text


def test_tables_round_trip(spark, sf_dir, tmp_path):
    fact = sales_fact(spark, sf_dir)
    tables = {name: kpi_table(fact, kpi) for name, kpi in KPIS.items()}
    write_tables_parquet(tables, str(tmp_path))
    write_tables_csv(tables, str(tmp_path))
    parquet = read_tables_parquet(spark, str(tmp_path))
    for name, table in tables.items():
        csv = read_csv(spark, f"{tmp_path}/csv/{name}.csv", table.schema)
        assert csv.schema.simpleString() == table.schema.simpleString()
        expected = sorted(collect(table))
        assert sorted(collect(parquet[name])) == expected
        assert sorted(collect(csv)) == expected


def test_writing_again_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    for values in ([1, 2], [3]):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        write_parquet(df, path)
        write_csv(df, f"{path}_csv")
    assert collect(spark.read.parquet(path)) == [(3,)]
    assert collect(spark.read.csv(f"{path}_csv", header=True)) == [("3",)]


def test_partitioned_fact(spark, sf_dir, tmp_path):
    fact = sales_fact(spark, sf_dir)
    path = str(tmp_path / "fact")
    write_parquet(fact, path, partition_by="order_year")
    back = spark.read.schema(fact.schema).parquet(path)
    assert sorted(collect(back.select(fact.columns))) == sorted(collect(fact))
    years = [p for p in Path(path).iterdir() if p.is_dir()]
    # Few files per year, however many tasks read the input.
    assert len(_files(path, ".parquet")) <= 2 * len(years)


def test_hot_partition_is_written_by_several_tasks(spark, sf_dir, tmp_path, conf):
    # Splitting goes by the blocks that different tasks wrote, so the input has many files.
    source, path = str(tmp_path / "source"), str(tmp_path / "fact")
    hot_year = F.when(F.col("units_sold") > 2, 2000).otherwise(F.col("order_year"))
    sales_fact(spark, sf_dir).withColumn("order_year", hot_year).repartition(16).write.parquet(source)
    conf("spark.sql.files.maxPartitionBytes", "50KB")
    conf("spark.sql.files.openCostInBytes", "0")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    fact = spark.read.parquet(source)
    write_parquet(fact, path, partition_by="order_year")
    assert len(_files(f"{path}/order_year=2000", ".parquet")) > 2
    assert spark.read.parquet(path).count() == fact.count()


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and second.startswith(shared) and first != second


def test_a_cluster_must_name_its_shared_folder():
    def session(master, **settings):
        conf = SimpleNamespace(get=lambda name, default: settings.get("shared", default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert "salesmill-" in scratch_dir(session("local[2]"), "x")
    assert scratch_dir(session("yarn", shared="hdfs://n/c/"), "x").startswith("hdfs://n/c/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"), "x")


def test_run(spark, sf_dir, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_csv(raw_sales(spark, sf_dir), raw)
    results = run(spark, raw, out, csv=True, database="kpi_run")
    fact = sales_fact(spark, sf_dir)
    assert sorted(collect(results["cleaned"])) == sorted(collect(fact))
    assert collect(results["null_dates"]) == [(0, 0)]
    parquet, saved = read_tables_parquet(spark, out), mart_tables(spark, "kpi_run")
    for name, kpi in KPIS.items():
        expected = collect(kpi_table(fact, kpi))
        assert collect(results[name]) == expected
        assert sorted(collect(parquet[name])) == sorted(expected)
        assert sorted(collect(saved[name])) == sorted(expected)
        assert Path(f"{out}/csv/{name}.csv").is_file()


def test_publishing_again_replaces(spark, tmp_path):
    for country in ("Japan", "Chile"):
        path = write_raw_csv(tmp_path / f"{country}.csv", [csv_row(Country=country)])
        run(spark, path, os.path.relpath(tmp_path / "out"), database="kpi_again")
        found = collect(spark.sql("SELECT country, revenue FROM kpi_again.top_countries"))
        assert found == [(country, 25.0)]


@pytest.mark.parametrize("partition_by", [None, "order_year_month"])
def test_run_with_undated_rows(spark, tmp_path, partition_by):
    rows = [csv_row(), csv_row(Order_Date="2/30/2010"), csv_row(Ship_Date="")]
    path = write_raw_csv(tmp_path / "s.csv", rows)
    results = run(spark, path, str(tmp_path / "out"), partition_by=partition_by)
    assert collect(results["null_dates"]) == [(1, 1)]
    expected = clean(read_sales_csv(spark, path))
    found = results["cleaned"].select(expected.columns)
    assert sorted(collect(found), key=repr) == sorted(collect(expected), key=repr)
    assert [r[0] for r in collect(results["monthly_kpi"])] == [None, "2010-01"]


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    path = write_raw_csv(tmp_path / "s.csv", [csv_row(), csv_row(Country="Chile", Region="")])
    out = str(tmp_path / "out")
    monkeypatch.setattr(sys, "argv", ["salesmill", path, out, "--csv"])
    cli.main()
    text = capsys.readouterr().out
    assert all(name in text for name in KPIS)
    assert "Chile" in text and "null_order_dates" in text
    monkeypatch.setattr(sys, "argv", ["salesmill", path, "--profile"])
    cli.main()
    text = capsys.readouterr().out
    assert all(word in text for word in ("row_count", "Order Priority", "2.50"))
