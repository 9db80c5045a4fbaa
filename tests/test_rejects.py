"""What does not convert is counted, large amounts are not lost, and text survives the CSV sink."""

from decimal import Decimal

import pytest

from helpers import HEADERS, collect, csv_row, write_raw_csv
from salesmill.plans.build import RejectedFields, run
from salesmill.plans.clean import clean
from salesmill.plans.kpi import CHANNELS, SUMMARY, kpi_schema, kpi_table
from salesmill.sources.sales_csv import read_sales_csv, read_sales_text, rejects
from salesmill.sources.sinks import (
    mart_tables,
    publish_tables,
    read_csv,
    read_tables_parquet,
    write_tables_csv,
    write_tables_parquet,
)


@pytest.mark.parametrize("infer", [False, True])
def test_large_amounts_are_summed(spark, tmp_path, infer):
    rows = [csv_row(), csv_row(Total_Revenue="12345678901.50", Units_Sold="3000000000")]
    path = write_raw_csv(tmp_path / "s.csv", rows)
    fact = clean(read_sales_csv(spark, path, infer))
    assert kpi_table(fact, SUMMARY).first()["total_revenue"] == 12345678926.5
    assert fact.agg({"units_sold": "sum"}).first()[0] == 3000000010


@pytest.mark.parametrize("infer", [False, True])
def test_decimals_are_not_cut(spark, tmp_path, infer):
    path = write_raw_csv(tmp_path / "s.csv", [csv_row(Unit_Price="1.23456")])
    assert read_sales_csv(spark, path, infer).first()["Unit Price"] == Decimal("1.23456")


BAD = [
    csv_row(Total_Revenue="n/a", Order_Date="13/45/2010"),
    csv_row(Units_Sold="many", Ship_Date="soon"),
    csv_row(Units_Sold="1.5", Total_Revenue=""),
    csv_row(Order_Date="2010-01-07", Ship_Date=""),
]


def test_rejects_are_counted(spark, tmp_path):
    path = write_raw_csv(tmp_path / "s.csv", BAD)
    with open(path, "a") as file:
        file.write("Asia,Japan,Meat\n")
        file.write(",".join(["x"] * 15) + "\n")
    counts = dict(collect(rejects(read_sales_text(spark, path))))
    assert {k: v for k, v in counts.items() if v} == {
        "order_date": 2,
        "ship_date": 2,
        "order_id": 1,
        "units_sold": 3,
        "unit_price": 1,
        "unit_cost": 1,
        "total_revenue": 2,
        "total_cost": 1,
        "total_profit": 1,
        "malformed_lines": 2,
    }


def test_run_counts_or_fails(spark, tmp_path):
    path = write_raw_csv(tmp_path / "s.csv", BAD)
    counts = dict(collect(run(spark, path, str(tmp_path / "out"))["rejects"]))
    assert (counts["total_revenue"], counts["units_sold"], counts["order_date"]) == (1, 2, 1)
    with pytest.raises(RejectedFields, match="units_sold"):
        run(spark, path, str(tmp_path / "out2"), on_reject="fail")
    good = write_raw_csv(tmp_path / "good.csv", [csv_row()])
    run(spark, good, str(tmp_path / "out3"), on_reject="fail")


@pytest.mark.parametrize("infer", [False, True])
def test_another_column_order_in_a_second_file_fails(spark, tmp_path, infer):
    (tmp_path / "in").mkdir()
    swapped = [*HEADERS[:-3], HEADERS[-1], HEADERS[-2], HEADERS[-3]]
    write_raw_csv(tmp_path / "in" / "a.csv", [csv_row()] * 3)
    write_raw_csv(tmp_path / "in" / "b.csv", [csv_row()], swapped)
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        read_sales_csv(spark, str(tmp_path / "in"), infer).collect()


def test_both_modes_agree(spark, tmp_path):
    rows = [csv_row(Order_Date="2010-01-07", Unit_Price="1,200.50".replace(",", "")), *BAD]
    path = write_raw_csv(tmp_path / "s.csv", rows)
    plain, inferred = (clean(read_sales_csv(spark, path, infer)) for infer in (False, True))
    assert plain.schema == inferred.schema
    assert collect(plain) == collect(inferred)
    assert plain.first()["order_year_month"] == "2010-01"


def test_odd_keys_survive_the_csv_sink(spark, tmp_path):
    keys = [" Japan ", 'a "q" b', "a,b", "two\nlines", "", None, "'", "\\", "tail\\"]
    rows = [(k, i, 0.0005 * i, 1.5e20, None) for i, k in enumerate(keys)]
    table = spark.createDataFrame(rows, kpi_schema(CHANNELS))
    write_tables_csv({CHANNELS.name: table}, str(tmp_path))
    path = tmp_path / "csv" / "channel_kpi.csv"
    assert path.is_file() and "E" not in path.read_text().split("\n", 1)[1]
    back = read_csv(spark, str(path), kpi_schema(CHANNELS))
    assert sorted(collect(back), key=repr) == sorted(rows, key=repr)


def test_publish_a_second_run_from_another_folder(spark, tmp_path):
    folders = [tmp_path / "it's one", tmp_path / "two"]
    for n, folder in enumerate(folders, 1):
        path = write_raw_csv(tmp_path / f"s{n}.csv", [csv_row()] * n)
        run(spark, path, str(folder))
        publish_tables(spark, str(folder), "kpi_again", str(tmp_path / "data'base"))
        assert mart_tables(spark, "kpi_again")["summary"].first()["rows"] == n
    assert read_tables_parquet(spark, str(folders[0]))["summary"].first()["rows"] == 1
    spark.sql("DROP DATABASE kpi_again CASCADE")


def test_tables_are_written_in_few_jobs(spark, tmp_path):
    path = write_raw_csv(tmp_path / "s.csv", [csv_row()] * 5)
    tables = run(spark, path, str(tmp_path / "out"))
    own = {name: tables[name] for name in ("summary", "monthly_kpi", "channel_kpi", "priority_kpi")}
    spark.sparkContext.setJobGroup("tables", "")
    write_tables_parquet(own, str(tmp_path / "again"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("tables")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 12
