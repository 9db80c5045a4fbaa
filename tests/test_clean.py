import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import HEADERS, collect, csv_row, write_raw_csv
from salesmill.operators import column_list, null_counts, null_dates, sample, shape
from salesmill.plans.clean import clean
from salesmill.plans.kpi import KPIS, SUMMARY, kpi_table
from salesmill.schema import CLEANED_SCHEMA
from salesmill.sources.sales_csv import read_sales_csv
from salesmill.sources.star import raw_sales, sales_fact


def _cleaned(spark, path, **kwargs):
    return clean(read_sales_csv(spark, path, **kwargs))


def test_cleaned_schema_and_values(spark, tmp_path):
    df = _cleaned(spark, write_raw_csv(tmp_path / "s.csv", [csv_row(Ship_Date="2/30/2010")]))
    assert df.schema.simpleString() == CLEANED_SCHEMA.simpleString()
    row = df.first()
    assert row.order_date == datetime.date(2010, 1, 7)
    assert row.ship_date is None
    assert (row.order_year, row.order_month, row.order_year_month) == (2010, 1, "2010-01")
    assert row.total_revenue == Decimal("25.0000")
    assert row.profit_margin_pct == 40.0


def test_inference_gives_the_same_fact(spark, tmp_path):
    rows = [csv_row(), csv_row(Order_ID="2", Order_Date="", Total_Profit="-3.25")]
    path = write_raw_csv(tmp_path / "s.csv", rows)
    explicit, inferred = _cleaned(spark, path), _cleaned(spark, path, infer=True)
    assert inferred.schema == explicit.schema
    assert sorted(collect(inferred), key=repr) == sorted(collect(explicit), key=repr)


def test_other_column_order_unknown_and_missing_columns(spark, tmp_path):
    headers = ["Note", *reversed([h for h in HEADERS if h != "Region"])]
    row = csv_row(Note="gift")
    df = _cleaned(spark, write_raw_csv(tmp_path / "s.csv", [row], headers))
    found = df.first()
    assert found.Note == "gift"
    assert found.country == "Japan" and found.units_sold == 10
    assert "region" not in df.columns


def test_files_with_different_column_orders_are_refused(spark, tmp_path):
    write_raw_csv(tmp_path / "a.csv", [csv_row()])
    write_raw_csv(tmp_path / "b.csv", [csv_row()], list(reversed(HEADERS)))
    with pytest.raises(Exception, match="header"):
        _cleaned(spark, str(tmp_path)).collect()


def test_field_that_does_not_fit_is_null(spark, tmp_path):
    path = write_raw_csv(tmp_path / "s.csv", [csv_row(Units_Sold="ten"), csv_row()])
    assert [r[0] for r in collect(_cleaned(spark, path).select("units_sold"))] == [None, 10]


def test_header_only(spark, tmp_path):
    fact = _cleaned(spark, write_raw_csv(tmp_path / "s.csv", []))
    for kpi in KPIS.values():
        expected = [(0, None, None, None)] if kpi is SUMMARY else []
        assert collect(kpi_table(fact, kpi)) == expected
    assert collect(null_dates(fact)) == [(0, 0)]


def test_null_dates_counts_blank_and_impossible(spark, tmp_path):
    rows = [
        csv_row(Order_Date="2/30/2010", Ship_Date=""),
        csv_row(Ship_Date="x"),
        csv_row(Order_Date="01/07/2010"),
    ]
    fact = _cleaned(spark, write_raw_csv(tmp_path / "s.csv", rows))
    assert collect(null_dates(fact)) == [(1, 2)]


def test_profile(spark, tmp_path):
    rows = [csv_row(Region="", Order_ID=str(i), Ship_Date="" if i else "1/9/2010") for i in range(4)]
    raw = read_sales_csv(spark, write_raw_csv(tmp_path / "s.csv", rows))
    assert collect(shape(raw)) == [(4, 14)]
    assert [(r.position, r.column_name) for r in column_list(raw).orderBy("position").collect()] == [
        (i, name) for i, name in enumerate(HEADERS, 1)
    ]
    top = collect(null_counts(raw))
    assert len(top) == 10
    assert top[:3] == [("Region", 4), ("Ship Date", 3), ("Country", 0)]
    assert collect(sample(raw.select("Order ID"))) == [(0,), (1,), (2,)]
    assert collect(sample(raw.select("Order ID"), 1, [F.col("Order ID").desc()])) == [(3,)]


def test_profile_of_odd_column_names(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "`a.b` int, `c``d` string")
    assert collect(null_counts(df)) == [("c`d", 2), ("a.b", 0)]


def test_raw_view_cleans_to_the_fact(spark, sf_dir):
    cleaned = clean(raw_sales(spark, sf_dir))
    fact = sales_fact(spark, sf_dir)
    assert cleaned.schema.simpleString() == fact.schema.simpleString()
    assert sorted(collect(cleaned)) == sorted(collect(fact))
