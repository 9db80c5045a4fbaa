import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import collect
from salesmill.functions import (
    margin_pct,
    parse_sales_date,
    sales_date_text,
    plain_number,
)


def test_dates(spark):
    texts = ["1/7/2010", "01/07/2010", "12/31/2016", "2/30/2010", "13/1/2010", "", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [row[0] for row in df.select(parse_sales_date(F.col("t"))).collect()]
    assert found[:3] == [
        datetime.date(2010, 1, 7),
        datetime.date(2010, 1, 7),
        datetime.date(2016, 12, 31),
    ]
    assert found[3:] == [None] * 5


@pytest.mark.parametrize(
    ("profit", "revenue", "expected"),
    [
        ("10.00", "25.00", 40.0),
        ("0.00", "25.00", 0.0),
        ("-1.00", "3.00", -33.33),
        ("2.00", "3.00", 66.67),
        ("-0.50", "0.00", None),
        ("0.00", "0.00", None),
        (None, "1.00", None),
    ],
)
def test_margin(spark, profit, revenue, expected):
    row = (profit and Decimal(profit), Decimal(revenue))
    df = spark.createDataFrame([row], "p decimal(14,4), r decimal(14,4)")
    assert df.select(margin_pct(F.col("p"), F.col("r"))).first()[0] == expected


def test_iso_dates_and_bad_ones(spark):
    texts = ["2010-01-07", " 2010-1-7 ", "2010-13-01", "2010", "2010-01-07x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [row[0] for row in df.select(parse_sales_date(F.col("t"))).collect()]
    assert found == [datetime.date(2010, 1, 7)] * 2 + [None] * 3


def test_plain_number(spark):
    values = [133606673066.41025, 241860844.0, 34.327819400002944, 0.0, -1.5e9, 1e7, 0.001, 0.0005, -1.5e20, 1.25e-7, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    texts = [row[0] for row in collect(df.select(plain_number(F.col("v"))))]
    assert texts == [
        "133606673066.41025",
        "241860844.0",
        "34.327819400002944",
        "0.0",
        "-1500000000.0",
        "10000000.0",
        "0.001",
        "0.0005",
        "-150000000000000000000.0",
        "0.000000125",
        None,
    ]


@settings(
    max_examples=15,
    deadline=None,
    derandomize=True,
    phases=[Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.floats(allow_nan=False, allow_infinity=False),
        min_size=1,
        max_size=30,
    )
)
def test_plain_number_reads_back_the_same(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    texts = [row[0] for row in collect(df.select(plain_number(F.col("v"))))]
    assert [float(t) for t in texts] == values
    assert not any("E" in t for t in texts)


def test_date_text_is_the_pattern_s(spark):
    days = ["2010-01-07", "2012-12-31", "0999-02-03", "1000-01-01", "9999-12-31", "+10000-01-01", "0001-01-01", "-0004-02-28"]
    df = spark.createDataFrame([(d,) for d in [*days, None]], "d string").select(F.col("d").cast("date").alias("d"))
    made, formatted = sales_date_text(F.col("d")), F.date_format("d", "M/d/yyyy")
    rows = df.select(made, formatted).collect()
    assert rows[0][0] == "1/7/2010" and rows[-1][0] is None
    assert [r[0] for r in rows] == [r[1] for r in rows]
