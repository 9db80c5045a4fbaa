"""Null texts, the first rows of files, and where rejected fields are."""

import random

import pytest

from helpers import HEADERS, collect, csv_row, write_raw_csv
from salesmill.operators import column_list, first_rows, null_counts
from salesmill.schema import NULL_TEXTS
from salesmill.sources.sales_csv import (
    MALFORMED,
    read_sales_text,
    rejects,
    split_rejects,
    typed_sales,
    write_split_rejects,
)


def test_null_texts_in_every_column(spark, tmp_path):
    rows = [csv_row(**{h.replace(" ", "_"): f'"{t}"' for h in HEADERS}) for t in NULL_TEXTS]
    rows += [csv_row(), csv_row(Country=" NA", Region="na", Unit_Price="NAN", Total_Cost="N/A ")]
    text = read_sales_text(spark, write_raw_csv(tmp_path / "s.csv", rows)).drop(MALFORMED)
    assert {nulls for *_, nulls in collect(column_list(text, NULL_TEXTS))} == {len(NULL_TEXTS)}
    assert collect(null_counts(text, 2, NULL_TEXTS)) == [
        ("Country", len(NULL_TEXTS)),
        ("Item Type", len(NULL_TEXTS)),
    ]
    # Without them, only the empty field is a null.
    assert {nulls for *_, nulls in collect(column_list(text))} == {1}


def test_null_texts_leave_numbers_alone(spark):
    df = spark.createDataFrame([(1, "NA"), (None, "x"), (3, None)], "`a.b` int, s string")
    assert collect(column_list(df, NULL_TEXTS)) == [(1, "a.b", 1), (2, "s", 2)]
    assert collect(column_list(df.limit(0), NULL_TEXTS)) == [(1, "a.b", 0), (2, "s", 0)]


@pytest.fixture
def parts(spark, tmp_path, conf):
    """A raw file of several parts, each read in many blocks; and its order ids in file order."""
    conf("spark.sql.files.maxPartitionBytes", "700")
    conf("spark.sql.files.openCostInBytes", "1")
    rng = random.Random(4)
    ids = rng.sample(range(1000), 120)
    (tmp_path / "in").mkdir()
    for n in range(4):
        rows = [csv_row(Order_ID=str(i)) for i in ids[n * 30 : n * 30 + 30]]
        write_raw_csv(tmp_path / "in" / f"part-{n}.csv", rows)
    return str(tmp_path / "in"), ids


@pytest.mark.parametrize("n", [3, 50, 120])
def test_first_rows_are_in_file_order(spark, parts, n):
    path, ids = parts
    text = read_sales_text(spark, path)
    assert text.rdd.getNumPartitions() > 8
    found = first_rows(text, n)
    assert found.columns == text.columns
    assert [int(r["Order ID"]) for r in found.collect()] == ids[:n]


def test_first_rows_are_not_sorted_as_a_whole(spark, parts):
    plan = first_rows(read_sales_text(spark, parts[0]))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_first_rows_of_few(spark, tmp_path):
    path = write_raw_csv(tmp_path / "s.csv", [csv_row()])
    assert first_rows(read_sales_text(spark, path), 3).count() == 1
    empty = write_raw_csv(tmp_path / "e.csv", [])
    assert first_rows(read_sales_text(spark, empty), 3).count() == 0


def test_rejects_are_split_in_one_write(spark, tmp_path):
    rows = [
        csv_row(Order_ID="1", Total_Revenue="n/a", Order_Date="13/45/2010"),
        csv_row(Order_ID="2"),
        csv_row(Order_ID="3", Units_Sold="many", Ship_Date="", Region=""),
    ]
    path = write_raw_csv(tmp_path / "s.csv", rows)
    with open(path, "a") as file:
        file.write("Asia,Japan,Meat\n")
    text = read_sales_text(spark, path)
    split_rejects(text).write.partitionBy("kind").parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    good = back.where("kind = 'row'").select(*[f"`{h}`" for h in HEADERS])
    assert sorted(collect(good), key=repr) == sorted(collect(text.drop(MALFORMED)), key=repr)
    bad = back.where("kind = 'reject'")
    assert {(r.column_name, r.raw_text) for r in bad.collect()} == {
        ("total_revenue", "n/a"),
        ("order_date", "13/45/2010"),
        ("units_sold", "many"),
        ("malformed_lines", "Asia,Japan,Meat"),
    }
    assert {(r.file.endswith("s.csv"), r.block_start) for r in bad.collect()} == {(True, 0)}
    assert {r.place for r in bad.where("column_name = 'units_sold'").collect()} == {2}
    counts = {name: n for name, n in collect(rejects(text)) if n}
    assert counts == dict(collect(bad.groupBy("column_name").count()))


def test_splitting_stays_in_generated_code_and_sorts_nothing(spark, tmp_path):
    rows = [csv_row(Order_ID=str(i), Units_Sold="many" if i % 3 else "5") for i in range(9)]
    text = read_sales_text(spark, write_raw_csv(tmp_path / "s.csv", rows))
    found = split_rejects(text)
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    option = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(option)
    write_split_rejects(text, str(tmp_path / "out"))
    assert spark.conf.get(option) == before
    back = spark.read.parquet(str(tmp_path / "out"))
    columns = [f"`{c}`" for c in found.columns]
    whole = sorted(collect(found), key=repr)
    assert sorted(collect(back.select(*columns)), key=repr) == whole and len(whole) == 15
    assert [len(list((tmp_path / "out" / f"kind={k}").glob("*.parquet"))) for k in ("row", "reject")] == [1, 1]


def test_whole_numbers_convert_as_by_a_cast(spark):
    odd = [chr(c) for c in [*range(0x180), 0x2003, 0x3000, 0xFEFF, 0x663]]
    texts = [f"{a}{n}{b}" for c in odd for n in ("5", "-5") for a, b in ((c, ""), ("", c), (c, c))]
    texts += ["", "+", "-", "many", "1.5", "5.", "1e3", "+7", "--7", "007", str(1 << 63), str(-(1 << 63))]
    text = spark.createDataFrame([(t, t) for t in texts], "`Units Sold` string, raw string")
    typed = typed_sales(text).select("raw", "`Units Sold`")
    assert "RLIKE" in typed._jdf.queryExecution().optimizedPlan().toString()
    cast = text.selectExpr("raw", "try_cast(raw AS bigint)")
    assert sorted(collect(typed), key=repr) == sorted(collect(cast), key=repr)
