import pytest
from pyspark.sql import functions as F

from helpers import collect, csv_row, final_plan, write_raw_csv
from salesmill.plans.build import run
from salesmill.plans.clean import clean
from salesmill.sources.inference import (
    _LIKE_DOUBLE,
    _LIKE_TIMESTAMP,
    DATE,
    DOUBLE,
    INT,
    LONG,
    TIMESTAMP,
    WHOLE,
    infer_types,
    kind,
    kind_aggregates,
    least_type,
)
from salesmill.sources.sales_csv import MALFORMED, read_sales_csv, read_sales_text

COLUMNS = {
    "small": ["1", "-5", "+7", "007", ""],
    "limits": ["2147483647", "-2147483648"],
    "long": ["1", "2147483648"],
    "whole": ["5", "1234567890123456789012345"],
    "too_long": ["1" * 45],
    "double": ["1", "2.5", "-.5", "1e5", "3."],
    "whole_and_double": ["12345678901234567890", "0.5"],
    "special": ["NaN", "1"],
    "day": ["2010-01-07", "", "2012-02-29"],
    "no_day": ["2010-02-30"],
    "loose_day": ["2010-1-7"],
    "month": ["2010-01"],
    "moment": ["2010-01-07 10:20:30", "2010-01-07T10:20:30.123"],
    "day_and_moment": ["2010-01-07 10:20:30", "2010-01-07"],
    "flag": ["true", "FALSE", "True"],
    "flag_and_number": ["true", "1"],
    "day_and_number": ["2010-01-07", "5"],
    "text": ["1", "n/a"],
    "line_feed": ["5\n"],
    "blank": ["", ""],
    "spaces": [" 5"],
    "dotted.name": ["1"],
}


def _write(tmp_path, columns):
    rows = max(map(len, columns.values()))
    path = tmp_path / "in.csv"
    lines = [",".join(columns)]
    for i in range(rows):
        own = [values[i] if i < len(values) else "" for values in columns.values()]
        lines.append(",".join(f'"{v}"' if v else "" for v in own))
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.mark.parametrize("turned", [False, True])
def test_types_are_those_that_spark_infers(spark, tmp_path, turned):
    columns = {h: v[::-1] if turned else v for h, v in COLUMNS.items()}
    path = _write(tmp_path, columns)
    reader = spark.read.options(header=True, escape='"', inferSchema=True, multiLine=True)
    expected = {f.name: f.dataType.simpleString() for f in reader.csv(path).schema}
    text = read_sales_text(spark, path, multiLine=True).drop(MALFORMED)
    found = infer_types(text, text.columns)
    assert {h: t.simpleString() for h, t in found.items()} == expected


def test_partial_results_merge_in_any_order(spark):
    rows = [(v,) for v in ["1", "2147483648", None, "2.5", ""]]
    merged = [
        spark.createDataFrame(rows[::step], "v string").repartition(n).agg(
            *(c.alias(name) for name, c in kind_aggregates(["v"]).items())
        ).first()
        for step in (1, -1)
        for n in (1, 5)
    ]
    assert len(set(map(tuple, merged))) == 1
    assert least_type(None, None).simpleString() == "string"


def test_nothing_unknown_costs_no_pass(spark, tmp_path):
    path = write_raw_csv(tmp_path / "s.csv", [csv_row()])
    spark.sparkContext.setJobGroup("known", "")
    text = read_sales_text(spark, path)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("known"))
    assert infer_types(text, []) == {}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("known")) == before
    spark.sparkContext.setJobGroup("", "")
    assert infer_types(spark.createDataFrame([], "v string"), ["v"])["v"].simpleString() == "string"


def test_run_finds_types_while_it_reads(spark, tmp_path):
    headers = [*csv_row(), "Floor", "Gift Note", "Opened"]
    rows = [
        {**csv_row(), "Floor": "3", "Gift Note": "5", "Opened": "2010-01-07"},
        {**csv_row(), "Floor": "", "Gift Note": "none", "Opened": "2011-01-07"},
    ]
    path = write_raw_csv(tmp_path / "s.csv", rows, headers)
    tables = run(spark, path, str(tmp_path / "out"), infer=True)
    types = {"Floor": "int", "Gift Note": "string", "Opened": "date"}
    assert {r.column_name: r.type for r in tables["types"].collect()} == types
    fact = tables["cleaned"]
    assert {h: fact.schema[h].dataType.simpleString() for h in types} == types
    assert sorted(r.Floor or 0 for r in fact.collect()) == [0, 3]
    assert fact.schema == clean(read_sales_csv(spark, path, infer=True)).schema
    plain = run(spark, path, str(tmp_path / "plain"))
    assert plain["types"].count() == 0
    assert plain["cleaned"].schema["Floor"].dataType.simpleString() == "string"


def test_aggregates_need_one_scan_and_one_row_per_task(spark, tmp_path):
    path = _write(tmp_path, {"a": ["1", "2"], "b": ["x", "y"]})
    text = read_sales_text(spark, path)
    found = text.agg(*(c.alias(name) for name, c in kind_aggregates(["a", "b"]).items()))
    plan = final_plan(found).split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "partial_bit_or" in plan
    assert found.select(F.col("kinds_1")).first()[0] == 128


def _kinds(spark, texts):
    return spark.createDataFrame([(v,) for v in texts], "v string").select("v", kind(F.col("v")).alias("kind"))


def test_whole_numbers_are_told_apart_without_casts(spark):
    ends = [m + d for m in (1 << 31, 1 << 63, -(1 << 31), -(1 << 63)) for d in (-1, 0, 1)]
    texts = [str(n) for n in [*ends, 0, 10**9, 10**10, 10**18, 10**19, 10**37, -(10**37)]]
    texts += [*(f"+{t}" for t in texts if t[0] != "-"), *(t.replace("-", "-000") for t in texts), "0" * 45, "-0"]
    found = _kinds(spark, texts)
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "as double" in plan and "as int)" not in plan and "as bigint)" not in plan
    for text, number in collect(found):
        sizes = [k for k, bits in ((INT, 31), (LONG, 63)) if -(1 << bits) <= int(text) < 1 << bits]
        assert number == (sizes or [WHOLE])[0], text


def test_texts_that_cannot_convert_are_kept_from_casts(spark):
    numbers = "1d 2.5F -.5 3. 1e5 +1E-5 1e5f NaN -inf +Infinity INFINITY 0x1p3 0X.8P-1d".split()
    numbers += [" 1.5", "1.5\t", "\n-inf ", "1" * 45, "1e999", " 5"]
    moments = ["2010-1-7", "2010", " 2010-01-07 ", "+2010-01-07", "T10:20:30", "10:20:30", "2010-01-07T10:20Z"]
    texts = "true no n/a 13/45/2010 soon e5 . - + 0x1 0xp nanf 1f5 2010-02-30 2010-13 12:61 T".split()
    by_text = dict(collect(_kinds(spark, [*numbers, *moments, *texts])))
    for text, double, moment in collect(
        spark.createDataFrame([(t,) for t in by_text], "v string").select(
            "v", F.expr("try_cast(v AS double) IS NOT NULL"), F.expr("try_cast(v AS timestamp) IS NOT NULL")
        )
    ):
        number = by_text[text]
        assert double == bool(number & (INT | LONG | WHOLE | DOUBLE)), text
        assert double or moment == bool(number & (DATE | TIMESTAMP)), text
    throwing = ["2010-01-07", "2010-01-07 10:20:30", "true", "n/a", "13/45/2010", "soon"]
    shown = F.expr("v").rlike(_LIKE_DOUBLE), F.expr("v").rlike(_LIKE_TIMESTAMP)
    let_by = spark.createDataFrame([(t,) for t in throwing], "v string").select(*shown)
    assert [tuple(r) for r in let_by.collect()][:4] == [(False, True), (False, True), (False, False), (False, False)]
