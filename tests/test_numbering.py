"""Row numbers over a whole table against sorting in Python."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import collect, final_plan
from salesmill.operators import numbering, row_numbers


def numbered(spark, rows, order):
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    return row_numbers(df, order)


def test_numbers_in_both_directions(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "é", ""]), i) for i in range(500)]
    found = collect(numbered(spark, rows, [F.col("k").asc_nulls_last(), F.col("v").desc()]))
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", -r[1]))
    assert sorted(found, key=lambda r: r[2]) == [
        (*row, i, len(rows) + 1 - i) for i, row in enumerate(order, 1)
    ]


def test_ties_and_repeated_rows_get_numbers_of_their_own(spark):
    rows = [("x", 1)] * 300 + [(None, 2)] * 10
    found = collect(numbered(spark, rows, [F.col("k").asc_nulls_last()]))
    assert sorted(r[2] for r in found) == list(range(1, 311))
    assert {r[2] for r in found if r[0] is None} == set(range(301, 311))
    assert all(a + d == 311 for *_, a, d in found)


def test_no_rows(spark):
    assert numbered(spark, [], [F.col("k")]).count() == 0


def test_a_hot_key_takes_many_partitions(spark, conf, tmp_path, monkeypatch):
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(numbering, "scratch_dir", lambda *_: str(tmp_path / "placed"))
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    assert row_numbers(df, [F.col("k")]).agg(F.max("rn_asc")).first()[0] == 30_000
    placed = spark.read.parquet(str(tmp_path / "placed")).where("k = 'hot'")
    sizes = [r["count"] for r in placed.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) > 3 and max(sizes) < 4000


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_no_window_over_all_rows(spark, conf, broadcast):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    plan = final_plan(row_numbers(spark.range(1000).toDF("k"), [F.col("k")]))
    final = plan.split("Initial Plan")[0]
    # The rows themselves meet neither a window nor a single partition: only the partitions' sizes.
    assert "BroadcastHashJoin" in final
    rows_side = final[: final.index("BroadcastQueryStage")] if "BroadcastQueryStage" in final else final
    assert "SinglePartition" not in rows_side.split("Window")[0]
