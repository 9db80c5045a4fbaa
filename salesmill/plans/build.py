"""From raw files to the cleaned fact, the KPI tables and, if wanted, the mart database."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from salesmill.plans.clean import clean
from salesmill.plans.kpi import (
    KPIS,
    kpi_order,
    null_dates_from_one_pass,
    one_pass,
    tables_from_one_pass,
)
from salesmill.sources.inference import cast_to, kind_aggregates, types_of
from salesmill.sources.sales_csv import (
    read_sales_text,
    reject_counts,
    typed_sales,
    unknown_headers,
)
from salesmill.sources.sinks import (
    publish_tables,
    read_tables_parquet,
    write_parquet,
    write_tables_csv,
    write_tables_parquet,
)


class RejectedFields(ValueError):
    """Fields that do not convert, or malformed lines, where the caller asked for none."""


def run(
    spark: SparkSession,
    input_path: str,
    out_dir: str,
    infer: bool = False,
    partition_by: str | None = None,
    csv: bool = False,
    database: str | None = None,
    on_reject: str = "count",
) -> dict[str, DataFrame]:
    """Write everything under ``out_dir`` and return the tables, read from there.

    The text files are parsed once; that pass also counts what does not convert (``rejects``, and
    with ``on_reject="fail"`` an error before any table is built) and, with ``infer``, finds the types of
    columns that no schema names: their files hold text, the returned fact has them in these types
    (``types`` lists them for other readers). The cleaned fact is written and
    read back as Parquet instead of cached: it survives lost executors, and later scans read only
    the columns they need. All KPI tables come from one scan of it; the rest works on group rows.
    """
    seen = Observation("rejects")
    text = read_sales_text(spark, input_path)
    counts = reject_counts(text)
    unknown = unknown_headers(text) if infer else []
    measures = {**counts, **kind_aggregates(unknown)}
    watched = text.observe(seen, *(measure.alias(name) for name, measure in measures.items()))
    cleaned = clean(typed_sales(watched))
    write_parquet(cleaned, f"{out_dir}/cleaned_parquet", partition_by)
    found = seen.get
    rejected = {name: found[name] for name in counts}
    if on_reject == "fail" and any(rejected.values()):
        raise RejectedFields(f"rejected: { {k: v for k, v in rejected.items() if v} }")
    # The schema is stated because partition values are otherwise typed by their text.
    types = types_of(unknown, found)
    fact = cast_to(spark.read.schema(cleaned.schema).parquet(f"{out_dir}/cleaned_parquet"), types)
    write_parquet(one_pass(fact), f"{out_dir}/kpi_parts_parquet")
    parts = spark.read.parquet(f"{out_dir}/kpi_parts_parquet")
    # Parquet keeps no order, so none is made.
    write_tables_parquet(tables_from_one_pass(parts, ordered=False), out_dir)
    tables = {
        name: table.orderBy(*kpi_order(KPIS[name])) if KPIS[name].key else table
        for name, table in read_tables_parquet(spark, out_dir).items()
    }
    if csv:
        write_tables_csv(tables, out_dir)
    if database:
        publish_tables(spark, out_dir, database)
    rejects = spark.createDataFrame(list(rejected.items()), "column_name string, rejected long")
    return {
        "cleaned": fact,
        "null_dates": null_dates_from_one_pass(parts),
        "rejects": rejects,
        "types": spark.createDataFrame(
            [(name, dtype.simpleString()) for name, dtype in types.items()],
            "column_name string, type string",
        ),
        **tables,
    }
