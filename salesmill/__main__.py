"""spark-submit entry: build all results and show a preview of each result."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from salesmill.operators import column_profile, first_rows, top_nulls
from salesmill.plans.kpi import KPIS, MONTHLY
from salesmill.plans.build import run
from salesmill.schema import NULL_TEXTS
from salesmill.sources.sales_csv import MALFORMED, read_sales_text


def main() -> None:
    parser = argparse.ArgumentParser(prog="salesmill", description=__doc__)
    parser.add_argument("input", help="CSV file or folder")
    parser.add_argument("output", nargs="?", default="outputs")
    parser.add_argument("--profile", action="store_true", help="only profile the input")
    parser.add_argument("--infer", action="store_true", help="infer the column types")
    parser.add_argument("--csv", action="store_true", help="also write the KPI tables as CSV")
    parser.add_argument("--database", help="also publish the KPI tables there")
    parser.add_argument("--partition-by", help="partition the cleaned fact by this column")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("salesmill").getOrCreate()
    if args.profile:
        raw = read_sales_text(spark, args.input)
        fields = raw.drop(MALFORMED)
        # One row per column; kept so that the text files are read once for both views of it.
        columns = column_profile(fields, NULL_TEXTS).cache()
        columns.orderBy("position").show(len(fields.columns), truncate=False)
        first_rows(raw).drop(MALFORMED).show(truncate=False)
        top_nulls(columns).show(truncate=False)
        return
    results = run(
        spark, args.input, args.output, args.infer, args.partition_by, args.csv, args.database
    )
    for name, kpi in KPIS.items():
        print(f"\n{name}")
        results[name].show(12 if kpi is MONTHLY else 20, truncate=False)
    results["null_dates"].show()


if __name__ == "__main__":
    main()
