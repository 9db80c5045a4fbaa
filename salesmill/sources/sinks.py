"""Writing and reading back the fact and the KPI tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmill.functions import plain_number
from salesmill.plans.kpi import KPIS, kpi_order, kpi_schema


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace ``path``. Unpartitioned writes need no shuffle.

    With ``partition_by`` the rows are rebalanced first: every task writing to every
    partition would leave tasks x partitions small files, and a plain repartition would put
    a hot value into one task. Rebalancing lets adaptive execution split and merge by size.
    """
    if partition_by:
        rebalanced = df.hint("rebalance", F.col(partition_by))
        rebalanced.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace those partitions of the table at ``path`` that ``df`` has rows for; others stay.

    The rows must not be read from the partitions that they replace. Partitions for which there are
    no rows are not touched, so an empty ``df`` changes nothing.
    """
    rebalanced = df.hint("rebalance", F.col(partition_by))
    writer = rebalanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_by).parquet(path)


# Text comes back as it was: quotes are doubled, blanks stay, null is not the empty text.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
#: What unquoted nothing is read as, so that it differs from a quoted empty text.
_NOTHING = "\u0000"


def write_csv(df: DataFrame, path: str) -> None:
    """Replace the folder ``path`` with headed UTF-8 CSV; doubles are written without exponents."""
    columns = [
        plain_number(F.col(f.name)).alias(f.name) if f.dataType == T.DoubleType() else f.name
        for f in df.schema
    ]
    writer = df.select(*columns).write.mode("overwrite").options(**_CSV)
    writer.option("nullValue", "").option("emptyValue", '""').csv(path)


def _write_csv_file(table: DataFrame, path: str, order: Sequence[Column]) -> None:
    """One file at ``path``, for KPI tables only: one task writes it, and it is moved into place."""
    spark = table.sparkSession
    ordered = table.coalesce(1)
    parts = f"{path}.parts"
    write_csv(ordered.sortWithinPartitions(*order) if order else ordered, parts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder, target = hadoop.Path(parts), hadoop.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    (written,) = files.globStatus(hadoop.Path(f"{parts}/part-*.csv"))
    files.delete(target, True)
    if not files.rename(written.getPath(), target):
        raise OSError(f"cannot move {written.getPath()} to {path}")
    files.delete(folder, True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV back under an explicit schema; inference would read months as timestamps."""
    reader = spark.read.schema(schema).options(**_CSV).option("enforceSchema", False)
    return reader.option("multiLine", True).option("nullValue", _NOTHING).csv(path)


def write_tables_parquet(tables: Mapping[str, DataFrame], out_dir: str) -> None:
    for name, table in tables.items():
        write_parquet(table, f"{out_dir}/{name}_parquet")


def read_tables_parquet(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    return {
        name: spark.read.schema(kpi_schema(kpi)).parquet(f"{out_dir}/{name}_parquet")
        for name, kpi in KPIS.items()
    }


def write_tables_csv(tables: Mapping[str, DataFrame], out_dir: str) -> None:
    """One headed file ``csv/<table>.csv`` per table, rows in the table's order."""
    for name, table in tables.items():
        _write_csv_file(table, f"{out_dir}/csv/{name}.csv", kpi_order(KPIS[name]))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_tables(
    spark: SparkSession, out_dir: str, database: str = "kpi", location: str | None = None
) -> None:
    """Make the tables written by ``write_tables_parquet`` readable by name in ``database``.

    The tables lie over the written files: nothing is copied. Publish a new run from a new folder:
    each name is then pointed there at once, and readers of the old files are not disturbed.
    ``location`` is the folder of a database created here.
    """
    where = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name, kpi in KPIS.items():
        # A catalog takes relative paths from its own folder, so the full one is looked up.
        folder = hadoop.Path(f"{out_dir}/{name}_parquet")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        full = files.makeQualified(folder).toString()
        table = f"`{database}`.`{name}`"
        if spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(full)}")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path=full, source="parquet", schema=kpi_schema(kpi))


def publish_steps(
    spark: SparkSession,
    out_dir: str,
    run_id: str,
    database: str = "kpi",
    location: str | None = None,
) -> Iterator[str]:
    """Publish a run as a whole: like ``publish_run``, but stops after each step.

    Each table has all runs, as partitions that lie over the files of ``write_tables_parquet``. The
    names are views that look for the run in a pointer table. Until the last step, which adds one
    file to the pointer table, all names show the run before.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    pointer = f"`{database}`.`current_run`"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {pointer} (seq BIGINT, run_id STRING) USING parquet")
    for name, kpi in KPIS.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kpi_schema(kpi))
        runs = f"`{database}`.`{name}_runs`"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {runs} ({columns}, run_id STRING)"
            " USING parquet PARTITIONED BY (run_id)"
        )
        yield f"table {name}"
        # A catalog takes relative paths from its own folder, so the full one is looked up.
        folder = hadoop.Path(f"{out_dir}/{name}_parquet")
        full = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder)
        spark.sql(
            f"ALTER TABLE {runs} ADD PARTITION (run_id = {_quoted(run_id)})"
            f" LOCATION {_quoted(full.toString())}"
        )
        yield f"run {name}"
        shown = ", ".join(f"`{f.name}`" for f in kpi_schema(kpi))
        spark.sql(
            f"CREATE VIEW IF NOT EXISTS `{database}`.`{name}` AS SELECT {shown} FROM {runs}"
            f" WHERE run_id = (SELECT max(struct(seq, run_id)).run_id FROM {pointer})"
        )
        yield f"name {name}"
    last = spark.table(pointer).agg(F.coalesce(F.max("seq"), F.lit(0)).alias("seq")).first().seq
    row = spark.createDataFrame([(last + 1, run_id)], "seq long, run_id string")
    row.coalesce(1).write.insertInto(pointer)
    spark.catalog.refreshTable(pointer)
    yield "pointer"


def publish_run(
    spark: SparkSession,
    out_dir: str,
    run_id: str,
    database: str = "kpi",
    location: str | None = None,
) -> None:
    """Make the tables written by ``write_tables_parquet`` the ones that all names show, at once.

    Nothing is copied, and earlier runs stay readable in ``<table>_runs``. A database holds either
    tables from ``publish_tables`` or runs.
    """
    for _ in publish_steps(spark, out_dir, run_id, database, location):
        pass


def mart_tables(spark: SparkSession, database: str = "kpi") -> dict[str, DataFrame]:
    return {name: spark.table(f"`{database}`.`{name}`") for name in KPIS}
