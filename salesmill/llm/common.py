"""Helpers that several training-data operators share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from salesmill.sources.scratch import scratch_dir

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"


@cache
def _archive() -> str:
    """This package as a file, on the driver."""
    package = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp(prefix="salesmill-"))
    return shutil.make_archive(str(folder / "salesmill"), "zip", package.parent, package.name)


def ship(spark: SparkSession) -> None:
    """Let Spark hand this package to its Python workers, wherever they run, in small batches."""
    # Texts are large: batches of the default 10,000 rows would fill the memory of a worker.
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "2000")
    context = spark.sparkContext
    if not any(name.endswith(Path(_archive()).name) for name in context._python_includes):
        context.addPyFile(_archive())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps read the files, so neither a lost executor nor a second use of the frame computes
    it again. The files stay: the result may be read at any later time by the caller, who owns
    the folder in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(frames: Iterator[pd.DataFrame], column: str, chars: int) -> Iterator[pd.DataFrame]:
    """Cut batches so that each holds about ``chars`` characters of a column, or one row."""
    for frame in frames:
        if frame.empty:
            continue
        sizes = frame[column].str.len().fillna(0).astype("int64")
        part = (sizes.cumsum() - sizes) // chars
        for _, rows in frame.groupby(part.to_numpy(), sort=True):
            yield rows.reset_index(drop=True)
