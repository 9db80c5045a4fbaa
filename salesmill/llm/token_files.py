"""Token ids in ORC files that are read by document id.

Files hold ``key``, ``part``, ``place`` and ``ids`` in ascending key order. ORC stores the integers
run-length encoded in stripes; every stripe has a row index with minima and maxima and a Bloom
filter of the keys, so a reader takes stripes in parallel and skips those that cannot hold what it
asks for.

The texts are dealt by sampled key ranges (``part`` numbers them, ``place`` the rows inside one),
so no task holds more than its range; a key that many rows share is split by their places in the input.
Where a document starts in the whole row of ids follows on reading: the totals of the parts before,
one number per part, and a running sum inside each.

A null text counts as empty: it has the end id only. A null key sorts first. Repeated rows are kept,
side by side. An empty table writes files without rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmill.llm.common import stash
from salesmill.llm.tokens import ID, encoder, ids_crc32

#: Rows per entry of the row index, each with a Bloom filter.
INDEX_ROWS = 1000
STRIPE_BYTES = 64 * 1024 * 1024
#: Bytes of text that are encoded at once.
BATCH = 4_000_000
SCHEMA = "key long, part int, place long, ids array<int>"


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``SCHEMA`` for every row, dealt and sorted by key; ``ids`` are the text's and the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
            part = (np.cumsum(size, dtype=np.int64) - size) // BATCH
            cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            for start, stop in zip(cuts, [*cuts[1:], len(part)], strict=True):
                rows = batch.slice(start, stop - start)
                ids = encoder(path)(rows["text"].to_pylist())
                # One array for all ids: no conversion id by id.
                ends = np.cumsum([len(own) // ID.itemsize for own in ids])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, ends].astype(np.int32)),
                    pa.array(np.frombuffer(b"".join(ids), ID).view("<i4")),
                )
                places = pa.array(np.arange(place, place + len(ids)))
                yield pa.RecordBatch.from_arrays(
                    [rows["key"], rows["part"], places, lists], ["key", "part", "place", "ids"]
                )
                place += len(ids)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # The row's place in the input splits a key that many rows share; unlike a hash of the text, it
    # costs the sampling nothing.
    placed = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    parts = dealt.select("key", "text", F.spark_partition_id().alias("part"))
    return parts.mapInArrow(run, SCHEMA)


def write(tokens: DataFrame, folder: str, compression: str = "none") -> None:
    (
        tokens.write.option("compression", compression)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.bloom.filter.columns", "key")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(folder)
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the files; a condition on ``key`` skips stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(folder)


def documents(files: DataFrame) -> DataFrame:
    """``key``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32``."""
    crc = F.pandas_udf(ids_crc32, "long")
    rows = stash(
        files.select(
            "key",
            "part",
            "place",
            F.size("ids").cast("long").alias("n_tokens"),
            crc("ids").alias("ids_crc32"),
        ),
        "token_rows",
    )
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per part.
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead"))
    placed = rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(F.broadcast(parts), "part").select(
        "key", (F.col("ahead") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
