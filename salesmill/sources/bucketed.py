"""Order lines and orders stored by order, so that they are joined where they lie."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Save ``df`` as ``table`` in sorted buckets of ``key``, one file each.

    This is the one shuffle of the table. Aggregates by the key, and joins on it with a table of as
    many buckets, then need none. All rows of a key share a file, so a key must not hold a large
    share of the rows; choose ``buckets`` so that one is read well by a task (input size / 200 MB).
    """
    dealt = df.repartition(buckets, key)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def bucket_count(source: DataFrame, target: int = 200 << 20) -> int:
    """Buckets of about ``target`` bytes for a frame as read from files; 8 at least."""
    size = int(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(8, -(-size // target))
