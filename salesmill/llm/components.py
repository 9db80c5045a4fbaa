"""Connected components of a graph given as an edge table, without holding it anywhere whole.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014): each turns the edges of a node towards the smallest node it knows. Minima are
pre-aggregated before they are shuffled and joined back with a plain join that Spark splits where a
node has very many edges. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.llm.common import stash


def _mark(edges: DataFrame) -> tuple[int, int, int]:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for all nodes that have an edge.

    ``edges`` has columns a and b of one ordered type; direction, order, repeats and loops do not
    matter. The smallest node of a component is its own root.
    """
    now = stash(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while (mark := _mark(now)) != before:
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stash(
            both.groupBy("a").agg(F.min("b").alias("m")).select(
                "a", F.least("a", "m").alias("m")
            ),
            "large_star",
        )
        large = both.where("b > a").join(least, "a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stash(large.distinct(), "edges")
        least = stash(large.groupBy("a").agg(F.min("b").alias("m")), "small_star")
        small = large.join(least, "a").where("b <> m")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stash(least.select("a", F.col("m").alias("b")).unionByName(small).distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
