"""Shards of nearly equal size, cut from an ordered row of groups that stay whole.

Rows with equal texts form a group, and a group never crosses a shard. Groups are ordered by the MD5
of their text. The driver searches the smallest capacity for which a greedy pass needs no more than the
wanted number of shards, and cuts under that capacity. It sees no sizes of single groups but those of
atoms: groups whose MD5 begin alike. Taking atoms that hold several groups as freely divisible bounds
the capacity from below, taking them as whole bounds it from above; as long as the bounds differ, the
atoms in which a cut may lie are refined by the next digits, the largest first. So the capacity is that
of the groups themselves, at any number of them, while a round brings a bounded number of atoms to the
driver. Atoms that hold a chosen cut are refined likewise, until they are one group each.

All else is DataFrame work: two aggregates over hash cells and one window per cell, so a group of
copies that holds a third of all rows is numbered by many tasks.

A null text counts as an empty one. A null id is numbered like any other; repeated rows each get a
slot. With fewer groups than shards, some shards stay empty. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmill.llm.common import stash

#: Hexadecimal digits of the MD5 that atoms begin with, and that a refinement adds.
ATOM_DIGITS, MORE_DIGITS = 4, 2
#: Atoms that are refined at once: each becomes at most ``16 ** MORE_DIGITS``.
REFINED = 256
#: Rows of a shard are numbered in so many independent cells.
CELLS = 256


def _stops(prefix: list[int], shards: int, capacity: int) -> int:
    """How many atoms a greedy pass places in that many shards."""
    at = 0
    for _ in range(shards):
        at = bisect_right(prefix, prefix[at] + capacity) - 1
    return at


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The smallest bound on a shard that contiguous shards can keep."""
    prefix = [0, *accumulate(sizes)]
    low, high = max([0, *sizes, -(-prefix[-1] // shards)]), prefix[-1]
    while low < high:
        middle = (low + high) // 2
        if _stops(prefix, shards, middle) == len(sizes):
            high = middle
        else:
            low = middle + 1
    return low


def cut(sizes: list[int], shards: int) -> list[int]:
    """Where shards 1, 2, ... start, as positions in ``sizes``.

    No shard exceeds the smallest capacity. Within that, each is cut nearest to an equal share of
    what is left, so that a single large group does not leave the other shards uneven.
    """
    prefix = [0, *accumulate(sizes)]
    capacity, end = smallest_capacity(sizes, shards), len(sizes)
    earliest = [end]  # earliest[k]: from here on, k shards are enough
    for _ in range(shards):
        earliest.append(bisect_left(prefix, prefix[earliest[-1]] - capacity))
    starts, at = [], 0
    for left in range(shards - 1, 0, -1):
        latest = bisect_right(prefix, prefix[at] + capacity) - 1
        first = max(earliest[left], min(at + 1, end))
        fair = prefix[at] + (prefix[-1] - prefix[at]) / (left + 1)
        stop = bisect_left(prefix, fair)
        if stop > at and (stop > end or fair - prefix[stop - 1] <= prefix[stop] - fair):
            stop -= 1
        at = min(max(stop, first), max(latest, first))
        starts.append(at)
    return starts


class Atom(NamedTuple):
    """Groups whose MD5 begin alike."""

    begins: str
    size: int
    whole: bool  # one group


def _flow(atoms: list[Atom], prefix: list[int], shards: int, capacity: int) -> list[int]:
    """Where a greedy pass ends each shard, in bytes, if atoms of several groups divide freely."""
    ends, at = [], 0
    for _ in range(shards):
        end = min(at + capacity, prefix[-1])
        inside = bisect_right(prefix, end) - 1
        if inside < len(atoms) and atoms[inside].whole:
            end = max(at, prefix[inside])
        ends.append(end)
        at = end
    return ends


def _least_flow(atoms: list[Atom], prefix: list[int], shards: int, high: int) -> int:
    """The smallest capacity if atoms of several groups divide freely."""
    low = max([-(-prefix[-1] // shards), *(a.size for a in atoms if a.whole)])
    while low < high:
        middle = (low + high) // 2
        if _flow(atoms, prefix, shards, middle)[-1] == prefix[-1]:
            high = middle
        else:
            low = middle + 1
    return low


def undecided(atoms: list[Atom], shards: int) -> list[str]:
    """Beginnings of the atoms to refine before the cuts are those of single groups."""
    sizes = [a.size for a in atoms]
    prefix = [0, *accumulate(sizes)]
    high = smallest_capacity(sizes, shards)
    low = _least_flow(atoms, prefix, shards, high)
    if low < high:
        firsts, at = [], 0
        for _ in range(shards):
            at = bisect_right(prefix, prefix[at] + low) - 1
            firsts.append(at)
        lasts = [
            min(bisect_right(prefix, end) - 1, len(atoms) - 1)
            for end in _flow(atoms, prefix, shards, high)
        ]
        near = {i for first, last in zip(firsts, lasts, strict=True) for i in range(first, last + 1)}
    else:
        # The atoms on both sides of a cut.
        near = {i for start in cut(sizes, shards) for i in (start - 1, start)}
    near = [i for i in near if 0 <= i < len(atoms) and not atoms[i].whole]
    near.sort(key=lambda i: (-sizes[i], i))
    return [atoms[i].begins for i in near[:REFINED]]


def _atoms(rows: DataFrame, digits: int, begins: list[str] | None = None) -> list[Atom]:
    """Atoms of so many digits, of all rows or of those that begin so."""
    if begins is not None:
        rows = rows.where(F.left("text_md5", F.lit(len(begins[0]))).isin(begins))
    found = rows.groupBy(F.left("text_md5", F.lit(digits)).alias("begins")).agg(
        F.sum("size").alias("size"), (F.min("text_md5") == F.max("text_md5")).alias("whole")
    )
    return [Atom(*row) for row in found.collect()]


def shard_starts(rows: DataFrame, shards: int, digits: int = ATOM_DIGITS) -> list[str]:
    """What the MD5 of the first group of shards 1, 2, ... begins with."""
    atoms = sorted(_atoms(rows, digits))
    while begins := undecided(atoms, shards) if atoms else []:
        by_length: dict[int, list[str]] = {}
        for name in begins:
            by_length.setdefault(len(name), []).append(name)
        gone = set(begins)
        atoms = [a for a in atoms if a.begins not in gone]
        for length, names in by_length.items():
            atoms += _atoms(rows, min(length + MORE_DIGITS, 32), names)
        atoms.sort()
    names = [a.begins for a in atoms] + ["g"]  # after all hexadecimal digits
    return [names[at] for at in cut([a.size for a in atoms], shards)]


def shard(
    docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``size`` (UTF-8 bytes and 1), ``text_crc32``, ``shard``, ``slot`` of every row."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = stash(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(value) + 1).cast("long").alias("size"),
            F.crc32(value).alias("text_crc32"),
            F.md5(value).alias("text_md5"),
        ).withColumns(
            {"cell": F.pmod(F.xxhash64("key", "text_md5"), F.lit(CELLS)).cast("int")}
        ),
        "shard_rows",
    )
    number = F.lit(0)
    for start in shard_starts(rows, shards):
        number = number + (F.col("text_md5") >= start).cast("int")
    placed = rows.withColumn("shard", number)
    # At most shards * CELLS rows.
    cells = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        "shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("shard", "cell").orderBy("key", "text_md5")
    return (
        placed.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), ["shard", "cell"])
        .select(
            F.col("key").alias(key),
            "size",
            "text_crc32",
            "shard",
            (F.col("offset") + F.col("place")).cast("long").alias("slot"),
        )
    )
