"""Packing of token sequences by best-fit decreasing.

A document's ids are cut into full windows and a rest. Rests are placed from the longest to the
shortest, each in the open window with the least room that is enough; a new window is opened where
none has. Pieces of one length are interchangeable, so the whole placement follows from how many
pieces there are of each length: one number per length, whatever the input. The driver runs
best-fit decreasing over these counts, whole runs of equal windows at a time, with a segment tree
over the room that is left. Its result is a short table of segments: pieces number a to b of a
length go to windows c, c + 1, ... at an offset. The pieces are numbered within their length in
independent cells, more of them the more pieces there are, and looked up in that table, so a length
that a third of all pieces share is numbered by many tasks, and no task sees a window's pieces together.

A null text counts as empty: it has the end id only. Rows with a null or repeated id are packed like
any other. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmill.llm.common import pieces, stash
from salesmill.llm.tokens import ID, REMEMBERED, encoder

WINDOW = 2048
#: Pieces of one length are numbered in so many cells, and one more for each ``CELL_PIECES`` of them.
CELLS = 64
CELL_PIECES = 1_000_000


def cut(
    docs: DataFrame,
    path: str,
    window: int = WINDOW,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The pieces of every row: ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``ids``.

    Without ``with_ids`` the ids stay out of the result; ``start`` and ``length`` name them. A worker
    remembers the ids of ``remembered`` parts of texts, about 200 bytes each.
    """
    schema = "key long, start long, length int, ids_crc32 long, doc_tokens long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, "text", 4_000_000):
            rows = []
            encode = encoder(path, remembered=remembered)
            for key_, ids in zip(frame["key"], encode(list(frame["text"])), strict=True):
                total = len(ids) // ID.itemsize
                for start in range(0, total, window):
                    own = ids[start * ID.itemsize : (start + window) * ID.itemsize]
                    row = (key_, start, len(own) // ID.itemsize, zlib.crc32(own), total)
                    rows.append((*row, np.frombuffer(own, ID).view("<i4")) if with_ids else row)
            names = ["key", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pd.DataFrame(rows, columns=names if with_ids else names[:-1])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInPandas(run, schema + ", ids array<int>" if with_ids else schema)


class Rooms:
    """Segment tree over the room left in open windows: which rooms have any, and the tightest."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def put(self, room: int, first: int, count: int) -> None:
        """Windows ``first`` to ``first + count - 1`` have this room left."""
        if count and room:
            self.runs.setdefault(room, []).append((first, count))
            self._mark(room, True)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            self._mark(room, False)
        return run

    def _mark(self, room: int, value: bool) -> None:
        at = room + self.leaves
        self.any[at] = value
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least``."""
        at = least + self.leaves
        while not self.any[at]:
            while at % 2:  # a right child: go up to one that has something to its right
                at //= 2
            if at == 0:
                return None
            at += 1
            if at & (at - 1) == 0:  # past the last leaf of a level
                return None
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Segments (length, first piece, pieces, first window, offset) for so many pieces of a length."""
    rooms, segments, opened = Rooms(window), [], 0
    for length in sorted(counts, reverse=True):
        first, left = 0, counts[length]

        def fill(base: int, windows: int, room: int, each: int) -> None:
            """``each`` pieces into each of some windows that have ``room`` left."""
            nonlocal first, left
            for j in range(each):
                segments.append((length, first, windows, base, window - room + j * length))
                first += windows
            left -= windows * each
            rooms.put(room - each * length, base, windows)

        while left:
            room = rooms.tightest(length)
            if room is None:
                room = window
                run = (opened, -(-left // (window // length)))
                opened += run[1]
            else:
                run = rooms.take(room)
            base, windows = run
            # Best fit fills one window as far as it goes before it turns to the next.
            each = room // length
            whole = min(windows, left // each)
            if whole:
                fill(base, whole, room, each)
            if left and whole < windows:
                fill(base + whole, 1, room, left)
                whole += 1
            rooms.put(room, base + whole, windows - whole)
    return segments


def cell_count(n: int) -> int:
    """Cells of a length that has n pieces: a cell holds about ``CELL_PIECES`` at any scale."""
    return min(n, CELLS + n // CELL_PIECES)


def pack(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``parts`` (key, start, length and any more columns) with ``sequence_id`` and ``offset``."""
    spark = parts.sparkSession
    # At most one row per length.
    lengths = parts.groupBy("length").agg(F.count("*").alias("n")).collect()
    counts = {r["length"]: r["n"] for r in lengths}
    cells = spark.createDataFrame(
        [(length, cell_count(n)) for length, n in counts.items()], "_of int, _cells long"
    )
    own_cell = F.pmod(F.xxhash64("key", "start"), F.col("_cells"))
    rows = (
        parts.join(F.broadcast(cells), F.col("length") == F.col("_of"))
        .withColumn("_cell", own_cell)
        .drop("_of", "_cells")
    )
    counted = rows.groupBy("length", "_cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most CELLS rows per length, and one per CELL_PIECES pieces.
    offsets = counted.select(
        "length", "_cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_ahead")
    )
    inside = Window.partitionBy("length", "_cell").orderBy("key", "start")
    numbered = (
        rows.withColumn("_own", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), ["length", "_cell"])
        .withColumn("_rank", F.col("_ahead") + F.col("_own"))
        .drop("_cell", "_own", "_ahead")
    )
    # A few segments per length.
    segments = spark.createDataFrame(
        best_fit(counts, window),
        "_length int, _first long, _pieces long, _window long, _offset long",
    )
    return numbered.join(
        F.broadcast(segments),
        (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("_first"))
        & (F.col("_rank") < F.col("_first") + F.col("_pieces")),
    ).select(
        *parts.columns,
        (F.col("_window") + F.col("_rank") - F.col("_first")).alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )


def packed(docs: DataFrame, path: str, window: int = WINDOW, **options) -> DataFrame:
    """The pieces of all documents without their ids, placed; ``options`` are those of ``cut``."""
    return pack(stash(cut(docs, path, window, with_ids=False, **options), "pieces"), window)


def sequences(placed: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """``sequence_id`` and its ``ids``, padded to the window, from placed pieces with ids."""
    filled = placed.groupBy("sequence_id").agg(
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]
            )
        ).alias("ids")
    )
    rest = F.array_repeat(F.lit(pad), F.lit(window) - F.size("ids"))
    return filled.select("sequence_id", F.concat("ids", rest).alias("ids"))
