"""Counting words and their codes inside tasks, with bounded memory.

Texts come as Arrow batches and are worked on as bytes. A task keeps counts of what it has met and
hands them on whenever they are many, so what is shuffled is pre-aggregated, whatever a text holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once. A longer text is cut at blanks.
SLICE = 4 << 20
#: Distinct keys that a task counts before it hands them on.
KEYS = 1_000_000
_BLANK = re.compile(rb"[ \t]")


def slices(raw: bytes) -> Iterator[bytes]:
    """A text in parts of about ``SLICE`` bytes, cut at a space or tab, which is left out."""
    at, size = 0, SLICE
    while len(raw) - at > size:
        blank = _BLANK.search(raw, at + size)
        if not blank:
            break
        yield raw[at : blank.start()]
        at = blank.end()
    yield raw[at:]


def binary(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8; null as empty."""
    return [raw or b"" for raw in batch.column(name).cast(pa.binary()).to_pylist()]


def coded(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words, and the place of each word among them."""
    places = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return list(places), np.fromiter(map(places.__getitem__, words), np.int64, len(words))


def strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


class KeyCounts:
    """Counts of integer keys."""

    def __init__(self, limit: int = KEYS) -> None:
        self.limit = limit
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found = np.unique(keys, return_counts=True)
        self.parts.append(found)
        self.size += len(found[0])

    def full(self) -> bool:
        """Whether there are many distinct keys, after equal ones are put together."""
        if self.size > 2 * self.limit:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
        return self.size > self.limit

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = np.concatenate([keys for keys, _ in self.parts])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        counts = np.concatenate([counts for _, counts in self.parts])[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else order
        return keys[first], np.add.reduceat(counts, first) if len(keys) else counts

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        found = self.merged()
        self.parts, self.size = [], 0
        return found


def sieve(rows: DataFrame, hashed: Column, bits: int) -> np.ndarray:
    """A bitmap of ``2 ** bits`` slots in which the slot of each row's hash is set.

    Its size does not depend on the rows. A value whose slot is empty is not among them; one whose
    slot is set may be, so what passes has to be looked up afterwards.
    """
    cells = (
        rows.select(hashed.bitwiseAND((1 << bits) - 1).alias("slot"))
        .groupBy(F.expr("shiftright(slot, 6)").alias("cell"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("set"))
        .toArrow()  # rows in Python would take hundreds of megabytes
    )
    found = np.zeros(1 << (bits - 6), np.int64)
    found[cells["cell"].to_numpy()] = cells["set"].to_numpy()
    return found


def passes(found: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Whether the slots of hashes are set in a sieve."""
    slot = hashed & (len(found) * 64 - 1)
    return (found[slot >> 6] >> (slot & 63)) & 1 > 0
