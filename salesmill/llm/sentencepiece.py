"""Sampled SentencePiece segmentations and their lossless decoding.

All ways to write a text with the pieces of a vocabulary form a lattice. A segmentation is drawn from
it in two passes: forward filtering sums the weights of all paths up to each character, backward
sampling walks from the end and picks each piece in proportion to the paths behind it. So every
segmentation is drawn with its own probability, and its random numbers depend on nothing but the
seed, the row's key, and the place in the text: partitions, batches and repeated tasks do not matter.

No piece crosses a blank, a line break or (checked on loading) the border between letters and other
characters, so the lattice of a text is a row of small ones. The filtered lattices of parts that
recur are kept by each worker and sampled for all their occurrences in a batch at once.

The vocabulary holds merges by rank, not probabilities; the piece of rank r weighs
``(r + 10) ** -sharpness``. A character without a piece, and U+2581 itself (which stands for a blank
in pieces), is written as its UTF-8 bytes, so decoding returns every text as it was.

A null or empty text has no ids and decodes to an empty text. Rows with equal keys and texts get equal
ids. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.llm.common import pieces

BLANK = "▁"
SHARPNESS = 2.0
#: log weight of a character that is written as bytes.
BYTES_WEIGHT = -40.0
#: Edges of filtered lattices that a worker keeps, 13 bytes each. The parts of one batch must all be
#: there at once, so a worker has room for this many and for those of a batch.
EDGES = 14_000_000
#: Characters of a batch, and of the parts that are filtered together.
BATCH, FILTERED = 1_000_000, 60_000
#: Parts of a text that are worked on at once; a longer text goes over several batches.
PARTS = 50_000
_ROW, _PART, _STEP = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BASE = np.uint64(0x100000001B3)
_TABLE_BITS = 18

# Letters are what \w has besides digits, underscores and the numbers among Latin signs.
_OTHER = r"\d_\u00b2\u00b3\u00b9\u00bc-\u00be"
_FINE = re.compile(rf" *[^\W{_OTHER}]+| *(?:[^\w \n]|[{_OTHER}])+| +|\n")
_COARSE = re.compile(r" *[^ \n]+| +|\n")


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Column:
    """An array that grows in place."""

    def __init__(self, kind: type) -> None:
        self.data, self.size = np.empty(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.data):
            # In place where the system can, without a second copy beside the first.
            self.data.resize(max(end, len(self.data) * 5 // 4), refcheck=False)
        self.data[self.size : end] = more
        self.size = end


class Vocabulary:
    """Pieces, weights and bytes of a model file, and filtered lattices of parts."""

    def __init__(self, path: str, sharpness: float = SHARPNESS) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        ids = range(self.size)
        names = [model.id_to_piece(i) for i in ids]
        plain = [
            i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.written: list[bytes] = [b""] * self.size
        for i in plain:
            self.written[i] = names[i].replace(BLANK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.written[i] = bytes([b])
        self.longest = max(len(names[i]) for i in plain)
        self.ids = {names[i].replace(BLANK, " "): i for i in plain}
        self.weight = np.full(self.size, -np.inf)
        for i in plain:
            self.weight[i] = -sharpness * math.log(10 - model.get_score(i))
        self._index([(self._hash(name), i) for name, i in self.ids.items()])
        if any("\n" in name for name in self.ids):
            raise ValueError("pieces that hold a line break are not supported")
        fits = [all(map(parts.fullmatch, self.ids)) for parts in (_FINE, _COARSE)]
        if not any(fits):
            raise ValueError("pieces that cross a blank are not supported")
        self.parts = _FINE if fits[0] else _COARSE
        self._forget()

    @staticmethod
    def _hash(name: str) -> int:
        h = 0
        for c in name:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _index(self, entries: list[tuple[int, int]]) -> None:
        """Hash tables of pieces: each has its place in the first one where that is free."""
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        factor = 1
        while entries:
            factor = factor * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
            hashes = np.zeros(1 << _TABLE_BITS, np.uint64)
            ids = np.full(1 << _TABLE_BITS, -1)
            rest = []
            for h, i in entries:
                at = (h * factor & 0xFFFFFFFFFFFFFFFF) >> (64 - _TABLE_BITS)
                if ids[at] >= 0:
                    rest.append((h, i))
                else:
                    hashes[at], ids[at] = h, i
            self.tables.append((np.uint64(factor), hashes, ids))
            entries = rest

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The id of the piece with each hash, or -1."""
        found = np.full(len(h), -1)
        for factor, hashes, ids in self.tables:
            at = (h * factor) >> np.uint64(64 - _TABLE_BITS)
            hit = hashes[at] == h
            found[hit] = ids[at[hit]]
        return found

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        #: Of each known part: the state of its end (one per character, in order) and its length.
        self.ends, self.sizes = _Column(np.int32), _Column(np.int32)
        self.states = 0
        self.first = _Column(np.int32)  # of the edges into each state, the likeliest
        self.cum = _Column(np.float64)  # probability of an edge and those before it
        self.edge_id, self.edge_len = _Column(np.int32), _Column(np.uint8)

    def _filter(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lattices of parts of one length (rows of code points).

        Where the edges of each state start; cumulative probability, id and length of each edge.
        """
        n, size = codes.shape
        prefix = np.zeros((n, size + 1), np.uint64)
        for j in range(size):
            prefix[:, j + 1] = prefix[:, j] * _BASE + codes[:, j] + np.uint64(1)
        power = [np.uint64(pow(int(_BASE), k, 1 << 64)) for k in range(self.longest + 1)]
        alpha = np.full((n, size + 1), -np.inf)
        alpha[:, 0] = 0
        found = []
        for j in range(1, size + 1):
            lengths = range(1, min(j, self.longest) + 1)
            score, ids = np.full((n, len(lengths)), -np.inf), np.full((n, len(lengths)), -1)
            for k, length in enumerate(lengths):
                h = prefix[:, j] - prefix[:, j - length] * power[length]
                own = self._find(h)
                hit = own >= 0
                if length == 1:  # every character has an edge of its own
                    hit &= codes[:, j - 1] != ord(BLANK)
                    own = np.where(hit, own, self.size + codes[:, j - 1].astype(np.int64))
                    weight = np.where(hit, self.weight[np.where(hit, own, 0)], BYTES_WEIGHT)
                    hit = np.ones(n, bool)
                else:
                    weight = self.weight[own]
                score[:, k] = np.where(hit, alpha[:, j - length] + weight, -np.inf)
                ids[:, k] = np.where(hit, own, -1)
            top = score.max(1)
            share = np.exp(score - top[:, None])
            total = share.sum(1)
            alpha[:, j] = top + np.log(total)
            row, k = np.nonzero(ids >= 0)
            found.append((row * size + j - 1, (share / total[:, None])[row, k], ids[row, k], k + 1))
        state, share, ids, length = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((length, -share, state))
        state, share = state[order], share[order]
        first = np.flatnonzero(np.r_[True, state[1:] != state[:-1]])
        rising = np.cumsum(share)
        rising -= np.repeat(rising[first] - share[first], np.diff(np.r_[first, len(state)]))
        rising[np.r_[first[1:], len(state)] - 1] = 1.0
        return first, rising, ids[order], length[order]

    def learn(self, new: list[str]) -> None:
        """Filter the lattices of parts."""
        by_length: dict[int, list[str]] = {}
        for part in new:
            by_length.setdefault(len(part), []).append(part)
        for size, alike in by_length.items():
            step = max(1, FILTERED // size)
            for at in range(0, len(alike), step):
                self._learn(alike[at : at + step], size)

    def _learn(self, parts: list[str], size: int) -> None:
        raw = "".join(parts).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, "<u4").reshape(-1, size)
        first, rising, own, length = self._filter(codes.astype(np.uint64))
        self.first.add(first + self.cum.size)
        self.cum.add(rising)
        self.edge_id.add(own)
        self.edge_len.add(length)
        names = range(len(self.known), len(self.known) + len(parts))
        self.known.update(zip(parts, names, strict=True))
        self.ends.add(self.states + np.arange(1, len(parts) + 1) * size - 1)
        self.sizes.add(np.full(len(parts), size))
        self.states += len(parts) * size

    def cut(self, text: str | None) -> Iterator[list[str]]:
        """The parts of a text, some at a time; no list for an empty text."""
        if not text:
            return
        if len(text) <= PARTS:
            yield self.parts.findall(" " + text)
            return
        found = self.parts.finditer(" " + text)
        while parts := [match[0] for match in islice(found, PARTS)]:
            yield parts

    def sample(
        self, cut: list[list[str]], keys: np.ndarray, seed: int, places: np.ndarray
    ) -> list[np.ndarray]:
        """Ids of each list of parts, drawn with the random numbers of its key and its first place."""
        new = set().union(*cut).difference(self.known)
        if new:
            if self.cum.size > EDGES:
                self._forget()
                new = set().union(*cut)
            self.learn(sorted(new))
        ends, sizes = self.ends.data, self.sizes.data
        cum, firsts, edge_ids, edge_lens = (
            column.data for column in (self.cum, self.first, self.edge_id, self.edge_len)
        )
        counts = np.array([len(parts) for parts in cut])
        known = self.known
        part_of = np.array([known[part] for parts in cut for part in parts], np.int64)
        end, size = ends[part_of].astype(np.int64), sizes[part_of].astype(np.int64)
        starts = np.cumsum(counts) - counts
        place = np.arange(len(end)) + np.repeat(places - starts, counts)
        row = _mix((keys.astype(np.uint64) ^ np.uint64(seed & 0xFFFFFFFFFFFFFFFF)) + _ROW)
        stream = np.repeat(row, counts) + place.astype(np.uint64) * _PART
        left, live = size.copy(), np.arange(len(end))
        steps, drawn = 0, []
        while len(live):
            random = _mix(stream[live] + np.uint64((steps + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
            state = end[live] - size[live] + left[live]
            u = (random >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = firsts[state]
            beyond = np.flatnonzero(cum[edge] <= u)
            while len(beyond):
                edge[beyond] += 1
                beyond = beyond[cum[edge[beyond]] <= u[beyond]]
            drawn.append((live, edge_ids[edge]))
            left[live] -= edge_lens[edge]
            live = live[left[live] > 0]
            steps += 1
        per_part = np.zeros(len(end), np.int64)
        for live, _ in drawn:
            per_part[live] += 1
        stop = np.cumsum(per_part)
        ids = np.empty(stop[-1] if len(stop) else 0, np.int64)
        for step, (live, own) in enumerate(drawn):
            ids[stop[live] - 1 - step] = own  # the walk goes backwards
        ascii_ = (ids >= self.size) & (ids < self.size + 128)
        ids[ascii_] = self.byte_ids[ids[ascii_] - self.size]
        bounds = np.r_[0, stop][np.r_[starts, len(end)]]
        return [self._spell(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def _spell(self, ids: np.ndarray) -> np.ndarray:
        """Characters without a piece as the ids of their bytes; ASCII is done before."""
        for at in np.flatnonzero(ids >= self.size)[::-1]:
            own = np.frombuffer(chr(ids[at] - self.size).encode("utf-8", "surrogatepass"), np.uint8)
            ids = np.r_[ids[:at], self.byte_ids[own], ids[at + 1 :]]
        return ids.astype(np.int32)

    def spell(self, ids: np.ndarray) -> bytes:
        """What the ids write, after the blank that every text begins with."""
        written = self.written
        return b"".join([written[i] for i in ids.tolist()])

    def text(self, ids: np.ndarray) -> str:
        return self.spell(ids).decode("utf-8", "replace")[1:]


@cache
def vocabulary(path: str, sharpness: float = SHARPNESS) -> Vocabulary:
    """One per worker process and model."""
    return Vocabulary(path, sharpness)


def _batches(
    own: Vocabulary, texts: Iterator[tuple[int, str | None]]
) -> Iterator[tuple[list[int], list[list[str]], list[int]]]:
    """Rows, their parts, and the place of the first of these parts, about ``BATCH`` characters."""
    rows: list[int] = []
    cut: list[list[str]] = []
    places: list[int] = []
    size = 0
    for row, text in texts:
        place = 0
        for parts in own.cut(text):
            rows.append(row)
            cut.append(parts)
            places.append(place)
            place += len(parts)
            size += sum(map(len, parts))
            if size > BATCH:
                yield rows, cut, places
                rows, cut, places, size = [], [], [], 0
    if rows:
        yield rows, cut, places


def _drawn(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(key)).alias("draw")
    )


def encode(
    docs: DataFrame,
    path: str,
    seed: int = 0,
    sharpness: float = SHARPNESS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, ``text`` and ``ids`` (a sampled segmentation) of every row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = vocabulary(path, sharpness)
        for frame in pieces(frames, "text", BATCH):
            draws = frame["draw"].to_numpy(np.int64)
            found: list[list[np.ndarray]] = [[np.zeros(0, np.int32)] for _ in draws]
            texts = enumerate(t if isinstance(t, str) else "" for t in frame["text"])
            for rows, cut, places in _batches(own, texts):
                drawn = own.sample(cut, draws[rows], seed, np.array(places))
                for row, ids in zip(rows, drawn, strict=True):
                    found[row].append(ids)
            frame["ids"] = [np.concatenate(ids) for ids in found]
            yield frame[["key", "text", "ids"]]

    rows = _drawn(docs, key, text)
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInPandas(run, f"key {kind}, text string, ids array<int>")


def round_trip(
    docs: DataFrame,
    path: str,
    seed: int = 0,
    sharpness: float = SHARPNESS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """What ``encode`` and ``decode`` make of every row, in one pass that keeps no ids.

    ``key``, ``n_tokens``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers),
    ``text_crc32`` of the decoded text, and whether it equals the text (``lossless``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path, sharpness)
        for batch in batches:
            n = batch.num_rows
            draws = batch.column("draw").to_numpy()
            tokens, ids_crc, text_crc, lossless = [0] * n, [0] * n, [0] * n, [True] * n
            texts = enumerate(value.as_py() for value in batch.column("text"))
            for rows, cut, places in _batches(own, texts):
                drawn = own.sample(cut, draws[rows], seed, np.array(places))
                for row, parts, place, ids in zip(rows, cut, places, drawn, strict=True):
                    written, blank = own.spell(ids), place == 0
                    tokens[row] += len(ids)
                    ids_crc[row] = zlib.crc32(ids.astype("<u4").tobytes(), ids_crc[row])
                    text_crc[row] = zlib.crc32(written[blank:], text_crc[row])
                    lossless[row] &= written == "".join(parts).encode()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    *(pa.array(x, pa.int64()) for x in (tokens, ids_crc, text_crc)),
                    pa.array(lossless),
                ],
                ["key", "n_tokens", "ids_crc32", "text_crc32", "lossless"],
            )

    rows = _drawn(docs, key, text)
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"key {kind}, n_tokens long, ids_crc32 long, text_crc32 long, lossless boolean"
    )


def decode(path: str):
    """A function on columns: the text that a column of ids writes."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        own = vocabulary(path)
        return ids.map(lambda row: own.text(np.asarray(row)))

    return run
