"""Removal of repeated passages: a sampled suffix array over all texts.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in a document with a
smaller id, or earlier in the same one) is removed, all judged on the input.

1. *Sampling.* Of every window of ``LENGTH`` bytes, the k-gram with the smallest hash is its anchor
   (a minimizer; the leftmost of equal ones). Equal windows have equal anchors at equal places, so
   suffixes that start at anchors are enough. An anchor stands for a run of windows; a hash of the
   k-gram and a 128-bit digest of all bytes of the run go through one shuffle by k-gram. A run that
   occurs earlier as a whole is removed at once; a run that is the first of its kind goes on only if
   its k-gram also occurs in other surroundings, and only with the windows whose bytes beside the
   k-gram occur with it there. Hashes only choose what goes on; bytes or digests decide what is equal.
   Runs that recur inside a task are settled there and spread evenly, so a passage that a third of
   all documents share costs a row per task, not per document. K-grams that a hash sample of the
   documents shows to be frequent are dealt by run, not by k-gram, and all their runs go on, so a line
   that a third of all documents hold in surroundings of their own is no task's group.
2. *Suffix array.* The remaining suffixes are dealt by sampled splitters over their leading bytes.
   Each bucket sorts them by multikey quicksort, from the anchor to the right and once more to the
   left; the common prefixes of neighbours in both orders say for every window of every run which
   other runs hold it. The first holder keeps it.
3. *Boundaries.* Windows whose bytes from the anchor on also start a bucket's first or last suffix
   may go on in another bucket. The runs of those that are first in their own are dealt once more, by
   their bytes from the anchor to the left, and compared in these buckets the same way. What may
   go on in others there too is compared across all, by 128-bit digest and pre-aggregated.

Rows with equal ids are documents in the order of a hash of their text; rows equal in both are one
document, and each gets its result. A null id is smaller than all others. A null text is empty.
Long texts are hashed in parts. Memory: one batch of texts, one bucket, the bytes of one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmill.llm.common import pieces, stash

LENGTH = 100
#: Bytes of an anchor's k-gram. Shorter ones are fewer, longer ones recur less by chance.
GRAM = 32
#: Bytes on either side of a k-gram that are hashed: windows that hold them need them elsewhere too.
SIDE = 12
#: Bytes of text that are hashed at once.
BATCH = 500_000
#: A place in a batch, which is at most twice as long and a window more, has so many bits at most.
PLACE_BITS = 24
#: Of so many documents one is looked at to find frequent k-grams.
PROBED = 64
#: Frequent is a k-gram with so many anchors among these, and this share of them: a million at most.
TIMES = 16
SHARE = 1e-6
#: Segments that multikey quicksort leaves to a plain sort.
SMALL = 64

_ODD = 0x9E3779B97F4A7C15
_WORD = 1 << 64


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd number, of its inverse, and a random number per byte."""
    out = []
    for base in (_ODD, pow(_ODD, -1, _WORD)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    noise = np.random.default_rng(7).integers(0, _WORD, 256, np.uint64, endpoint=False)
    return out[0], out[1], noise


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs(data: bytes, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor, in texts that lie one after the other and stop at ``ends``.

    Returns arrays: hash of the k-gram, digest of all bytes of the run in two numbers, hashes of the
    bytes before and behind the k-gram in one number, first and last window, anchor.
    """
    none = (np.zeros(0, np.uint64),) * 4 + (np.zeros(0, np.int64),) * 3
    n = len(data)
    if n < length:
        return none
    size = 1 << max(16, n.bit_length())
    power, inverse, noise = _powers(size)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(noise[np.frombuffer(data, np.uint8)] * power[:n], out=prefix[1:])
    grams = _mixed((prefix[gram:] - prefix[:-gram]) * inverse[: n - gram + 1])
    # The hash in the upper bits, the place in the lower ones: the leftmost of equal hashes wins.
    bits = np.uint64(PLACE_BITS)
    keyed = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    place = _sliding_min(keyed, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))
    # Windows that lie inside one text.
    text_of = np.searchsorted(ends, np.arange(len(place)), "right")
    inside = np.arange(len(place)) + length <= ends[text_of]
    window = np.flatnonzero(inside)
    if not len(window):
        return none
    anchor, text_of = place[window].astype(np.int64), text_of[window]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text_of[1:] != text_of[:-1])]
    first = window[new]
    last = window[np.r_[np.flatnonzero(new)[1:], len(window)] - 1]
    anchor = anchor[new]
    view = memoryview(data)
    # Equal bytes have equal anchors, so the digest of the bytes is that of the run.
    whole = np.frombuffer(
        b"".join(
            blake2b(view[a : b + length], digest_size=16).digest()
            for a, b in zip(first.tolist(), last.tolist(), strict=True)
        ),
        np.uint64,
    ).reshape(-1, 2)
    before = np.maximum(anchor - SIDE, 0)
    left = _mixed((prefix[anchor] - prefix[before]) * inverse[before])
    behind = anchor + gram
    right = _mixed((prefix[np.minimum(behind + SIDE, n)] - prefix[behind]) * inverse[behind])
    half = np.uint64(32)
    sides = left >> half << half | right >> half
    return grams[anchor], whole[:, 0], whole[:, 1], sides, first, last, anchor


def _batches(
    frame: pd.DataFrame, length: int, batch: int
) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of a frame one after the other: bytes, ends, the documents they are of, where in these
    they start. A long text comes in parts: each window lies in one part as a whole.
    """
    data, ends, docs, begins, size = [], [], [], [], 0
    for doc, text in zip(frame["doc"].tolist(), frame["text"], strict=True):
        raw = (text or "").encode()
        for begin in range(0, max(len(raw) - length, 0) + 1, batch):
            data.append(raw[begin : begin + batch + length - 1])
            size += len(data[-1])
            ends.append(size)
            docs.append(doc)
            begins.append(begin)
            if size >= batch:
                yield b"".join(data), np.array(ends), np.array(docs, np.int64), np.array(begins)
                data, ends, docs, begins, size = [], [], [], [], 0
    if size:
        yield b"".join(data), np.array(ends), np.array(docs, np.int64), np.array(begins)


#: The digest of a run in two numbers, and its first window, further windows and bytes before the anchor.
ANCHORS = "gram long, high long, low long, sides long, doc long, place long"


def _sampled(
    frames: Iterator[pd.DataFrame], length: int, gram: int, batch: int
) -> Iterator[pd.DataFrame]:
    """The columns of ``ANCHORS``; ``high`` and ``low`` are null where a run recurs in a batch."""
    for frame in pieces(frames, "text", batch):
        for data, ends, docs, begins in _batches(frame, length, batch):
            grams, high, low, sides, first, last, anchor = runs(data, ends, length, gram)
            if not len(first):
                continue
            text_of = np.searchsorted(ends, first, "right")
            doc = docs[text_of]
            start = first - np.r_[0, ends[:-1]][text_of] + begins[text_of]
            place = start << 16 | (last - first) << 8 | anchor - first
            order = np.lexsort((place, doc, low, high))
            grams, high, low, sides, doc, place = (
                x[order] for x in (grams, high, low, sides, doc, place)
            )
            same = np.r_[False, (high[1:] == high[:-1]) & (low[1:] == low[:-1])]
            leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
            later = same & ((doc != doc[leader]) | (place != place[leader]))
            # Known to occur earlier: any task may take them.
            spread = _mixed(doc.astype(np.uint64) * np.uint64(_ODD) + place.astype(np.uint64))
            yield pd.DataFrame(
                {
                    "gram": np.where(later, spread, grams).view(np.int64),
                    "high": pd.arrays.IntegerArray(high.view(np.int64), later),
                    "low": pd.arrays.IntegerArray(low.view(np.int64), later),
                    "sides": sides.view(np.int64),
                    "doc": doc,
                    "place": place,
                }
            )


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """The order of rows of unsigned words, compared word by word from the left.

    Each step splits a segment of rows that agree so far into those with a smaller, the same, and a
    larger word than a pivot; only the middle part goes on to the next word.
    """
    order = np.arange(len(words))
    stack = [(0, len(words), 0)]
    while stack:
        low, high, depth = stack.pop()
        if high - low < 2 or depth == words.shape[1]:
            continue
        own = order[low:high]
        if high - low <= SMALL:
            order[low:high] = own[np.lexsort(words[own, depth:].T[::-1])]
            continue
        column = words[own, depth]
        pivot = np.sort(column[[0, len(column) // 2, -1]])[1]
        less, same = column < pivot, column == pivot
        a, b = int(less.sum()), int(same.sum())
        order[low:high] = np.concatenate([own[less], own[same], own[column > pivot]])
        stack += [(low, low + a, depth), (low + a, low + a + b, depth + 1), (low + a + b, high, depth)]
    return order


def _matrix(strings: list[bytes], width: int) -> np.ndarray:
    """Rows of bytes, each one more than it is (UTF-8 has no byte 255), with zeros behind the end."""
    out = np.zeros((len(strings), -(-width // 8) * 8), np.uint8)
    for row, own in zip(out, strings, strict=True):
        row[: len(own)] = np.frombuffer(own, np.uint8) + 1
    return out


def _common(matrix: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many bytes each row in order shares with the one before it."""
    rows = matrix[order]
    equal = rows[1:] == rows[:-1]
    shared = np.where(equal.all(1), rows.shape[1], equal.argmin(1)) if len(rows) > 1 else []
    filled = (rows != 0).sum(1)
    return np.minimum(np.r_[0, shared], np.r_[0, np.minimum(filled[1:], filled[:-1])]).astype(np.int64)


def _shared(matrix: np.ndarray, at: int) -> np.ndarray:
    """How many bytes each row shares with one of them."""
    equal = matrix == matrix[at]
    shared = np.where(equal.all(1), matrix.shape[1], equal.argmin(1))
    filled = (matrix != 0).sum(1)
    return np.minimum(shared, np.minimum(filled, filled[at]))


def bucket(rows: pd.DataFrame, length: int = LENGTH) -> np.ndarray:
    """Which windows of which runs occur earlier in the bucket: a flag per row and offset.

    ``right`` holds the bytes from the anchor to the end of the last window, ``left`` those before the
    anchor, from it back to the first window; offset a is the window that starts a bytes before it.
    """
    n = len(rows)
    ahead = rows["ahead"].to_numpy(np.int64)  # of the first window, the largest offset
    behind = ahead - rows["more"].to_numpy(np.int64)  # the smallest; negative if after the anchor
    right = _matrix(list(rows["right"]), length)
    left = _matrix(list(rows["left"]), length)
    by_right = multikey_quicksort(right.view(">u8").astype(np.uint64))
    by_left = multikey_quicksort(left.view(">u8").astype(np.uint64))
    right_common, left_common = _common(right, by_right), _common(left, by_left)
    rank = np.empty(n, np.int64)
    document = rows["doc"].to_numpy(np.int64)
    anchor = rows["start"].to_numpy(np.int64) + ahead
    rank[np.lexsort((anchor, document))] = np.arange(n)
    later = np.zeros((n, int(ahead.max(initial=0)) + 1), bool)
    for a in range(later.shape[1]):
        own = np.flatnonzero((behind <= a) & (a <= ahead))
        if len(own) < 2:
            continue
        kind = np.empty(n, np.int64)
        kind[by_right] = np.cumsum(right_common < length - a)
        side = np.empty(n, np.int64)
        side[by_left] = np.cumsum(left_common < a) if a else 0
        code = kind[own] * (n + 1) + side[own]
        order = np.lexsort((rank[own], code))
        code, own = code[order], own[order]
        head = np.maximum.accumulate(
            np.where(np.r_[True, code[1:] != code[:-1]], np.arange(len(code)), 0)
        )
        first = own[head]
        later[own, a] = (document[own] != document[first]) | (anchor[own] != anchor[first])
    return later


def _marks(rows: pd.DataFrame, later: np.ndarray, length: int) -> pd.DataFrame:
    """Spans that the flagged windows cover, neighbours merged."""
    edge = np.zeros((len(later), 1), bool)
    padded = np.hstack([edge, later, edge])
    row, low = np.nonzero(padded[:, 1:-1] & ~padded[:, :-2])
    _, high = np.nonzero(padded[:, 1:-1] & ~padded[:, 2:])
    anchor = (rows["start"] + rows["ahead"]).to_numpy(np.int64)[row]
    return pd.DataFrame(
        {
            "doc": rows["doc"].to_numpy(np.int64)[row],
            "start": anchor - high,
            "stop": anchor - low + length,
        }
    )


def _open(rows: pd.DataFrame, later: np.ndarray, side: str, length: int) -> np.ndarray:
    """Which windows, first in this bucket, may go on in others: a flag per row and offset.

    Buckets are dealt by the bytes of a side. What starts with the same bytes lies together: it can
    only go on in another bucket if the row at that end of this one starts with them too.
    """
    matrix = _matrix(list(rows[side]), length)
    order = np.lexsort(matrix.view(">u8").astype(np.uint64).T[::-1])
    reach = np.maximum(_shared(matrix, order[0]), _shared(matrix, order[-1]))[:, None]
    ahead = rows["ahead"].to_numpy(np.int64)[:, None]
    behind = ahead - rows["more"].to_numpy(np.int64)[:, None]
    offset = np.arange(later.shape[1])[None, :]
    needed = length - offset if side == "right" else offset
    return ~later & (offset >= behind) & (offset <= ahead) & (needed <= reach)


def _rightwards(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Settle a bucket dealt by ``right``: spans, with ``stop``, and runs of the windows that may go on
    in others, without. The bytes of ``left`` are those before the anchor from right to left.
    """
    whole = [frame for frame in frames if len(frame)]
    if not whole:
        return
    rows = pd.concat(whole, ignore_index=True)
    later = bucket(rows, length)
    yield _marks(rows, later, length).assign(right=None, left=None, more=None, ahead=None)
    still = _open(rows, later, "right", length)
    at = np.flatnonzero(still.any(1))
    if not len(at):
        return
    low = still[at].argmax(1)
    high = still.shape[1] - 1 - still[at, ::-1].argmax(1)
    rows = rows.iloc[at]
    yield pd.DataFrame(
        {
            "right": [own[: length - a] for own, a in zip(rows["right"], low.tolist(), strict=True)],
            "left": [own[:a] for own, a in zip(rows["left"], high.tolist(), strict=True)],
            "doc": rows["doc"].to_numpy(),
            "start": rows["start"].to_numpy() + rows["ahead"].to_numpy() - high,
            "more": high - low,
            "ahead": high,
            "stop": None,
        }
    )


def _leftwards(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Settle a bucket dealt by ``left``: spans without digest, and windows that may go on with theirs."""
    whole = [frame for frame in frames if len(frame)]
    if not whole:
        return
    rows = pd.concat(whole, ignore_index=True)
    later = bucket(rows, length)
    yield _marks(rows, later, length).assign(high=None, low=None)
    still = _open(rows, later, "left", length)
    found = []
    for at in np.flatnonzero(still.any(1)).tolist():
        own = rows.iloc[at]
        text = own["left"][::-1] + own["right"]
        anchor = int(own["start"] + own["ahead"])
        for a in np.flatnonzero(still[at]).tolist():
            first = int(own["ahead"]) - a
            digest = blake2b(text[first : first + length], digest_size=16).digest()
            high, low = np.frombuffer(digest, np.int64).tolist()
            found.append((own["doc"], anchor - a, anchor - a + length, high, low))
    yield pd.DataFrame(found, columns=["doc", "start", "stop", "high", "low"])


def _zipped(texts: pd.Series) -> pd.Series:
    """Texts as compressed bytes: they are shuffled twice."""
    own = zstandard.ZstdCompressor(level=1)
    return texts.map(lambda t: None if t is None else own.compress(t.encode()))


def _raw(value: bytes | None) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value) if value is not None else b""


def _contexts(frames: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """The bytes around the anchors that a document is asked for."""
    for frame in frames:
        found = []
        for doc, value, places in zip(frame["doc"], frame["zipped"], frame["places"], strict=True):
            raw = _raw(value)
            for place in np.asarray(places).tolist():
                start, more, ahead = place >> 16, place >> 8 & 255, place & 255
                anchor = start + ahead
                found.append(
                    (raw[anchor : start + more + length], raw[start:anchor][::-1], doc, start, more, ahead)
                )
        yield pd.DataFrame(found, columns=["right", "left", "doc", "start", "more", "ahead"])


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``key`` and ``text``, and a number ``doc`` in document order.

    An id that is an integer and that no two rows share is that number.
    """
    if rows.schema["key"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        twice = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1 OR key IS NULL")
        if twice.isEmpty():
            return rows.withColumn("doc", F.col("key").cast("long"))
    tied = rows.withColumn("tie", F.xxhash64("text"))
    known = (
        tied.select(F.col("key").alias("own"), F.col("tie").alias("own_tie"))
        .distinct()
        .repartitionByRange("own", "own_tie")
        .sortWithinPartitions("own", "own_tie")
        .withColumn("doc", F.monotonically_increasing_id())
    )
    known = stash(known, "document_numbers")
    return tied.join(
        known, tied["key"].eqNullSafe(known["own"]) & (tied["tie"] == known["own_tie"])
    ).drop("own", "own_tie", "tie")


def _frequent(rows: DataFrame, length: int, gram: int, batch: int) -> DataFrame:
    """K-grams whose runs are too many for one task, by a hash sample of the documents."""
    probed = rows.where(F.pmod(F.xxhash64("doc"), F.lit(PROBED)) == 0)
    counted = (
        probed.mapInPandas(lambda frames: _sampled(frames, length, gram, batch), ANCHORS)
        .rollup("gram")
        .agg(F.count("high").alias("n"))
        .where(F.col("n") >= TIMES)
    )
    counted = stash(counted, "frequent")
    # The row of all k-grams; it is missing if they are too few for any to be frequent.
    total = counted.where("gram IS NULL").first()
    least = SHARE * total["n"] if total else 0
    frequent = counted.where(F.col("gram").isNotNull() & (F.col("n") >= least))
    return frequent.select("gram", F.lit(True).alias("frequent"))


def dealt(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Runs as in ``ANCHORS``, whether their k-gram is frequent, and the ``key`` they are dealt by."""
    batch = BATCH
    anchors = rows.mapInPandas(lambda frames: _sampled(frames, length, gram, batch), ANCHORS)
    frequent = F.broadcast(_frequent(rows, length, gram, batch))
    anchors = anchors.join(frequent, "gram", "left").withColumn(
        "frequent", F.coalesce("frequent", F.lit(False))
    )
    key = F.when(F.col("frequent"), F.xxhash64("high", "low")).otherwise(F.col("gram"))
    return anchors.withColumn("key", key)


def spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc`` and the ``start`` and ``stop`` of spans to remove, from ``doc`` and ``text``."""
    rows = rows.select("doc", "text")
    anchors = dealt(rows, length, gram).repartition("key")
    anchors = anchors.select(
        "key",
        "high",
        "low",
        "frequent",
        "doc",
        "place",
        F.shiftright("sides", 32).alias("left"),
        F.col("sides").bitwiseAND(F.lit(0xFFFFFFFF)).alias("right"),
    )

    def elsewhere(*same: str) -> Column:
        """Whether another run has the same k-gram, and the same bytes beside it; if frequent, yes."""
        among = Window.partitionBy("key", *same)
        differ = [F.min(half).over(among) != F.max(half).over(among) for half in ("high", "low")]
        return F.col("frequent") | differ[0] | differ[1]

    own = F.struct("doc", "place")
    earlier = own != F.min(own).over(Window.partitionBy("key", "high", "low"))
    start = F.shiftright("place", 16)
    more = F.shiftright("place", 8).bitwiseAND(F.lit(255))
    ahead = F.col("place").bitwiseAND(F.lit(255))
    judged = anchors.select(
        "doc",
        "place",
        (F.col("high").isNull() | earlier).alias("later"),
        # A window starts so many bytes before the anchor at most, and at least.
        F.when(elsewhere("left"), ahead).otherwise(F.least(ahead, F.lit(SIDE - 1))).alias("most"),
        F.when(elsewhere("right"), ahead - more)
        .otherwise(F.greatest(ahead - more, F.lit(length - gram - SIDE + 1)))
        .alias("least"),
        elsewhere().alias("many"),
    )
    anchor = start + ahead
    left_over = (
        F.shiftleft(anchor - F.col("most"), 16)
        .bitwiseOR(F.shiftleft(F.col("most") - F.col("least"), 8))
        .bitwiseOR(F.col("most"))
    )
    judged = judged.where("later OR (many AND least <= most)").select(
        "doc", F.when(F.col("later"), F.col("place")).otherwise(left_over).alias("place"), "later"
    )
    judged = stash(judged, "runs")
    known = judged.where("later").select(
        "doc", start.alias("start"), (start + more + length).alias("stop")
    )
    # As many as a document has anchors.
    asked = judged.where("NOT later").distinct()
    asked = asked.groupBy("doc").agg(F.collect_list("place").alias("places"))
    zipped = F.pandas_udf(_zipped, "binary")
    contexts = stash(
        rows.select("doc", zipped("text").alias("zipped"))
        .join(asked, "doc")
        .mapInPandas(
            lambda frames: _contexts(frames, length),
            "right binary, left binary, doc long, start long, more int, ahead int",
        ),
        "suffixes",
    )
    run = "right binary, left binary, doc long, start long, more int, ahead int"
    by_right = stash(
        contexts.repartitionByRange("right", "doc", "start").mapInPandas(
            lambda frames: _rightwards(frames, length), f"{run}, stop long"
        ),
        "runs_at_boundaries",
    )
    settled = stash(
        by_right.where("stop IS NULL")
        .repartitionByRange("left", "doc", "start")
        .mapInPandas(
            lambda frames: _leftwards(frames, length),
            "doc long, start long, stop long, high long, low long",
        ),
        "windows",
    )
    open_ = settled.where("high IS NOT NULL")
    firsts = open_.groupBy("high", "low").agg(F.min(F.struct("doc", "start")).alias("first"))
    firsts = stash(firsts, "first_windows")
    across = open_.join(firsts, ["high", "low"]).where(F.struct("doc", "start") != F.col("first"))
    columns = ["doc", "start", "stop"]
    return (
        known.unionByName(by_right.where("stop IS NOT NULL").select(columns))
        .unionByName(settled.where("high IS NULL").select(columns))
        .unionByName(across.select(columns))
    )


def _kept(raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes go, and in how many runs."""
    if not len(starts):
        return raw, 0, 0
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    first, last = starts[new], reach[np.r_[new[1:], True]]
    edges = zip([0, *last.tolist()], [*first.tolist(), len(raw)], strict=True)
    return b"".join(raw[a:b] for a, b in edges), int((last - first).sum()), len(first)


def dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", as_text: bool = False
) -> DataFrame:
    """``row`` (the input's columns but the text), n_bytes, n_removed, n_spans and kept bytes.

    With ``as_text`` what is kept is text, without characters that have lost some of their bytes.
    """
    others = [F.col(c) for c in docs.columns if c != text]
    rows = _numbered(
        docs.select(F.struct(*others).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    )
    found = (
        spans(rows)
        .groupBy("doc")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        .select(
            "doc",
            F.transform("spans", lambda s: s["start"]).alias("starts"),
            F.transform("spans", lambda s: s["stop"]).alias("stops"),
        )
    )

    def cut(zipped: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
        out = []
        for value, a, b in zip(zipped, starts, stops, strict=True):
            raw = _raw(value)
            a, b = (np.zeros(0, np.int64) if x is None else np.asarray(x) for x in (a, b))
            kept, removed, runs_ = _kept(raw, a, b)
            out.append((len(raw), removed, runs_, kept.decode(errors="ignore") if as_text else kept))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    kind = "string" if as_text else "binary"
    result = F.pandas_udf(cut, f"n_bytes long, n_removed long, n_spans long, kept {kind}")
    zipped = F.pandas_udf(_zipped, "binary")
    joined = rows.select("row", "doc", zipped("text").alias("zipped")).join(found, "doc", "left")
    return joined.select("row", result("zipped", "starts", "stops").alias("result")).select(
        "row", "result.*"
    )


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut from their texts, columns as they are.

    A character that loses some of its bytes goes as a whole. A null text becomes an empty one.
    """
    written = F.col("kept").alias(text)
    return dedup(docs, key, text, as_text=True).select(
        *(written if c == text else F.col("row").getField(c).alias(c) for c in docs.columns)
    )
