"""SimHash near-duplicates: documents whose fingerprints differ in a few bits, and their components.

Fingerprints: texts are lower-cased in A-Z, cut into words, and every run of four words (or the whole
text, if shorter) votes with its XXH64 on each of 64 bits. Equal fingerprints are one class, named by
its smallest document; all further work is on classes.

Links: a self-join of binary tries. Two fingerprints that differ in at most four bits agree on at
least one of five blocks of bits, so each class is dealt to five tries, each under the value of one
block. A value that too many classes share is dealt again, by five blocks of its remaining bits, and
so on until every trie is bounded; a trie that agrees on all but b bits has 2**b members at most.
Inside a trie, pairs of nodes are walked down together from the root; each pair carries the number
of bits that already differ and is dropped as soon as they exceed the budget, or when all leaves
below it are known to be connected. A trie returns no pairs but at most one link for each member,
to the smallest one it is connected with, so a large group costs what it has members.

Defined results: a null, empty or blank text has no shingle and fingerprint zero, and is linked like
any other. Rows with a repeated id each get a row; a null id is never the smallest. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmill.llm.common import pieces, stash
from salesmill.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
#: A block value that more classes share than this is dealt again by its remaining bits.
TRIE_MEMBERS = 20_000
#: Node pairs that a walk expands at once.
PAIRS = 200_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    from xxhash import xxh64_intdigest

    # On bytes, lower() changes A-Z only and split() cuts at the six ASCII blanks.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(ends + 1).tolist()]
    ends = [*ends.tolist(), len(joined)]
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 16):
        hashes = np.array(
            [
                xxh64_intdigest(joined[a:b], SEED)
                for a, b in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)], strict=True)
            ],
            ">u8",
        )
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts)).view(">u8")[0])


def fingerprints(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """``key`` and ``fp`` (signed) of every row, and ``more`` of its columns."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [fingerprint(t, shingle) for t in frame["text"]]
            frame["fp"] = np.array(found, np.uint64).view(np.int64)
            yield frame[["key", "fp", *more]]

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *more)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    others = "".join(f", {name} {kinds[name]}" for name in more)
    return rows.mapInPandas(run, f"key {kinds['key']}, fp long{others}")


def _blocks(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` as ``parts`` masks, from the highest bit down."""
    bits = [1 << i for i in reversed(range(BITS)) if free >> i & 1]
    return [sum(found) for found in (bits[j::parts] for j in range(parts)) if found]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def trie_links(
    group: np.ndarray, fp: np.ndarray, distance: int = DISTANCE
) -> tuple[np.ndarray, np.ndarray]:
    """For each member (sorted by group and unsigned fingerprint), the first one of its component.

    Components are those of links of at most ``distance`` bits inside a group. Returns positions of
    members that are not the first of theirs, and the positions of those first ones.
    """
    n = len(fp)
    label = np.arange(n)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], n] if n else starts
    more = ends - starts > 1
    starts, ends = starts[more], ends[more]
    # How many of the members before a position have the bit, for each bit: where a node splits.
    shift = np.arange(BITS - 1, -1, -1, dtype=np.uint64)
    stack = [(0, starts, ends, starts, ends, np.zeros(len(starts), np.int64))]
    ones: dict[int, np.ndarray] = {}

    def before(level: int) -> np.ndarray:
        if level not in ones:
            bit = (fp >> shift[level]) & np.uint64(1)
            ones[level] = np.r_[0, np.cumsum(bit.astype(np.int64))]
        return ones[level]

    def join(a: np.ndarray, b: np.ndarray) -> None:
        """Connect members pairwise."""
        nonlocal label
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:  # every label straight to its root
                up = label[label]
                if (up == label).all():
                    break
                label = up

    while stack:
        level, alo, ahi, blo, bhi, off = stack.pop()
        # Known to be connected below: nothing to find.
        turn = np.r_[0, np.cumsum(label[1:] != label[:-1])] if n else label
        known = (
            (turn[ahi - 1] == turn[alo]) & (turn[bhi - 1] == turn[blo]) & (label[alo] == label[blo])
        )
        if known.any():
            live = ~known
            alo, ahi, blo, bhi, off = (x[live] for x in (alo, ahi, blo, bhi, off))
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            a, b = alo[single], blo[single]
            near = np.bitwise_count(fp[a] ^ fp[b]) <= distance
            join(a[near], b[near])
            live = ~single
            alo, ahi, blo, bhi, off = (x[live] for x in (alo, ahi, blo, bhi, off))
        if not len(alo):
            continue
        if len(alo) > PAIRS:
            for at in range(0, len(alo), PAIRS):
                part = slice(at, at + PAIRS)
                stack.append((level, alo[part], ahi[part], blo[part], bhi[part], off[part]))
            continue
        count = before(level)
        amid = ahi - (count[ahi] - count[alo])
        bmid = bhi - (count[bhi] - count[blo])
        same = alo == blo  # a node with itself
        sides = (
            (alo, amid, blo, bmid, off, None),
            (amid, ahi, bmid, bhi, off, None),
            (alo, amid, bmid, bhi, off + 1, None),
            (amid, ahi, blo, bmid, off + 1, ~same),
        )
        near_pairs, far_pairs = [], []
        for k, (x0, x1, y0, y1, bits, allowed) in enumerate(sides):
            good = (x1 > x0) & (y1 > y0) & (bits <= distance)
            if allowed is not None:
                good &= allowed
            good &= ~((x0 == y0) & (x1 - x0 == 1))  # a member with itself
            (near_pairs if k < 2 else far_pairs).append(
                tuple(x[good] for x in (x0, x1, y0, y1, bits))
            )
        # In a crowd, pairs that differ less are walked first: what they connect saves walks.
        crowd = sum(len(pairs[0]) for pairs in near_pairs + far_pairs) > PAIRS
        for found in (far_pairs, near_pairs) if crowd else (near_pairs + far_pairs,):
            joined = [np.concatenate(column) for column in zip(*found, strict=True)]
            if len(joined[0]):
                stack.append((level + 1, *joined))
    far = np.flatnonzero(label != np.arange(n))
    return far, label[far]


def _walk(frames: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Links inside each group of rows sorted by group; groups that end are walked at once."""
    rest: pd.DataFrame | None = None

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
        key = rows["trie"].to_numpy(np.int64)
        value = rows["value"].to_numpy(np.int64)
        order = np.lexsort((fp, value, key))
        fp, key, value = fp[order], key[order], value[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (value[1:] != value[:-1])]
        far, first = trie_links(np.cumsum(new), fp, distance)
        return pd.DataFrame({"a": fp[far].view(np.int64), "b": fp[first].view(np.int64)})

    for frame in frames:
        if frame.empty:
            continue
        rows = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        last = (rows["trie"] == rows["trie"].iloc[-1]) & (rows["value"] == rows["value"].iloc[-1])
        done, rest = rows[~last.to_numpy()], rows[last.to_numpy()]
        if len(done):
            yield links(done)
    if rest is not None and len(rest):
        yield links(rest)


def near_links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints ``fp`` within ``distance`` bits."""
    spark = classes.sparkSession
    full = (1 << BITS) - 1
    found = None
    # Members of a trie agree on the bits ``trie``, where they all have ``value``.
    rows, agreed = classes.select("fp", F.lit(0).cast("long").alias("agreed")), [0]
    while agreed:
        masks = [
            (bits, _signed(bits & full | block))
            for bits in agreed
            for block in _blocks(full & ~bits, distance + 1)
        ]
        masks = spark.createDataFrame(masks, "agreed long, trie long")
        named = rows.join(F.broadcast(masks), "agreed").select(
            "fp", "trie", F.col("fp").bitwiseAND(F.col("trie")).alias("value")
        )
        counts = named.groupBy("trie", "value").agg(F.count("*").alias("n"))
        crowded = stash(counts.where(F.col("n") > TRIE_MEMBERS).select("trie", "value"), "crowded")
        # Each level agrees on a fifth more of the bits that are left: a few masks at most.
        agreed = [r.trie for r in crowded.select("trie").distinct().collect()]
        rows = None
        if agreed:
            apart = named.join(crowded, ["trie", "value"], "left_semi")
            rows = stash(apart.select("fp", F.col("trie").alias("agreed")), "dealt")
            named = named.join(crowded, ["trie", "value"], "left_anti")
        walked = (
            named.repartition("trie", "value")
            .sortWithinPartitions("trie", "value")
            .mapInPandas(lambda frames: _walk(frames, distance), "a long, b long")
        )
        found = walked if found is None else found.unionByName(walked)
    return found


def _named(rows: DataFrame, distance: int, least: Column) -> DataFrame:
    """``fp``, ``root`` (of its component) and ``first`` (the least of the component) of all ``fp``."""
    classes = stash(rows.groupBy("fp").agg(F.min(least).alias("least")), "classes")
    roots = stash(components(near_links(classes, distance)), "roots")
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    first = stash(named.groupBy("root").agg(F.min("least").alias("first")), "smallest")
    return stash(named.select("fp", "root").join(first, "root"), "known")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    rows = stash(fingerprints(docs, key, text, shingle), "fingerprints")
    known = _named(rows, distance, F.col("key")).select("fp", F.col("first").alias("component_id"))
    return rows.join(known, "fp").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One row of each component, the one with the smallest id; columns as they are.

    What is kept or dropped are rows, not ids: rows that share an id stay beside each other if their
    texts are not alike. Among rows of a component with the same smallest id, that with the smallest
    MD5 of the text stays, then one by a hash of all its columns; of wholly equal rows, one. A row
    without an id comes after all others of its component.
    """
    every = F.xxhash64(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))
    marks = {"_sim_digest": F.md5(F.coalesce(F.col(text), F.lit(""))), "_sim_mark": every}
    marked = docs.withColumns(marks)
    rows = stash(fingerprints(marked, key, text, shingle, tuple(marks)), "fingerprints")
    least = F.struct(F.col("key").isNull().alias("unnamed"), "key", *marks)
    firsts = _named(rows, distance, least).select("root", "first").distinct()
    firsts = firsts.select(*(F.col(f"first.{c}").alias(c) for c in ("key", *marks)))
    # As many as documents that stay: they have no bound, so they are not broadcast at any size.
    counts = rows.groupBy("key", *marks).agg(F.count("*").alias("n"))
    on = F.expr(" AND ".join(f"a.{c} <=> b.{c}" for c in ("key", *marks)))
    kept = firsts.alias("a").hint("merge").join(counts.alias("b"), on)
    kept = stash(kept.select("b.*").withColumnsRenamed({c: f"{c}_" for c in ("key", *marks)}), "kept")

    def staying(which: str) -> DataFrame:
        own = kept.where(which).hint("merge")
        same = marked[key].eqNullSafe(own["key_"])
        for c in marks:
            same = same & (marked[c] == own[f"{c}_"])
        return marked.join(own, same, "left_semi").drop(*marks)

    if kept.where("n > 1").isEmpty():
        return staying("n = 1")
    return staying("n = 1").unionByName(staying("n > 1").dropDuplicates())
