"""Near-duplicate vectors by product quantisation, with links checked by exact cosine.

Equal vectors are one class. A bounded sample fits coarse centroids and, on what is left after the
nearest centroid, one codebook per subspace. Every class lives in the list of its nearest centroid,
with its codes and the exact length of its quantisation error, and visits the lists of its
``PROBES`` nearest centroids. Where a visitor meets a list, its distances to all codewords make a
table; sums of table entries are its distances to the decoded members. By the triangle inequality a
member can only be within the wanted distance if its decoded distance minus its error is, so the
table drops none that the exact cosine in double precision, taken of the rest, would accept.

A list meets its visitors in blocks of at most ``BLOCK`` members and as many visitors, so a list that
holds a third of all vectors is many tasks. A block returns no pairs: for each of its vectors the
number of links, and one edge to the smallest vector it is connected with. Of a pair whose two lists
are different, each side counts its own visit; a member also counts a visitor whose list it does not
visit itself, so a link counts on both sides if either finds it.

Defined results: a vector that is null, empty or zero or holds null or non-finite components has no
link and is a component of its own. Vectors of different lengths are never linked. Rows with a
repeated id are vectors of their own; a null id is never the smallest. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmill.llm.common import stash
from salesmill.llm.components import components

COSINE = 0.95
#: The index is fitted on about so many classes, picked by hash; at most twice as many.
SAMPLE = 8192
#: Lists grow with the square root of the classes, between these bounds, so that a list and its
#: visitors grow no faster.
LISTS, MOST_LISTS = 512, 4096
#: Centroids are no closer than this, so that a dense group does not fall apart into many lists.
CENTROID_COSINE = 0.7
PROBES = 10
SUBSPACES, CODES = 8, 64
BLOCK = 2048


def _unit(vectors: list) -> np.ndarray:
    m = np.array([np.asarray(v, np.float64) for v in vectors])
    m = m / np.abs(m).max(1, keepdims=True)  # squares of tiny or huge components stay finite
    return m / np.sqrt((m * m).sum(1))[:, None]


def _kmeans(points: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids of points, started from evenly spaced ones; deterministic."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = (points @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        size = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


@dataclass(frozen=True)
class Index:
    """Unit coarse centroids, and one codebook per subspace for residuals."""

    coarse: np.ndarray
    bounds: np.ndarray
    books: list[np.ndarray]

    @staticmethod
    def fit(units: np.ndarray, lists: int = LISTS) -> Index:
        chosen: list[int] = []
        free = np.full(len(units), -1.0)
        for i in range(len(units)):
            if free[i] < CENTROID_COSINE and len(chosen) < lists:
                chosen.append(i)
                free = np.maximum(free, units @ units[i])
        coarse = units[chosen]
        residual = units - coarse[(units @ coarse.T).argmax(1)]
        bounds = np.linspace(0, units.shape[1], min(SUBSPACES, units.shape[1]) + 1).astype(int)
        books = [_kmeans(residual[:, a:b], CODES) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return Index(coarse, bounds, books)

    def subspaces(self):
        return zip(self.bounds[:-1], self.bounds[1:], self.books, strict=True)

    def probes(self, units: np.ndarray) -> np.ndarray:
        """The nearest lists of each vector, its own first."""
        k = min(PROBES, len(self.coarse))
        return np.argsort(-(units @ self.coarse.T), axis=1, kind="stable")[:, :k]

    def code(self, units: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of what is left after the centroid, and the length of the error."""
        residual = units - self.coarse[lists]
        codes, error = [], np.zeros(len(units))
        for a, b, book in self.subspaces():
            part = residual[:, a:b]
            own = (part @ book.T - 0.5 * (book**2).sum(1)).argmax(1)
            codes.append(own)
            error += ((part - book[own]) ** 2).sum(1)
        return np.stack(codes, 1).astype(np.int16), np.sqrt(error)

    def tables(self, units: np.ndarray, at: int) -> list[np.ndarray]:
        """Squared distances of each visitor's residual to the codewords of each subspace."""
        residual = units - self.coarse[at]
        return [
            ((residual[:, a:b, None] - book.T[None]) ** 2).sum(1) for a, b, book in self.subspaces()
        ]


def links(
    index: Index, at: int, visitors: np.ndarray, members: np.ndarray, codes: np.ndarray,
    errors: np.ndarray, cosine: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (visitor, member) of one list with at least that cosine."""
    reach = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9 + errors
    found = []
    for start in range(0, len(visitors), 256):
        own = visitors[start : start + 256]
        squared = np.zeros((len(own), len(members)))
        for table, code in zip(index.tables(own, at), codes.T, strict=True):
            squared += table[:, code]
        v, m = np.nonzero(squared <= reach**2)
        exact = np.einsum("ij,ij->i", own[v], members[m]) >= cosine
        found.append((v[exact] + start, m[exact]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _connect(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each of n."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while (up := label[label]).tolist() != label.tolist():
            label = up


def _block(index: Index, cosine: float, rows: pd.DataFrame) -> pd.DataFrame:
    """Links of the visitors of a block with its members."""
    visits = rows["visits"].to_numpy(bool)
    inside, outside = rows[~visits], rows[visits]
    empty = pd.DataFrame({name: pd.Series(dtype=object) for name in ("cid", "links", "root")})
    if inside.empty or outside.empty:
        return empty
    members, visitors = _unit(list(inside["vector"])), _unit(list(outside["vector"]))
    codes = np.stack([np.asarray(c) for c in inside["codes"]])
    at = int(rows["list"].iloc[0])
    v, m = links(index, at, visitors, members, codes, inside["error"].to_numpy(float), cosine)
    names = np.r_[outside["cid"].to_numpy(str), inside["cid"].to_numpy(str)]
    other = names[v] != names[len(outside) + m]
    v, m = v[other], m[other]
    if not len(v):
        return empty
    n_v, n_m = outside["n"].to_numpy(np.int64), inside["n"].to_numpy(np.int64)
    home = outside["home"].to_numpy(np.int64)
    count = np.zeros(len(names), np.int64)
    np.add.at(count, v, n_m[m])
    probed = np.stack([np.asarray(p) for p in inside["probes"]])
    alone = ~(probed[m] == home[v][:, None]).any(1)  # the member does not come to the visitor
    np.add.at(count, len(outside) + m[alone], n_v[v[alone]])
    # One position per name, in the order of names, so that roots are the smallest names.
    unique, position = np.unique(names, return_inverse=True)
    label = _connect(len(unique), position[v], position[len(outside) + m])
    used = np.zeros(len(names), bool)
    used[v], used[len(outside) + m] = True, True
    return pd.DataFrame(
        {
            "cid": pd.Series(names[used].tolist(), dtype=object),
            "links": count[used],
            "root": pd.Series(unique[label[position[used]]].tolist(), dtype=object),
        }
    )


def _indexed(classes: DataFrame, size: int, index: Index) -> DataFrame:
    """Classes of one vector length with home list, probes, codes and error."""
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def run(frames):
        own = shared.value
        for frame in frames:
            if frame.empty:
                continue
            units = _unit(list(frame["vector"]))
            probes = own.probes(units)
            codes, error = own.code(units, probes[:, 0])
            yield pd.DataFrame(
                {
                    "cid": frame["cid"],
                    "n": frame["n"],
                    "vector": frame["vector"],
                    "home": probes[:, 0],
                    "probes": list(probes.astype(np.int32)),
                    "codes": list(codes),
                    "error": error,
                }
            )

    return classes.where(F.size("vector") == size).select("cid", "n", "vector").mapInPandas(
        run,
        "cid string, n long, vector array<double>, home int, probes array<int>,"
        " codes array<smallint>, error double",
    )


def list_count(classes: int) -> int:
    return min(MOST_LISTS, max(LISTS, math.isqrt(classes)))


def _found(classes: DataFrame, size: int, total: int, cosine: float) -> DataFrame | None:
    """``cid``, ``links`` and ``root`` from the blocks of all classes of one vector length."""
    own = classes.where(F.size("vector") == size)
    if total > SAMPLE:
        places = 1 << 40
        draw = F.pmod(F.xxhash64("cid"), F.lit(places))
        own = own.where(draw < SAMPLE * places // total)
    picked = own.select("cid", "vector").limit(2 * SAMPLE + 1).collect()
    if len(picked) > 2 * SAMPLE:  # any rows of so many would be another index each time
        raise RuntimeError(f"more than {2 * SAMPLE} vectors were picked for the index")
    units = _unit([r.vector for r in sorted(picked, key=lambda r: r.cid)])
    index = Index.fit(units, list_count(total))
    rows = stash(_indexed(classes, size, index), "vector_index")
    members = rows.select("*", F.col("home").alias("list"), F.lit(False).alias("visits"))
    visitors = rows.select("*", F.explode("probes").alias("list"), F.lit(True).alias("visits"))
    # At most MOST_LISTS rows.
    chunks = (
        members.groupBy("list").agg(F.count("*").alias("n_in"))
        .join(visitors.groupBy("list").agg(F.count("*").alias("n_out")), "list")
        .select(
            "list",
            F.ceil(F.col("n_in") / BLOCK).cast("int").alias("in_chunks"),
            F.ceil(F.col("n_out") / BLOCK).cast("int").alias("out_chunks"),
        )
    )
    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Rows in a chunk of their own side, once for every chunk of the other side."""
        placed = rows.join(F.broadcast(chunks), "list")
        mine = F.pmod(F.xxhash64("cid"), F.col(f"{own}_chunks")).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(f"{other}_chunks") - 1))
        return placed.withColumn(own, mine).withColumn(other, theirs)

    # A visitor needs neither codes nor probes.
    nothing = {c: F.lit(None).cast(rows.schema[c].dataType) for c in ("codes", "probes")}
    blocks = dealt(members, "in", "out").unionByName(
        dealt(visitors, "out", "in").withColumns(nothing)
    )
    blocks = blocks.drop("in_chunks", "out_chunks")
    shared = classes.sparkSession.sparkContext.broadcast(index)
    return blocks.groupBy("list", "in", "out").applyInPandas(
        lambda frame: _block(shared.value, cosine, frame), "cid string, links long, root string"
    )


def near_duplicates(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` (smallest key reachable) and ``kept`` of every row."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))

    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    usable = (
        F.coalesce(F.size(vector) > 0, F.lit(False))
        & ~F.coalesce(F.exists(values, odd), F.lit(True))
        & F.coalesce(F.exists(values, lambda x: x != 0), F.lit(False))
    )
    rows = stash(
        table.select(
            F.col(key).alias("key"),
            F.when(usable, F.md5(F.to_json(values))).alias("cid"),
            F.when(usable, values).alias("vector"),
        ),
        "vectors",
    )
    classes = stash(
        rows.where("cid IS NOT NULL")
        .groupBy("cid")
        .agg(
            F.min("key").alias("least"),
            F.count("*").alias("n"),
            F.any_value("vector").alias("vector"),
        ),
        "vector_classes",
    )
    sizes = classes.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).collect()
    found = None
    for r in sorted(sizes, key=lambda r: r.size):
        own = _found(classes, r.size, r.n, cosine)
        found = own if found is None else found.unionByName(own)
    if found is None:
        own = F.lit(0).cast("long")
        return rows.select(
            F.col("key").alias(key), own.alias("n_links"), F.col("key").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    found = stash(found, "vector_links")
    roots = stash(
        components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))), "roots"
    )
    counted = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = (
        classes.select("cid", "least", "n")
        .join(counted, "cid", "left")
        .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        .select(
            "cid",
            "least",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "cid").alias("root"),
        )
    )
    named = stash(named, "vector_roots")
    smallest = stash(named.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    known = stash(named.join(smallest, "root").select("cid", "n_links", "component_id"), "known")
    joined = rows.select("key", "cid").join(known, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )


SQL = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), usable AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM vectors
  WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b
  ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= {COSINE} * a.norm * b.norm
), reach AS (
  SELECT vec_id, vec_id AS other FROM vectors
  UNION
  SELECT vec_id, b FROM reach JOIN links ON other = a
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
), roots AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
       vec_id = component_id AS kept
FROM roots LEFT JOIN counts USING (vec_id)
"""
