"""Phrase collocations of two and three words, the best of each language.

Texts are lower-cased in A-Z, split at ``. , ; : ! ?`` and line breaks into pieces, and those at spaces
and tabs into words. A phrase scores by how often it occurs against its parts: the lowest
``a * a / (l * r)`` over its cuts. A phrase of two words is dropped if a frequent phrase of three holds
at least half of its occurrences.

Phrases grow from their prefixes, best first. For a prefix ``x y``, no phrase ``x y z`` can occur more
often than ``x y`` or its own end ``y z``, so ``f(x y) / f(x)`` bounds all their scores. A round sets each
language a threshold, expands the frontier of prefixes whose bound reaches it (and, to the left,
what may drop a pair that reaches it), and settles the languages in which enough scores survive at or
above the threshold: whatever was not expanded scores less, so no tie is missed. Other languages go
on with a lower threshold, in the end with zero, which expands all.

Counts are whole: tasks count in their own codes and hand on partial sums. Words and prefixes that
matter are known to the tasks as bitmaps of a fixed size, which may let others through but hold none
back; what they let through is looked up in exact tables afterwards. Scores are exact to counts
of 10**16.

Defined results: a null text has no words, a null language is ``und``; repeated rows count again. A
language with fewer surviving phrases returns those it has, one without any none.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmill.llm.common import stash
from salesmill.llm.words import KeyCounts, binary, coded, passes, sieve, slices, strings

OCCURRENCES = 10
LIMIT = 2000
#: Percentage of a pair's occurrences within a longer phrase that drops it.
HELD = 50
WORD_BITS, PAIR_BITS = 24, 26
#: Bytes of text that a task counts at once.
BUFFER = 8 << 20
_BREAK = re.compile(rb"[.,;:!?\n-\r]+")
_EDGE = b"."
_SALTS = 64
#: The hash of a pair in a language: factors of its words' CRC-32, and low bits that are dropped.
_X, _Y, _DROP = 1_640_531, 2_246_823, 9


def words_of(raw: bytes) -> list[bytes]:
    """The words of a text, with ``.`` where a piece ends."""
    return _BREAK.sub(b" . ", raw.lower()).split()


def _crc(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words))


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Some texts of one language at a time, about ``BUFFER`` bytes of all languages together."""
    kept: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang, raw in zip(langs, binary(batch), strict=True):
            kept.setdefault(lang, []).append(raw)
            size += len(raw)
            if size > BUFFER:
                yield from kept.items()
                kept, size = {}, 0
    yield from kept.items()


def _streams(texts: list[bytes]) -> Iterator[tuple[list[bytes], int]]:
    """Words of texts, and how many of the first are repeated from the stream before.

    A long text goes over several streams; a phrase that ends in repeated words has been counted.
    """
    words: list[bytes] = []
    repeated = size = 0
    for raw in texts:
        for part in slices(raw):
            words += words_of(part)
            size += len(part)
            if size > BUFFER:
                yield words, repeated
                words = words[-2:]
                repeated, size = len(words), 0
        words.append(_EDGE)
    yield words, repeated


def _counted(lang: str, columns: dict[str, pa.Array], n: np.ndarray) -> pa.RecordBatch:
    names = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int64)))
    return pa.RecordBatch.from_arrays(
        [names, *columns.values(), pa.array(n)], ["lang", *columns, "n"]
    )


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang``, ``word`` and ``n`` of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _buffers(batches):
            for words, repeated in _streams(texts):
                names, code = coded(words)
                n = np.bincount(code[repeated:], minlength=len(names))
                found = [i for i in np.flatnonzero(n).tolist() if names[i] != _EDGE]
                yield _counted(lang, {"x": strings([names[i] for i in found])}, n[found])

    counts = rows.mapInArrow(run, "lang string, x string, n long")
    return counts.groupBy("lang", "x").agg(F.sum("n").alias("n"))


def pair_counts(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``lang``, ``x``, ``y`` and ``n`` of neighbours that both pass the sieve of frequent words."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _buffers(batches):
            for words, repeated in _streams(texts):
                names, code = coded(words)
                good = passes(shared.value, _crc(names))
                good[[i for i, name in enumerate(names) if name == _EDGE]] = False
                inside = good[code[:-1]] & good[code[1:]]
                inside[: max(0, repeated - 1)] = False
                counts = KeyCounts()
                counts.add((code[:-1] * len(names) + code[1:])[inside])
                keys, n = counts.take()
                spelled = strings(names)
                x, y = (spelled.take(pa.array(k)) for k in np.divmod(keys, max(1, len(names))))
                yield _counted(lang, {"x": x, "y": y}, n)

    counts = rows.mapInArrow(run, "lang string, x string, y string, n long")
    return counts.groupBy("lang", "x", "y").agg(F.sum("n").alias("n"))


def triple_counts(
    rows: DataFrame, frequent: np.ndarray, grow: np.ndarray, own: np.ndarray
) -> DataFrame:
    """``lang``, ``x``, ``y``, ``z`` and ``n`` of what grows from a prefix, or ends in an own pair."""
    shared = rows.sparkSession.sparkContext.broadcast((frequent, grow, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, grow, own = shared.value
        for lang, texts in _buffers(batches):
            for words, _ in _streams(texts):
                names, code = coded(words)
                size, crc = max(1, len(names)), _crc(names)
                good = passes(frequent, crc)
                good[[i for i, name in enumerate(names) if name == _EDGE]] = False
                inside = good[code[:-2]] & good[code[1:-1]] & good[code[2:]]
                at = np.flatnonzero(inside)  # two repeated words make no triple
                head = zlib.crc32(lang.encode()) + _X * crc[code[at]]
                prefix = passes(grow, head + _Y * crc[code[at + 1]] >> _DROP)
                head = zlib.crc32(lang.encode()) + _X * crc[code[at + 1]]
                suffix = passes(own, head + _Y * crc[code[at + 2]] >> _DROP)
                at = at[prefix | suffix]
                pairs, first = np.unique(code[at] * size + code[at + 1], return_inverse=True)
                counts = KeyCounts()
                counts.add(first * size + code[at + 2])
                keys, n = counts.take()
                first, z = np.divmod(keys, size)
                x, y = np.divmod(pairs[first], size)
                spelled = strings(names)
                x, y, z = (spelled.take(pa.array(k)) for k in (x, y, z))
                yield _counted(lang, {"x": x, "y": y, "z": z}, n)

    counts = rows.mapInArrow(run, "lang string, x string, y string, z string, n long")
    return counts.groupBy("lang", "x", "y", "z").agg(F.sum("n").alias("n"))


def _score(a: str, left: str, right: str) -> Column:
    """Exact: a count of up to 10**16 squared and times a million has 38 digits."""
    top = f"cast(1000000 as decimal(38,0)) * cast({a} as decimal(38,0)) * cast({a} as decimal(38,0))"
    return F.expr(f"({top}) div (cast({left} as decimal(38,0)) * cast({right} as decimal(38,0)))")


def best_of(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each language and their ``rank``.

    Salted parts of a language are cut to the limit before they meet, so no task sorts them all.
    """
    part = Window.partitionBy("lang", "salt").orderBy(*order)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("x", "y"), F.lit(_SALTS)))
    first = salted.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= limit)
    whole = Window.partitionBy("lang").orderBy(*order)
    return (
        first.withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= limit)
        .drop("salt")
    )


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    occurrences: int = OCCURRENCES,
    limit: int = LIMIT,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the best phrases."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.col(text).alias("text"),
    )
    every = stash(word_counts(rows), "words")
    totals = stash(every.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    words = every.where(F.col("n") >= occurrences)
    frequent = sieve(words, F.crc32("x"), WORD_BITS)
    hashed = F.expr(f"shiftright(crc32(lang) + {_X}L * crc32(x) + {_Y}L * crc32(y), {_DROP})")
    counted = pair_counts(rows, frequent).where(F.col("n") >= occurrences)
    left = words.select("lang", "x", F.col("n").alias("l"))
    right = words.select("lang", F.col("x").alias("y"), F.col("n").alias("r"))
    pairs = stash(
        counted.join(left, ["lang", "x"])
        .join(right, ["lang", "y"])
        .select("lang", "x", "y", F.col("n").alias("a"), "l", "r", _score("n", "l", "r").alias("score"))
        .withColumn("bound", F.expr("cast(1000000 as decimal(38,0)) * a div l")),
        "pairs",
    )
    ranked = [F.desc("score"), F.desc("a"), F.concat_ws(" ", "x", "y", "z")]
    found, reach, open_ = None, 2 * limit, totals.select("lang")
    while True:
        # Where the pairs of a language end before the reach, everything is expanded.
        last = best_of(pairs.withColumn("z", F.lit(None).cast("string")), ranked, reach)
        last = last.where(F.col("rank") == reach).select("lang", "score")
        least = F.coalesce("score", F.lit(0)) if reach < 100 * limit else F.lit(0)
        frontier = stash(
            open_.join(last, "lang", "left").select("lang", least.alias("least")), "frontier"
        )
        active = pairs.join(frontier, "lang").where("bound >= least")
        grow = sieve(active, hashed, PAIR_BITS)
        own = sieve(active.where("score >= least"), hashed, PAIR_BITS)
        triples = stash(
            triple_counts(rows.join(frontier, "lang", "left_semi"), frequent, grow, own)
            .where(F.col("n") >= occurrences)
            .withColumnRenamed("n", "a"),
            "triples",
        )
        prefix = pairs.select("lang", "x", "y", F.col("a").alias("xy"), F.col("l").alias("only_x"))
        suffix = pairs.select(
            "lang", F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("yz"),
            F.col("r").alias("only_z"),
        )
        cut = (
            triples.join(prefix, ["lang", "x", "y"])
            .join(suffix, ["lang", "y", "z"])
            .withColumn("one", _score("a", "only_x", "yz"))
            .withColumn("two", _score("a", "xy", "only_z"))
        )
        lower = F.col("two") < F.col("one")
        long = cut.select(
            "lang", "x", "y", "z", "a",
            F.when(lower, F.col("xy")).otherwise(F.col("only_x")).alias("l"),
            F.when(lower, F.col("only_z")).otherwise(F.col("yz")).alias("r"),
            F.least("one", "two").alias("score"),
        )
        holds = triples.select("lang", "x", "y", "a").unionByName(
            triples.select("lang", F.col("y").alias("x"), F.col("z").alias("y"), "a")
        )
        held = holds.groupBy("lang", "x", "y").agg(F.max("a").alias("held"))
        short = (
            active.where("score >= least")
            .join(held, ["lang", "x", "y"], "left")
            .where(F.expr(f"held IS NULL OR 100 * held < {HELD} * a"))
            .select("lang", "x", "y", F.lit(None).cast("string").alias("z"), "a", "l", "r", "score")
        )
        above = long.join(frontier, "lang").where("score >= least").drop("least")
        best = stash(best_of(short.unionByName(above), ranked, limit), "best")
        n = best.groupBy("lang").agg(F.count("*").alias("n"))
        state = frontier.join(n, "lang", "left").withColumn(
            "settled", (F.col("least") == 0) | (F.coalesce("n", F.lit(0)) >= limit)
        )
        state = stash(state.select("lang", "settled"), "state")
        settled = best.join(state.where("settled"), "lang", "left_semi")
        found = settled if found is None else found.unionByName(settled)
        open_ = state.where("NOT settled").select("lang")
        if open_.isEmpty():
            break
        reach *= 8
    return found.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        F.concat_ws(" ", "x", "y", "z").alias("phrase"),
        "a",
        "l",
        "r",
        F.col("total").alias("n"),
        "score",
    )


#: The same for DuckDB, over the view ``documents``.
SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
         regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]') AS texts
  FROM documents
), numbered AS (
  SELECT lang, doc, generate_subscripts(texts, 1) AS piece, unnest(texts) AS text FROM pieces
), lists AS (
  SELECT lang, doc, piece, regexp_extract_all(text, '[^\x20\x09]+') AS w FROM numbered
), places AS (
  SELECT lang, doc, piece, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM lists
), grams AS (
  SELECT lang, x, lead(x, 1) OVER around AS y, lead(x, 2) OVER around AS z
  FROM places WINDOW around AS (PARTITION BY doc, piece ORDER BY i)
), counts AS (
  SELECT lang, 1 AS k, x AS phrase, count(*) AS f FROM grams GROUP BY ALL
  UNION ALL
  SELECT lang, 2, x || ' ' || y, count(*) FROM grams WHERE y IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT lang, 3, x || ' ' || y || ' ' || z, count(*) FROM grams WHERE z IS NOT NULL GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w
  FROM counts WHERE k > 1 AND f >= 10
), split AS (
  SELECT lang, k, phrase, a, w[1] AS head, array_to_string(w[2:], ' ') AS tail, 1 AS j FROM candidates
  UNION ALL
  SELECT lang, k, phrase, a, array_to_string(w[1:2], ' '), w[3], 2 FROM candidates WHERE k = 3
), cuts AS (
  SELECT s.lang, s.k, s.phrase, s.a, j, p.f AS l, q.f AS r,
         (1000000::HUGEINT * s.a * s.a) // (p.f::HUGEINT * q.f) AS score
  FROM split AS s
  JOIN counts AS p ON p.lang = s.lang AND p.phrase = s.head
  JOIN counts AS q ON q.lang = s.lang AND q.phrase = s.tail
), lowest AS (
  SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), holders AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3
), held AS (
  SELECT lang, phrase, max(a) AS most FROM holders GROUP BY ALL
), ranked AS (
  SELECT lowest.lang, lowest.phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, encode(lowest.phrase))
           AS rank
  FROM lowest LEFT JOIN held ON held.lang = lowest.lang AND held.phrase = lowest.phrase
  WHERE k = 3 OR most IS NULL OR 100 * most < 50 * a
)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN totals ON totals.lang = ranked.lang
WHERE rank <= 2000
"""
