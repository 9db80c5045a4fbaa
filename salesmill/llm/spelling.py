"""Spelling variants: words one edit apart, the frequent word that each one is a form of, and roots.

Words are the letter runs of all texts, lower-cased in A-Z. In a document where the CRC-32 of
``<doc_id>:<run>`` is divisible by 199, a run loses one letter; the counts are of what is left. Kept
are words of at least six code points that occur at least five times.

Near words are found by a reduced alphabet: letters are hashed to a few symbols, and of each reduced
word the one-edit neighbourhood is generated and joined with the reduced vocabulary. Words that are
one edit apart are at most one edit apart when reduced; the pairs that the join finds are verified on
the original strings. An insertion into one word is a deletion from the other, and a replacement seen
from one side is one seen from the other, so of the full neighbourhood those halves are generated
that reach each pair once: the reduced word itself, its deletions, and its replacements by a higher
symbol. There are so many symbols that the reduced words of the shortest length outnumber the
vocabulary: few words share one, at any size of the vocabulary.

Defined results: a null text has no words; a null id counts as an empty one in the hash; each of
several equal rows counts. A table without words gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmill.llm.common import stash
from salesmill.llm.words import binary, slices, strings

LETTERS = 6
OCCURRENCES = 5
#: A form is so many times as frequent as its variant.
RATIO = 5
DIVISOR = 199
#: Words that a task counts before it hands them on.
WORDS = 400_000
# Of lower-cased UTF-8: a to z, and U+00C0 to U+00FF.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def spelled(doc: bytes, run: bytes, divisor: int = DIVISOR) -> bytes:
    """The word that a run stands for in a document (its id and a colon)."""
    h = zlib.crc32(run, zlib.crc32(doc))
    if h % divisor:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def vocabulary(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    letters: int = LETTERS,
    occurrences: int = OCCURRENCES,
) -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            long = [(w, n) for w, n in counts.items() if len(w) >= letters]
            words = strings([w for w, _ in long])
            numbers = pa.array([n for _, n in long], pa.int64())
            return pa.RecordBatch.from_arrays([words, numbers], ["word", "n"])

        for batch in batches:
            names = batch.column("key").to_pylist()
            for name, raw in zip(names, binary(batch), strict=True):
                doc = zlib.crc32(((name or "") + ":").encode())
                for part in slices(raw):
                    for found, n in Counter(_RUN.findall(part.lower())).items():
                        if zlib.crc32(found, doc) % DIVISOR:
                            counts[found] += n
                        else:
                            counts[spelled(((name or "") + ":").encode(), found)] += n
                if len(counts) > WORDS:
                    yield counted()
                    counts.clear()
        yield counted()

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    counts = rows.mapInArrow(run, "word string, n long")
    return (
        counts.where(F.length("word") >= letters)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= occurrences)
    )


def symbols_for(words: int, letters: int = LETTERS) -> int:
    """The fewest symbols that spell as many reduced words of ``letters`` letters."""
    symbols = 2
    while symbols**letters < words:
        symbols += 1
    return symbols


def reduced(word: str, symbols: int) -> str:
    """Each code point as one of ``symbols`` letters."""
    return "".join([chr(97 + (ord(c) * 40503 >> 4) % symbols) for c in word])


def neighbourhood(code: str, symbols: int) -> list[str]:
    """The halves of the one-edit neighbourhood that reach each pair of reduced words once."""
    found = {code}
    for i, own in enumerate(code):
        left, right = code[:i], code[i + 1 :]
        found.add(left + right)
        found.update([left + chr(s) + right for s in range(ord(own) + 1, 97 + symbols)])
    return list(found)


def near_words(words: DataFrame, symbols: int) -> DataFrame:
    """All pairs of words one edit apart, both ways: ``word``, ``n``, ``near``, ``near_n``."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [reduced(w, symbols) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.string())], ["word", "n", "code"]
            )

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                own = batch.column("code").to_pylist()
                found = [(i, c) for i, at in enumerate(own) for c in neighbourhood(at, symbols)]
                rows = pa.array([i for i, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("word").take(rows),
                        batch.column("n").take(rows),
                        pa.array([c for _, c in found], pa.string()),
                        pa.array([c == own[i] for i, c in found], pa.bool_()),
                    ],
                    ["a", "a_n", "code", "same"],
                )

    vocabulary = words.select("word", "n").mapInArrow(code, "word string, n long, code string")
    pairs = (
        # Both sides are as many as there are words: neither is broadcast at any size.
        vocabulary.mapInArrow(around, "a string, a_n long, code string, same boolean")
        .hint("merge")
        .join(vocabulary, "code")
        .select("a", "a_n", F.col("word").alias("b"), F.col("n").alias("b_n"), "same")
        # Words with equal codes meet from both sides.
        .where((~F.col("same") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    )

    def way(word: str, near: str) -> Column:
        return F.struct(
            F.col(word).alias("word"),
            F.col(f"{word}_n").alias("n"),
            F.col(near).alias("near"),
            F.col(f"{near}_n").alias("near_n"),
        )

    return pairs.select(F.explode(F.array(way("a", "b"), way("b", "a"))).alias("pair")).select("pair.*")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for words with a ``form``, each followed to its end.

    A form is several times as frequent, so chains are short; each round doubles the steps.
    """
    now = stash(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stash(now.hint("merge").join(on, "root", "left"), "roots")
        if joined.where("next IS NOT NULL").isEmpty():
            return now
        now = joined.select("word", F.coalesce("next", "root").alias("root"))


def variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    letters: int = LETTERS,
    occurrences: int = OCCURRENCES,
    ratio: int = RATIO,
) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of all words."""
    words = stash(vocabulary(docs, key, text, letters, occurrences), "words")
    near = near_words(words, symbols_for(words.count(), letters))
    # The most frequent one, of equally frequent ones the first in code-point order.
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    linked = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.n") >= ratio * F.col("n")
    linked = stash(
        linked.select(
            "word",
            "n_near",
            F.when(enough, F.col("best.word")).alias("form"),
            F.when(enough, -F.col("best.n")).alias("form_n"),
        ),
        "linked",
    )
    ends = roots(linked.where("form IS NOT NULL"))
    return (
        words.hint("merge")
        .join(linked, "word", "left")
        .hint("merge")
        .join(ends, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
