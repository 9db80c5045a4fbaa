"""Language-model scores of texts from a probabilistic suffix tree over words.

Symbols are the words of lower-cased texts and the end of a text. The root's distribution is that of
single tokens, ``(c + 0.1) / (N + 0.1 * (V + 1))``, with one class for all unseen words. Contexts are the
words before, up to ``depth`` of them, with the start of a text as a first one. A context enters the
tree if it makes up at least ``CONTEXTS`` of all tokens (so a level has at most ``1 / CONTEXTS`` nodes,
at any size of the corpus) and if what follows it diverges from what follows its longest suffix in
the tree: the leave-one-out estimate of the gain in log-likelihood must exceed ``DIVERGENCE`` a token.

What follows a node is smoothed by absolute discounting of one occurrence: the discounted mass goes to
the distribution of the node's suffix, down to the root. So a pair seen once counts as a type and needs
no entry of its own. A token is scored by the longest suffix of the words before it that is a node.

In the distributions of nodes, words rarer than ``SYMBOLS`` of all tokens (which leaves at most
``1 / SYMBOLS`` others) are one symbol; that symbol's mass is shared out in proportion to the root.

Tasks know the tree's nodes, the frequent symbols and the entries that make up at least ``ENTRIES`` of
all tokens, which all have that proven bound. Counts of rare words and all other entries lie in
tables that grow with the corpus and are joined to what a text needs of them. For that, an entry also
has what it adds to the log-probability that its node would give without it. These add up along the
suffixes of a context, so one join looks up all of them; a bitmap of fixed size holds back most of
what has no entry.

Defined results: a null or empty text is one end; a null id counts as an empty text in the hash that
decides what is held out, and is held out; each of several rows with one id is learnt from and scored
by itself. Without a text to learn from all scores are zero. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmill.llm.common import stash
from salesmill.llm.words import KeyCounts, binary, coded, passes, sieve, slices, strings

DEPTH = 2
SYMBOLS, CONTEXTS = 2.0**-20, 2.0**-16
#: Entries that tasks know rather than look up: no result depends on it.
ENTRIES = 2.0**-20
#: A context occurs at least so often.
OCCURRENCES = 16
#: Nats a token by which a context must predict better than its suffix.
DIVERGENCE = 0.01
#: One text in so many is held out.
FOLDS = 10
#: Bytes of the longest word that is a symbol of its own.
LONGEST = 64
#: Bytes of text that a task works on at once, and words that it counts.
BUFFER, WORDS = 2 << 20, 250_000
END, RARE, START = 0, 1, 2
#: Words never hold a blank and are never empty.
_END, _START = b"", b" "
_BITS = 21
#: The hash of a key in the sieve of entries, which has ``2 ** _SIEVE`` slots: no product overflows.
_FACTOR, _DROP, _SIEVE = 11_400_713, 15, 26


@dataclass
class Tree:
    """What tasks know: symbols, nodes by level, and frequent entries."""

    ids: dict[bytes, int]
    counts: np.ndarray
    #: log10 of the root's distribution by symbol.
    log_p: np.ndarray
    depth: int
    #: Of each level, sorted keys (node of the shorter suffix, symbol before it) and their nodes.
    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    #: Of each node: whether it is in the tree, its longest suffix there, log10 of the mass left to it.
    keep: np.ndarray = field(default_factory=lambda: np.zeros(1, bool))
    up: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    back: np.ndarray = field(default_factory=lambda: np.zeros(1))
    #: Frequent entries: sorted keys (node, symbol), and log10 of their probabilities.
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    log_q: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: Bitmap of all entries: what it holds back has none to be looked up.
    sieve: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    def symbols(self, words: list[bytes]) -> np.ndarray:
        get = self.ids.get
        return np.array([get(word, RARE) for word in words], np.int64)

    def nodes(self, ids: np.ndarray) -> list[np.ndarray]:
        """For each level, the node of the symbols before each place, or 0."""
        found, node = [], np.zeros(len(ids), np.int64)
        for back, (keys, names) in enumerate(self.levels, 1):
            before = np.r_[np.full(min(back, len(ids)), END), ids[:-back]]
            if back == 1:  # keys are symbols
                table = np.zeros(len(self.log_p), np.int64)
                table[keys] = names
                node = table[before]
            else:
                at, hit = _find(keys, node << _BITS | before)
                node = np.where(hit & (node > 0), names[at] if len(names) else 0, 0)
            found.append(node)
        return found


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted keys, and whether they hold what is wanted."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _streams(
    texts: Iterator[tuple[int, bytes]], depth: int
) -> Iterator[tuple[list[bytes], list[int], list[int], int]]:
    """Words of some texts with their starts and ends, whose they are, and how many are repeated.

    A long text goes over several streams, each of which repeats the context it goes on from.
    """
    words: list[bytes] = []
    rows: list[int] = []
    lengths: list[int] = []
    repeated = size = 0
    for row, raw in texts:
        words.append(_START)
        own = 1
        for part in slices(raw):
            found = part.lower().split()
            words += found
            own += len(found)
            size += len(part)
            if size > BUFFER:
                yield words, [*rows, row], [*lengths, own], repeated
                words = words[-depth:]
                repeated = own = len(words)
                rows, lengths, size = [], [], 0
        words.append(_END)
        rows.append(row)
        lengths.append(own + 1)
    yield words, rows, lengths, repeated


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        yield from enumerate(binary(batch))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            columns = [strings(list(counts)), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for _, raw in _texts(batches):
            for part in slices(raw):
                counts.update(part.lower().split())
                if len(counts) > WORDS:
                    yield counted()
                    counts.clear()
        yield counted()

    counts = docs.select("text").mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def entry_counts(docs: DataFrame, tree: Tree) -> DataFrame:
    """``key`` (node of the deepest level, symbol after it) and ``n``."""
    shared = docs.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, counts = shared.value, KeyCounts()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in counts.take()], ["key", "n"])

        for words, _, _, repeated in _streams(_texts(batches), tree.depth):
            ids = tree.symbols(words)
            node = tree.nodes(ids)[-1]
            good = (node > 0) & (ids != START)
            good[:repeated] = False
            counts.add((node << _BITS | ids)[good])
            if counts.full():
                yield counted()
        yield counted()

    counts = docs.select("text").mapInArrow(run, "key long, n long")
    return counts.groupBy("key").agg(F.sum("n").alias("n"))


def _symbols(vocabulary: DataFrame, texts: int, tokens: int, types: int, depth: int) -> Tree:
    """A tree of the root alone."""
    # At most 1 / SYMBOLS rows: the counts add up to fewer than all tokens.
    common = vocabulary.where(
        (F.col("n") >= tokens * SYMBOLS) & (F.octet_length("word") <= LONGEST)
    ).toArrow().to_pandas()
    common = common.sort_values("word")
    ids = {_END: END, _START: START}
    ids.update((word.encode(), i) for i, word in enumerate(common["word"], START + 1))
    counts = np.r_[texts, 0, texts, common["n"].to_numpy(np.int64)].astype(np.int64)
    counts[RARE] = tokens - texts - counts[START + 1 :].sum()
    whole = tokens + 0.1 * (types + 1)
    p = (counts + 0.1) / whole
    # All rare words, and the class of the unseen ones.
    p[RARE] = (counts[RARE] + 0.1 * (max(types - 1, 0) - len(common) + 1)) / whole
    return Tree(ids, counts, np.log10(p), depth)


class Growth:
    """Grows a tree level by level; nodes are known to the driver, entries are tables."""

    def __init__(self, docs: DataFrame, tree: Tree, tokens: int) -> None:
        self.docs, self.tree, self.tokens = docs, tree, tokens
        self.spark = docs.sparkSession
        self.least = max(OCCURRENCES, tokens * CONTEXTS)
        #: Of each node: its words, occurrences, longest suffix in the tree, log10 of the mass left.
        self.contexts: list[tuple[int, ...]] = [()]
        self.counts, self.up, self.back, self.keep = [0], [0], [0.0], [False]
        self.entries: DataFrame | None = None
        self.root = self.spark.createDataFrame(
            pd.DataFrame({"symbol": np.arange(len(tree.log_p)), "log_p": tree.log_p}),
            "symbol long, log_p double",
        )
        symbols = np.flatnonzero(tree.counts >= self.least)
        found = [((int(s),), int(tree.counts[s])) for s in symbols if s != END]
        while found and len(tree.levels) < tree.depth:
            found = self._level(found)
        tree.keep, tree.up, tree.back = map(np.array, (self.keep, self.up, self.back))

    def _suffix(self, context: tuple[int, ...], of: dict[tuple[int, ...], int]) -> int:
        for start in range(1, len(context)):
            node = of.get(context[start:])
            if node and self.keep[node]:
                return node
        return 0

    def _level(self, found: list[tuple[tuple[int, ...], int]]) -> list[tuple[tuple[int, ...], int]]:
        """Add nodes for contexts and return those that may be the next level."""
        of = {context: node for node, context in enumerate(self.contexts)}
        found = [(context, n) for context, n in found if context[1:] in of]
        first = len(self.contexts)
        self.contexts += [context for context, _ in found]
        self.counts += [n for _, n in found]
        self.up += [self._suffix(context, of) for context, _ in found]
        self.keep += [False] * len(found)
        keys = np.array([of[c[1:]] << _BITS | c[0] for c, _ in found], np.int64)
        order = np.argsort(keys)
        self.tree.levels.append((keys[order], first + order))
        rows = stash(entry_counts(self.docs, self.tree).where("n >= 2"), "entries")
        node = F.expr(f"shiftright(key, {_BITS})").alias("node")
        # One row per node of this level.
        seen = rows.groupBy(node).agg(F.count("*").alias("k"), F.sum("n").alias("n")).toArrow().to_pandas()
        often = dict(zip(seen["node"], zip(seen["k"], seen["n"], strict=True), strict=True))
        types = []
        for at in range(first, len(self.contexts)):
            k, n = often.get(at, (0, 0))
            types.append(int(k) + self.counts[at] - int(n))
        self.back += [
            float(np.log10(t / n)) for t, n in zip(types, self.counts[first:], strict=True)
        ]
        own = self.spark.createDataFrame(
            pd.DataFrame(
                {
                    "node": np.arange(first, len(self.contexts)),
                    "count": self.counts[first:],
                    "types": types,
                    "left": self.back[first:],
                }
            ),
            "node long, count long, types long, left double",
        )
        split = rows.select("key", "n", node, F.expr(f"key & {(1 << _BITS) - 1}").alias("symbol"))
        known = self._suffixed(split, first).join(F.broadcast(own), "node")
        known = known.withColumn("parent", F.pow(F.lit(10.0), "log"))
        # What the node would say of an occurrence that it had not seen, against its suffix.
        unseen = (F.col("n") - 2 + F.col("types") * F.col("parent")) / (F.col("count") - 1)
        gain = F.sum(F.col("n") * F.log(unseen / F.col("parent")))
        gains = known.groupBy("node").agg(gain.alias("gain")).toArrow().to_pandas()
        gains = dict(zip(gains["node"], gains["gain"], strict=True))
        for at, t in zip(range(first, len(self.contexts)), types, strict=True):
            n = self.counts[at]
            once = n - int(often.get(at, (0, 0))[1])
            total = gains.get(at, 0.0) + (once * np.log((t - 1) / (n - 1)) if once and t > 1 else 0.0)
            self.keep[at] = bool(total > DIVERGENCE * n)
        kept = self.spark.createDataFrame(
            [(at,) for at in range(first, len(self.contexts)) if self.keep[at]], "node long"
        )
        p = (F.col("n") - 1 + F.col("types") * F.col("parent")) / F.col("count")
        entries = known.join(F.broadcast(kept), "node").select(
            "key",
            "n",
            F.log10(p).alias("log_q"),
            (F.log10(p) - F.col("left") - F.col("log")).alias("gain"),
        )
        entries = stash(entries, "kept_entries")
        self.entries = entries if self.entries is None else self.entries.unionByName(entries)
        # At most 1 / CONTEXTS rows.
        wide = split.where((F.col("n") >= self.least) & (F.col("symbol") != END)).collect()
        return [((*self.contexts[r.node], r.symbol), r.n) for r in wide]

    def _suffixed(self, rows: DataFrame, first: int) -> DataFrame:
        """``rows`` with ``log``: log10 of the probability of ``symbol`` after the node's suffix."""
        mass, steps = [], []
        for node in range(first, len(self.contexts)):
            at, total = self.up[node], 0.0
            while at:
                steps.append((node, at))
                total += self.back[at]
                at = self.up[at]
            mass.append((node, total))
        mass = F.broadcast(self.spark.createDataFrame(mass, "node long, mass double"))
        rows = rows.join(mass, "node").join(F.broadcast(self.root), "symbol")
        rows = rows.withColumn("log", F.col("mass") + F.col("log_p")).drop("mass", "log_p")
        if not steps:
            return rows
        # At most as many rows as nodes times levels.
        steps = F.broadcast(self.spark.createDataFrame(steps, "node long, at long"))
        asked = rows.select("key", "node", "symbol").join(steps, "node")
        asked = asked.withColumn("entry", F.expr(f"shiftleft(at, {_BITS}) | symbol"))
        entries = self.entries.select(F.col("key").alias("entry"), "gain")
        gains = asked.join(entries, "entry").groupBy("key").agg(F.sum("gain").alias("gain"))
        more = F.coalesce("gain", F.lit(0.0))
        return rows.join(gains, "key", "left").withColumn("log", F.col("log") + more).drop("gain")


def _scored(rows: DataFrame, tree: Tree) -> DataFrame:
    """Parts of each row: sums over what its tasks know, and what has to be looked up."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)
    names = [*rows.columns, "n_tokens", "n_known", "base", "score", "rare", "pending"]
    names.remove("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            own = batch.select([n for n in batch.schema.names if n != "text"])
            for words, owners, lengths, repeated in _streams(_texts(iter([batch])), tree.depth):
                n = len(owners)
                row = np.repeat(np.arange(n), lengths)
                ids = tree.symbols(words)
                state = np.zeros(len(ids), np.int64)
                for node in tree.nodes(ids):
                    state = np.where(tree.keep[node], node, state)
                new = ids != START
                new[:repeated] = False
                row, ids, state, places = row[new], ids[new], state[new], np.flatnonzero(new)
                rare = ids == RARE
                log = np.where(rare, -tree.log_p[RARE], 0.0)
                waiting = [(row[:0], ids[:0])]
                left = np.arange(len(ids))
                while len(left):  # from the longest suffix to the root
                    at_root = state[left] == 0
                    log[left[at_root]] += tree.log_p[ids[left[at_root]]]
                    left = left[~at_root]
                    key = state[left] << _BITS | ids[left]
                    at, hit = _find(tree.keys, key)
                    log[left[hit]] += tree.log_q[at[hit]]
                    waiting.append((row[left[~hit]], key[~hit]))
                    left = left[~hit]
                    log[left] += tree.back[state[left]]
                    state[left] = tree.up[state[left]]
                asked, wanted = (np.concatenate(x) for x in zip(*waiting, strict=True))
                there = passes(tree.sieve, wanted * _FACTOR >> _DROP)
                asked, wanted = asked[there], wanted[there]
                base = np.where(rare, 0.0, tree.log_p[ids])
                known = ~rare & (tree.counts[ids] > 0)
                spelled, code = coded([words[i] for i in places[rare].tolist()])
                lists = []
                for kind, values, of in (
                    ("rare", code, row[rare]),
                    ("pending", wanted, asked),
                ):
                    pairs, count = np.unique(of << 40 | values, return_counts=True)
                    values = pa.array(pairs & ((1 << 40) - 1))
                    if kind == "rare":
                        values = strings(spelled).take(values)
                    cells = pa.StructArray.from_arrays([values, pa.array(count)], ["what", "n"])
                    starts = np.searchsorted(pairs >> 40, np.arange(n + 1)).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(starts), cells))
                yield pa.RecordBatch.from_arrays(
                    [
                        *own.take(pa.array(owners, pa.int64())).columns,
                        pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(row, known, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(row, base, minlength=n)),
                        pa.array(np.bincount(row, log, minlength=n)),
                        *lists,
                    ],
                    names,
                )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"uid long, key {kind}, held_out boolean, n_tokens long, n_known long, base double, score double,"
        " rare array<struct<what:string,n:long>>, pending array<struct<what:long,n:long>>",
    )


def score(
    docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH
) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    named = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.crc32(named.cast("binary")) % FOLDS == 0).alias("held_out"),
        F.col(text).alias("text"),
    )
    train = rows.where("NOT held_out")
    texts = train.count()
    vocabulary = stash(word_counts(train), "vocabulary")
    words, types = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, types = words + texts, types + (texts > 0)
    tree = _symbols(vocabulary, texts, tokens, types, depth)
    growth = Growth(train, tree, tokens)
    if growth.entries is not None:
        # At most 1 / ENTRIES rows of each level.
        often = growth.entries.where(F.col("n") >= tokens * ENTRIES).toArrow().to_pandas().sort_values("key")
        tree.keys, tree.log_q = often["key"].to_numpy(np.int64), often["log_q"].to_numpy()
        hashed = F.expr(f"shiftright(key * {_FACTOR}L, {_DROP})")
        tree.sieve = sieve(growth.entries, hashed, _SIEVE)
    # Numbers of rows hold because they are written with all that is found out about a row.
    numbered = rows.select(F.monotonically_increasing_id().alias("uid"), "key", "held_out", "text")
    parts = stash(_scored(numbered, tree), "parts")

    whole = tokens + 0.1 * (types + 1)
    c = F.coalesce("c", F.lit(0))
    log = F.col("n") * F.log10((c + 0.1) / whole)
    # Words and keys are unique on the side that is hashed, so its partitions are even.
    rare = (
        parts.select("uid", F.explode("rare").alias("r"))
        .select("uid", F.col("r.what").alias("word"), F.col("r.n").alias("n"))
        .join(vocabulary.withColumnRenamed("n", "c").hint("shuffle_hash"), "word", "left")
        .select(
            "uid",
            F.when(c > 0, F.col("n")).otherwise(0).alias("n_known"),
            log.alias("base"),
            log.alias("score"),
        )
    )
    sums = parts.drop("rare", "pending").unionByName(rare, allowMissingColumns=True)
    if growth.entries is not None:
        waiting = parts.select("uid", F.explode("pending").alias("p"))
        found = (
            waiting.select("uid", F.col("p.n").alias("times"), F.col("p.what").alias("key"))
            .join(growth.entries.hint("shuffle_hash"), "key")
            .select("uid", (F.col("times") * F.col("gain")).alias("score"))
        )
        sums = sums.unionByName(found, allowMissingColumns=True)
    sums = sums.groupBy("uid").agg(
        *(F.any_value(c, F.lit(True)).alias(c) for c in ("key", "held_out")),
        *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")),
    )
    return sums.select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
