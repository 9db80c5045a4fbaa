"""Rules, classifier, SimHash and passages against plain Python on small documents."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_edge import EDGE, PROSE
from salesmill.llm import quality_classifier, quality_rules, simhash, substring_dedup
from salesmill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def test_rules_equal_plain_counts(edge_docs):
    judged = quality_rules.judge(edge_docs)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = sorted((tuple(r) for r in judged.select(names).collect()), key=repr)
    assert found == sorted((plain_measures(t) for _, t in EDGE), key=repr)


def test_rules_keep_rows_as_they_are(edge_docs, no_docs):
    kept = quality_rules.keep(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 7, 8, 9, None}
    assert quality_rules.keep(no_docs).count() == 0


@pytest.mark.parametrize("n, failed", [(19, True), (20, False)])
def test_length_limit(make_docs, n, failed):
    text = " ".join(PROSE.split()[:n])
    assert quality_rules.judge(make_docs([(1, text)])).first().base_failed is failed


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    clean = rng.random(20_000) < 0.8
    votes = np.stack([np.where(rng.random(len(clean)) < p, clean, ~clean) for p in (0.95, 0.85, 0.75)], 1)
    patterns, counts = np.unique(votes.astype(int), axis=0, return_counts=True)
    quality_prior = quality_classifier.estimate(patterns, counts.astype(float))
    assert abs(quality_prior.clean - 0.8) < 0.03
    right = quality_prior.words[:, 1, 1] / quality_prior.words[:, 1, :2].sum(1)
    assert np.allclose(right, [0.95, 0.85, 0.75], atol=0.04)


def test_classifier_on_labels_it_never_saw(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality_classifier.score(docs).join(labels, "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) / len(clean) > 0.99
    assert sum(junk) / len(junk) < 0.05


def plain_votes(text):
    """0 for junk, 1 for clean, 2 for nothing, labeller by labeller."""
    text = text or ""
    words = WORD.findall(text)
    if not words:
        return (2,) * 7
    pairs = set(zip(words, [*words[1:], None], strict=True))
    stops = sum(w.lower() in set(quality_rules.STOP_WORDS) for w in words) / len(words)
    distinct, fresh = len(set(words)) / len(words), len(pairs) / len(words)
    return (
        2 if len(re.findall(r"[#*$%&|<>]", text)) / len(words) <= 0.1 else 0,
        0 if not 0.03 <= stops <= 1 else 1 if 0.12 <= stops <= 0.7 else 2,
        0 if distinct < 0.2 else 1 if distinct >= 0.5 else 2,
        0 if fresh < 0.5 else 1 if fresh >= 0.8 else 2,
        2 if sum("A" <= c <= "Z" for c in text) / len(text) <= 0.2 else 0,
        2 if text.count("!!") / len(words) <= 0.1 else 0,
        2 if 3.5 <= len(text) / len(words) <= 8.5 else 0,
    )


def plain_posteriors(votes):
    """Expectation-maximisation document by document, P(clean) of each."""
    n = len(votes)
    prior = [[0.1, 0.9, 0.5], [0.9, 0.1, 0.5]]
    prior = {(c, w): prior[1 - c][w] / 1.5 for c in (0, 1) for w in range(3)}
    table = {(i, c, w): prior[c, w] for i in range(7) for c in (0, 1) for w in range(3)}
    share = 0.8

    def clean(own):
        odds = math.log(share / (1 - share))
        odds += sum(math.log(table[i, 1, w] / table[i, 0, w]) for i, w in enumerate(own))
        return 1 / (1 + math.exp(-min(50, max(-50, odds))))

    for _ in range(100):
        sure = [clean(own) for own in votes]
        seen = {k: prior[k[1:]] * (0.01 * n + 1) for k in table}
        for own, p in zip(votes, sure, strict=True):
            for i, w in enumerate(own):
                seen[i, 1, w] += p
                seen[i, 0, w] += 1 - p
        share = (sum(sure) + 1) / (n + 2)
        table = {k: v / sum(seen[k[0], k[1], w] for w in range(3)) for k, v in seen.items()}
    return [clean(own) for own in votes]


def plain_features(text):
    data = f"  {text}  ".encode()
    grams = Counter(data[i : i + 3] for i in range(len(data) - 2))
    places = Counter()
    for gram, n in grams.items():
        places[(int.from_bytes(gram, "big") * 0x9E3779B1) % 2**32 >> 17] += n
    size = math.sqrt(sum(math.log(1 + n) ** 2 for n in places.values()))
    found = Counter({p: math.log(1 + n) / size for p, n in places.items()})
    found[min(9, 10 * len(places) // (len(data) - 2))] += 0.5
    return found


def plain_scorer(rows, targets):
    """Logistic regression by Adam, both classes alike; its probability as a function."""
    share = min(0.98, max(0.02, sum(targets) / len(targets)))
    weights, first, second = Counter(), Counter(), Counter()

    def probability(row):
        odds = weights["constant"] + sum(weights[p] * v for p, v in row.items())
        return 1 / (1 + math.exp(-min(50, max(-50, odds))))

    for t in range(1, 151):
        slope = Counter({p: 1e-6 * w for p, w in weights.items() if p != "constant"})
        for row, target in zip(rows, targets, strict=True):
            weigh = target / (2 * share) + (1 - target) / (2 * (1 - share))
            error = weigh * (probability(row) - target) / len(rows)
            slope["constant"] += error
            for p, v in row.items():
                slope[p] += error * v
        for p, g in slope.items():
            first[p] = 0.9 * first[p] + 0.1 * g
            second[p] = 0.99 * second[p] + 0.01 * g * g
            step = 0.2 * first[p] / (1 - 0.9**t)
            weights[p] -= step / (math.sqrt(second[p] / (1 - 0.99**t)) + 1e-8)
    return probability


def test_classifier_equals_plain_python(spark, make_docs):
    """Votes, label model, features and training, each as its textbook says, on every text."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in table.orderBy("doc_id").collect() if len(r.text or "") < 1500][:70]
    texts += ["buy now!! cheap $$$ ### " * 9, "THE SAME " * 30, *(t for _, t in EDGE if len(t or "") < 999)]
    docs = make_docs(list(enumerate(texts)))
    votes = [plain_votes(t) for t in texts]
    found = {r.doc_id: tuple(r.votes) for r in quality_classifier.votes(docs, "text", "doc_id").collect()}
    assert found == dict(enumerate(votes))
    assert len(set(votes)) > 5
    posteriors = plain_posteriors(votes)
    worded = [i for i, t in enumerate(texts) if WORD.search(t or "")]
    rows = {i: plain_features(texts[i]) for i in worded}
    probability = plain_scorer([rows[i] for i in worded], [posteriors[i] for i in worded])
    expected = [probability(rows[i]) if i in rows else 0.0 for i in range(len(texts))]
    scored = {r.doc_id: r for r in quality_classifier.score(docs).collect()}
    assert np.allclose([scored[i].score for i in range(len(texts))], expected, atol=2e-3)
    clear = [i for i, p in enumerate(expected) if abs(p - quality_classifier.THRESHOLD) > 0.01]
    assert all(scored[i].kept == (expected[i] >= quality_classifier.THRESHOLD) for i in clear)
    assert 0 < sum(r.kept for r in scored.values()) < len(texts)


def test_classifier_edge_rows(edge_docs, no_docs):
    rows = quality_classifier.score(edge_docs).collect()
    assert len(rows) == len(EDGE)
    assert {r.score for r in rows if r.doc_id in (2, 3, 4)} == {0.0}
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert quality_classifier.score(no_docs).count() == 0
    assert quality_classifier.keep(edge_docs).columns == edge_docs.columns


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def near(fps, distance=4):
    return [
        (i, j)
        for i in range(len(fps))
        for j in range(i)
        if (int(fps[i]) ^ int(fps[j])).bit_count() <= distance
    ]


def test_simhash_edge_rows(edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    prints = [plain_fingerprint(t) for _, t in EDGE]
    roots = plain_components(len(EDGE), near(prints))
    least = {}
    for (doc, _), root in zip(EDGE, roots, strict=True):
        if doc is not None:
            least[root] = min(doc, least.get(root, doc))
    expected = sorted(
        (repr(doc), f"{fp:016x}", least.get(root))
        for (doc, _), fp, root in zip(EDGE, prints, roots, strict=True)
    )
    assert sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in rows) == expected
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 11, 12, 2, 5, 6, 9, None]
    assert simhash.keep(no_docs).count() == 0


A, B, C = PROSE, " ".join(reversed(PROSE.split())), "word " * 30


@pytest.mark.parametrize(
    "rows, stay",
    [
        ([(1, A), (5, A), (5, B)], [(1, A), (5, B)]),
        ([(1, A), (1, B)], [(1, A), (1, B)]),
        ([(1, A), (1, A.upper())], 1),
        ([(3, A), (3, A), (3, B), (4, B), (4, C), (3, C)], [(3, A), (3, B), (3, C)]),
        ([(None, A), (2, A), (None, B), (None, C)], [(2, A), (None, B), (None, C)]),
        ([(None, A), (None, A), (9, None), (8, "")], [(None, A), (8, "")]),
    ],
)
def test_rows_are_kept_not_ids(make_docs, rows, stay):
    found = [(r.doc_id, r.text) for r in simhash.keep(make_docs(rows)).collect()]
    if stay == 1:
        assert len(found) == 1 and found[0] in rows
    else:
        assert sorted(found, key=repr) == sorted(stay, key=repr)


def test_trie_walk_equals_all_pairs():
    rng = random.Random(3)
    fps = []
    for _ in range(12):  # dense crowds, in which most pairs are near
        base = rng.getrandbits(64)
        bits = rng.sample(range(64), 9)
        fps += [base ^ sum(1 << b for b in bits if rng.random() < 0.5) for _ in range(60)]
    fps = np.unique(np.array(fps + [rng.getrandbits(64) for _ in range(300)], np.uint64))
    far, first = simhash.trie_links(np.zeros(len(fps), np.int64), fps)
    roots = np.arange(len(fps))
    roots[far] = first
    assert roots.tolist() == plain_components(len(fps), near(fps))


def test_crowded_blocks_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TRIE_MEMBERS", 60)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    bits = rng.sample(range(64), 14)
    fps = sorted({base ^ sum(1 << b for b in bits if rng.random() < 0.3) for _ in range(250)})
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    classes = spark.createDataFrame([(fp,) for fp in signed], "fp long")
    place = {fp: i for i, fp in enumerate(signed)}
    links = [(place[r.a], place[r.b]) for r in simhash.near_links(classes).collect()]
    assert plain_components(len(fps), links) == plain_components(len(fps), near(fps))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {
        **dict.fromkeys(range(41), 0),
        **dict.fromkeys(range(100, 130), 100),
    }
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_dedup(rows):
    """By distinct (id, text) in order; identical rows are one document."""
    seen, out = {}, {}
    known = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for doc in known:
        raw = (doc[1] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if seen.setdefault(raw[i : i + 100], (doc, i)) != (doc, i):
                gone[i : i + 100] = b"\1" * 100
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[doc] = (
            len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))),
            hashlib.sha256(kept).hexdigest(),
        )
    return out


def check_dedup(docs, rows):
    expected = plain_dedup(rows)
    found = substring_dedup.dedup(docs).selectExpr(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)"
    )
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(
        ((row[0], *expected[row]) for row in rows), key=repr
    )


def test_passages_edge_rows(edge_docs, no_docs):
    check_dedup(edge_docs, EDGE)
    assert substring_dedup.dedup(no_docs).count() == 0
    kept = substring_dedup.keep(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len(EDGE)


def passages(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(40)]
    shared = [" ".join(rng.choices(words, k=rng.randint(15, 80))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(3)]
        for p in rng.sample(shared, 2):
            cut = rng.randint(0, 30)
            parts.insert(rng.randint(0, len(parts)), p[cut:] if rng.random() < 0.5 else p)
        rows.append((i, rng.choice(["", " ", "\n"]).join(parts)))
    return [*rows, (60, "ab" * 700)]


@pytest.mark.parametrize("seed", range(2))
def test_passages_equal_brute_force(make_docs, seed):
    check_dedup(make_docs(passages(seed)), passages(seed))


@pytest.mark.parametrize("seed", range(2, 4))
def test_passages_across_many_small_buckets(make_docs, conf, seed):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "24")
    check_dedup(make_docs(passages(seed)), passages(seed))


def lines_in_own_surroundings(seed, n=240):
    """A third of the documents hold one line, of them a third with the same words before or behind."""
    rng = random.Random(seed)
    line = " The same sixty bytes of a line stand in many documents here. "

    def prose(k):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(k))

    ends = [prose(12), prose(3)]
    rows = []
    for i in range(n):
        text = prose(rng.randint(10, 40))
        if i % 3 == 0:
            before = text + rng.choice(ends) if i % 9 == 0 else text
            text = before + line + (rng.choice(ends) if i % 9 < 6 else "") + prose(30)
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed, times", [(5, 2), (6, 2), (6, 10_000)])
def test_frequent_grams_give_the_same_passages(make_docs, conf, monkeypatch, seed, times):
    """As many buckets as there are groups: windows go on to the right and to the left."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "24")
    monkeypatch.setattr(substring_dedup, "PROBED", 1)
    monkeypatch.setattr(substring_dedup, "TIMES", times)
    rows = [*lines_in_own_surroundings(seed), *((i + 1000, t) for i, t in passages(seed))]
    check_dedup(make_docs(rows), rows)


@pytest.mark.parametrize("batch", [1, 150, 4000])
def test_long_texts_are_hashed_in_parts(make_docs, monkeypatch, batch):
    monkeypatch.setattr(substring_dedup, "BATCH", batch)
    rows = passages(7)[40:]
    rows += [(100, " ".join(t for _, t in rows)), (101, "x" + rows[0][1] * 3)]
    check_dedup(make_docs(rows), rows)


def test_parts_hold_each_window_once():
    frame = pd.DataFrame({"doc": [4, 5, 6, 7], "text": ["ab" * 333, None, "é" * 50, "c" * 99]})
    seen = []
    for data, ends, docs, begins in substring_dedup._batches(frame, 100, 64):
        for a, b, doc, begin in zip([0, *ends], ends, docs, begins, strict=False):
            seen += [(doc, begin + i) for i in range(b - a - 99)]
        assert len(data) == ends[-1] < 2 * 64 + 100
    assert seen == [(4, i) for i in range(567)] + [(6, 0)]


def test_a_frequent_line_is_no_single_group(spark, monkeypatch):
    """A third of 20,000 documents: its runs lie in all partitions, each about as large."""
    monkeypatch.setattr(substring_dedup, "PROBED", 8)
    line = "-- this one line of sixty bytes stands in a third of them. --"
    words = "concat_ws(' ', transform(sequence(1, 12), i -> md5(concat(id, '-', i))))"
    docs = spark.range(20_000).selectExpr(
        "id AS doc", f"IF(id % 3 = 0, concat(md5(string(id)), ' {line} ', md5(string(-id))), {words}) AS text"
    )
    dealt = substring_dedup.dealt(docs).repartition(16, "key")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * np.median(sizes)
    most = dealt.where("frequent").groupBy("gram").count().agg(F.max("count")).first()[0]
    assert most > 6000
    assert substring_dedup.spans(docs).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_multikey_quicksort_sorts(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 3, (2000, 5)).astype(np.uint64)
    order = substring_dedup.multikey_quicksort(rows)
    assert sorted(order) == list(range(2000))
    assert [tuple(r) for r in rows[order]] == sorted(tuple(r) for r in rows)
