"""Shards, URLs, tokens, packing, pieces and vectors against plain Python."""

import functools
import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_edge import EDGE
from salesmill.llm import (
    packing,
    queries,
    sentencepiece,
    sharding,
    token_files,
    tokens,
    url_filter,
    vector_dedup,
)

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = queries.queries()[name](spark, SF_DIR)
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(df.columns)
    found = sorted((tuple(r) for r in df.select(names).collect()), key=repr)
    assert found == sorted(cursor.fetchall(), key=repr)


def test_sql_of_rules_on_edge_rows(edge_docs):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", EDGE)
    cursor = duck.execute(queries.oracle_sql()["op2_quality_rules"])
    names = [column[0] for column in cursor.description]
    judged = queries.quality_rules.judge(edge_docs).selectExpr("row.doc_id", *names[1:])
    found = sorted((tuple(r) for r in judged.collect()), key=repr)
    assert found == sorted(cursor.fetchall(), key=repr)


# Shards.


def fewest(sizes, capacity):
    shards, room = 1, capacity
    for size in sizes:
        if size > room:
            shards, room = shards + 1, capacity
        room -= size
    return shards


@pytest.mark.parametrize("seed", range(8))
def test_capacity_is_the_smallest_and_cuts_keep_it(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 5, 40, 400]) for _ in range(rng.randint(1, 60))]
    shards = rng.randint(1, 9)
    capacity = sharding.smallest_capacity(sizes, shards)
    assert max(sizes) <= capacity and fewest(sizes, capacity) <= shards
    assert capacity == max(sizes) or fewest(sizes, capacity - 1) > shards
    starts = [0, *sharding.cut(sizes, shards), len(sizes)]
    assert starts == sorted(starts) and len(starts) == shards + 1
    assert max(sum(sizes[a:b]) for a, b in zip(starts, starts[1:], strict=False)) <= capacity


def test_one_large_group_leaves_the_rest_even():
    sizes = [1] * 300 + [200] + [1] * 300
    starts = [0, *sharding.cut(sizes, 8), len(sizes)]
    parts = [sum(sizes[a:b]) for a, b in zip(starts, starts[1:], strict=False)]
    assert max(parts) == 200 and sorted(parts)[0] > 50


def largest_shard(rows):
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    return max(sizes.values())


def plain_groups(texts):
    sizes = Counter()
    for text in texts:
        sizes[hashlib.md5(text.encode()).hexdigest()] += len(text.encode()) + 1
    return [sizes[name] for name in sorted(sizes)]


@pytest.mark.parametrize("digits, hot", [(1, 0), (1, 900), (2, 900), (1, 20_000), (0, 5000)])
def test_shards_are_cut_between_groups_at_any_grain(spark, monkeypatch, digits, hot):
    """Few digits: most atoms hold many groups, and those with a cut have to be refined."""
    monkeypatch.setattr(sharding, "ATOM_DIGITS", digits)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    monkeypatch.setattr(sharding, "REFINED", 3)
    monkeypatch.setattr(sharding.shard_starts, "__defaults__", (digits,))
    rng = random.Random(digits + hot)
    texts = ["t" * rng.choice([1, 3, 30, 120]) + str(i) for i in range(1500)] + ["hot"] * hot
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard(docs, 7).collect()
    assert largest_shard(rows) == sharding.smallest_capacity(plain_groups(texts), 7)
    assert len({(r.text_crc32, r.shard) for r in rows}) == len(set(texts))


def test_more_groups_than_first_atoms(spark):
    texts = [f"text {i} {'x' * (i % 50)}" for i in range(150_000)]
    docs = spark.range(150_000).selectExpr("id AS doc_id", "concat('text ', id, ' ', repeat('x', cast(id % 50 as int))) AS text")
    placed = sharding.shard(docs).groupBy("shard").agg({"size": "sum"}).collect()
    assert max(r[1] for r in placed) == sharding.smallest_capacity(plain_groups(texts), 16)


def test_shards_edge_rows(edge_docs, no_docs):
    rows = sharding.shard(edge_docs).collect()
    texts = sorted((repr(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in EDGE)
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in rows) == texts
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert all(0 <= shard < 16 for shard in slots)
    shard_of = {r.doc_id: r.shard for r in rows}
    assert shard_of[1] == shard_of[7] and shard_of[2] == shard_of[3]
    assert sharding.shard(no_docs).count() == 0


# URLs.


def plain_rule(url):
    rest = (url or "").partition("://")[2]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        r
        for r in url_filter.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


URLS = [
    None, "", "no scheme", "https://", "https://Www.Example.COM/en/1?x#y", "http://example.com/en/2",
    "http://a.example.com/fr", "http://notexample.com/en/", "x://b.net/es/1", "x://b.net?/es/1",
    "x://b.net/ES/1", "x://net/fr/", "x://b.org/é/://c.com/", "x://com", "x://com/", "x://É.com/#",
    "http://example.com/en/2", "http://example.org/" + "long/" * 2000,
]


def test_rules_of_odd_urls(spark):
    pages = spark.createDataFrame(
        [(i, u, "<p>", "v") for i, u in enumerate(URLS)],
        "page_id long, url string, html string, verdict string",
    )
    rows = url_filter.judge(pages).collect()
    assert {r.page_id: (r.host, r.path, r.rule) for r in rows} == {
        i: plain_rule(u)[:3] for i, u in enumerate(URLS)
    }
    assert all(r.verdict in ("allow", "block") for r in rows)
    assert all(r.verdict == plain_rule(URLS[r.page_id])[3] for r in rows if r.rule)
    assert url_filter.judge(pages.where("false")).count() == 0


def plain_ratio(counts, gram):
    """Witten-Bell by recursion."""

    def p(kind, k):
        if k == 0:
            return 1 / url_filter.ALPHABET
        tail = gram[-k:]
        own, after = counts[kind][k], tail[:-1]
        total = sum(n for g, n in own.items() if g[:-1] == after)
        kinds = sum(1 for g in own if g[:-1] == after)
        lower = p(kind, k - 1)
        return (own.get(tail, 0) + kinds * lower) / (total + kinds) if total else lower

    return math.log(p(0, url_filter.ORDER)) - math.log(p(1, url_filter.ORDER))


def test_language_model_equals_recursion(spark):
    seen = [("abcde", 3, 0), ("xbcde", 1, 2), ("abcdf", 0, 4), ("zzzzz", 2, 1)]
    wanted = ["abcde", "abcdf", "abcdq", "qqqqq", "xzzzz", "bbcde"]
    counts = []
    for kind in (1, 2):
        by_order = {}
        for k in range(1, 6):
            by_order[k] = Counter()
            for row in seen:
                if row[kind]:
                    by_order[k][row[0][-k:]] += row[kind]
        counts.append(by_order)
    model = url_filter.log_ratios(
        spark.createDataFrame(seen, "gram string, accepted long, rejected long"),
        spark.createDataFrame([(g,) for g in wanted], "gram string"),
    )
    found = {r.gram: r.ratio for r in model.collect()}
    assert found.keys() == set(wanted)
    for gram, ratio in found.items():
        assert ratio == pytest.approx(plain_ratio(counts, gram))


def plain_judge(urls):
    """Scores and verdicts of URLs without a rule, by dictionaries."""
    order = url_filter.ORDER
    sites = {}
    for url in urls:
        host, path, _, verdict = plain_rule(url)
        sites[host + path] = verdict

    def own_grams(site):
        padded = "\x02" * (order - 1) + site + "\x03"
        return [padded[i : i + order] for i in range(len(site) + 1)]

    def held_out(site):
        draw = xxhash.xxh64_intdigest(site.encode(), 42)
        return (draw - (draw >> 63 << 64)) % url_filter.HELD_OUT == 0

    counts = [{k: Counter() for k in range(1, order + 1)} for _ in range(2)]
    for site, verdict in sites.items():
        if verdict and not held_out(site):
            for gram in own_grams(site):
                for k in range(1, order + 1):
                    counts[verdict != "allow"][k][gram[-k:]] += 1
    ratio = functools.cache(lambda gram: round(plain_ratio(counts, gram) * url_filter.UNITS))

    def score(site):
        found = [ratio(gram) for gram in own_grams(site)]
        return sum(found) / len(found) / url_filter.UNITS

    judged = [(score(s), v == "allow") for s, v in sites.items() if v and held_out(s)]
    errors = {}
    good, bad = ([x for x, kind in judged if kind == wanted] for wanted in (True, False))
    for place in range(-url_filter.BINS, url_filter.BINS + 2) if good and bad else ():
        def below(scores, place=place):
            bins = (min(max(math.floor(x * 100), -url_filter.BINS), url_filter.BINS) for x in scores)
            return sum(b < place for b in bins) / len(scores)

        errors[place] = below(good) + 1 - below(bad)
    ties = [place for place, error in errors.items() if math.isclose(error, min(errors.values()))]
    threshold = ties[len(ties) // 2] / 100 if ties else 0.0
    return {s: (score(s), "allow" if score(s) >= threshold else "block") for s, v in sites.items() if not v}


def test_scored_verdicts_equal_plain_python(spark):
    rng = random.Random(4)
    hosts = ["shop.com", "a.example.com", "b.net", "c.org", "d.org", "é😀.org"]
    paths = ["/en/", "/es/", "/fr/", "/de/", "/"]
    words = {"com": "buy list item", "net": "casino win now", "org": "item win page 😀"}
    urls = []
    for i in range(150):
        host, path = rng.choice(hosts), rng.choice(paths)
        own = words[host.rsplit(".", 1)[1]].split()
        urls.append(f"https://{host}{path}{rng.choice(own)}-{rng.choice(own)}{i % 20}")
    urls += ["", "https://x.org/" + "page-" * 300]
    expected = plain_judge(urls)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.judge(pages.repartition(3)).collect()
    assert {r.rule for r in rows} > {None} and len(rows) == len(urls)
    assert {v for _, v in expected.values()} == {"allow", "block"}
    for r in rows:
        if r.rule is None:
            score, verdict = expected[r.host + r.path]
            assert (r.score, r.verdict) == (pytest.approx(score, abs=1e-8), verdict)


def test_work_on_one_url_is_in_proportion_to_its_length(spark):
    """A million characters; work that grows with the square would take hours."""
    long = "https://a.org/" + "".join(f"{i * 7919 % 1000003:06d}" for i in range(170_000))
    urls = [long, "https://a.com/x", "https://b.net/es/y", "https://c.org/z"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    started = time.monotonic()
    rows = url_filter.judge(pages).select("page_id", F.length("path").alias("n"), "verdict").collect()
    assert time.monotonic() - started < 60
    assert {r.page_id: r.n for r in rows}[0] == len(long) - len("https://a.org")


# Tokens.

ODD = [
    "don't stop, I'll go", "a  b", "x\n\ny", " lead", "trail ", "trail\n", "a \nb", "a\n b",
    "<|endoftext|> a<|startoftext|>b", "œuvre cœur", "İstanbul ΣΑΣ", "tab\there", "A\u00a0B",
    "12 345,6 a1b2 ²³¹¼", "...!!! ???", "e\u0301\u0300 \u0301", "ªº µ", "", "\n", " ", "a\x1cb", "中文 字",
    "naïve Ærø ÿ×÷", "x" * 5000, "😀 👍🏽", "word, Word. WORD! (word) word-word word_word @word #1",
]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_equal_the_library_on_whole_texts(path):
    library, own = Tokenizer.from_file(path), tokens.Encoder(path)
    texts = ODD + [t for _, t in EDGE if t] + ["\n".join(ODD), " ".join(ODD)]
    for text, ids in zip(texts, own(texts), strict=True):
        expected = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert np.frombuffer(ids, tokens.ID).tolist() == expected


def library_ids(path):
    library = Tokenizer.from_file(path)
    return [[*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t in EDGE]


def test_token_files_edge_rows(spark, edge_docs, no_docs, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write(token_files.encode(edge_docs, WORDS), folder)
    files = token_files.read(spark, folder)
    ids = sorted(zip([i for i, _ in EDGE], library_ids(WORDS), strict=True), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected, start = [], 0
    for key, own in ids:
        expected.append((key, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    rows = [tuple(r) for r in token_files.documents(files).collect()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    assert files.where("key = 9").first()["ids"] == ids[[k for k, _ in ids].index(9)][1]
    empty = str(tmp_path / "empty")
    token_files.write(token_files.encode(no_docs, WORDS), empty)
    assert token_files.documents(token_files.read(spark, empty)).count() == 0


@pytest.fixture
def many_tokens(spark, make_docs, tmp_path, monkeypatch):
    """One file of several stripes, each of several row groups; the keys are even."""
    monkeypatch.setattr(token_files, "STRIPE_BYTES", 50_000)
    folder = str(tmp_path / "many")
    docs = make_docs([(2 * i, f"text {i} " + "word " * (i % 40)) for i in range(20_000)])
    token_files.write(token_files.encode(docs, WORDS).coalesce(1), folder)
    (path,) = (tmp_path / "many").glob("*.orc")
    return folder, str(path)


def test_stripes_have_row_indexes_and_bloom_filters_of_keys(spark, many_tokens):
    jvm = spark._jvm
    options = jvm.org.apache.orc.OrcFile.readerOptions(jvm.org.apache.hadoop.conf.Configuration())
    reader = jvm.org.apache.orc.OrcFile.createReader(
        jvm.org.apache.hadoop.fs.Path(many_tokens[1]), options
    )
    assert list(reader.getSchema().getFieldNames())[0] == "key"
    assert reader.getRowIndexStride() == token_files.INDEX_ROWS
    stripes = list(reader.getStripes())
    assert len(stripes) > 2 and sum(s.getNumberOfRows() for s in stripes) == 20_000
    rows = reader.rows()
    for stripe in stripes:
        footer = rows.readStripeFooter(stripe)
        found = {(s.getKind().toString(), s.getColumn()) for s in footer.getStreamsList()}
        # Column 1 is the key; the others have an index only.
        assert {("ROW_INDEX", i) for i in range(6)} <= found
        assert [c for kind, c in found if kind.startswith("BLOOM_FILTER")] == [1]
        # Version 2 of the integer run-length encoding.
        assert footer.getColumns(5).getKind().toString() == "DIRECT_V2"
    rows.close()


@pytest.mark.parametrize("key, groups", [(20_000, 1), (20_001, 0), (50_000, 0), (0, 1)])
def test_a_key_reads_one_row_group_and_an_absent_one_none(spark, many_tokens, key, groups):
    """The odd key lies between those of a row group: only the Bloom filter can leave it out."""
    wanted = token_files.read(spark, many_tokens[0]).where(f"key = {key}")
    plan = wanted._jdf.queryExecution().executedPlan()
    assert plan.execute().count() == groups
    (scan,) = [leaf for leaf in [plan.collectLeaves().apply(0)] if "Scan orc" in leaf.nodeName()]
    read = scan.metrics().apply("numOutputRows").value()
    assert groups <= read <= groups * token_files.INDEX_ROWS


def one_by_one(counts, window):
    """Best-fit decreasing as the textbook has it."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [i for i, room in enumerate(rooms) if room >= length]
            if fitting:
                rooms[min(fitting, key=lambda i: rooms[i])] -= length
            else:
                rooms.append(window - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(10))
def test_runs_equal_best_fit_one_by_one(seed):
    rng = random.Random(seed)
    window = rng.choice([8, 31, 64])
    counts = {rng.randint(1, window): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
    used, placed = defaultdict(list), Counter()
    for length, first, pieces, base, offset in packing.best_fit(counts, window):
        assert first == placed[length]
        placed[length] += pieces
        for k in range(pieces):
            used[base + k].append((offset, length))
    assert placed == counts
    for own in used.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= window
    rooms = sorted(window - sum(n for _, n in own) for own in used.values())
    assert rooms == one_by_one(counts, window)
    assert sorted(used) == list(range(len(used)))


def test_cells_grow_with_the_pieces_of_a_length():
    assert [packing.cell_count(n) for n in (1, 63, 5000, 10**7, 12 * 10**9)] == [1, 63, 64, 74, 12064]


@pytest.mark.parametrize("cells, each", [(packing.CELLS, packing.CELL_PIECES), (1, 3), (0, 1), (2, 10**6)])
def test_packing_edge_rows(edge_docs, no_docs, monkeypatch, cells, each):
    monkeypatch.setattr(packing, "CELLS", cells)
    monkeypatch.setattr(packing, "CELL_PIECES", each)
    placed = packing.pack(packing.cut(edge_docs, BYTES, 64), 64)
    rows = placed.collect()
    pieces = Counter()
    for (key, _), own in zip(EDGE, library_ids(BYTES), strict=True):
        for start in range(0, len(own), 64):
            pieces[(key, start, tuple(own[start : start + 64]), len(own))] += 1
    assert Counter((r.key, r.start, tuple(r.ids), r.doc_tokens) for r in rows) == pieces
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.ids))
    sequences = {r.sequence_id: r.ids for r in packing.sequences(placed, 64).collect()}
    assert sequences.keys() == by_sequence.keys()
    for number, own in by_sequence.items():
        ids = [i for _, part in sorted(own) for i in part]
        assert sequences[number] == ids + [0] * (64 - len(ids))
    assert packing.packed(no_docs, BYTES).count() == 0


# Pieces.


def test_sampled_pieces_are_lossless_and_reproducible(edge_docs, no_docs):
    def drawn(docs, seed):
        rows = sentencepiece.encode(docs, PIECES, seed)
        decoded = sentencepiece.decode(PIECES)("ids").alias("decoded")
        return sorted((tuple(r) for r in rows.select("key", "text", "ids", decoded).collect()), key=repr)

    rows = drawn(edge_docs, 1)
    assert all(decoded == (text or "") for _, text, _, decoded in rows)
    assert rows == drawn(edge_docs.repartition(1), 1)
    assert rows != drawn(edge_docs, 2)
    assert drawn(no_docs, 1) == []


@pytest.mark.parametrize("text", ["these", "to\u2581\U0001f389 an, 7é"])
def test_pieces_are_drawn_with_their_probabilities(text, monkeypatch):
    """All paths of a text, also over several parts and characters that are written as bytes."""
    own = sentencepiece.Vocabulary(PIECES, sharpness=0.5)
    paths = {}

    def walk(rest, ids, weight):
        if not rest:
            paths[tuple(ids)] = weight
        for n in range(1, len(rest) + 1):
            piece = rest[:n]
            if piece in own.ids and piece != sentencepiece.BLANK:
                walk(rest[n:], [*ids, own.ids[piece]], weight + own.weight[own.ids[piece]])
            elif n == 1:
                spelt = [int(own.byte_ids[b]) for b in piece.encode()]
                walk(rest[n:], [*ids, *spelt], weight + sentencepiece.BYTES_WEIGHT)

    walk(" " + text, [], 0.0)
    total = sum(map(math.exp, paths.values()))
    monkeypatch.setattr(sentencepiece, "PARTS", 2)
    n = 20_000
    cut, places = [], []
    for parts in own.cut(text):
        places.append(sum(map(len, cut)))
        cut.append(parts)
    keys = np.arange(n)
    drawn = [own.sample([parts] * n, keys, 5, np.full(n, at)) for parts, at in zip(cut, places, strict=True)]
    drawn = Counter(tuple(int(i) for ids in row for i in ids) for row in zip(*drawn, strict=True))
    assert drawn.keys() <= paths.keys()
    for ids, weight in paths.items():
        p = math.exp(weight) / total
        assert abs(drawn[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


@pytest.mark.parametrize("edges", [sentencepiece.EDGES, 50])
def test_round_trip_is_that_of_encode_and_decode(edge_docs, no_docs, monkeypatch, edges):
    monkeypatch.setattr(sentencepiece, "EDGES", edges)
    rows = sentencepiece.encode(edge_docs, PIECES).collect()
    expected = [
        (
            r.key, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()),
            zlib.crc32((r.text or "").encode()), True,
        )
        for r in rows
    ]
    monkeypatch.setattr(sentencepiece, "PARTS", 7)
    monkeypatch.setattr(sentencepiece, "BATCH", 100)
    found = sentencepiece.round_trip(edge_docs, PIECES)
    assert found.columns == ["key", "n_tokens", "ids_crc32", "text_crc32", "lossless"]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    assert sentencepiece.round_trip(no_docs, PIECES).count() == 0


# Vectors.

VECTORS = [
    (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.01, 0.0]), (4, None), (5, []),
    (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [float("nan"), 1.0, 0.0]),
    (9, [float("inf"), 1.0, 0.0]), (10, [0.0, 1.0, 0.0]), (11, [0.0, 1.0, 0.0]), (11, [0.0, 1.0, 0.0]),
    (None, [0.0, 0.0, 1.0]), (12, [1e-300, 0.0, 0.0]), (13, [1e200, 0.0, 0.0]), (14, [1.0, 0.0]),
]


def test_vectors_edge_rows(spark):
    table = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in VECTORS],
        "vec_id long, embedding array<double>, n_links int, cid string",
    )
    rows = vector_dedup.near_duplicates(table)
    found = sorted((tuple(r) for r in rows.collect()), key=repr)
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 14, None)]
    first = [(i, 4, 1, i == 1) for i in (1, 2, 3, 12, 13)]
    second = [(10, 2, 10, True), (11, 2, 10, False), (11, 2, 10, False)]
    assert found == sorted(alone + first + second, key=repr)
    assert vector_dedup.near_duplicates(table.where("false")).count() == 0
    assert vector_dedup.near_duplicates(table.where("vec_id = 4")).count() == 1


def test_lists_grow_with_the_square_root():
    assert [vector_dedup.list_count(n) for n in (1, 10**5, 10**6, 10**7, 10**12)] == [
        512, 512, 1000, 3162, 4096,
    ]


@pytest.mark.parametrize("sample, lists, most", [(vector_dedup.SAMPLE, 512, 4096), (200, 8, 30), (200, 200, 200)])
def test_recall_on_noisy_clusters(spark, monkeypatch, sample, lists, most):
    """Also with an index that is fitted on a seventh of the vectors, most of whose clusters are small."""
    for name, value in {"BLOCK": 100, "SAMPLE": sample, "LISTS": lists, "MOST_LISTS": most}.items():
        monkeypatch.setattr(vector_dedup, name, value)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 32))
    points = np.repeat(centres, rng.integers(1, 30, 60), 0)
    points = np.vstack([points, np.repeat(centres[:1], 500, 0)])
    points += rng.normal(scale=0.2, size=points.shape)
    units = points / np.linalg.norm(points, axis=1)[:, None]
    true = (units @ units.T >= 0.95).sum(1) - 1
    table = spark.createDataFrame(
        [(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>"
    )
    rows = vector_dedup.near_duplicates(table).collect()
    found = np.zeros(len(points), int)
    for r in rows:
        found[r.vec_id] = r.n_links
    assert (found <= true).all()
    assert found.sum() >= 0.9 * true.sum()
