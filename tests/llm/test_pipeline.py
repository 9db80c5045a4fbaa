"""The pipeline's stages on odd rows: what each keeps, and what the last one places."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
import public_tokenizers
from llm_edge import EDGE, PROSE
from salesmill.llm.common import table
from test_text_operators import plain_components, plain_dedup, plain_fingerprint, plain_measures, near

#: Columns of documents, and some whose names clash with those that stages use.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, kept string, n int"
OTHER = " ".join(reversed(PROSE.split()))
#: Repeated ids with equal and with different texts, beside the usual odd rows.
ROWS = [*EDGE, (1, PROSE), (1, OTHER), (20, OTHER), (21, "intro " + PROSE * 4), (22, "other " + PROSE * 4)]


def documents(spark, rows):
    whole = [(i, t, "en", "s", None if t is None else len(t), 7, "x", 1) for i, t in rows]
    return spark.createDataFrame(whole, SCHEMA).repartition(3)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_five_stages():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_classifier", "quality_rules", "simhash_dedup", "substring_dedup", "packing",
    ]
    assert pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, stage):
    docs = documents(spark, ROWS)
    kept = stage(spark, docs, "")
    assert kept.schema.names == docs.schema.names
    assert [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
    assert stage(spark, documents(spark, []), "").count() == 0


def test_classifier_drops_what_it_rejects(spark):
    docs = documents(spark, ROWS)
    scored = pipeline.quality_classifier.score(docs).select("doc_id", "kept").collect()
    kept = pairs(pipeline.classify(spark, docs, ""))
    assert len(kept) == sum(r.kept for r in scored)
    assert not {t for _, t in kept} & {None, "", " \t\n\x0b\f\r "}


def test_rules_drop_what_fails(spark):
    kept = pairs(pipeline.apply_rules(spark, documents(spark, ROWS), ""))
    assert not [t for _, t in kept if plain_measures(t)[-1]]
    assert (1, PROSE) in kept and (1, OTHER) in kept


def test_one_row_of_each_group_stays(spark):
    fps = [plain_fingerprint(t) for _, t in ROWS]
    least = {}
    for root, (doc, text) in zip(plain_components(len(ROWS), near(fps)), ROWS, strict=True):
        order = (doc is None, doc or 0)
        if root not in least or order < least[root][0]:
            least[root] = order, doc, text
    kept = pairs(pipeline.drop_near_copies(spark, documents(spark, ROWS), ""))
    assert kept == sorted(((doc, text) for _, doc, text in least.values()), key=repr)


def test_passages_are_cut(spark):
    expected = plain_dedup(ROWS)
    kept = pipeline.cut_passages(spark, documents(spark, ROWS), "").collect()
    sizes = sorted(((r.doc_id, len((r.text or "").encode())) for r in kept), key=repr)
    assert sizes == sorted(
        ((row[0], expected[row][0] - expected[row][1]) for row in ROWS), key=repr
    )
    assert all(r.n_chars == len(r.text) for r in kept if r.text)


def test_pieces_are_placed(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, r[1]) for i, r in enumerate(ROWS)]
    placed = pipeline.pack(spark, documents(spark, rows), "").collect()
    whole = {}
    for doc, text in rows:
        whole[doc] = [*library.encode(text or "", add_special_tokens=False).ids, 1]
    at = dict.fromkeys(whole, 0)
    for r in sorted(placed, key=lambda r: (r.doc_id, r.start)):
        ids = whole[r.doc_id][r.start : r.start + r.length]
        assert (r.start, r.doc_tokens) == (at[r.doc_id], len(whole[r.doc_id]))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at[r.doc_id] += r.length
    assert at == {doc: len(ids) for doc, ids in whole.items()}
    ends = {}
    for r in sorted(placed, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
        assert r.offset + r.length <= 2048
    assert pipeline.pack(spark, documents(spark, []), "").count() == 0


def test_run_hands_on_what_each_stage_kept(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    plain = sorted(map(tuple, docs.select("doc_id", "start", "length", "ids_crc32").collect()))
    run = pipeline.run(spark, folder)
    assert sorted(map(tuple, run.select("doc_id", "start", "length", "ids_crc32").collect())) == plain
    assert len(plain) > 50
