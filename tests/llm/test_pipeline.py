"""The pipeline's stages on the smallest driver tables, each against what it has to do."""

import brute
import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(str(base / f"{k}"))
        out.append(spark.read.parquet(str(base / f"{k}")))
    return out


def test_stage_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "pii", "mixing", "packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality_keeps_good_documents(spark, stages):
    kept = {r.doc_id for r in stages[1].select("doc_id").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [r.doc_id for r in labels if r.quality == 0 or r.toxic == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good) and sum(d in kept for d in bad) <= 0.2 * len(bad)


def test_one_document_of_each_class_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert {r.doc_id for r in stages[2].collect()} == set(brute.classes(rows).values())
    assert stages[2].count() == stages[2].select("doc_id").distinct().count()


def test_personal_data_is_gone(stages):
    assert {r.doc_id for r in stages[3].collect()} == {r.doc_id for r in stages[2].collect()}
    assert all(not brute.base_spans(r.text) for r in stages[3].collect())
    before = {r.doc_id: r.text for r in stages[2].collect()}
    for r in stages[3].collect():
        assert r.n_chars == len(r.text)
        if not brute.base_spans(before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_mixing_leaves_nothing_out(stages):
    uses = {r.doc_id: r["count"] for r in stages[4].groupBy("doc_id").count().collect()}
    assert set(uses) == {r.doc_id for r in stages[3].collect()} and max(uses.values()) <= corpus_pipeline.MAX_REPEATS


def test_packing_holds_every_token(stages):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    want = sum(len(e.ids) + 1 for e in tok.encode_batch([r.text for r in stages[4].collect()], add_special_tokens=False))
    packed = stages[5]
    assert packed.agg(F.sum("length")).first()[0] == want
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 4096 for r in fill) and len(fill) <= -(-want // 4096) + 1


def test_run_equals_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, stages[5].select(key).collect()))


def test_stages_take_odd_and_empty_documents(spark, odd_docs, empty_docs):
    for start in (odd_docs, empty_docs):
        docs = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if k < 4:
                assert out.columns == docs.columns, name
            assert out.count() >= 0
            if k in (1, 2):
                docs = out


def test_copies_never_share_a_sequence_and_order_is_kept(spark, stages):
    """Sequences ascend with the place of their first document in the mixture; both copies of a document are apart."""
    places = {}
    for i, r in enumerate(stages[4].select("doc_id", "_metadata.file_path", "_metadata.row_index").orderBy("file_path", "row_index").collect()):
        places.setdefault(r.doc_id, []).append(i)
    members = {}
    for r in stages[5].collect():
        members.setdefault(r.sequence_id, []).append((r.doc_id, r.piece))
    assert all(len(set(m)) == len(m) for m in members.values())
    assert any(len(p) > 1 for p in places.values())
    for s, m in members.items():
        place = s >> 20
        assert place in places[[d for d, _ in m if place in places[d]][0]]


def test_small_stretches_follow_the_order(spark, stages):
    from flightlake.llm import packing
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(stages[4], path, in_order=True, part_pieces=20, patience=0).collect()
    order = {}
    for i, r in enumerate(stages[4].select("doc_id", "_metadata.file_path", "_metadata.row_index").orderBy("file_path", "row_index").collect()):
        order.setdefault(r.doc_id, []).append(i)
    for r in rows:      # every piece stands within a stretch of its sequence's first document
        assert min(abs(p - (r.sequence_id >> 20)) for p in order[r.doc_id]) <= 60
    assert rows[0].over_bound >= 0
