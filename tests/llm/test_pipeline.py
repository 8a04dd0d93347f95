import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from plain_versions import plain_line_dedup, plain_near_copies, plain_private

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage got and gave."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, FOLDER).cache()
        out.append((name, docs, made))
        docs = made
    yield {n: (a.toPandas().set_index("doc_id"), b) for n, a, b in out}
    for _, _, made in out:
        made.unpersist()


def test_stages(spark, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "pii", "packing"]
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    assert all([(f.name, f.dataType) for f in steps[n][1].schema] == [(f.name, f.dataType) for f in schema] for n in list(steps)[:-1])


def test_toxic_documents_go(spark, steps):
    before, after = steps["toxicity"]
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    assert kept < set(before.index)
    assert np.mean([(d not in kept) == bool(t) for d, t in toxic.items()]) > 0.95


def test_line_stage(steps):
    before, after = steps["line_dedup"]
    expected = plain_line_dedup(before)
    got = {r.doc_id: (r.text, r.n_chars) for r in after.collect()}
    assert got == {d: (t, len(t)) for d, t in expected.items()}


def test_near_copy_stage(steps):
    before, after = steps["simhash_near_dedup"]
    kept = {r.doc_id for r in after.collect()}
    sure, maybe = plain_near_copies(before, 0.85), plain_near_copies(before, 0.7)
    # every group of sure copies leaves at most one; every group that might be one leaves something
    assert all(len(kept & g) <= 1 for g in sure) and all(kept & g for g in maybe)


def test_personal_data_is_replaced(steps):
    before, after = steps["pii"]
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(before.index)
    assert not any(plain_private(r.text) for r in rows)
    assert all(r.text == before.text[r.doc_id] for r in rows if "[" not in r.text)


def test_packing_holds_every_document(steps):
    before, after = steps["packing"]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in after.collect():
        assert zlib.crc32(r.ids) == r.ids_crc32
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
    assert set(pieces) == set(before.index)
    for d, p in pieces.items():
        assert b"".join(x for _, x in sorted(p)) == np.array(t.encode(before.text[d], add_special_tokens=False).ids + [0], "<u4").tobytes()


def test_run_is_the_stages(spark, steps):
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = corpus_pipeline.run(spark, FOLDER).groupBy("doc_id").agg({"length": "sum"}).collect()
    own = steps["packing"][1].select(*cols).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, own))


def test_an_empty_table_goes_through(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_toxicity_stage_keeps_a_column_named_score(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = corpus_pipeline.toxicity_stage(spark, docs.selectExpr("*", "doc_id % 7 as score"), FOLDER)
    assert got.columns == [*docs.columns, "score"]
    assert {(r.doc_id, r.score) for r in got.collect()} == {(r.doc_id, r.doc_id % 7) for r in corpus_pipeline.toxicity_stage(spark, docs, FOLDER).collect()}
