"""The corpus pipeline: every stage against what it may keep, and the last one whole."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from periodlens.llm import near_dedup, pii
from periodlens.llm.rows import stage
from periodlens.llm.tokens import Encoder, vocabulary

from .helpers import collected
from .test_near_dedup import brute as groups
from .test_search import brute as leaks

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "PII", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        after = stage(spark, f(spark, docs, SF), "test")
        out.append((docs, after))
        docs = after
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in collected(df)]


def test_columns_stay(spark, steps):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    assert all(after.schema == schema for _, after in steps[:-1])


def test_quality_keeps_clean_rows(spark, steps):
    before, after = steps[0]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {i for i, _ in pairs(after)}
    clean = [i for i, _ in pairs(before) if i in labels and labels[i].quality == 1 and labels[i].toxic == 0]
    assert np.mean([i in kept for i in clean]) > 0.95 and after.count() < before.count()


def test_near_duplicates_leave_one_of_each_group(spark, steps):
    before, after = steps[1]
    want = {c for d, n, c, k in groups(pairs(before), 80)}
    assert {i for i, _ in pairs(after)} == want and after.count() == len(want)
    assert near_dedup.near_duplicates(spark, after, least=80).where("not kept").count() == 0


def test_contaminated_documents_go(spark, steps):
    before, after = steps[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [(d, t) for (d, t), r in zip(pairs(before), leaks(pairs(before), items), strict=True) if not r[-1]]
    assert sorted(pairs(after)) == sorted(want)


def test_personal_data_is_masked(steps):
    before, after = steps[3]
    for (i, a), (j, b) in zip(sorted(pairs(before)), sorted(pairs(after)), strict=True):
        assert i == j and b == pii.mask(a, pii.find(a)[1]) and not pii.find(b)[1]
    assert all(r["n_chars"] == len(r["text"]) for r in collected(after))


def test_packed_pieces_hold_every_id(spark, steps):
    before, after = steps[4]
    e = Encoder(vocabulary("word_bpe_49k.json"), "word")
    want = []
    for i, t in pairs(before):
        ids = np.array([*e.tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want += [(i, a, zlib.crc32(ids[a : a + 4096].tobytes())) for a in range(0, len(ids), 4096)]
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in collected(after)) == sorted(want)


def test_run_gives_the_stages_result(spark, steps):
    key = lambda df: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in collected(df))
    assert key(corpus_pipeline.run(spark, SF)) == key(steps[-1][1])
