"""The quality classifier: label model, scorer, held-out accuracy, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from periodlens.llm import quality

from .helpers import awkward, collected, documents

SF = "/root/testdata/sf0.1"


def test_expectation_maximisation_finds_the_accuracies():
    rng = np.random.default_rng(3)
    accuracy, leak, n = np.array([0.95, 0.7, 0.3, 0.85]), 0.03, 20_000
    voted = rng.random((n, 4)) < [0.1, 0.15, 0.2, 0.05]
    truth = ((voted & (rng.random((n, 4)) < accuracy)).any(1) | (rng.random(n) < leak)).astype(int)
    label = np.where(rng.random(n) < 0.33, truth, quality.NONE)
    v = np.concatenate((np.where(voted, quality.YES, quality.NONE), label[:, None]), 1)
    patterns, place, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    post, found_leak, found = quality.em(patterns, counts.astype(float))
    assert np.abs(found - accuracy).max() < 0.06 and abs(found_leak - leak) < 0.015
    best = np.where(label == quality.NONE, (quality.chance_of(v, accuracy, leak) > 0.5), truth)
    assert ((post[place.ravel()] > 0.5) == best).mean() > 0.97


def test_kinds_that_never_meet_are_all_found():
    """Two kinds of cases with heuristics of their own, of which only one kind has overlapping ones."""
    yes, none, no = quality.YES, quality.NONE, quality.NO
    patterns = np.array([[yes, none, none, none], [yes, none, none, yes], [none, yes, yes, none], [none, yes, yes, yes], [none, none, none, none], [none, none, none, no]])
    post, leak, found = quality.em(patterns, np.array([500, 100, 300, 150, 5000, 3000.0]))
    assert (post[:4] > 0.9).all() and (post[4:] < 0.05).all()


def test_scorer_learns_soft_labels():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.append(rng.integers(0, 5000, 60), [7] * (i % 3 == 0) + [quality.SIZE])) for i in range(900)]
    target = np.array([0.95 if 7 in r[:-1] else 0.03 for r in rows])
    w = quality.train(rows, target)
    score = np.array([w[r].sum() for r in rows])
    assert ((score > 0) == (target > 0.5)).mean() > 0.98 and (w != 0).sum() < 2500


def test_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(3)) == 0
    out = quality.classify(spark, docs, labels.where(~held)).join(labels.where(held), "doc_id")
    rows = collected(out.select("kept", "quality", "toxic"))
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    toxic = [r["kept"] for r in rows if r["toxic"] == 1]
    assert len(clean) > 800 and np.mean(clean) > 0.98
    assert np.mean(junk) < 0.05 and np.mean(toxic) < 0.25


@pytest.mark.parametrize("labelled", [False, True])
def test_awkward_rows(spark, labelled):
    docs = documents(spark, awkward()).withColumn("kept", F.lit("x"))
    rows = [(4, 1, 0), (4, 0, None), (None, 1, 1), (3, None, None)] if labelled else []
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    out = collected(quality.classify(spark, docs, labels))
    texts = [r["text"] for r in collected(docs)]
    assert len(out) == len(texts)
    for r, t in zip(out, texts, strict=True):
        if not (t or "").strip():
            assert not r["kept"] and r["junk_score"] is None
    kept = quality.filter_documents(spark, docs, labels)
    assert kept.schema == docs.schema and kept.count() == sum(r["kept"] for r in out)
    assert quality.classify(spark, docs.limit(0), labels).count() == 0
