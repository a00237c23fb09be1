"""Near-duplicates against brute force."""

import random
import re
from math import comb

import numpy as np
import pytest

from periodlens.llm import graph, near_dedup

from .helpers import awkward, collected, documents, sample

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, least=85):
    """(id, n, component, kept) per row."""
    own = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if own[i] and own[j] and 100 * len(own[i] & own[j]) >= least * len(own[i] | own[j]):
                up[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    for i, (d, _) in enumerate(rows):
        ids = [x for x in groups[root(i)] if x is not None]
        c = min(ids) if ids else None
        yield d, len(own[i]), c, d == c


def edited(rng, words, share):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


def family(seed=5, n=60, words=150):
    """A base text and edited copies: all close to it, many not close to each other; and chains."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    texts = [edited(rng, base, 0.012) for _ in range(n)]
    texts.insert(n // 2, " ".join(base))
    chain = [f"c{i}" for i in range(200)]
    for step in range(12):  # each link is close to the next one only
        texts.append(" ".join(chain))
        at = 15 * step
        chain[at : at + 4] = [f"d{step}x{k}" for k in range(4)]
    return texts


def rows_of(df):
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in collected(df)], key=str)


@pytest.mark.parametrize("least", [85, 80])
def test_near_duplicates(spark, least):
    docs = documents(spark, [*awkward(), *[(100 + i, t) for i, t in enumerate(family())], (7, "A B c d e f g"), (8, "a b\nC d e F g"), (None, "a b c d e f g")])
    docs = docs.withColumn("key", docs.text).withColumn("n", docs.text)
    got = rows_of(near_dedup.near_duplicates(spark, docs, least=least))
    assert got == sorted(brute([(r["doc_id"], r["text"]) for r in collected(docs)], least), key=str)
    assert sum(not g[3] for g in got) > 30


def test_open_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    texts = [edited(rng, base, 0.02) for _ in range(40)]  # no base: links between some of the copies only
    docs = documents(spark, texts)
    assert rows_of(near_dedup.near_duplicates(spark, docs)) == sorted(brute(list(enumerate(texts))), key=str)


def test_sample(spark):
    docs = sample(spark)
    want = sorted(brute([(r.doc_id, r.text) for r in docs.collect()]), key=str)
    assert rows_of(near_dedup.near_duplicates(spark, docs)) == want


def test_drop_keeps_one_row_of_each_group(spark):
    docs = documents(spark, [*awkward(), *family(n=10)])
    kept = near_dedup.drop_near_duplicates(spark, docs, least=85)
    rows = [(r["doc_id"], r["text"]) for r in collected(docs)]
    own = [shingles(t) for _, t in rows]
    groups = {}
    for (d, t), s, (_, _, c, _) in zip(rows, own, brute(rows), strict=True):
        groups.setdefault((c, d) if not s else c, []).append((d, t))
    assert kept.schema == docs.schema
    empty = sum(not s for s in own)
    assert kept.count() == empty + len({c for (d, t), s, (_, _, c, _) in zip(rows, own, brute(rows), strict=True) if s})
    assert near_dedup.drop_near_duplicates(spark, docs.limit(0)).count() == 0
    assert near_dedup.near_duplicates(spark, docs.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000 + i) for i in range(1, 80)] + [(4999, 5001)]
    labels = {r.node: r.label for r in graph.components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    up = {n: n for e in links for n in e}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        up[root(a)] = root(b)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert set(labels) == linked
    by = {}
    for n in linked:
        by.setdefault(root(n), set()).add(labels[n])
    assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)
    assert graph.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_pruning_rarely_drops_a_similar_pair():
    steps = near_dedup.least_matches(0.85, 1e-9)
    assert [n for n, _ in steps] == [24, 48, 72, 96, 120] and 70 < steps[-1][1] < 90
    for n, m in steps:  # the chance that a pair at the threshold falls below
        assert sum(comb(n, i) * 0.85**i * 0.15 ** (n - i) for i in range(m)) < 2e-8


def test_links_found_span_their_component(spark):
    words = [f"w{i}" for i in range(200)]
    docs = documents(spark, [" ".join([*words, f"end{i}"]) for i in range(6)] + ["all alone here"])
    out = near_dedup.near_duplicates(spark, docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept", "n_spanning_links"]
    found = {r.doc_id: r.n_spanning_links for r in out.collect()}
    assert found[6] == 0 and all(found[i] > 0 for i in range(6)) and sum(found.values()) >= 2 * 5
