"""Decontamination and top-k search against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from periodlens.llm import decontamination, topk

from .helpers import awkward, collected, documents, sample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, n=10):
    windows = defaultdict(set)
    for i, t in items:
        if i is None:
            continue
        w = words(t)
        for j in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[j : j + n])].add(str(i))
    lengths = {len(w) for w in windows}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for j in range(len(w)):
            for k in lengths:
                x = tuple(w[j : j + k])
                if len(x) == k and x in windows:
                    hit.update(range(j, j + k))
                    found |= windows[x]
        yield i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


PASSAGE = " ".join(f"Tok{i}" for i in range(30))
ITEMS = [(1, PASSAGE), (2, "two words"), (3, "One"), (10, PASSAGE.upper()), (4, None), (5, " .,"), (None, "word7 word8"), (6, "über5 w18 ÜBER6"), (1, "word1 Word2 word3"), (7, " ".join(f"word{i}" for i in range(100, 112)))]
TEXTS = [*awkward(), "x " + PASSAGE + " y", " ".join(PASSAGE.split()[3:13]), " ".join(PASSAGE.split()[3:12]), PASSAGE.replace("Tok15", "other"), "tok1", "One one two words. one", "zzÜber5"]
KEYS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def rows(df):
    return sorted([tuple(r[k] for k in KEYS) for r in collected(df)], key=str)


@pytest.mark.parametrize("block,shard", [(1 << 25, 1 << 21), (40, 64)])
def test_contamination(spark, monkeypatch, block, shard):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", shard)
    docs = documents(spark, TEXTS)
    # the whole of an item's rows stays in one block: its id decides
    found = decontamination.digest(decontamination.find_contamination(spark, docs.withColumn("items", docs.text), benchmark(spark, ITEMS)))
    want = sorted(brute([(r["doc_id"], r["text"]) for r in collected(docs)], ITEMS), key=str)
    assert rows(found) == want
    kept = decontamination.decontaminate(spark, docs, benchmark(spark, ITEMS))
    assert kept.schema == docs.schema and kept.count() == sum(not w[-1] for w in want)


def test_contamination_of_the_sample(spark):
    docs, items = sample(spark), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = sorted(brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]), key=str)
    assert rows(decontamination.digest(decontamination.find_contamination(spark, docs, items))) == want
    assert any(w[-1] for w in want)


def test_nothing_to_find(spark):
    docs = documents(spark, awkward())
    none = decontamination.digest(decontamination.find_contamination(spark, docs, benchmark(spark, [])))
    assert none.where("contaminated").count() == 0 and none.count() == docs.count()
    assert decontamination.find_contamination(spark, docs.limit(0), benchmark(spark, ITEMS)).count() == 0


# ---- top-k


def brute_top(rows, k=10, every=100):
    vectors = sorted({(i, tuple(int(np.floor(1024 * float(x))) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)})
    for q, a in vectors:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in vectors if i != q and len(b) == len(a))[:k]
            yield from ((q, r + 1, i, -s) for r, (s, i) in enumerate(scores))


def top_rows(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in collected(df))


@pytest.mark.parametrize("dims", [3, 16])
def test_top_k(spark, monkeypatch, dims):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 37)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(dims)
    data = [(i, [float(x) for x in rng.normal(size=dims)]) for i in range(350)]
    same = data[17][1]
    data += [(i, same) for i in range(400, 520)]  # a group of copies
    data += [(600, None), (601, []), (602, [None] * dims), (603, [float("nan")] * dims), (604, [float("inf")] * dims), (None, same), (700, same[:2]), (701, same[:2]), (17, same)]
    data += [(i, [round(float(x)) * 1.0 for x in rng.normal(size=dims)]) for i in range(800, 905)]  # ties
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    data = [(r.vec_id, r.embedding) for r in df.collect()]
    assert top_rows(topk.top_k(spark, df)) == list(brute_top(data))


def test_top_k_of_far_values_and_few_rows(spark):
    df = spark.createDataFrame([(0, [1e5, -3.0]), (1, [1e6, 1.0]), (2, [-1e6, 2.0]), (3, [0.5, 0.25])], "vec_id long, embedding array<double>")
    assert top_rows(topk.top_k(spark, df)) == list(brute_top([(r.vec_id, r.embedding) for r in df.collect()]))
    assert topk.top_k(spark, df.limit(0)).count() == 0


def test_top_k_of_the_sample(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert top_rows(topk.top_k(spark, df)) == list(brute_top([(r.vec_id, r.embedding) for r in df.collect()]))


def test_bounds_hold_the_scores():
    rng = np.random.default_rng(1)
    v, q = rng.integers(-900, 900, (500, 24)), rng.integers(-900, 900, (7, 24)).astype(float)
    low, width = v.min(0).astype(float), np.maximum(1, -(-(v.max(0) - v.min(0) + 1) // topk.CELLS)).astype(float)
    lower, upper = topk.bounds(topk.approximate(v, low, width).astype(float), low, width, q)
    exact = q @ v.T
    assert (lower <= exact).all() and (exact <= upper).all() and (upper - lower).mean() < 0.2 * np.abs(exact).mean() + 20_000


@pytest.mark.parametrize("block, shard", [(1 << 25, 1 << 19), (60, 120)])
def test_longest_matches(spark, monkeypatch, block, shard):
    import random
    import re

    monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", shard)
    rng = random.Random(8)
    line = [rng.choice("abcd") + str(rng.randrange(3)) for _ in range(60)]
    items = [("1", " ".join(line[:30])), ("2", " ".join(line[20:50])), ("2", " ".join(line[20:50])), ("3", "a0 b1"), ("4", ""), ("5", " ".join(line[:12] + line[:12])), (None, "a0 a0")]
    texts_ = [" ".join(rng.choice("abcd") + str(rng.randrange(3)) for _ in range(rng.randrange(30))) + " . ".join(["", *line[rng.randrange(20) : rng.randrange(20, 60)]]) for _ in range(25)]
    docs = documents(spark, [*texts_, None, "", " ".join(line), (None, " ".join(line))])
    bench = spark.createDataFrame(items, "item_id string, text string")

    def brute(text):
        words = re.findall(r"[a-z0-9]+", text or "")
        out = set()
        for name, item in items:
            own = re.findall(r"[a-z0-9]+", item)
            least = min(10, len(own))
            for i in range(len(words)):
                for j in range(len(own) if name and least else 0):
                    if i and j and words[i - 1] == own[j - 1]:
                        continue
                    n = 0
                    while i + n < len(words) and j + n < len(own) and words[i + n] == own[j + n]:
                        n += 1
                    if n >= least:
                        out.add((i, name, j, n))
        return out

    want = sorted(((r["doc_id"], *m) for r in docs.collect() for m in brute(r["text"])), key=str)
    got = sorted((tuple(r) for r in decontamination.longest_matches(spark, docs, bench).collect()), key=str)
    assert got == want
