"""The prefix-tree join against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from periodlens.llm import prefix_tree_join as join

from .helpers import awkward, documents, sample

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def ngrams(text, width=4):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, least=85):
    own = [ngrams(t) for _, t in rows]
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
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in groups[root(i)] if x is not None]
        out.append((d, len(own[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def got(df, spark, **options):
    return sorted((tuple(r) for r in join.similar_groups(spark, df, **options).collect()), key=str)


def edited(rng, words, share):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


def family(seed=5, n=70, words=120):
    """A base text and edited copies of every closeness, a chain of texts, texts made of common lines only."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    texts = [edited(rng, base, rng.choice([0.005, 0.012, 0.02, 0.04])) for _ in range(n)]
    chain = [f"c{i}" for i in range(150)]
    for step in range(12):  # each link is close to the next one only
        texts.append(" ".join(chain))
        chain[12 * step : 12 * step + 3] = [f"d{step}x{k}" for k in range(3)]
    lines = [" ".join(f"l{i}w{k}" for k in range(12)) for i in range(9)]
    texts += [" ".join(rng.sample(lines, rng.randrange(2, 9))) for _ in range(60)]
    texts += [" ".join(f"only{i}x{k}" for k in range(30)) + " " + lines[0] for i in range(20)]
    texts += ["x", "x y", "X  Y", "y x", "one two three", "one two three four", "one two three four five"]
    rng.shuffle(texts)
    return texts + texts[::3]


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.mark.parametrize("texts", [family(), awkward(60), []], ids=["family", "awkward", "empty"])
def test_equals_brute_force(spark, texts):
    df = documents(spark, texts)
    assert got(df, spark) == brute(rows_of(df))


@pytest.mark.parametrize("least, frequent", [(85, 3), (70, 5), (95, 1000)])
def test_small_blocks_ranges_and_few_frequent_ngrams(spark, monkeypatch, least, frequent):
    for name, value in {"BLOCK_BYTES": 9000, "RANGE": 300, "RANGES": 1, "FREQUENT": frequent, "MOST_FREQUENT": 40, "COUNTERS": 60, "EDGE": 5}.items():
        monkeypatch.setattr(join, name, value)
    df = documents(spark, family(seed=least))
    assert got(df, spark, least=least) == brute(rows_of(df), least)


def test_given_documents(spark):
    df = sample(spark)
    assert got(df.withColumns({"id": F.lit("x"), "t": F.lit(1), "_f": F.lit(2), "k": F.lit(None).cast("int")}), spark) == brute(rows_of(df))


def test_trie_finds_what_is_similar():
    rng = np.random.default_rng(1)
    pool = np.sort(rng.integers(0, 2**64, 90, dtype=np.uint64))
    members = {tuple(np.sort(rng.choice(pool, rng.integers(1, 80), replace=False))) for _ in range(150)}
    members |= {tuple(pool[:k]) for k in (1, 2, 5, 40, 41, 89, 90)} | {tuple(np.delete(pool, k)) for k in range(0, 90, 7)}
    members = [np.array(m, np.uint64) for m in sorted(members)]
    trie = join.Trie(members)
    for probe in [*members[::5], pool, pool[20:]]:
        for least in (50, 85, 100):
            want = [i for i, m in enumerate(members) if 100 * len(set(m) & set(probe)) >= least * len(set(m) | set(probe))]
            assert sorted(trie.similar(probe, least, np.ones(len(members), bool)).tolist()) == want
            some = np.arange(len(members)) % 3 == 0
            assert sorted(trie.similar(probe, least, some).tolist()) == [i for i in want if i % 3 == 0]


def test_counters_keep_what_is_frequent():
    rng = np.random.default_rng(2)
    often = join.Frequent(20)
    values = np.concatenate((np.repeat(np.arange(5, dtype=np.uint64), 400), rng.integers(100, 2**60, 3000, dtype=np.uint64)))
    for part in np.array_split(rng.permutation(values), 30):
        often.add(part)
    assert len(often.value) <= 20 and {0, 1, 2, 3, 4} <= set(often.value.tolist())
