"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from periodlens.llm import suffix_dedup

from .helpers import awkward, collected, documents, sample


def brute(rows, length=200):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    for (d, _), b in zip(rows, data, strict=True):
        cover = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                cover[i] += 1
                if i + length <= len(b):
                    cover[i + length] -= 1
        hit = np.concatenate(([False], np.cumsum(cover)[: len(b)] > 0, [False]))
        kept = bytes(x for x, h in zip(b, hit[1:], strict=False) if not h)
        yield d, len(b), int(hit.sum()), int((hit[1:] & ~hit[:-1]).sum()), hashlib.sha256(kept).hexdigest()


def rows_of(df):
    return sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in collected(df)], key=str)


def noise(rng, n):
    return "".join(rng.choice("abcdefghijklmnop éü") for _ in range(n))


def passages(seed=1):
    rng = random.Random(seed)
    p, q, r = noise(rng, 260), noise(rng, 199), noise(rng, 420)
    out = [noise(rng, 50) + p + noise(rng, 80), noise(rng, 9) + p, p + noise(rng, 300), q + noise(rng, 100), noise(rng, 100) + q]
    out += [noise(rng, 30) + r[:300], r[100:] + noise(rng, 30), noise(rng, 30) + r[50:260] + "!" + r[200:], r]
    out += [p + noise(rng, 40) + p, "abcdefg" * 60, "abcdefg" * 31, "z" * 500, "z" * 199, "z" * 200, "z" * 200, "y" * 200, "ab" * 101]
    for _ in range(60):  # one hot passage with other surroundings, some of them shared
        a, b = rng.randrange(0, 60), rng.randrange(230, 420)
        out.append(noise(rng, rng.randrange(0, 40)) + r[a:b] + noise(rng, rng.randrange(0, 40)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, seed):
    docs = documents(spark, [*awkward(60), *passages(seed), (None, "x" + passages(seed)[0])]).withColumn("spans", suffix_dedup.F.lit("x"))
    got = rows_of(suffix_dedup.digest(suffix_dedup.remove_repeats(spark, docs)))
    want = sorted(brute([(r["doc_id"], r["text"]) for r in collected(docs)]), key=str)
    assert got == want
    assert sum(w[2] > 0 for w in want) > 50 and any(0 < w[2] < w[1] for w in want)


def test_other_lengths(spark):
    docs = documents(spark, passages(3))
    out = suffix_dedup.digest(suffix_dedup.remove_repeats(spark, docs, length=40, gram=16))
    assert rows_of(out) == sorted(brute([(r["doc_id"], r["text"]) for r in collected(docs)], 40), key=str)


def test_sample(spark):
    docs = sample(spark)
    want = sorted(brute([(r.doc_id, r.text) for r in docs.collect()]), key=str)
    assert rows_of(suffix_dedup.digest(suffix_dedup.remove_repeats(spark, docs))) == want


def test_nothing(spark):
    assert suffix_dedup.remove_repeats(spark, documents(spark, [])).count() == 0
    assert collected(suffix_dedup.digest(suffix_dedup.remove_repeats(spark, documents(spark, ["one", None]))))[0]["n_removed"] == 0
