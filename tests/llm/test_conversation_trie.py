"""The conversation trie against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import pyspark.sql.types as T

from periodlens.llm import conversation_trie as trie

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows, share_heads=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    made = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if share_heads else 0
        made[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + x[h:])
    members, ends = {}, {}
    for c, x in made.items():
        for d in range(len(x) + 1):
            members.setdefault(x[:d], []).append(c)
        ends.setdefault(x, []).append(c)
    out = {}
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    sums = {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves, saved = (0 if kids else 1), (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        sums[p] = leaves, saved = leaves + sum(sums[k][0] for k in kids), saved + sum(sums[k][1] for k in kids)
        out[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids), leaves, saved, hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
    return sorted(map(str, out.values()))


def got(spark, rows, extra=None, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    if extra:
        df = df.withColumns(extra)
    return sorted(str(tuple(r[c] for c in COLUMNS)) for r in trie.prefix_trie(spark, df, **options).collect())


def some(seed, convs=240, most=9, words=4):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 700), convs):
        for t in range(rng.randrange(1, most)):
            rows.append((c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(["hé llo", "", None, "x" * 30, *[f"w{i}" for i in range(words)]])))
    return rows


AWKWARD = [
    (0, None, "user", "first"), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "assistant", "b"), (0, 2, None, None),
    (1, 0, "user", "a"), (2, 0, "user", "a"), (None, 0, "user", "lost"), (101, 5, "", ""), (105, None, None, None), (205, 1, "us", "erx"), (206, 1, "user", "x"),
    (-7, 0, "user", "a"), (-1, 0, "user", "a"), (2**40, 1, "user", "日本"), *[(3, i, "user", f"long {i % 3}") for i in range(400)], *[(4, i, "user", f"long {i % 3}") for i in range(300)],
]


@pytest.mark.parametrize("rows", [some(1), some(2, words=1, most=14), AWKWARD, []], ids=["random", "few words", "awkward", "empty"])
def test_equals_brute_force(spark, rows):
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("limit", [1, 7, 60])
def test_small_shards_put_hot_subtrees_into_the_spine(spark, limit):
    rows = [(c, 0, "user", "hello") for c in range(300)] + [(c, t, "user", f"{(c * t) % 4}") for c in range(0, 300, 2) for t in range(1, 6)]
    assert got(spark, rows, limit=limit, share_heads=False) == brute(rows, share_heads=False)


def test_a_conversation_over_several_ranges_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 80)
    rows = [(7, i, "user", f"t{i % 5}") for i in range(1500)] + [(c, i, "user", "same") for c in range(900) for i in range(2)]
    assert got(spark, rows) == brute(rows)


def test_other_columns_are_not_read(spark):
    from pyspark.sql import functions as F

    rows = some(3, convs=40)
    assert got(spark, rows, {"c": F.lit("x"), "pos": F.lit(1), "k1": F.lit(None).cast("string"), "d": F.lit(2.5)}) == brute(rows)


def test_perfect_hash():
    rng = np.random.default_rng(0)
    lo, hi = rng.integers(0, 2**63, 5000, dtype=np.uint64), rng.integers(0, 2**63, 5000, dtype=np.uint64)
    lo[1] = lo[0] + np.uint64(1)
    slots = trie.PerfectHash(lo, hi)
    assert sorted(slots.find(lo, hi).tolist()) == list(range(5000))
    assert (slots.find(lo, hi + np.uint64(1)) == -1).all()  # the digest at the slot is another one
    assert (slots.find(rng.integers(0, 2**63, 1000, dtype=np.uint64), hi[:1000]) == -1).all()
    assert not len(trie.PerfectHash(lo[:0], hi[:0]).find(lo[:0], hi[:0]))
