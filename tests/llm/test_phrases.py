"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import pytest
import pyspark.sql.types as T
from pyspark.sql import functions as F

from periodlens.llm import phrases

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())])
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, k=2000):
    f, n = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, g), a in cand.items():
        for j in range(2, len(g)):
            for i in range(len(g) - j + 1):
                longer[lang, g[i : i + j]] = max(longer[lang, g[i : i + j]], a)
    out = {}
    for (lang, g), a in cand.items():
        if longer[lang, g] and 100 * longer[lang, g] >= 80 * a:
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, g[:c]] + f[lang, g[c:]]), c, f[lang, g[:c]], f[lang, g[c:]]) for c in range(1, len(g)))
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, x in out.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:k], 1))


def got(spark, rows, least, k=2000, extra=None):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    if extra:
        df = df.withColumns(extra)
    return sorted(tuple(r) for r in phrases.top(phrases.collocations(spark, df, least=least), k).collect())


def some(seed, n=120, vocabulary=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Über", "É", "a\x0bb", "x\u00a0y", "THE", "the", "日本"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?", "\r\n", ":"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(0, 60)))
        if rng.random() < 0.4:
            text += " strong tea in the house. " * rng.randrange(3)
        rows.append((i, rng.choice(["en", "en", "fr", None, "und", ""]), text))
    return rows


AWKWARD = [(1, "en", None), (2, "en", ""), (3, None, "one two three"), (3, None, "one two three"), (None, "und", "One TWO three"), (5, "en", "a " * 3000), (6, "fr", "...!!"), (7, "fr", " b b b b b b b"), (8, "fr", "word")]


@pytest.mark.parametrize("rows, least", [(some(1), 3), (some(2, vocabulary=3), 5), (some(3), 40), (AWKWARD, 2), ([], 2)], ids=["many", "few words", "frequent", "awkward", "empty"])
def test_equals_brute_force(spark, rows, least):
    assert got(spark, rows, least) == brute(rows, least)


def test_blocks_and_ranks(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 50)
    rows = some(4)
    assert got(spark, rows, 3, k=7, extra={"c1": F.lit("x"), "m": F.lit(0), "word": F.lit(None).cast("string")}) == brute(rows, 3, k=7)


def test_streams_over_small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = some(5, n=60)
        assert got(spark, rows, 3) == brute(rows, 3)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_scores_beyond_64_bits(spark):
    df = spark.range(1).select(F.lit(9 * 10**18).cast("long").alias("f"), F.lit(9 * 10**18).cast("long").alias("l1"), F.lit(9 * 10**18).cast("long").alias("r1"))
    assert df.select(F.expr(phrases.score_sql(1, 2_000_000)).alias("s")).first()["s"] == 10**6


def test_each_place_makes_one_phrase_of_three_or_four_words(spark, monkeypatch):
    made, counts = [], phrases.phrase_counts
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: made.append(counts(*a)) or made[-1])
    rng = random.Random(6)  # all pairs of six words come often, few phrases of three, hardly any of four
    rows = [(i, "en", " ".join(f"w{rng.randrange(6)}" for _ in range(50)) + " strong tea in the house" * (i % 2)) for i in range(30)]
    assert got(spark, rows, 12) == brute(rows, 12)
    texts = [text.split() for *_, text in rows]
    pairs = Counter(p for w in texts for p in zip(w, w[1:]))
    places = sum(pairs[w[i], w[i + 1]] >= 12 and pairs[w[i + 1], w[i + 2]] >= 12 for w in texts for i in range(len(w) - 2))
    assert made[-1].groupBy().sum("cnt").first()[0] == places
