"""Phrase collocations from count streams kept in prefix and in suffix order.

1. Words get 64-bit codes. Counts of words, then of pairs, then of phrases of 3 and 4 words are made: a phrase is
   counted only where its words (for longer ones: its pairs) may be frequent, by a Bloom filter; counts
   are exact, as every part of a frequent phrase is frequent. Each task combines blocks before the shuffle.
   Each place makes one row, its longest phrase: a phrase of 3 words counts as often as it and the phrases of 4 that it begins.
2. The counts of two neighbouring levels are laid out as one sorted stream: in prefix order each shorter phrase stands
   right before the phrases it begins, in suffix order right before those it ends. One pass over a stream,
   in lockstep, hands a phrase the counts of all its first (last) parts and takes back the most frequent
   extension to the right (left). Streams are dealt out in sorted ranges; nothing is looked up in a hash table.
3. From these counts come the score of each cut and the phrases that a longer one explains: a longer phrase that holds a
   phrase holds an extension of it by one word, which is at least as frequent, so the two nearest levels decide.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``.
Defined results: null text is empty; null lang is ``und``; repeated rows count each; ties are ranked by score, a, phrase
(bytes); an empty table gives no rows; other columns aren't read. Two frequent words of one language with the same
64-bit code raise an error (never seen; words are told apart by their codes).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodlens.llm import bloom, texts
from periodlens.llm.rows import bounded_batches, stage
from periodlens.llm.texts import lean, mix
from periodlens.operators.metrics import ranked

LONGEST = 4
#: phrases combined at once in a task
BLOCK = 1 << 20

_CODES = [f"c{i}" for i in range(1, LONGEST + 1)]
_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(10, 14)]] = True
_IN_WORD = ~_BREAKS
_IN_WORD[[32, 9]] = False


def _chain(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(h * np.uint64(31) + code)


def _lang_codes(langs: list[str]) -> np.ndarray:
    """A 64-bit start value per language."""
    data = [x.encode() for x in langs]
    out = np.zeros(len(data), np.uint64)
    for i, x in enumerate(data):
        h = np.uint64(len(x) + 1)
        for b in x:
            h = _chain(np.array([h], np.uint64), np.array([b + 1], np.uint64))[0]
        out[i] = h
    return out


def _pieces(batch: pa.RecordBatch):
    """(language number per word, start value per word, piece per word, code, start, end, lower-cased bytes, languages) by segments."""
    langs = batch.column(0).dictionary_encode()
    names, of = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
    seeds = _lang_codes(names)
    for i, j, data, at in texts.segments(batch.column(1)):
        start, end, code, doc = texts.words(data, at, _IN_WORD)
        piece = np.cumsum(_BREAKS[data])[start] + doc if len(start) else doc  # both only grow: equal if both are
        lang = of[i:j][doc]
        yield lang, seeds[lang] if len(names) else np.zeros(0, np.uint64), piece, code, start, end, data, names


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, code, word, cnt), a row per block and distinct word; word null: all words of the block."""

    def run(batches: Iterator[pa.RecordBatch]):
        held, size, known = [], 0, {}

        def flush():
            h, lang, code, count = (np.concatenate([x[k] for x in held]) for k in range(4))
            words = [w for x in held for w in x[4]]
            order = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (code[order][1:] != code[order][:-1]))))
            at, each = order[first], np.add.reduceat(count[order], first)
            total = np.bincount(lang, count, len(known)).astype(np.int64)
            names, some = list(known), np.flatnonzero(total)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([names[k] for k in [*lang[at].tolist(), *some.tolist()]], pa.string()),
                    pa.array(np.concatenate((code[at].view(np.int64), np.zeros(len(some), np.int64)))),
                    pa.array([*[words[i] for i in at.tolist()], *[None] * len(some)], pa.string()),
                    pa.array(np.concatenate((each, total[some]))),
                ],
                names=["lang", "code", "word", "cnt"],
            )

        for batch in batches:
            for lang, seed, _, code, start, end, data, langs in _pieces(batch):
                if not len(code):
                    continue
                number = np.array([known.setdefault(x, len(known)) for x in langs], np.int32)
                h = _chain(seed, code)
                _, at, count = np.unique(h, return_index=True, return_counts=True)
                low = texts._LOWER[data].tobytes()
                words = [low[a:b].decode("utf-8", "replace") for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
                held.append((h[at], number[lang[at]], code[at], count, words))
                size += len(at)
                if size >= BLOCK // 4:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(lean(run), "lang string, code long, word string, cnt long")


def phrase_counts(docs: DataFrame, lengths: tuple[int, ...], frequent) -> DataFrame:
    """(lang, c1.., cnt) of the longest phrase of so many words that begins at each place, a row per block; codes beyond
    a phrase's words are 0.

    ``frequent``: a filter of the frequent phrases of one word less than the shortest length; a phrase counts only
    if all parts of that length may be frequent. A shorter phrase occurs as often as all rows that begin with it."""
    base = lengths[0] - 1
    names = _CODES[: lengths[-1]]

    def run(batches: Iterator[pa.RecordBatch]):
        held, size, known = [], 0, {}

        def flush():
            h, lang, *codes = (np.concatenate([x[k] for x in held]) for k in range(len(names) + 2))
            order = np.argsort(h, kind="stable")
            h = h[order]
            new = np.concatenate(([True], h[1:] != h[:-1]))
            for k, c in enumerate(codes):
                codes[k] = c = c[order]
                new[1:] |= c[1:] != c[:-1]  # phrases of one hash stay apart
            first = np.flatnonzero(new)
            lang = lang[order]
            languages = pa.DictionaryArray.from_arrays(pa.array(lang[first], pa.int32()), pa.array(list(known), pa.string())).cast(pa.string())
            return pa.RecordBatch.from_arrays([languages, *[pa.array(c[first].view(np.int64)) for c in codes], pa.array(np.diff(np.concatenate((first, [len(h)]))))], names=["lang", *names, "cnt"])

        for batch in batches:
            for lang, seed, piece, code, *_, langs in _pieces(batch):
                if len(code) <= base:
                    continue
                number = np.array([known.setdefault(x, len(known)) for x in langs], np.int32)
                part = seed
                for k in range(base):
                    part = _chain(part[: len(code) - k], code[k:])
                may = bloom.holds(frequent.value, part)  # of the part that begins at each word
                longest = np.zeros(len(code), np.int8)
                for m in lengths:
                    n = len(code) - m + 1
                    if n < 1:
                        continue
                    whole = piece[:n] == piece[m - 1 :]
                    for k in range(m - base + 1):
                        whole &= may[k : k + n]
                    longest[:n][whole] = m
                at = np.flatnonzero(longest)
                if len(at):
                    h, own = part[at], [code[at + k] for k in range(base)]
                    for k in range(base, lengths[-1]):
                        has = longest[at] > k
                        own.append(np.zeros(len(at), np.uint64))
                        own[k][has] = code[at[has] + k]
                        h[has] = _chain(h[has], own[k][has])
                    held.append((h, number[lang[at]], *own))
                    size += len(at)
                if size >= BLOCK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(lean(run), f"lang string, {', '.join(f'{n} long' for n in names)}, cnt long")


def _hashed(level: DataFrame, m: int) -> DataFrame:
    """(h): the hash that tasks compute of each phrase."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            h = _lang_codes(langs.dictionary.to_pylist())[langs.indices.to_numpy()] if batch.num_rows else np.zeros(0, np.uint64)
            for k in range(1, m + 1):
                h = _chain(h, batch.column(k).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return level.select("lang", *[f"c{i}" for i in range(1, m + 1)]).mapInArrow(lean(run), "h long")


_LEFT, _RIGHT = [f"l{k}" for k in range(1, LONGEST)], [f"r{k}" for k in range(1, LONGEST)]
_STREAM = ["m", *_CODES, "f", *_LEFT, *_RIGHT, "ext"]


def lockstep(level: DataFrame, m: int, side: str) -> DataFrame:
    """One pass over the stream of phrases of m - 1 and m words in prefix (``side`` = "l") or suffix order ("r").

    A longer phrase gets the counts of its first (last) parts from the shorter one before it, the shorter one the
    count of its most frequent extension; shorter phrases have m - 1 words in ``m``."""
    longer = F.col("m") == m
    key = [F.col(f"c{i}") if side == "l" else F.when(longer, F.col(f"c{i + 1}")).otherwise(F.col(f"c{i}")) for i in range(1, m)]
    keys = [f"k{i}" for i in range(1, m)]
    stream = level.select("lang", *_STREAM, *[k.alias(n) for k, n in zip(key, keys, strict=True)])
    # in suffix order the last word leads
    lead = keys if side == "l" else keys[::-1]
    stream = stream.repartitionByRange("lang", *lead).sortWithinPartitions("lang", *lead, "m")

    def run(batches: Iterator[pa.RecordBatch]):
        held: dict | None = None  # the last shorter phrase, which still gathers extensions
        for batch in batches:
            if not batch.num_rows:
                continue
            x = {n: batch.column(n).to_numpy().copy() for n in [*_STREAM, *keys]}
            lang = batch.column("lang")
            if held is not None:  # it stands before the batch's rows again
                x = {n: np.concatenate(([held[n]], v)) for n, v in x.items()}
                lang = pa.concat_arrays([pa.array([held["lang"]], pa.string()), lang.cast(pa.string())])
            short = x["m"] == m - 1
            at = np.maximum.accumulate(np.where(short, np.arange(len(short)), -1))
            long_ = np.flatnonzero(~short)
            up = at[long_]
            if len(long_) and (up.min() < 0 or any((x[n][long_] != x[n][up]).any() for n in keys)):
                raise AssertionError("a phrase stands apart from its part")
            # the counts of parts: of m - 1 words from the shorter phrase itself, of fewer from what it got
            if side == "l":  # l[k]: the first k words
                for k in range(1, m - 1):
                    x[f"l{k}"][long_] = x[f"l{k}"][up]
                x[f"l{m - 1}"][long_] = x["f"][up]
            else:  # r[k]: what follows the first k words
                for k in range(2, m):
                    x[f"r{k}"][long_] = x[f"r{k - 1}"][up]
                x["r1"][long_] = x["f"][up]
            np.maximum.at(x["ext"], up, x["f"][long_])
            last = int(at[-1])
            held = {n: v[last] for n, v in x.items()} | {"lang": lang[last].as_py()}
            keep = np.ones(len(short), bool)
            keep[last] = False
            yield pa.RecordBatch.from_arrays([lang.filter(pa.array(keep)).cast(pa.string()), *[pa.array(x[n][keep]) for n in _STREAM]], names=["lang", *_STREAM])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held["lang"]], pa.string()), *[pa.array([held[n]], pa.int64()) for n in _STREAM]], names=["lang", *_STREAM])

    return stream.mapInArrow(lean(run), "lang string, " + ", ".join(f"{n} long" for n in _STREAM))


def score_sql(k: int, scale: int) -> str:
    """floor(scale * f / (l + r)) of the cut after k words, in decimals of 38 digits."""
    return f"cast(cast({scale} as decimal(19,0)) * cast(f as decimal(19,0)) div (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0))) as long)"


def collocations(spark: SparkSession, docs: DataFrame, least: int = 30, absorbed: int = 80, scale: int = 2_000_000, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """Every candidate phrase (2 to 4 words, counted ``least`` times or more) that no longer one explains: lang, phrase, a, l, r, n, score.

    score: the least floor(scale * a / (l + r)) over all cuts into a first part (l) and a rest (r)."""
    bounded_batches(spark)
    docs = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_column), F.lit("")).alias("t"))
    counted = stage(spark, word_counts(docs).groupBy("lang", "code", "word").agg(F.sum("cnt").alias("f")).where(F.col("word").isNull() | (F.col("f") >= least)), "words")
    totals = counted.where("word is null").select("lang", F.col("f").alias("n"))
    words = counted.where("word is not null").select("lang", F.col("code").alias("c1"), "word", "f")
    if not words.groupBy("lang", "c1").count().where("count > 1").isEmpty():
        raise ValueError("two frequent words share a code")
    zero = F.lit(0).cast("long")

    def as_stream(level: DataFrame, m: int) -> DataFrame:
        has = set(level.columns)
        return level.select("lang", F.lit(m).cast("long").alias("m"), *[(F.col(n) if n in has else zero).alias(n) for n in _STREAM[1:]])

    shorter, done = as_stream(words, 1), []
    filters, counts = [], None
    for m in range(2, LONGEST + 1):
        # words, then pairs, then what frequent pairs make up: the two longest are counted in one pass
        if m <= 3:
            below = words if m == 2 else counts
            filters.append(bloom.of_hashes(spark, stage(spark, _hashed(below, m - 1), "hashes"), "h"))
            lengths = (2,) if m == 2 else tuple(range(3, LONGEST + 1))
            codes, first = _CODES[: lengths[-1]], ["lang", *_CODES[:m]]
            found = phrase_counts(docs, lengths, filters[-1])
            if m == 2:
                found = found.groupBy("lang", *codes).agg(F.sum("cnt").alias("f")).where(F.col("f") >= least)
            else:  # dealt out by the shorter phrase, whose count is the sum over all that follows it
                found = found.repartition(*first).groupBy("lang", *codes).agg(F.sum("cnt").alias("f"))
                found = found.withColumn("all", F.sum("f").over(Window.partitionBy(*first))).where(F.col("all") >= least)
            counts = stage(spark, found, f"phrases-{m}")
        if m == 2:
            level = counts
        elif m < LONGEST:
            level = counts.groupBy(*first).agg(F.first("all").alias("f"))
        else:
            level = counts.where((F.col(_CODES[LONGEST - 1]) != 0) & (F.col("f") >= least))
        in_prefix_order = stage(spark, lockstep(shorter.unionByName(as_stream(level, m)), m, "l"), "prefix-order")
        in_suffix_order = stage(spark, lockstep(in_prefix_order, m, "r"), "suffix-order")
        if m > 2:
            done.append((m - 1, in_suffix_order.where(F.col("m") == m - 1)))
        shorter = in_suffix_order.where(F.col("m") == m)
    done.append((LONGEST, shorter))
    wide = lambda c: (F.col(c) if isinstance(c, str) else F.lit(c)).cast("decimal(38,0)")
    out = None
    for m, found in done:
        found = found.where(wide(100) * wide("ext") < wide(absorbed) * wide("f"))
        cuts = [F.struct(F.expr(score_sql(k, scale)).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, m)]
        found = found.withColumn("x", F.array_min(F.array(*cuts))).select("lang", *_CODES[:m], F.col("f").alias("a"), "x.l", "x.r", "x.score")
        for i, c in enumerate(_CODES[:m], 1):
            found = found.join(words.select("lang", F.col("c1").alias(c), F.col("word").alias(f"w{i}")), ["lang", c])
        found = found.withColumn("phrase", F.concat_ws(" ", *[f"w{i}" for i in range(1, m + 1)])).select("lang", "phrase", "a", "l", "r", "score")
        out = found if out is None else out.unionByName(found)
    for shared in filters:
        shared.unpersist()
    return out.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def top(found: DataFrame, k: int = 2000) -> DataFrame:
    """The first k of each language by score, a (both descending) and phrase, numbered over sorted ranges: no language is one task's."""
    numbered = ranked(found.withColumn("less", -F.col("a")), ["lang"], "score", "rank", ["less", "phrase"], method="range").where(F.col("rank") <= k)
    return numbered.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
