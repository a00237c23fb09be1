"""Benchmark decontamination by suffix arrays of the training documents.

Each task cuts its documents into shards of bounded size and builds a suffix array of each over
word ids: suffixes are sorted by their first ``window`` words. Every suffix of every benchmark
item is looked up in it by binary search, one word deeper at a time, which gives the interval
of suffixes that share its first 1, 2, ... words; an interval that is left at full depth holds
all places of that verbatim window, and windows that follow each other in the document and the item
give the longest matches with their places (:func:`longest_matches`). Suffixes
whose first two words begin no benchmark suffix can never be found and aren't sorted.

The benchmark reaches the tasks in blocks of bounded size, each sent once; a larger benchmark
takes more blocks, and what they hit is put together per document.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; a window is ``window``
consecutive words of an item, an item of fewer (but not none) is one window. Defined results:
null text has no words; items with a null id or no words take no part; an item id that
occurs twice counts once; null or repeated document ids are judged each; an empty benchmark
hits nothing, empty documents give no rows; other columns are kept (decontaminate) or not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm import texts
from periodlens.llm.rows import with_row_key
from periodlens.llm.texts import lean

#: characters of benchmark text sent to the tasks at once
BLOCK_CHARS = 1 << 25
SHARD_BYTES = 1 << 19


class TestSuffixes:
    """The windows of a block of benchmark items, as ids of the block's own words."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int):
        names = sorted({i for i, _ in items})
        number = {n: k for k, n in enumerate(names)}
        data, at = texts.text_bytes(pa.array([t for _, t in items], pa.large_string()))
        _, _, hashes, doc = texts.words(data[: at[-1]], at, texts.ALNUM)
        self.names = names
        self.vocabulary, ids = np.unique(hashes, return_inverse=True)
        ids = ids.astype(np.int64) + 1
        count = np.bincount(doc, minlength=len(items)) if len(items) else np.zeros(0, np.int64)
        first = np.concatenate(([0], np.cumsum(count)))
        rows: dict[tuple[int, ...], set[int]] = {}
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for k, (name, _) in enumerate(items):
            own = ids[first[k] : first[k + 1]].tolist()
            for j in range(max(1, len(own) - window + 1) if own else 0):
                rows.setdefault(tuple(own[j : j + window]), set()).add(number[name])
                places.setdefault(tuple(own[j : j + window]), []).append((k, j))
        #: the places of each window, as (text, first word there), and the item of each text
        self.places = [np.array(x, np.int64) for x in places.values()]
        self.item_of = np.array([number[name] for name, _ in items], np.int64)
        self.window = window
        self.length = np.array([len(r) for r in rows], np.int64)
        self.ids = np.zeros((len(rows), window), np.int64)
        for k, r in enumerate(rows):
            self.ids[k, : len(r)] = r
        self.items = [np.array(sorted(x), np.int64) for x in rows.values()]
        two = self.length > 1
        self.pairs = np.unique(self.ids[two, 0] * (len(self.vocabulary) + 1) + self.ids[two, 1]) if window > 1 else np.zeros(0, np.int64)
        self.single = np.zeros(len(self.vocabulary) + 1, bool)
        self.single[self.ids[~two, 0] if window > 1 else self.ids[:, 0]] = True


def lookup(data: np.ndarray, at: np.ndarray, test: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the documents of a shard: (words of each, first word of each, places, windows found there)."""
    n_docs, size = len(at) - 1, len(test.vocabulary) + 1
    _, _, hashes, doc = texts.words(data, at, texts.ALNUM)
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(count)))
    none = np.zeros(0, np.int64)
    if not len(hashes) or size == 1:
        return count, first, none, none
    # ids of the benchmark's words, 0 for others; a document ends with a 0, so places move by its number
    found = np.searchsorted(test.vocabulary, hashes)
    found[found == size - 1] = 0
    ids = np.zeros(len(hashes) + n_docs + test.window, np.int64)
    place = np.arange(len(hashes)) + doc
    ids[place] = np.where(test.vocabulary[found] == hashes, found + 1, 0)
    start = place[(ids[place] > 0)]
    pair = ids[start] * size + ids[start + 1]
    near = np.searchsorted(test.pairs, pair)
    near[near == len(test.pairs)] = 0
    start = start[test.single[ids[start]] | (test.pairs[near] == pair if len(test.pairs) else False)]
    columns = [ids[start + j] for j in range(test.window)]
    order = np.lexsort(columns[::-1])
    array, columns = start[order], [c[order] for c in columns]
    # one word deeper at a time: key = (rank of the words so far, next word) ascends along the array
    rank = np.zeros(len(array), np.int64)
    low, high = np.zeros(len(test.ids), np.int64), np.full(len(test.ids), len(array), np.int64)
    alive = np.arange(len(test.ids))
    for j in range(test.window):
        alive = alive[(test.length[alive] > j) & (low[alive] < high[alive])]
        if not len(alive):
            break
        key = rank * size + columns[j]
        want = rank[low[alive]] * size + test.ids[alive, j]
        low[alive], high[alive] = np.searchsorted(key, want, "left"), np.searchsorted(key, want, "right")
        rank = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
    n = np.maximum(high - low, 0)
    window = np.repeat(np.arange(len(n)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return count, first, array[low[window] + inside], window


def _judge(data: np.ndarray, at: np.ndarray, test: TestSuffixes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per document: words, spans of hit words (starts and ends in turn), items."""
    count, first, place, window = lookup(data, at, test)
    n_docs = len(at) - 1
    base = first[:-1] + np.arange(n_docs)
    owner = np.searchsorted(base, place, "right") - 1
    order = np.argsort(owner, kind="stable")
    cut = np.searchsorted(owner[order], np.arange(n_docs + 1))
    for d in range(n_docs):
        own = order[cut[d] : cut[d + 1]]
        if not len(own):
            yield int(count[d]), np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        change = np.zeros(count[d] + 1, np.int64)
        start = place[own] - base[d]
        np.add.at(change, start, 1)
        np.add.at(change, start + test.length[window[own]], -1)
        hit = np.concatenate(([False], np.cumsum(change)[:-1] > 0, [False]))
        yield int(count[d]), np.flatnonzero(hit[1:] != hit[:-1]), np.unique(np.concatenate([test.items[w] for w in np.unique(window[own])]))


def _matches(data: np.ndarray, at: np.ndarray, test: TestSuffixes) -> np.ndarray:
    """Rows (document, first word, item, first word there, words) of the longest verbatim matches: windows that follow each
    other in the document and in one item's text are one match."""
    _, first, place, window = lookup(data, at, test)
    if not len(place):
        return np.zeros((0, 5), np.int64)
    base = first[:-1] + np.arange(len(at) - 1)
    owner = np.searchsorted(base, place, "right") - 1
    n = np.array([len(test.places[w]) for w in window], np.int64)
    where = np.concatenate([test.places[w] for w in window])
    owner, start, length = np.repeat(owner, n), np.repeat(place - base[owner], n), np.repeat(test.length[window], n)
    text, there = where[:, 0], where[:, 1]
    order = np.lexsort((start, start - there, text, owner))
    owner, start, length, text, there = (x[order] for x in (owner, start, length, text, there))
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (text[1:] != text[:-1]) | (start[1:] - there[1:] != start[:-1] - there[:-1]) | (start[1:] != start[:-1] + 1)))
    begin = np.flatnonzero(new)
    end = np.concatenate((begin[1:], [len(new)])) - 1
    out = np.stack((owner[begin], start[begin], test.item_of[text[begin]], there[begin], start[end] - start[begin] + length[end]), 1)
    return np.unique(out, axis=0)  # texts of one item that say the same give one match


def longest_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per longest verbatim match of ``window`` words or more (or of a whole shorter item): id, doc_start, item_id (string),
    item_start, n_words; places count words from 0."""
    docs = docs.select(id_column, text_column)
    schema = T.StructType([docs.schema[id_column], T.StructField("doc_start", T.LongType()), T.StructField("item_id", T.StringType()), T.StructField("item_start", T.LongType()), T.StructField("n_words", T.LongType())])
    out = spark.createDataFrame([], schema)
    for test in _blocks(benchmark, "item_id", "text", window):
        shared = spark.sparkContext.broadcast(test)

        def run(batches: Iterator[pa.RecordBatch], shared=shared):
            for batch in batches:
                for i, _, data, at in texts.segments(batch.column(1), SHARD_BYTES):
                    found = _matches(data, at, shared.value)
                    names = pa.array([shared.value.names[k] for k in found[:, 2].tolist()], pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(found[:, 0] + i)), pa.array(found[:, 1]), names, pa.array(found[:, 3]), pa.array(found[:, 4])], names=schema.names)

        out = out.unionByName(docs.mapInArrow(lean(run), schema))
    return out


def _blocks(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> Iterator[TestSuffixes]:
    """The items in blocks of bounded size (an item is never cut)."""
    items = benchmark.select(F.col(id_column).cast("string").alias("i"), F.col(text_column).alias("t")).where("i is not null and t is not null")
    size = items.select(F.sum(F.length("t"))).first()[0] or 0
    n = -(-size // BLOCK_CHARS)
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k)
        yield TestSuffixes([tuple(r) for r in part.collect()], window)


def find_contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_words, spans (word ranges hit: starts and ends in turn), items (ids as sorted strings)."""
    shape = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))]

    def judged(frame: DataFrame, test: TestSuffixes | None) -> DataFrame:
        test = spark.sparkContext.broadcast(test or TestSuffixes([], window))
        schema = T.StructType([*[f for f in frame.schema.fields if f.name != text_column], *shape])
        text = frame.columns.index(text_column)

        def run(batches: Iterator[pa.RecordBatch]):
            suffixes = test.value
            for batch in batches:
                others = [c for i, c in enumerate(batch.columns) if i != text]
                for i, j, data, at in texts.segments(batch.column(text), SHARD_BYTES):
                    rows = list(_judge(data, at, suffixes))
                    yield pa.RecordBatch.from_arrays(
                        [*[c.slice(i, j - i) for c in others], pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([[suffixes.names[x] for x in r[2]] for r in rows], pa.list_(pa.string()))],
                        names=schema.names,
                    )

        return frame.mapInArrow(lean(run), schema)

    tests = list(_blocks(benchmark, id_column="item_id", text_column="text", window=window))
    docs = docs.select(id_column, text_column)
    if len(tests) <= 1:
        return judged(docs, tests[0] if tests else None)
    keyed = with_row_key(spark, docs, "decontamination")
    parts = [judged(keyed, t) for t in tests]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    merged = union.groupBy("_f", "_r").agg(F.first(id_column).alias(id_column), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.select(id_column, "n_words", "spans", "items")


def _covered(spans: np.ndarray) -> int:
    """Words covered by spans (starts and ends in turn), which may overlap."""
    if not len(spans):
        return 0
    start, end = spans[::2], spans[1::2]
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    before = np.concatenate(([0], reach[:-1]))
    return int(np.maximum(0, reach - np.maximum(start, before)).sum())


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    schema = T.StructType([found.schema[id_column], *[T.StructField(n, T.LongType()) for n in ("n_words", "n_hit", "n_items")], T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()), T.StructField("longest", T.LongType())])
    found = found.select(id_column, "n_words", "spans", "items")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            spans = [np.array(x or [], np.int64) for x in batch.column(2).to_pylist()]
            hit = [_covered(x) for x in spans]
            items = [sorted(x or []) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(hit, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                    pa.array([n > 0 for n in hit]),
                    pa.array([int((x[1::2] - x[::2]).max()) if len(x) else 0 for x in spans], pa.int64()),
                ],
                names=schema.names,
            )

    return found.mapInArrow(lean(run), schema)


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10, text_column: str = "text") -> DataFrame:
    """The rows without a word inside any benchmark window, all columns as they were."""
    at = docs.columns.index(text_column)
    for test in _blocks(benchmark, "item_id", "text", window):
        shared = spark.sparkContext.broadcast(test)

        def run(batches: Iterator[pa.RecordBatch], shared=shared):
            for batch in batches:
                keep = np.concatenate([np.array([not len(r[1]) for r in _judge(data, offsets, shared.value)], bool) for _, _, data, offsets in texts.segments(batch.column(at), SHARD_BYTES)] or [np.zeros(0, bool)])
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs
