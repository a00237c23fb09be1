"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes its set of distinct word shingles. Equal sets are one class from here on.
2. Classes whose MinHash signatures agree on a band are candidates. In each bucket, all are
   paired with one leader, the member that shares most buckets with others.
3. A pair's signatures are compared batch by batch: with m of n values equal, the chance of a
   similarity of at least t is P(Bin(n + 1, t) <= m) (uniform prior). A pair whose chance falls
   below ``miss`` is dropped; survivors are verified exactly on their full sets.
4. Links found so far are contracted to components. Buckets that still hold more than one
   component are compared across components, block by block, with the same pruning, and
   survivors are verified on the spot: every candidate pair is either judged or already in one component.

What can be missed: a pair that shares no band (at similarity 0.85: 8e-7) or is pruned (``miss``
per batch). A bucket is never held by one task: counts and leaders are pre-aggregated, and
comparisons go by blocks of ``BLOCK`` members.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Defined results: null or empty text
has no shingles and is linked with nothing; fewer words than a shingle make one shingle; a null
id takes part but is never a component's id where there is another; repeated rows are one class
and get the same result each; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm import bloom, graph, texts
from periodlens.llm.rows import stage, with_row_key
from periodlens.llm.texts import lean

BANDS, ROWS = 24, 5
SIZE = BANDS * ROWS
BATCH = 24
BLOCK = 1024
#: pairs of a block compared at once
PAIRS = 1 << 16

_rng = np.random.default_rng(77)
_MULTIPLY = _rng.integers(0, 2**63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, SIZE, dtype=np.uint64)


def sets(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all documents one after another, offsets)."""
    n = len(at) - 1
    _, _, hashes, doc = texts.words(data, at, texts.NOT_SPACE)
    value, owner = texts.shingles(hashes, doc, n, width)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))) if len(value) else np.zeros(0, bool)
    value, owner = value[fresh], owner[fresh]
    return value, np.searchsorted(owner, np.arange(n + 1))


def signatures(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash signatures (32 bits a value) of the sets that have members, in order."""
    start = first[:-1][first[1:] > first[:-1]]
    out = np.zeros((len(start), SIZE), np.uint32)
    with np.errstate(over="ignore"):
        for j in range(SIZE if len(start) else 0):
            out[:, j] = np.minimum.reduceat((value * _MULTIPLY[j] + _ADD[j]) >> np.uint64(32), start)
    return out


def sketch(docs: DataFrame, width: int, id_column: str, text_column: str) -> DataFrame:
    """(_f, _r, id, n, key, sig) of each row; key: 128 bits of the whole set, null where it is empty."""
    docs = docs.select("_f", "_r", F.col(id_column).alias("id"), F.col(text_column).alias("t"))
    schema = T.StructType([*docs.schema.fields[:3], T.StructField("n", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("sig", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, j, data, at in texts.segments(batch.column(3)):
                value, first = sets(data, at, width)
                n = np.diff(first)
                sig = iter(signatures(value, first))
                keys = [hashlib.blake2b(value[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(i, j - i) for k in range(3)], pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array([next(sig).tobytes() if k else None for k in keys], pa.binary())], names=schema.names)

    return docs.mapInArrow(lean(run), schema)


def banded(classes: DataFrame) -> DataFrame:
    """(h, node): a row per class and band."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
                h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), sig.shape[:2])
                with np.errstate(over="ignore"):
                    for k in range(ROWS):
                        h = texts.mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
                h = h & ~np.uint64(31) | np.arange(BANDS, dtype=np.uint64)  # the band stands in the lowest bits
                node = np.repeat(batch.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(node)], names=["h", "node"])

    return classes.select("node", "sig").mapInArrow(lean(run), "h long, node long")


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(n, m) for each batch: with fewer than m of the first n values equal, a pair is dropped."""
    out = []
    for n in range(BATCH, SIZE + 1, BATCH):
        total, m = 0.0, 0
        while total + (p := comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)) < miss:
            total, m = total + p, m + 1
        out.append((n, m))
    return out


def _sizes_fit(a: str, b: str, least: int) -> F.Column:
    """Similarity is at most the ratio of the set sizes."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * least


def pruned(pairs: DataFrame, classes: DataFrame, least: int, miss: float) -> DataFrame:
    """The pairs (a, b) that sequential comparison of their signatures keeps."""
    of = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").where(_sizes_fit("na", "nb", least)).select("a", "b", "sa", "sb")
    steps = least_matches(least / 100, miss)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, SIZE) for k in (2, 3))
            left, same, done = np.arange(len(x)), np.zeros(len(x), np.int64), 0
            for n, m in steps:
                same[left] += (x[left, done:n] == y[left, done:n]).sum(1)
                left, done = left[same[left] >= m], n
            yield batch.select([0, 1]).take(pa.array(left))

    return both.mapInArrow(lean(run), "a long, b long")


def across(spark: SparkSession, members: DataFrame, classes: DataFrame, docs: DataFrame, least: int, width: int, miss: float, text_column: str) -> DataFrame:
    """Links (a, b) between members (h, node, comp, c) of one bucket but different components.

    A bucket of c members is cut into c / BLOCK blocks; every two blocks meet once, with signatures and sets,
    so that pairs are pruned and verified where they meet and only links leave. A pair that
    shares several bands is judged in the first of them."""
    nodes = members.select("node").distinct()
    whole = full_sets(spark, nodes, classes, docs, width, text_column)
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    cut = members.withColumn("k", blocks).withColumn("i", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    cut = cut.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    cut = cut.select("h", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "node", "comp")
    cut = cut.join(classes.select("node", "n", "sig"), "node").join(whole, "node")
    met = cut.select("h", "lo", "hi", "i", "node", "comp", "n", "sig", "s").repartition("h", "lo", "hi").sortWithinPartitions("h", "lo", "hi")
    steps = least_matches(least / 100, miss)

    def judge(held: list[pa.RecordBatch]) -> tuple[list[int], list[int]]:
        table = pa.Table.from_batches(held)
        h, lo, hi = (table.column(k)[0].as_py() for k in ("h", "lo", "hi"))
        block, node, comp, n = (table.column(k).to_numpy() for k in ("i", "node", "comp", "n"))
        x, y = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, SIZE)
        known: dict[int, np.ndarray] = {}

        def members_of(k: int) -> np.ndarray:
            if k not in known:
                known[k] = np.frombuffer(table.column("s")[k].as_py(), np.uint64)
            return known[k]

        a, b = [], []
        step = max(1, PAIRS // max(1, len(y)))
        for at in range(0, len(x), step):
            part = x[at : at + step]
            fit = (comp[part][:, None] != comp[y][None]) & (np.minimum(n[part][:, None], n[y][None]) * 100 >= np.maximum(n[part][:, None], n[y][None]) * least)
            if lo == hi:
                fit &= part[:, None] < y[None]
            i, j = np.nonzero(fit)
            i, j = part[i], y[j]
            same, done = np.zeros(len(i), np.int64), 0
            for size, m in steps:
                same += (sig[i, done:size] == sig[j, done:size]).sum(1)
                keep = same >= m
                i, j, same, done = i[keep], j[keep], same[keep], size
            first = (sig[i] == sig[j]).reshape(-1, BANDS, ROWS).all(2).argmax(1) == h & 31
            for p, q in zip(i[first].tolist(), j[first].tolist(), strict=True):
                if similar(members_of(p), members_of(q), least):
                    a.append(int(min(node[p], node[q])))
                    b.append(int(max(node[p], node[q])))
        return a, b

    def run(batches: Iterator[pa.RecordBatch]):
        held, key = [], None
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)] if len(keys) else []
            a, b = [], []
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                now = tuple(keys[start])
                if held and now != key:
                    found = judge(held)
                    a, b, held = a + found[0], b + found[1], []
                key = now
                held.append(batch.slice(start, end - start))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        found = judge(held) if held else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], names=["a", "b"])

    return met.mapInArrow(lean(run), "a long, b long")


def similar(x: np.ndarray, y: np.ndarray, least: int) -> bool:
    """Whether two sorted sets of hashes are similar enough."""
    common = np.intersect1d(x, y, assume_unique=True).size
    return 100 * common >= least * (len(x) + len(y) - common)


def full_sets(spark: SparkSession, nodes: DataFrame, classes: DataFrame, docs: DataFrame, width: int, text_column: str) -> DataFrame:
    """(node, s): the whole sets of the nodes, from the text of the row that stands for each."""
    keys = stage(spark, nodes.join(classes.select("node", "_f", "_r"), "node"), "nodes")
    held = bloom.inner(spark, docs.select("_f", "_r", F.col(text_column).alias("t")), keys, "_f", "_r").select("node", "t")

    def full(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, j, data, at in texts.segments(batch.column(1)):
                value, first = sets(data, at, width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([value[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())], names=["node", "s"])

    return stage(spark, held.mapInArrow(lean(full), "node long, s binary"), "sets")


def verified(spark: SparkSession, pairs: DataFrame, classes: DataFrame, docs: DataFrame, least: int, width: int, text_column: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    whole = full_sets(spark, nodes, classes, docs, width, text_column)
    of = lambda x: whole.select(F.col("node").alias(x), F.col("s").alias(f"s{x}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
                keep[i] = similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), least)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "sa", "sb").mapInArrow(lean(run), "a long, b long")


def classes_and_links(spark: SparkSession, docs: DataFrame, least: int, width: int, miss: float, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes with node numbers, links between nodes) of documents with row keys."""
    rows = stage(spark, sketch(docs, width, id_column, text_column), "sketches")
    whole = rows.where("key is not null").groupBy("key").agg(F.min("id").alias("id"), F.min(F.struct("_f", "_r", "n", "sig")).alias("x"))
    classes = stage(spark, whole.select(F.monotonically_increasing_id().alias("node"), "key", "id", "x.*"), "classes")
    bands = banded(classes)
    # buckets with company; counts and leaders are pre-aggregated and written, so that a join can split a hot bucket
    counts = stage(spark, bands.groupBy("h").agg(F.count("*").alias("c")).where("c > 1"), "counts")
    live = stage(spark, bands.join(counts, "h"), "buckets")
    popular = live.groupBy("node").agg(F.sum("c").alias("p"))
    leaders = live.join(popular, "node").groupBy("h").agg(F.max(F.struct("p", (-F.col("node")).alias("m"))).alias("x")).select("h", (-F.col("x.m")).alias("leader"))
    star = live.join(stage(spark, leaders, "leaders"), "h").where("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    near = stage(spark, pruned(star, classes, least, miss), "pairs")
    links = stage(spark, verified(spark, near, classes, docs, least, width, text_column), "links")
    labels = graph.components(spark, links)
    open_ = live.join(labels, "node", "left").select("h", "node", F.coalesce("label", "node").alias("comp"))
    split = open_.groupBy("h").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("c")).where("x <> y").select("h", "c")
    members = stage(spark, open_.join(split, "h"), "open")
    more = across(spark, members, classes, docs, least, width, miss, text_column)
    return rows, classes, stage(spark, links.union(more), "all-links")


def near_duplicates(spark: SparkSession, docs: DataFrame, least: int = 85, width: int = 5, miss: float = 1e-9, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id, kept, and n_spanning_links: the links of its class
    that were found on the way to the components, which is not all (pairs within a component formed already aren't judged)."""
    docs = with_row_key(spark, docs.select(id_column, text_column), "documents")
    rows, found = _assigned(spark, docs, least, width, miss, id_column, text_column)
    alone = F.col("key").isNull()
    out = rows.join(found, "key", "left")
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), F.coalesce("n_spanning_links", F.lit(0)).alias("n_spanning_links"))


def _assigned(spark: SparkSession, docs: DataFrame, least: int, width: int, miss: float, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """(rows, per class key: component_id, component, number of links found)."""
    rows, classes, links = classes_and_links(spark, docs, least, width, miss, id_column, text_column)
    labels = graph.components(spark, links)
    count = links.select("a").union(links.select("b")).groupBy("a").agg(F.count("*").alias("n_spanning_links"))
    named = classes.select("node", "key", "id").join(labels, "node", "left").withColumn("component", F.coalesce("label", "node"))
    ids = named.groupBy("component").agg(F.min("id").alias("component_id"))
    found = named.join(ids, "component").join(count.withColumnRenamed("a", "node"), "node", "left").select("key", "component", "component_id", "n_spanning_links")
    return rows, stage(spark, found, "components")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, least: int = 80, width: int = 5, miss: float = 1e-9, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group, the one with the smallest id (then the first), all columns as they were.

    Rows without words are linked with nothing and stay."""
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))]  # names of the frame's own columns may be anything
    keyed = with_row_key(spark, docs.toDF(*own), "documents")
    rows, found = _assigned(spark, keyed, least, width, miss, own[names.index(id_column)], own[names.index(text_column)])
    order = F.struct(F.col("id").isNull().alias("null"), "id", "_f", "_r")
    member = rows.where("key is not null").join(found.select("key", "component"), "key").select("component", "id", "_f", "_r")
    first = member.groupBy("component").agg(F.min(order).alias("x")).select("x._f", "x._r")
    dropped = stage(spark, member.select("_f", "_r").join(first, ["_f", "_r"], "left_anti"), "dropped")
    return bloom.without(spark, keyed, dropped, "_f", "_r").select(own).toDF(*names)
