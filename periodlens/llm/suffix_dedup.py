"""Removal of repeated byte strings by a depth-limited radix sort of all suffixes.

Every start of a ``length``-byte string is a suffix, ordered only as deep as ``length`` bytes, most
significant digit first; a group of one is finished and drops out, and the groups that are left
at full depth are exactly the repeated strings. Digits are fingerprints of byte blocks, so a
pass is one grouping instead of one per byte, and neighbours share their first digits:

1. First digit: the least (by hash) of a suffix's 64-byte grams. Suffixes one after another mostly have
   the same one, so they travel as one run (gram, first and last start) instead of one by one. Runs
   whose gram occurs once in the corpus are finished.
2. Second digit: the whole span of a run. Where it occurs again in the same place to the gram, all
   suffixes of the run are repeated: finished, too.
3. Last digit: the ``length`` bytes themselves, for single suffixes of the runs that are left (the
   ends of repeated passages), against those and one run of each span with the same gram.

Equal suffixes have equal least grams in equal places, so no pass parts them. Passes 2 and 3 compare
128 bits. Groups are only counted (pre-aggregated) and joined, never gathered, so a string
that a third of the documents hold costs no task more than others.

Defined results: null text is empty; a text shorter than ``length`` keeps everything; strings never
cross documents; repeated rows repeat each other (from ``length`` bytes on nothing is left of them);
null ids are documents; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm import bloom, texts
from periodlens.llm.rows import stage, with_row_key
from periodlens.llm.texts import lean

GRAM = 64
_PLACE = np.uint64((1 << 30) - 1)
#: second set of byte values, for another 64 bits
_OTHER = np.random.default_rng(9).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Prefixes:
    """Fingerprints of any span of a byte array."""

    def __init__(self, data: np.ndarray, two: bool = True):
        up, self.down = texts.powers(len(data) + 1)
        self.sums = []
        for values in (texts._VALUES, _OTHER)[: 2 if two else 1]:
            total = np.zeros(len(data) + 1, np.uint64)
            with np.errstate(over="ignore"):
                np.cumsum(values[data] * up[: len(data)], out=total[1:])
            self.sums.append(total)

    def of(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        total = self.sums[which]
        with np.errstate(over="ignore"):
            return texts.mix((total[end] - total[start]) * self.down[start])


def runs(data: np.ndarray, at: np.ndarray, length: int, gram: int, prefixes: Prefixes) -> tuple[np.ndarray, ...]:
    """(document, place of the least gram, its hash, first start, last start) of the runs of suffixes."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none.astype(np.uint64), none, none
    hashes = np.full(n, ~np.uint64(0))
    place = np.arange(n - gram + 1)
    hashes[: n - gram + 1] = prefixes.of(place, place + gram)
    # the least of the grams of each suffix; of equal ones the first
    least = hashes & ~_PLACE | np.arange(n, dtype=np.uint64)
    width, step = length - gram + 1, 1
    while 2 * step <= width:
        least[: n - step] = np.minimum(least[: n - step], least[step:])
        step *= 2
    m = n - width + 1
    least = np.minimum(least[:m], least[width - step : width - step + m])
    inside = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(at[:-1], at[1:], strict=True)] or [none])
    if not len(inside):
        return none, none, none.astype(np.uint64), none, none
    where = (least[inside] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (where[1:] != where[:-1]) | (inside[1:] != inside[:-1] + 1))))
    first, last, where = inside[new], inside[np.concatenate((new[1:], [len(inside)])) - 1], where[new]
    return np.searchsorted(at, where, "right") - 1, where, hashes[where], first, last


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def repeated_grams(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(g): hashes of least grams that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for _, _, data, at in texts.segments(batch.column(0)):
                yield pa.RecordBatch.from_arrays([_long(runs(data, at, length, gram, Prefixes(data, two=False))[2])], names=["g"])

    return docs.select("t").mapInArrow(lean(run), "g long").groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g")


def spans_of_runs(docs: DataFrame, length: int, gram: int, filled) -> DataFrame:
    """(_f, _r, g, a, first, last, x, y) of the runs whose gram may be repeated; x, y: the span's fingerprint."""
    schema = "_f long, _r long, g long, first long, last long, x long, y long"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, _, data, at in texts.segments(batch.column(2)):
                prefixes = Prefixes(data)
                doc, where, g, first, last = runs(data, at, length, gram, prefixes)
                keep = bloom.holds(filled.value, g)
                doc, where, g, first, last = doc[keep], where[keep], g[keep], first[keep], last[keep]
                shape = texts.mix(((where - first) << 32 | last - first).astype(np.uint64))
                with np.errstate(over="ignore"):
                    x, y = (prefixes.of(first, last + length, k) + shape for k in range(2))
                rows = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *map(_long, (g, first - at[doc], last - at[doc], x, y))], names=names)

    return docs.select("_f", "_r", "t").mapInArrow(lean(run), schema)


def _windows(row_first: list[int], row_last: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(start of each suffix, which run it is of)."""
    first, last = np.array(row_first, np.int64), np.array(row_last, np.int64)
    n = last - first + 1
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[which], which


def single_suffixes(edges: DataFrame, length: int, filled=None) -> DataFrame:
    """(x, y) of each suffix of the runs of edges (_f, _r, t, runs); with a filter: (_f, _r, p, x, y) of open ones that it holds."""
    schema = "x long, y long" if filled is None else "_f long, _r long, p long, x long, y long"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, j, data, at in texts.segments(batch.column(2)):
                prefixes, out = Prefixes(data), []
                for row, own in enumerate(batch.column(3).slice(i, j - i).to_pylist()):
                    if filled is not None:
                        own = [r for r in own if r["open"]]
                    p, _ = _windows([r["first"] for r in own], [r["last"] for r in own])
                    out.append((np.full(len(p), row), p))
                row = np.concatenate([r for r, _ in out])
                p = np.concatenate([p for _, p in out])
                start = at[row] + p
                x, y = prefixes.of(start, start + length, 0), prefixes.of(start, start + length, 1)
                if filled is None:
                    yield pa.RecordBatch.from_arrays([_long(x), _long(y)], names=names)
                else:
                    keep = bloom.holds(filled.value, x)
                    at_row = pa.array(row[keep] + i)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at_row), batch.column(1).take(at_row), *map(_long, (p[keep], x[keep], y[keep]))], names=names)

    return edges.select("_f", "_r", "t", "runs").mapInArrow(lean(run), schema)


def repeated_starts(spark: SparkSession, docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(_f, _r, first, last): ranges of starts of repeated strings, from documents (_f, _r, t)."""
    grams = stage(spark, repeated_grams(docs, length, gram), "grams")
    found = spans_of_runs(docs, length, gram, bloom.of_hashes(spark, grams, "g")).join(grams, "g")
    found = stage(spark, found, "runs")
    # repeated spans: how often, and the run that stands for each; written, so that the join can split a hot span
    spans = found.groupBy("x", "y").agg(F.count("*").alias("c"), F.min(F.struct("_f", "_r", "first")).alias("least")).where("c > 1")
    both = found.join(stage(spark, spans, "spans"), ["x", "y"], "left").withColumn("stands", F.struct("_f", "_r", "first") == F.col("least"))
    judged = stage(spark, both.select("_f", "_r", "g", "first", "last", F.coalesce("c", F.lit(1)).alias("c"), "stands"), "judged")
    whole = judged.where("c > 1").select("_f", "_r", "first", "last")
    left = judged.where("c = 1")
    support = judged.where("c > 1 and stands").join(stage(spark, left.select("g").distinct(), "open-grams"), "g", "left_semi")
    edge = left.withColumn("open", F.lit(True)).unionByName(support.withColumn("open", F.lit(False)))
    by_doc = stage(spark, edge.groupBy("_f", "_r").agg(F.collect_list(F.struct("first", "last", "open")).alias("runs")), "edge-runs")
    edges = stage(spark, bloom.inner(spark, docs, by_doc, "_f", "_r").select("_f", "_r", "t", "runs"), "edges")
    again = stage(spark, single_suffixes(edges, length).groupBy("x", "y").agg(F.count("*").alias("c")).where("c > 1").select("x", "y"), "suffixes")
    single = single_suffixes(edges, length, bloom.of_hashes(spark, again, "x")).join(again, ["x", "y"], "left_semi").select("_f", "_r", F.col("p").alias("first"), F.col("p").alias("last"))
    return whole.unionByName(single)


def covered(first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of bytes inside the strings that start in the ranges."""
    order = np.argsort(first, kind="stable")
    start, reach = first[order], np.maximum.accumulate(last[order] + length)
    new = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
    return start[new], reach[np.concatenate((new[1:], [len(start)])) - 1]


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 200, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes, spans (removed byte ranges: starts and ends in turn), kept (binary: what is left)."""
    keyed = with_row_key(spark, docs.select(id_column, text_column), "documents").select("_f", "_r", F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("t"))
    starts = repeated_starts(spark, keyed.select("_f", "_r", "t"), length, gram)
    ranges = stage(spark, starts.groupBy("_f", "_r").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "ranges")
    maybe = bloom.maybe_in(spark, ranges, "_f", "_r")
    touched = keyed.where(maybe).join(ranges, ["_f", "_r"], "left").select("id", "t", "ranges").unionByName(keyed.where(~maybe).select("id", "t", F.lit(None).cast(ranges.schema["ranges"].dataType).alias("ranges")))
    schema = T.StructType([T.StructField(id_column, keyed.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            data, at = texts.text_bytes(batch.column(1))
            spans, kept = [], []
            for k, own in enumerate(batch.column(2)):
                text = data[at[k] : at[k + 1]]
                if not own.is_valid:
                    spans.append([])
                    kept.append(text.tobytes())
                    continue
                own = own.values
                start, end = covered(own.field("first").to_numpy(), own.field("last").to_numpy(), length)
                spans.append(np.stack((start, end), 1).ravel())
                cuts = [0, *spans[-1].tolist(), len(text)]
                kept.append(b"".join(text[a:b].tobytes() for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())], names=schema.names)

    return touched.mapInArrow(lean(run), schema)


def digest(out: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return out.select(
        id_column, "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.floor(F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
