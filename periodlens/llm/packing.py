"""Packing documents into fixed windows by best-fit decreasing.

A document longer than a window is first cut into full windows and a rest; pieces then go,
longest first, each into the open window with the least room that still holds it. A segment
tree over the remaining capacities finds that window. Pieces are dealt at random-free, equal
shares into buckets of about ``bucket_tokens`` tokens; each is packed on its own, so a task
holds a bounded share and the padding stays below about one window per bucket.

Defined results: null text is empty; an empty text is one piece with only the end id; null or
repeated ids are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm.tokens import binaries, encoder
from periodlens.llm.texts import lean

WINDOW = 4096


class Capacities:
    """Which remaining capacities (0..size) have an open window: a segment tree of counts."""

    def __init__(self, size: int):
        self.leaves = 1 << (size + 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, window) with the least capacity of at least ``need``; it is taken out."""
        i, count = need + self.leaves, self.count
        while not count[i]:
            while i & 1:  # climb until there is a sibling to the right
                i >>= 1
                if i <= 1:
                    return None
            i += 1
            if i == 1 or i >= 2 * self.leaves:
                return None
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        window = self.open[capacity].pop()
        self._add(capacity, -1)
        return capacity, window


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each piece; pieces are at most ``window`` long."""
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int(np.searchsorted(-lengths[order], -window, "right"))
    where[order[:full]] = np.arange(full)
    windows, free = full, Capacities(window)
    for i in order[full:].tolist():
        n = int(lengths[i])
        found = free.take(n)
        if found is None:
            found = window, windows
            windows += 1
        capacity, where[i] = found
        offset[i] = window - capacity
        if capacity > n:
            free.put(capacity - n, found[1])
    return where, offset


def pieces(docs: DataFrame, path: str, kind: str, end_id: int, window: int, id_column: str, text_column: str) -> DataFrame:
    """One row per piece: id, start, ids (binary, little-endian), tokens of the document."""
    docs = docs.select(id_column, text_column)
    schema = T.StructType([docs.schema[id_column], T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]):
        encode = encoder(path, kind)
        for batch in batches:
            ids, at = encode.encode_all(batch.column(1), end_id)
            tokens = np.diff(at)
            parts = -(-tokens // window)
            row = np.repeat(np.arange(len(parts)), parts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * window
            cuts = np.concatenate((at[row] + start, at[-1:]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(start), binaries(ids, cuts), pa.array(tokens[row])], names=schema.names)

    return docs.mapInArrow(lean(run, keep=True), schema)


def pack(
    spark: SparkSession, docs: DataFrame, path: str, kind: str = "word", end_id: int = 2, window: int = WINDOW, bucket_tokens: int = 1 << 22, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True
) -> DataFrame:
    """Pieces with their place: id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset.

    ``ids`` is binary (little-endian; width = size / length), left out unless ``with_ids``; ``ids_crc32`` is the checksum of the ids as
    unsigned 32-bit integers. The number of buckets follows the
    bytes of all texts (about 2.5 bytes a token)."""
    size = docs.select(F.sum(F.octet_length(text_column) + 8)).first()[0] or 0
    cut = pieces(docs, path, kind, end_id, window, id_column, text_column)
    dtype = encoder(path, kind).dtype  # of the vocabulary's ids; the tasks that pack need no tokenizer
    kept = [f for f in cut.schema.fields if with_ids or f.name != "ids"]
    schema = T.StructType([*kept, *[T.StructField(n, T.LongType()) for n in ("length", "ids_crc32", "sequence_id", "offset")]])

    def run(batches: Iterator[pa.RecordBatch]):
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        if not table.num_rows:
            return
        ids = [np.frombuffer(x.as_buffer(), dtype) for x in table.column("ids").chunk(0)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        where, offset = best_fit_decreasing(sizes, window)
        base = TaskContext.get().partitionId() << 32
        more = {"length": sizes, "ids_crc32": np.array([zlib.crc32(x.astype("<u4")) for x in ids], np.int64), "sequence_id": base + where, "offset": offset}
        for name, values in more.items():
            table = table.append_column(name, pa.array(values))
        yield from table.select(schema.names).to_batches(max_chunksize=2000)

    # dealing out is by turns over sorted rows, so a task that runs again gets the same rows
    return cut.repartition(max(1, int(size / 2.5 / bucket_tokens) + 1)).mapInArrow(lean(run), schema)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """sequence_id, input_ids: the windows themselves, padded (a sequence of a power of two stays as it is)."""
    width = F.length("ids") / F.col("length")
    whole = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.max(width).cast("int").alias("width"))
    schema = "sequence_id long, length int, input_ids array<int>"

    def run(batches):
        for batch in batches:
            ids, lengths = [], []
            for parts, width in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                x = np.frombuffer(b"".join(p["ids"] for p in parts), f"<u{width}").astype(np.int32)
                lengths.append(len(x))
                ids.append(x if len(x) & (len(x) - 1) == 0 else np.concatenate((x, np.full(window - len(x), pad_id, np.int32))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int32()), pa.array(ids, pa.list_(pa.int32()))], names=["sequence_id", "length", "input_ids"])

    return whole.mapInArrow(lean(run), schema)


def digest(packed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The placing of each piece with the checksum of its ids."""
    return packed.select(id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
