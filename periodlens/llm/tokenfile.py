"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Ids are replaced by their rank by frequency in the corpus, so that common ids take one byte.
A rank takes 1 to 4 bytes; its length (2 bits) stands in a control byte shared by four ranks,
apart from the data bytes, so numpy decodes a whole block with one table lookup.

A file set is a folder with three tables: ``ranks`` (rank, id, n), ``blocks`` (shard, block, number
of documents and ids, ids before it in its shard, document ids, sizes, control bytes, data
bytes; shards are ascending ranges of document ids) and ``shards`` (shard, ids before it). They
are written by Spark's own writer, so a lost executor's part is written again or not at all.

Order: ascending id, null ids first, ties in file order. Defined results: null text is empty;
an empty text is the end id alone; repeated rows are documents of their own; an empty table
gives empty tables.
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
from pyspark.sql.pandas.types import to_arrow_type

from periodlens.llm.rows import stage, with_row_key
from periodlens.llm.tokens import binaries, encoder
from periodlens.llm.texts import lean

#: bytes of each of the four ranks of a control byte
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
BLOCK_IDS = 1 << 19


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    ranks = ranks.astype(np.uint32)
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    each = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), each[np.arange(4) < size[:, None]].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    end = np.cumsum(size, dtype=np.int64)
    start = end - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[start].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        out[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def token_ids(spark: SparkSession, docs: DataFrame, path: str, kind: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """(id, _f, _r, ids): the ids of each document with the end id, little-endian binary; and a row per task
    with _r = -1, whose ids are pairs of 64-bit (id, number of its occurrences in the task)."""
    docs = with_row_key(spark, docs.select(id_column, text_column), "tokens").select(id_column, "_f", "_r", text_column)
    schema = T.StructType([*docs.schema.fields[:3], T.StructField("ids", T.BinaryType())])

    id_type = to_arrow_type(docs.schema[0].dataType)

    def run(batches: Iterator[pa.RecordBatch]):
        encode, total = encoder(path, kind), np.zeros(0, np.int64)
        for batch in batches:
            ids, cuts = encode.encode_all(batch.column(3), end_id)
            n = np.bincount(ids, minlength=len(total))
            n[: len(total)] += total
            total = n
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], binaries(ids, cuts)], names=schema.names)
        at = np.flatnonzero(total)
        zero, none = pa.array([0], pa.int64()), pa.nulls(1, id_type)
        yield pa.RecordBatch.from_arrays([none, zero, pa.array([-1], pa.int64()), pa.array([np.stack((at, total[at]), 1).tobytes()], pa.binary())], names=schema.names)

    return docs.mapInArrow(lean(run, keep=True), schema)


def frequencies(tokens: DataFrame) -> DataFrame:
    """(id, n) of all ids, from the tasks' own counts."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for x in batch.column(0):
                pairs = np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["id", "n"])

    return tokens.where("_r = -1").select("ids").mapInArrow(lean(run), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(
    spark: SparkSession, docs: DataFrame, folder: str, path: str, kind: str = "byte", end_id: int = 2, shard_ids: int = 1 << 23, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Encode all documents and write them as a file set to a folder that all executors reach."""
    dtype = encoder(path, kind).dtype.str
    width = np.dtype(dtype).itemsize
    tokens = stage(spark, token_ids(spark, docs, path, kind, end_id, id_column, text_column), "token-ids")
    # as many rows as the vocabulary has ids
    ranked = frequencies(tokens).orderBy(F.desc("n"), "id").collect()
    spark.createDataFrame([(i, r["id"], r["n"]) for i, r in enumerate(ranked)], "rank long, id long, n long").coalesce(1).write.parquet(f"{folder}/ranks")
    total = sum(r["n"] for r in ranked)
    rank = np.zeros(max((r["id"] for r in ranked), default=0) + 1, np.uint32)
    rank[[r["id"] for r in ranked]] = np.arange(len(ranked))
    names = ["shard", "block", "n_docs", "n_ids", "before", "doc_ids", "sizes", "control", "data"]
    schema = "shard int, block int, n_docs long, n_ids long, before long, doc_ids array<long>, sizes array<long>, control binary, data binary"

    def run(batches: Iterator[pa.RecordBatch]):
        shard, block, before, ids, held, n = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def made():
            sizes = [len(x) // width for x in held]
            control, data = encode_ranks(rank[np.frombuffer(b"".join(held), dtype)])
            values = [shard, block, len(held), n, before, ids, sizes, control, data]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            for i, x in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(i.as_py())
                held.append(x.as_py())
                n += len(held[-1]) // width
                if n >= BLOCK_IDS:
                    yield made()
                    block, before, ids, held, n = block + 1, before + n, [], [], 0
        if held:
            yield made()

    in_order = [F.asc_nulls_first(id_column), F.asc("_f"), F.asc("_r")]
    ordered = tokens.where("_r >= 0").repartitionByRange(max(1, -(-total // shard_ids)), *in_order).sortWithinPartitions(*in_order)
    ordered.select(F.col(id_column).cast("long"), "ids").mapInArrow(lean(run), schema).write.option("compression", "zstd").parquet(f"{folder}/blocks")
    # one row per shard
    sizes = spark.read.parquet(f"{folder}/blocks").groupBy("shard").agg(F.sum("n_ids"), F.sum("n_docs")).orderBy("shard").collect()
    rows, before = [], 0
    for shard, n, n_docs in sizes:
        rows.append((shard, before, n, n_docs))
        before += n
    spark.createDataFrame(rows, "shard int, start long, n_ids long, n_docs long").coalesce(1).write.parquet(f"{folder}/shards")


def read(spark: SparkSession, folder: str, each=None, schema: str = "doc_id long, start long, n_tokens long, ids array<int>") -> DataFrame:
    """The documents of a file set: id, ids of all documents before it, number of ids, ids.

    ``each(ids)`` may turn a document's ids (numpy, unsigned 32-bit) into another last column."""
    # the vocabulary's size
    table = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    back = np.array([r["id"] for r in table], np.uint32)
    blocks = spark.read.parquet(f"{folder}/blocks").join(spark.read.parquet(f"{folder}/shards").select("shard", "start"), "shard")
    last = pa.list_(pa.int32()) if each is None else pa.int64()
    names = [x.split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                ids = back[decode_ranks(row["control"], row["data"], row["n_ids"])]
                sizes = np.array(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                for a in range(0, len(sizes), 1000):
                    part = slice(a, a + 1000)
                    own = [ids[e - n : e] for e, n in zip(ends[part], sizes[part], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row["doc_ids"][part], pa.int64()), pa.array(row["start"] + row["before"] + ends[part] - sizes[part]), pa.array(sizes[part]), pa.array([x if each is None else each(x) for x in own], last)],
                        names=names,
                    )

    return blocks.select("start", "before", "n_ids", "doc_ids", "sizes", "control", "data").mapInArrow(lean(run), schema)


def digest(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, lambda ids: zlib.crc32(ids.astype("<u4")), "doc_id long, start long, n_tokens long, ids_crc32 long")
