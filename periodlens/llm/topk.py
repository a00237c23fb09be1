"""Exact top-k inner products by vector-approximation files.

A vector's components are cut into cells of equal width per dimension (one byte each); the cells
are the approximation file. For a query, each cell bounds the component's share of the inner
product from below and above. A scan of the cells in blocks keeps, per query and block, the
vectors whose upper bound reaches the block's k-th best lower bound; over all blocks the k-th
best lower bound cuts them again. Only then are exact vectors read, in the order of their
bounds, until the k-th best exact score passes the next bound.

Query blocks meet vector blocks on a key of their own each, so no task holds more than one of
either. Equal vectors of a block stand behind one approximation; as ties go to the smaller id,
their k + 1 smallest ids are all that can be answers, which is exact and keeps a group of
copies of any size at k + 1 rows per block.

Components become floor(scale * x). Defined results: vectors that are null, empty or hold
null or non-finite components take no part, nor do rows with a null id; only vectors of as many
components as the query are compared; a repeated id with the same vector counts once, with other
vectors each one counts; fewer candidates than k give fewer rows; scores beyond 64 bits are clipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.llm.rows import stage
from periodlens.llm.texts import lean

CELLS = 256
BLOCK_ROWS, BLOCK_QUERIES = 4096, 256
#: beyond this magnitude of a component 64-bit sums could overflow; such vectors are scored with Python's integers
SAFE = 1 << 26


def vectors(embeddings: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): integer components of the vectors that take part."""
    x = F.col(vector_column).cast("array<double>")
    fit = F.col(id_column).isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    # floor() of a double is a long: beyond its range it clips
    return embeddings.where(fit).select(F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v")).dropDuplicates()


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False)
    return rows.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _score(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    if max(np.abs(v).max(initial=0), np.abs(q).max(initial=0)) < SAFE and len(q) < 1024:
        return v @ q
    exact = [sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in v]
    return np.array([max(-(2**63), min(2**63 - 1, s)) for s in exact], np.int64)


def _blocked(table: DataFrame, rows: int, tag: str) -> DataFrame:
    """Blocks: one row each, of vectors of the same number of components."""
    schema = f"{tag}_dim int, {tag}_ids array<long>, {tag}_v binary"

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes):
                own = batch.filter(pa.array(sizes == d))
                for a in range(0, own.num_rows, rows):
                    part = own.slice(a, rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d], pa.int32()), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([_matrix(part.column(1)).astype("<i8").tobytes()], pa.binary())], names=[f"{tag}_dim", f"{tag}_ids", f"{tag}_v"]
                    )

    return table.select("vec_id", "v").mapInArrow(lean(run), schema)


def cell_bounds(spark: SparkSession, table: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per number of components: the least value and the cell width of each dimension."""
    ends = table.select(F.size("v").alias("d"), F.posexplode("v").alias("j", "x")).groupBy("d", "j").agg(F.min("x"), F.max("x")).collect()
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d, j, least, most in ends:
        low, width = out.setdefault(d, (np.zeros(d, np.float64), np.ones(d, np.float64)))
        low[j], width[j] = least, max(1, -(-(int(most) - int(least) + 1) // CELLS))
    return out


def approximate(v: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    return np.clip((v - low) // width, 0, CELLS - 1).astype(np.uint8)


def bounds(cells: np.ndarray, low: np.ndarray, width: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of every cell vector's inner product with every query: queries x vectors."""
    # centre +- half a cell, and a little for the rounding of floats
    centre = (low + cells * width + (width - 1) / 2) @ q.T
    reach = ((width - 1) / 2) @ np.abs(q).T
    slack = 1 + 1e-12 * (np.abs(low).max(initial=0) + CELLS * width.max(initial=0)) * np.abs(q).sum(1)
    return (centre - reach - slack).T, (centre + reach + slack).T


def approximation_file(spark: SparkSession, table: DataFrame, k: int) -> tuple[DataFrame, dict]:
    """Blocks of cells with the ids behind them; equal vectors of a block share a row of cells."""
    marks = cell_bounds(spark, table)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for d, ids, raw in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                v, ids = np.frombuffer(raw, "<i8").reshape(-1, d), np.array(ids, np.int64)
                order = np.argsort(ids, kind="stable")
                v, ids = v[order], ids[order]
                _, group = np.unique(v, axis=0, return_inverse=True)
                by = np.argsort(group.ravel(), kind="stable")
                g = group.ravel()[by]
                rank = np.arange(len(g)) - np.searchsorted(g, g)
                keep = np.sort(by[rank <= k])
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([ids[keep].tolist()], pa.list_(pa.int64())), pa.array([approximate(v[keep], *marks[d]).tobytes()], pa.binary())], names=["d_dim", "d_ids", "d_cells"])

    return _blocked(table, BLOCK_ROWS, "d").mapInArrow(lean(run), "d_dim int, d_ids array<long>, d_cells binary"), marks


def top_k(spark: SparkSession, embeddings: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each row whose id is divisible by ``every``."""
    source = vectors(embeddings, scale, id_column, vector_column)
    table = stage(spark, source.repartition(F.col("vec_id")), "vectors")
    cells, marks = approximation_file(spark, table, k)
    data = stage(spark, cells.withColumn("d_block", F.monotonically_increasing_id()), "cells")
    chosen = table.where(F.pmod("vec_id", F.lit(every)) == 0)
    queries = stage(spark, _blocked(chosen.repartition(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, chosen.count() // BLOCK_QUERIES)))), BLOCK_QUERIES, "q").withColumn("q_block", F.monotonically_increasing_id()), "queries")
    # each block of queries against each block of vectors: every pair of blocks is a key of its own
    q_keys = queries.select("q_block", F.col("q_dim").alias("dim"))
    d_keys = data.select("d_block", F.col("d_dim").alias("dim"))
    pairs = q_keys.join(d_keys, "dim").repartition("q_block", "d_block")
    met = pairs.join(queries, "q_block").join(data, "d_block").select("dim", "q_ids", "q_v", "d_ids", "d_cells")

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for d, q_ids, q_v, ids, raw in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                q, ids = np.frombuffer(q_v, "<i8").reshape(-1, d).astype(np.float64), np.array(ids, np.int64)
                lower, upper = bounds(np.frombuffer(raw, np.uint8).reshape(-1, d).astype(np.float64), *marks[d], q)
                own = np.array(q_ids, np.int64)[:, None] == ids
                lower[own], upper[own] = -np.inf, -np.inf
                kth = np.partition(lower, len(ids) - k, 1)[:, len(ids) - k] if len(ids) >= k else np.full(len(q), -np.inf)
                i, j = np.nonzero((upper >= kth[:, None]) & ~own)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(q_ids, np.int64)[i]), pa.array(ids[j]), pa.array(lower[i, j]), pa.array(upper[i, j]), pa.array(np.full(len(i), d, np.int32))], names=["query_id", "vec_id", "lower", "upper", "dim"])

    near = stage(spark, met.mapInArrow(lean(scan), "query_id long, vec_id long, lower double, upper double, dim int"), "candidates")
    kth = near.groupBy("query_id", "dim").agg(F.array_sort(F.collect_list("lower"), lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0)).alias("l")).select("query_id", "dim", F.try_element_at("l", F.lit(k)).alias("kth"))
    left = near.join(kth, ["query_id", "dim"]).where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth"))).select("query_id", "vec_id", "upper", "dim")
    exact = left.join(table.select("vec_id", "v", F.size("v").alias("dim")), ["vec_id", "dim"]).join(chosen.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.size("v").alias("dim")), ["query_id", "dim"])

    def verify(key, frame):
        """Exact vectors in the order of their bounds, until the k-th best score is certain."""
        frame = frame.sort_values(["upper", "vec_id"], ascending=[False, True], kind="stable")
        q = np.array(frame["q"].iloc[0], np.int64)
        best: list[tuple[int, int]] = []
        step = max(16, 2 * k)
        for a in range(0, len(frame), step):
            if len(best) >= k and -best[k - 1][0] > frame["upper"].iloc[a]:
                break
            part = frame.iloc[a : a + step]
            scores = _score(np.array(part["v"].tolist(), np.int64).reshape(len(part), -1), q)
            best = sorted(best + [(-int(s), int(i)) for s, i in zip(scores, part["vec_id"], strict=True)])[:k]
        return best

    def answer(key, frame):
        import pandas as pd

        best = verify(key, frame)
        return pd.DataFrame({"query_id": key[0], "rank": range(1, len(best) + 1), "vec_id": [i for _, i in best], "score": [-s for s, _ in best]})

    return exact.groupBy("query_id", "dim", "q").applyInPandas(answer, "query_id long, rank int, vec_id long, score long")
