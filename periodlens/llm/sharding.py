"""A uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows come in chunks (a file's rows by index). From the chunks' row counts and the exact shard
sizes, the matrix of how many rows each chunk sends to each shard is drawn from the multivariate
hypergeometric distribution, row by row. A chunk's rows are permuted by a seed of its own and so
dealt out by its matrix row; after the exchange each shard is permuted again by random keys, in
cells of bounded size. Every assignment depends on the seed and the row's place only: a task that
runs again gives the same rows.

With very many chunks (small files) the matrix has two levels: one row per group of chunks, drawn
from the groups' row counts, and in a task per group the rows of its chunks, drawn from the group's row; each chunk's
rows are then joined with its row. Both levels are exact draws, so the law of the whole is the same.

Law: "rows" (shard sizes at most one apart). Defined results: a null text has no bytes; null ids
and repeated rows are rows like any others; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodlens.llm.rows import stage, with_row_key

#: the matrix is sent to the tasks up to so many rows of n_shards 64-bit counts; beyond, it is drawn in two levels
MOST_CHUNKS = 200_000
#: chunks of a group of the second level
GROUP_CHUNKS = 4_096


def communication_matrix(counts: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """How many rows each chunk sends to each shard, so that all shards get exactly their size."""
    rng, left = np.random.default_rng(seed), sizes.astype(np.int64).copy()
    out = np.zeros((len(counts), len(sizes)), np.int64)
    for i, n in enumerate(counts):
        rest = left.sum()
        for j in range(len(sizes)):  # marginals, one after another
            rest -= left[j]
            out[i, j] = rng.hypergeometric(left[j], rest, n) if n and left[j] < 10**9 and rest < 10**9 else _large(rng, left[j], rest, n)
            n -= out[i, j]
        left -= out[i]
    return out


def _large(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """A hypergeometric draw beyond numpy's range: n draws, one by one in bulk of uniforms."""
    if not n or not good:
        return 0
    got = 0
    for u in rng.random(n):
        hit = u * (good + bad) < good
        got, good, bad = got + hit, good - hit, bad - (not hit)
    return int(got)


def _two_levels(spark: SparkSession, counts: DataFrame, sizes: np.ndarray, seed: int) -> DataFrame:
    """(_f, c, sent): the matrix row of each chunk of counts (_f, c, count)."""
    groups = -(-counts.count() // GROUP_CHUNKS)
    grouped = counts.withColumn("g", F.pmod(F.xxhash64("_f", "c"), F.lit(groups)))
    # one row per group of some thousand chunks
    totals = {r["g"]: r["n"] for r in grouped.groupBy("g").agg(F.sum("count").alias("n")).collect()}
    rows = communication_matrix(np.array([totals.get(g, 0) for g in range(groups)], np.int64), sizes, seed)
    shared = spark.sparkContext.broadcast(rows)

    def draw(key: tuple, chunks: pd.DataFrame) -> pd.DataFrame:
        chunks = chunks.sort_values(["_f", "c"])
        g = int(key[0])
        own = communication_matrix(chunks["count"].to_numpy(), shared.value[g], hash_seed(seed, g))
        return pd.DataFrame({"_f": chunks["_f"], "c": chunks["c"], "sent": list(own)})

    return grouped.groupBy("g").applyInPandas(draw, "_f long, c long, sent array<long>")


def hash_seed(seed: int, g: int) -> int:
    """A seed for a group of chunks."""
    return int(np.random.SeedSequence((seed, g, 1)).generate_state(1, np.uint64)[0])


def _dealt_by_row(seed: int, n_shards: int, chunk_rows: int):
    """The shard of a row from its chunk's matrix row; each chunk has a permutation of its own."""

    @F.pandas_udf("int")
    def dealt(f: pd.Series, c: pd.Series, r: pd.Series, sent: pd.Series) -> pd.Series:
        f, c, r = f.to_numpy(), c.to_numpy(), r.to_numpy()
        out = np.zeros(len(r), np.int32)
        order = np.lexsort((c, f))
        new = np.flatnonzero(np.concatenate(([True], (f[order][1:] != f[order][:-1]) | (c[order][1:] != c[order][:-1])))) if len(r) else []
        for a, b in zip(new, [*new[1:], len(r)], strict=True):
            own = order[a:b]
            i = own[0]
            labels = np.random.default_rng((seed, int(f[i]) & (2**63 - 1), int(c[i]), 2)).permutation(np.repeat(np.arange(n_shards, dtype=np.int32), np.asarray(sent.iloc[i])))
            out[own] = labels[r[own] - c[i] * chunk_rows]
        return pd.Series(out)

    return dealt


def shuffle_to_shards(spark: SparkSession, docs: DataFrame, n_shards: int = 24, seed: int = 7, chunk_rows: int = 1 << 16, cell_rows: int = 1 << 13) -> DataFrame:
    """All columns of docs (those named shard or slot are replaced), with shard and slot.

    Slots of a shard are 0, 1, ... without gaps, in uniformly random order."""
    docs = docs.drop("shard", "slot")
    names = docs.columns
    docs = with_row_key(spark, docs.toDF(*[f"c{i}" for i in range(len(names))]), "sharding")
    total = docs.count()
    chunk = F.floor(F.col("_r") / F.lit(chunk_rows))
    sizes = np.full(n_shards, total // n_shards) + (np.arange(n_shards) < total % n_shards)
    counts = docs.groupBy("_f", chunk.alias("c")).count()
    held = counts.limit(MOST_CHUNKS + 1).collect()
    if len(held) > MOST_CHUNKS:
        sent = stage(spark, _two_levels(spark, stage(spark, counts, "chunks"), sizes, seed), "matrix")
        docs = docs.withColumn("c", chunk).join(sent, ["_f", "c"])
        dealt = _dealt_by_row(seed, n_shards, chunk_rows)("_f", "c", "_r", "sent")
    else:
        held = sorted(tuple(r) for r in held)
        matrix = communication_matrix(np.array([n for _, _, n in held], np.int64), sizes, seed)
        shared = spark.sparkContext.broadcast(({(f, int(c)): i for i, (f, c, _) in enumerate(held)}, matrix))

        @F.pandas_udf("int")
        def by_matrix(f: pd.Series, r: pd.Series) -> pd.Series:
            place, sent = shared.value
            f, r = f.to_numpy(), r.to_numpy()
            c = r // chunk_rows
            out = np.zeros(len(r), np.int32)
            change = np.flatnonzero(np.concatenate(([True], (f[1:] != f[:-1]) | (c[1:] != c[:-1])))) if len(r) else []
            for a, b in zip(change, [*change[1:], len(r)], strict=True):
                i = place[int(f[a]), int(c[a])]
                labels = np.random.default_rng((seed, i)).permutation(np.repeat(np.arange(n_shards, dtype=np.int32), sent[i]))
                out[a:b] = labels[r[a:b] - c[a] * chunk_rows]
            return pd.Series(out)

        dealt = by_matrix("_f", "_r")

    cells = max(1, math.ceil(total / n_shards / cell_rows))
    key = F.xxhash64(F.lit(seed), "_f", "_r")
    rows = docs.withColumn("shard", dealt).withColumn("_key", key).withColumn("_cell", F.pmod(F.shiftright("_key", 20), F.lit(cells)))
    ahead = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("shard", "_cell").count().select("shard", "_cell", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_base"))
    within = Window.partitionBy("shard", "_cell").orderBy("_key", "_f", "_r")
    placed = rows.join(bases, ["shard", "_cell"]).withColumn("slot", F.col("_base") + F.row_number().over(within) - 1)
    return placed.drop("_f", "_r", "_cell", "_key", "_base").select(*[F.col(f"c{i}") for i in range(len(names))], "shard", "slot").toDF(*names, "shard", "slot")


def digest(sharded: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharded.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
