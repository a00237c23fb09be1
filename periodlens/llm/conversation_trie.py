"""The prefix trie of conversations, in node tables addressed by a minimal perfect hash.

1. A turn becomes a 128-bit digest of (role, text), a prefix of d turns the sum of its turns' digests, each mixed
   with its place. The sums are running sums over ranges of the sorted turns, with what earlier ranges hold of a
   conversation carried over, so a conversation may be longer than a task's share.
2. Prefixes are combined where they are made: a row per distinct digest of a task's block, with its number of
   conversations and the smallest one. So a first turn or a whole conversation that many share makes few rows.
3. Whole subtrees go to shards, by their first turn; where a subtree has more than ``limit`` rows, its top node is
   taken out (to the spine) and its children's subtrees are dealt instead, and so on. The same goes for a subtree of more than one in
   ``SHARES`` of all rows, so that shards are of like size.
4. In a shard the distinct digests get slots 0..m-1 by a minimal perfect hash; a slot's digest is
   compared whenever it is looked up. Counts are scattered into flat arrays, children are added to their
   parents' slots from the deepest level up. The spine, which has at most rows / limit nodes a level, is such a
   table of its own, on top of the sums of the subtrees below it.

Order of turns: turn (null first), then role, then text. Defined results: null role or text is
empty; rows without a conversation id are no conversation and take no part; repeated rows are repeated turns; an
empty table gives no rows, not even the root; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.llm.rows import bounded_batches, stage
from periodlens.llm.texts import lean, mix

#: rows a shard's arrays may have, of whole subtrees; a subtree of more than one in SHARES of all rows is split, too
LIMIT, SHARES = 1 << 18, 256
#: prefixes combined at once in a task
BLOCK = 1 << 17
#: bytes of conversation ids hashed at once
CHUNK = 1 << 16
_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))


class PerfectHash:
    """Slots 0..n-1 of n distinct 128-bit digests; a digest that isn't among them has slot -1.

    Level by level, digests that have a position of a table to themselves stay there, the others go on
    to the next level. A slot is the rank of a position; the digest kept at it is compared."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        slot, left, base = np.zeros(len(lo), np.int64), np.arange(len(lo)), 0
        while len(left):
            size = 2 * len(left) + 1
            at = self._place(lo[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.cumsum(alone) - alone + base
            stay = alone[at]
            slot[left[stay]] = rank[at[stay]]
            self.levels.append((size, np.where(alone, rank, -1), base))
            base += int(stay.sum())
            left = left[~stay]
            if len(self.levels) > 64:
                raise ValueError("digests aren't distinct")
        self.lo, self.hi = np.zeros(len(lo), np.uint64), np.zeros(len(lo), np.uint64)
        self.lo[slot], self.hi[slot] = lo, hi

    @staticmethod
    def _place(lo: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(lo + np.uint64(level + 1) * _STEP[0]) % np.uint64(size)).astype(np.int64)

    def find(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        out, left = np.full(len(lo), -1, np.int64), np.arange(len(lo))
        for level, (size, slots, _) in enumerate(self.levels):
            found = slots[self._place(lo[left], level, size)]
            out[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
        if len(self.lo):
            right = (out >= 0) & (self.lo[out] == lo) & (self.hi[out] == hi)
            out[~right] = -1
        return out


def _distinct(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of the first of each distinct digest."""
    order = np.lexsort((hi, lo))
    new = np.concatenate(([True], (lo[order][1:] != lo[order][:-1]) | (hi[order][1:] != hi[order][:-1]))) if len(lo) else np.zeros(0, bool)
    return order[new]


def node_table(rows: dict[str, np.ndarray], below: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """The nodes of rows (k1, k2, p1, p2, d, chars, n, c), with sums over their subtrees.

    ``below``: (p1, p2, children, leaves, saved) of subtrees that hang on these nodes from elsewhere.
    ``pc`` is the parent's smallest conversation; ``top`` says that the parent isn't among the nodes."""
    first = _distinct(rows["k1"], rows["k2"])
    slots = PerfectHash(rows["k1"][first], rows["k2"][first])
    size = len(first)
    slot = slots.find(rows["k1"], rows["k2"])
    if (slot < 0).any():
        raise AssertionError("a digest lost its slot")
    out = {"k1": slots.lo, "k2": slots.hi}
    for name in ("p1", "p2", "d", "chars"):
        out[name] = np.zeros(size, rows[name].dtype)
        out[name][slot] = rows[name]
    n, conv = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    np.add.at(n, slot, rows["n"])
    np.minimum.at(conv, slot, rows["c"])
    parent = slots.find(out["p1"], out["p2"])
    parent[out["d"] == 0] = -1
    inside = parent >= 0
    children = np.bincount(parent[inside], minlength=size).astype(np.int64)
    leaves, saved = np.zeros(size, np.int64), (n - 1) * out["chars"]
    if below is not None and len(below["p1"]):
        at = slots.find(below["p1"], below["p2"])
        np.add.at(children, at, below["children"])
        np.add.at(leaves, at, below["leaves"])
        np.add.at(saved, at, below["saved"])
    leaves[children == 0] = 1
    order = np.argsort(out["d"], kind="stable")
    cuts = np.flatnonzero(np.diff(out["d"][order])) + 1
    for level in np.split(order, cuts)[::-1]:
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    return out | {"n": n, "c": conv, "top": ~inside, "pc": np.where(inside, conv[parent], 0), "children": children, "leaves": leaves, "saved": saved}


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_signed(x) for x in columns.values()], names=list(columns))


def _long(names: str) -> str:
    return ", ".join(f"{n} long" for n in names.split())


def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)


def running(spark: SparkSession, frame: DataFrame, order: list, make, columns: str, lanes: str, name: str) -> DataFrame:
    """``columns`` and running sums (modulo 2**64) of ``lanes`` per conversation ``c``, over the given order.

    ``make`` turns a sorted batch into (c, columns, lanes) as arrays. Rows are dealt out in sorted ranges; sums within
    a range are written, what earlier ranges hold of a range's first conversation (one row a range) is added as they are read."""
    names = lanes.split()

    def local(batches: Iterator[pa.RecordBatch]):
        part, key, held, done = TaskContext.get().partitionId(), None, {n: np.uint64(0) for n in names}, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            made = make(batch)
            c = made["c"]
            start = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
            size = np.diff(np.concatenate((start, [len(c)])))
            for n in names:
                with np.errstate(over="ignore"):
                    total = np.cumsum(made[n], dtype=np.uint64)
                    before = np.where(start > 0, total[start - 1], np.uint64(0))
                    if key == c[0]:  # the conversation goes on from the last batch
                        before[0] -= held[n]
                    made[n] = total - np.repeat(before, size)
                held[n] = made[n][-1]
            key = c[-1]
            yield _batch({"_p": np.full(len(c), part), "_i": np.arange(done, done + len(c)), **made})
            done += len(c)

    sorted_ = frame.repartitionByRange("c", *order).sortWithinPartitions("c", *order)
    part = stage(spark, sorted_.mapInArrow(lean(local), _long(f"_p _i c {columns} {lanes}")), name)
    last = F.max(F.struct("_i", "c", *names))
    ranges = {r["_p"]: r for r in part.groupBy("_p").agg(F.min("c").alias("low"), last.alias("last")).collect()}
    carry, key, held = {}, None, dict.fromkeys(names, 0)
    for p in sorted(ranges):
        r = ranges[p]
        if r["low"] == key:
            carry[p] = (key, dict(held))
        goes_on = r["low"] == r["last"]["c"] == key
        held = {n: ((held[n] if goes_on else 0) + r["last"][n]) % 2**64 for n in names}
        key = r["last"]["c"]
    shared = spark.sparkContext.broadcast(carry)

    def whole(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            p, c = batch.column("_p").to_numpy(), batch.column("c").to_numpy()
            out = {n: batch.column(n).to_numpy() for n in ["c", *columns.split()]} | {n: _unsigned(batch, n).copy() for n in names}
            for q in np.unique(p).tolist():
                if q in shared.value:
                    key, sums = shared.value[q]
                    goes_on = (p == q) & (c == key)
                    for n in names:
                        with np.errstate(over="ignore"):
                            out[n][goes_on] += np.uint64(sums[n])
            yield _batch(out)

    return part.mapInArrow(lean(whole), _long(f"c {columns} {lanes}"))


def turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """(c, pos from 1, t1, t2: digest of role and text, chars: code points of the text) of every turn."""
    empty = F.lit("")
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("t"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))

    def made(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        digests, chars = [], []
        for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
            role_bytes = role.encode()
            digests.append(hashlib.blake2b(len(role_bytes).to_bytes(8, "little") + role_bytes + text.encode(), digest_size=16).digest())
            chars.append(len(text))
        t = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        return {"c": batch.column("c").to_numpy(), "t1": t[:, 0].copy(), "t2": t[:, 1].copy(), "chars": np.array(chars, np.int64), "pos": np.ones(len(t), np.uint64)}

    ordered = running(spark, rows, [F.col("t").asc_nulls_first(), "role", "text"], made, "t1 t2 chars", "pos", "turns")
    return stage(spark, ordered, "ordered")


def rebuilt(rows: DataFrame) -> DataFrame:
    """The turns (c, d, t1, t2, chars) of the conversations that begin with the first h turns of c - c % 100, then go on
    with their own turns after their first h; h = crc32(decimal c) % 6."""
    h = F.crc32(F.col("c").cast("string").cast("binary")) % 6
    first = rows.where("pos <= 5").select(F.col("c").alias("b"), "pos", "t1", "t2", "chars")
    lengths = first.groupBy("b").agg(F.max("pos").alias("most"))
    own = F.col("c") - F.col("c") % 100
    heads = rows.where("pos = 1").select("c", own.alias("b"), h.alias("h")).join(first, "b").where("pos <= h").select("c", F.col("pos").alias("d"), "t1", "t2", "chars")
    tails = rows.withColumns({"b": own, "h": h}).where("pos > h").join(lengths, "b", "left")
    shared = F.least("h", F.coalesce("most", F.lit(0)))
    return heads.unionByName(tails.select("c", (F.col("pos") - F.col("h") + shared).alias("d"), "t1", "t2", "chars"))


def _digest(lane: int, total: np.ndarray, d: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(total + (d.astype(np.uint64) + np.uint64(1)) * _STEP[1 - lane])


ROOT = tuple(int(_digest(lane, np.zeros(1, np.uint64), np.zeros(1, np.uint64)).view(np.int64)[0]) for lane in (0, 1))


def paths(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(c, d, chars, k1, k2, p1, p2, a1, a2): each conversation's prefixes, their parents and first turns, as digests."""

    def made(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        d = batch.column("d").to_numpy()
        out = {"c": batch.column("c").to_numpy(), "d": d, "chars": batch.column("chars").to_numpy()}
        for lane, (name, step) in enumerate(zip(("t1", "t2"), _STEP, strict=True), 1):
            with np.errstate(over="ignore"):
                v = mix(_unsigned(batch, name) + d.astype(np.uint64) * step)
            out |= {f"v{lane}": v, f"s{lane}": v, f"f{lane}": np.where(d == 1, v, np.uint64(0))}
        return {k: out[k].copy() for k in ("c", "d", "chars", "v1", "v2", "s1", "s2", "f1", "f2")}

    summed = running(spark, rows, ["d"], made, "d chars v1 v2", "s1 s2 f1 f2", "sums")

    def keyed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            d, one = batch.column("d").to_numpy(), np.ones(batch.num_rows, np.int64)
            out = {n: batch.column(n).to_numpy() for n in ("c", "d", "chars")}
            for lane in (1, 2):
                s, v, f = (_unsigned(batch, f"{x}{lane}") for x in "svf")
                with np.errstate(over="ignore"):
                    out |= {f"k{lane}": _digest(lane - 1, s, d), f"p{lane}": _digest(lane - 1, s - v, d - 1), f"a{lane}": _digest(lane - 1, f, one)}
            yield _batch({k: out[k] for k in ("c", "d", "chars", "k1", "k2", "p1", "p2", "a1", "a2")})

    return stage(spark, summed.mapInArrow(lean(keyed), _long("c d chars k1 k2 p1 p2 a1 a2")), "paths")


_ROW = "k1 k2 p1 p2 a1 a2 d chars n c"


def combined(rows: DataFrame) -> DataFrame:
    """A row per distinct prefix of a block of a task's prefixes: n conversations, c the smallest."""

    def run(batches: Iterator[pa.RecordBatch]):
        held, size = [], 0

        def flush():
            x = {f: np.concatenate([b.column(f).to_numpy() for b in held]) for f in ("c", "d", "chars", "k1", "k2", "p1", "p2", "a1", "a2")}
            order = np.lexsort((x["c"], x["k2"], x["k1"]))
            k1, k2 = x["k1"][order], x["k2"][order]
            first = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))))
            out = {f: v[order[first]] for f, v in x.items()} | {"n": np.diff(np.concatenate((first, [len(order)])))}
            return _batch({f: out[f] for f in _ROW.split()})

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= BLOCK:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return rows.mapInArrow(lean(run), _long(_ROW))


_NODE = "k1 k2 p1 p2 d n c top pc children leaves saved"


def _tables(rows: DataFrame, limit: int) -> DataFrame:
    """The nodes of whole subtrees, which come one after another; a subtree's first node is a top."""

    def nodes(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        x = {n: np.concatenate([b.column(n).to_numpy() for b in held]) for n in _ROW.split()}
        for n in ("k1", "k2", "p1", "p2"):
            x[n] = x[n].view(np.uint64)
        out = node_table(x)
        return _batch({n: out[n] for n in _NODE.split()})

    def run(batches: Iterator[pa.RecordBatch]):
        held, size, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            a = np.stack([batch.column(n).to_numpy() for n in ("a1", "a2")], 1)
            at = [0, *(np.flatnonzero((a[1:] != a[:-1]).any(1)) + 1), len(a)]
            begun = 0
            for start, end in zip(at[:-1], at[1:], strict=True):
                if size + start - begun >= limit and tuple(a[start]) != last:  # a new subtree, and enough of earlier ones
                    if start > begun:
                        held.append(batch.slice(begun, start - begun))
                    yield nodes(held)
                    held, size, begun = [], 0, start
                last = tuple(a[start])
            held.append(batch.slice(begun))
            size += batch.num_rows - begun
        if held:
            yield nodes(held)

    return rows.mapInArrow(lean(run), _long(_NODE))


def _spine(rows: DataFrame) -> DataFrame:
    """The nodes above all shards, in one table. Rows: (kind 0) nodes, (kind 1) sums of the subtrees on a node (p1, p2)."""

    def run(batches: Iterator[pa.RecordBatch]):
        table = pa.Table.from_batches(list(batches), None) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        x = {n: table.column(n).to_numpy() for n in table.column_names}
        for n in ("k1", "k2", "p1", "p2"):
            x[n] = np.ascontiguousarray(x[n]).view(np.uint64)
        own, sums = x["kind"] == 0, x["kind"] == 1
        out = node_table({n: v[own] for n, v in x.items()}, {n: v[sums] for n, v in x.items()})
        yield _batch({n: out[n] for n in _NODE.split()})

    return rows.repartition(1).mapInArrow(lean(run), _long(_NODE))


def member_hashes(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of (c, k1, k2): decimal ids, ascending, comma-joined.

    Ids are written out in sorted ranges, so that a group of any size arrives in its last task as few rows of bytes."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            k1, k2, c = (batch.column(n).to_numpy() for n in ("k1", "k2", "c"))
            at = [0, *(np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1), len(c)] if len(c) else [0]
            starts = [s for a, b in zip(at[:-1], at[1:], strict=True) for s in range(a, b, CHUNK // 8)]
            stops = [*starts[1:], len(c)]
            yield pa.RecordBatch.from_arrays([pa.array(k1[starts]), pa.array(k2[starts]), pa.array(c[starts]), pa.array([",".join(map(str, c[a:b].tolist())).encode() for a, b in zip(starts, stops, strict=True)], pa.binary())], names=["k1", "k2", "c", "ids"])

    parts = ends.repartitionByRange("k1", "k2", "c").sortWithinPartitions("k1", "k2", "c").select("k1", "k2", "c").mapInArrow(lean(run), "k1 long, k2 long, c long, ids binary")

    def hashed(batches: Iterator[pa.RecordBatch]):
        key, sha = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "ids")), strict=True):
                if (k1, k2) != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (k1, k2), hashlib.sha256(ids)
                else:
                    sha.update(b"," + ids)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["k1", "k2", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([sha.hexdigest()])], names=["k1", "k2", "ends_sha256"])

    return stage(spark, parts, "ids").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "c").mapInArrow(lean(hashed), "k1 long, k2 long, ends_sha256 string")


def prefix_trie(spark: SparkSession, conversations: DataFrame, share_heads: bool = True, limit: int = LIMIT) -> DataFrame:
    """One row per distinct prefix (node): conv_id (its smallest conversation), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 and its 128-bit digest (k1, k2).

    ``share_heads``: conversations are first rebuilt, see :func:`rebuilt`; else they are taken as they are."""
    bounded_batches(spark)
    ordered = turns(spark, conversations)
    convs = ordered.where("pos = 1").select("c")
    rows = rebuilt(ordered) if share_heads else ordered.withColumnRenamed("pos", "d")
    whole = paths(spark, rows)
    parts = stage(spark, combined(whole), "prefixes")
    longest, total = parts.agg(F.coalesce(F.max("d"), F.lit(0)), F.count("*")).first()
    most, level, todo, light, spine = max(min(limit, total // SHARES), 2 * longest), 1, parts, [], []
    while True:
        heavy = stage(spark, todo.groupBy("a1", "a2").count().where(F.col("count") > most).select("a1", "a2"), "heavy")
        if heavy.isEmpty():
            light.append(todo)
            break
        light.append(todo.join(heavy, ["a1", "a2"], "left_anti"))
        hot = todo.join(heavy, ["a1", "a2"], "left_semi")
        spine.append(hot.where(F.col("d") == level))
        level += 1
        next_ = whole.where(F.col("d") == level).select("c", F.col("k1").alias("a1"), F.col("k2").alias("a2"))
        todo = stage(spark, hot.where(F.col("d") >= level).drop("a1", "a2").join(next_, "c"), "deeper")
    dealt = light[0]
    for frame in light[1:]:
        dealt = dealt.unionByName(frame)
    nodes = stage(spark, _tables(dealt.select(*_ROW.split()).repartition("a1", "a2").sortWithinPartitions("a1", "a2"), most), "nodes")
    root = convs.agg(F.count("*").alias("n"), F.min("c").alias("c")).where("n > 0").select(F.lit(ROOT[0]).alias("k1"), F.lit(ROOT[1]).alias("k2"), F.lit(0).alias("p1"), F.lit(0).alias("p2"), F.lit(0).alias("d"), F.lit(0).alias("chars"), "n", "c")
    above = root
    for frame in spine:
        above = above.unionByName(frame.groupBy("k1", "k2", "p1", "p2", "d", "chars").agg(F.sum("n").alias("n"), F.min("c").alias("c")))
    tops = nodes.where("top = 1")
    sums = tops.groupBy("p1", "p2").agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    both = above.withColumn("kind", F.lit(0)).unionByName(sums.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    long_ = [F.coalesce(F.col(n).cast("long"), F.lit(0)).alias(n) for n in "kind k1 k2 p1 p2 d chars n c children leaves saved".split()]
    upper = stage(spark, _spine(both.select(long_)), "spine")
    # the parents of the shards' top nodes stand in the spine
    named = tops.drop("pc").join(upper.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("c").alias("pc")), ["p1", "p2"])
    all_ = nodes.where("top = 0").unionByName(named).unionByName(upper)
    ends = whole.groupBy("c").agg(F.max(F.struct("d", "k1", "k2")).alias("x")).select("c", "x.k1", "x.k2")
    turnless = convs.join(ends.select("c"), "c", "left_anti").select("c", F.lit(ROOT[0]).alias("k1"), F.lit(ROOT[1]).alias("k2"))
    hashes = member_hashes(spark, ends.unionByName(turnless))
    out = all_.join(hashes, ["k1", "k2"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("c").alias("conv_id"),
        F.col("d").alias("depth"),
        F.when(F.col("d") > 0, F.col("pc")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        "k1",
        "k2",
    )
