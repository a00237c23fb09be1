"""Similarity join of n-gram sets by prefix trees.

1. Every text becomes its set of distinct n-grams (word shingles). Equal sets are one class from here on. Tasks count
   n-grams with a bounded number of counters (what is frequent in a task is surely kept); the merged counts, of
   ``MOST_FREQUENT`` n-grams at most, put frequent n-grams last in the global order of n-grams.
2. At a similarity of t a set shares at least t of its n-grams with another class, so at most (1 - t) n may
   be its own. Half of all n-grams (by hash) are counted over the classes, by ranges of hashes; a class of whose n-grams
   more than (1 - t) n occur in no other class is linked with nothing.
3. Two similar sets share one of their first n - ceil(t n) + 1 n-grams in the global order. Classes that share such a
   prefix n-gram and are of similar size meet at the group's leader, the member that meets most others;
   groups with one leader are one star. So copies of one text make one star, not one group for each n-gram.
4. The sets of a star's block are stored in a trie along the global order. The leader's set walks down all branches
   at once; sets with equal beginnings share their overlap so far, and a subtree is left as soon as its
   overlap and the n-grams that remain on either side can't reach the similarity any more.
5. Links are contracted to components. Stars that still hold several components are joined with themselves, block by
   block, in the same way, each set against the trie of the sets of other components. Every pair that
   shares a prefix n-gram is thus either judged on full sets or already in one component: nothing is missed.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; n-grams are told apart by 63 bits of a hash. Defined results: null or
empty text has no n-grams and is linked with nothing; fewer words than an n-gram make one n-gram; a null id takes part
but is never a component's id where there is another; repeated rows are one class and get the same result each; an
empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from periodlens.llm import bloom, graph, texts
from periodlens.llm.rows import stage, with_row_key
from periodlens.llm.texts import lean, mix

#: counters of frequent n-grams a task, and in all
COUNTERS, MOST_FREQUENT = 1 << 13, 1 << 17
#: an n-gram is frequent from this count on
FREQUENT = 64
#: n-grams of a range of hashes, when classes' n-grams are counted; ranges there are at least
RANGE, RANGES = 1 << 21, 48
#: bytes of the sets of a block
BLOCK_BYTES = 1 << 21
#: n-grams of the first part of a trie's edge; later parts double
EDGE = 32
_HEAVY = np.uint64(1 << 63)


def sets(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct 63-bit n-gram hashes of all documents one after another, offsets)."""
    n = len(at) - 1
    _, _, hashes, doc = texts.words(data, at, texts.NOT_SPACE)
    value, owner = texts.shingles(hashes, doc, n, width)
    value = value >> np.uint64(1)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value):
        fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
        value, owner = value[fresh], owner[fresh]
    return value, np.searchsorted(owner, np.arange(n + 1))


class Frequent:
    """Counters of at most ``size`` values: a value with more than (all values) / size occurrences is surely among them."""

    def __init__(self, size: int):
        self.size, self.value, self.count = size, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        value, count = np.unique(values, return_counts=True)
        both, which = np.unique(np.concatenate((self.value, value)), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, which, np.concatenate((self.count, count)))
        if len(both) > self.size:  # all counters fall by the first count that finds no place
            total -= np.partition(total, len(total) - self.size - 1)[len(total) - self.size - 1]
        keep = total > 0
        self.value, self.count = both[keep], total[keep]


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """(_f, _r, id, n, half: n-grams with an even hash, k: the key's first 64 bits, key) of each row, and a row per task with
    (n = -1, key: frequent n-grams and their counts)."""
    schema = T.StructType([*docs.schema.fields[:2], T.StructField("id", docs.schema["id"].dataType), *[T.StructField(x, T.LongType()) for x in ("n", "half", "k")], T.StructField("key", T.BinaryType())])
    id_type = to_arrow_type(docs.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]):
        often = Frequent(COUNTERS)
        for batch in batches:
            values = []
            for i, j, data, at in texts.segments(batch.column(3)):
                value, first = sets(data, at, width)
                values.append(value)
                keys = [hashlib.blake2b(value[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(first[:-1], first[1:], strict=True)]
                even = np.concatenate(([0], np.cumsum((value & np.uint64(1)) == 0)))
                k = _key_hash([x or b"\0" * 8 for x in keys])
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, j - i) for c in range(3)], pa.array(np.diff(first), pa.int64()), pa.array(np.diff(even[first]), pa.int64()), pa.array(k), pa.array(keys, pa.binary())], names=schema.names)
            if values:
                often.add(np.concatenate(values))
        kept = often.count > 1
        data = np.stack((often.value[kept].view(np.int64), often.count[kept]), 1).tobytes()
        zero = pa.array([0], pa.int64())
        yield pa.RecordBatch.from_arrays([zero, zero, pa.nulls(1, id_type), pa.array([-1], pa.int64()), zero, zero, pa.array([data], pa.binary())], names=schema.names)

    return docs.select("_f", "_r", "id", "t").mapInArrow(lean(run), schema)


def frequent_ngrams(rows: DataFrame) -> np.ndarray:
    """The most frequent n-grams, rarest first, of at most MOST_FREQUENT."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for data in batch.column(0):
                pairs = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["h", "c"])

    counts = rows.where("n = -1").select("key").mapInArrow(lean(run), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT)
    found = counts.orderBy(F.desc("c"), "h").limit(MOST_FREQUENT).toArrow()
    h, c = found.column("h").to_numpy(), found.column("c").to_numpy()
    return h[np.lexsort((h, c))].view(np.uint64)


class Order:
    """Codes of n-grams whose numeric order is the global one: hashes, then frequent ones by their count."""

    def __init__(self, frequent: np.ndarray):
        self.by = np.argsort(frequent, kind="stable").astype(np.uint64)
        self.sorted = frequent[self.by.astype(np.int64)]

    def heavy(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.sorted, value), max(0, len(self.sorted) - 1))
        return at, self.sorted[at] == value if len(self.sorted) else np.zeros(len(value), bool)

    def codes(self, value: np.ndarray) -> np.ndarray:
        at, heavy = self.heavy(value)
        if not len(self.sorted):
            return value
        return np.where(heavy, _HEAVY | self.by[at], value)


def _key_hash(keys: list) -> np.ndarray:
    return np.frombuffer(b"".join(k[:8] for k in keys), np.int64) if keys else np.zeros(0, np.int64)


def shared_counts(docs: DataFrame, order, ranges: int, width: int) -> DataFrame:
    """(k, c): how many of the n-grams with an even hash a set (its key's first 64 bits) shares with another; frequent ones count as shared.

    Each n-gram travels as 12 bytes in blocks by range of hashes; in a range, what only one key has is not shared."""

    def split(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for _, _, data, at in texts.segments(batch.column(0)):
                value, first = sets(data, at, width)
                n = np.diff(first)
                some = np.flatnonzero(n)
                keys = _key_hash([hashlib.blake2b(value[first[i] : first[i + 1]].tobytes(), digest_size=16).digest() for i in some])
                owner = np.repeat(keys, n[some])
                half = (value & np.uint64(1)) == 0
                value, owner = value[half], owner[half]
                _, heavy = order.value.heavy(value)
                known, which = np.unique(owner[heavy], return_inverse=True)
                value, owner = mix(value[~heavy]), owner[~heavy]
                part = (value >> np.uint64(32)) % np.uint64(ranges)
                low = (value & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                by = np.argsort(part, kind="stable")
                cut = np.searchsorted(part[by], np.arange(ranges + 1))
                parts = [p for p in range(ranges) if cut[p + 1] > cut[p]]
                hs = [low[by[cut[p] : cut[p + 1]]].tobytes() for p in parts]
                ks = [owner[by[cut[p] : cut[p + 1]]].tobytes() for p in parts]
                count = np.bincount(which, minlength=len(known)).astype(np.uint32)
                to = known.view(np.uint64) % np.uint64(ranges)
                for p in np.unique(to).tolist():  # a key's frequent n-grams: to the range its key belongs to
                    parts.append(ranges + p)
                    hs.append(count[to == p].tobytes())
                    ks.append(known[to == p].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(hs, pa.binary()), pa.array(ks, pa.binary())], names=["p", "h", "k"])

    def counted(held: list, p: int) -> pa.RecordBatch:
        h = np.frombuffer(b"".join(x[0] for x in held), np.uint32)
        k = np.frombuffer(b"".join(x[1] for x in held), np.int64)
        if p >= ranges:  # repeated rows say the same
            keys, first = np.unique(k, return_index=True)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(h[first].astype(np.int64))], names=["k", "c"])
        by = np.lexsort((k, h))
        h, k = h[by], k[by]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (k[1:] != k[:-1])))
        h, k = h[new], k[new]
        same = h[1:] == h[:-1]
        shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
        keys, count = np.unique(k[shared], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(count.astype(np.int64))], names=["k", "c"])

    def run(batches: Iterator[pa.RecordBatch]):
        held, last = [], None
        for batch in batches:
            for p, h, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if held and p != last:
                    yield counted(held, last)
                    held = []
                last = p
                held.append((h, k))
        if held:
            yield counted(held, last)

    blocks = docs.select("t").mapInArrow(lean(split), "p int, h binary, k binary")
    return blocks.repartition("p").sortWithinPartitions("p").mapInArrow(lean(run), "k long, c long").groupBy("k").agg(F.sum("c").alias("c"))


def _prefix(n: np.ndarray, least: int) -> np.ndarray:
    """How many first n-grams of a set hold one that a similar set has among its first ones, too."""
    return n - -(-n * least // 100) + 1


def bands(n: np.ndarray, least: int) -> np.ndarray:
    """Classes of set sizes: similar sets are in the same or in neighbouring ones."""
    return np.floor(np.log(n) / np.log(101 / (least + 0.0))).astype(np.int64)


def prefixes(whole: DataFrame, least: int) -> DataFrame:
    """(g, node): a row per set, prefix n-gram and size class (its own and the next)."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            n = batch.column("n").to_numpy()
            if not len(n):
                continue
            p, band = _prefix(n, least), bands(n, least)
            codes = np.concatenate([np.frombuffer(s.as_buffer(), ">u8", int(k)) for s, k in zip(batch.column("s"), p, strict=True)]).astype(np.uint64)
            node, band = np.repeat(batch.column("node").to_numpy(), p), np.repeat(band, p)
            for more in (0, 1):
                with np.errstate(over="ignore"):
                    g = mix(codes * np.uint64(0x9E3779B97F4A7C15) + (band + more).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(node)], names=["g", "node"])

    return whole.select("node", "n", "s").mapInArrow(lean(run), "g long, node long")


class Trie:
    """Sets of ascending codes, all different, as a path-compressed trie in arrays.

    A node's edge is codes start..depth of the member ``rep``; it stands for the members lo..hi in sorted order,
    of ``least`` to ``most`` codes, and is itself the end of member ``leaf`` (or -1)."""

    def __init__(self, members: list[np.ndarray]):
        raw = [m.astype(">u8").tobytes() for m in members]
        self.order = np.array(sorted(range(len(members)), key=raw.__getitem__), np.int64)
        members = [members[i] for i in self.order]
        self.sizes = np.array([len(m) for m in members], np.int64)
        self.codes = np.concatenate(members)
        self.at = np.concatenate(([0], np.cumsum(self.sizes)))
        shared = [0, *[_common(a, b) for a, b in zip(members[:-1], members[1:], strict=True)]]
        # node 0 is the root; a path of open nodes leads to the last member
        depth, parent, rep, leaf, path = [0], [-1], [0], [-1], [0]
        for i, n in enumerate(self.sizes.tolist()):
            last = -1
            while depth[path[-1]] > shared[i]:
                last = path.pop()
            if depth[path[-1]] < shared[i]:  # a new fork on the edge to the last node
                depth.append(shared[i])
                parent.append(path[-1])
                rep.append(rep[last])
                leaf.append(-1)
                parent[last] = len(depth) - 1
                path.append(len(depth) - 1)
            depth.append(n)
            parent.append(path[-1])
            rep.append(i)
            leaf.append(i)
            path.append(len(depth) - 1)
        self.depth, self.parent, self.rep, self.leaf = (np.array(x, np.int64) for x in (depth, parent, rep, leaf))
        count = len(depth)
        low, high, least, most = [len(members)] * count, [0] * count, [1 << 62] * count, [0] * count
        for v in np.argsort(-self.depth, kind="stable").tolist():  # children first
            if leaf[v] >= 0:
                i, n = leaf[v], depth[v]
                low[v], high[v], least[v], most[v] = min(low[v], i), max(high[v], i + 1), min(least[v], n), max(most[v], n)
            u = parent[v]
            if u >= 0:
                low[u], high[u], least[u], most[u] = min(low[u], low[v]), max(high[u], high[v]), min(least[u], least[v]), max(most[u], most[v])
        self.lo, self.hi, self.least, self.most = (np.array(x, np.int64) for x in (low, high, least, most))
        self.start = np.where(self.parent >= 0, self.depth[self.parent], 0)
        by = np.argsort(self.parent[1:], kind="stable") + 1
        self.children, self.first = by, np.searchsorted(self.parent[by], np.arange(count + 1))

    def _below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(children of the nodes, which node each belongs to)."""
        size = self.first[nodes + 1] - self.first[nodes]
        which = np.repeat(np.arange(len(nodes)), size)
        return self.children[_ranges(self.first[nodes], size)], which

    def similar(self, probe: np.ndarray, least: int, wanted: np.ndarray) -> np.ndarray:
        """Numbers of the members (``wanted`` ones) that are similar to the probe.

        All branches are walked at once, part by part of their edges. A branch is left if its overlap and the codes that remain,
        in the probe beyond the branch's last code or in the subtree's largest member, are too few for its smallest member."""
        found, size, total = [], EDGE, np.concatenate(([0], np.cumsum(wanted[self.order])))
        node, which = self._below(np.zeros(1, np.int64))
        overlap, place, rank = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        while len(node):
            live = total[self.hi[node]] > total[self.lo[node]]
            remain = np.minimum(self.most[node] - place, len(probe) - rank)
            live &= (overlap + remain) * (100 + least) >= least * (len(probe) + self.least[node])
            node, overlap, place = node[live], overlap[live], place[live]
            if not len(node):
                break
            to = np.minimum(self.depth[node], place + size)
            length = to - place
            codes = self.codes[_ranges(self.at[self.rep[node]] + place, length)]
            at = np.searchsorted(probe, codes)
            hit = probe[np.minimum(at, len(probe) - 1)] == codes
            ends = np.cumsum(length)
            overlap = overlap + np.add.reduceat(hit, ends - length)
            rank, place = (at + hit)[ends - 1], to
            done = place == self.depth[node]
            leaf = self.leaf[node[done]]
            both = overlap[done]
            fits = (leaf >= 0) & (100 * both >= least * (len(probe) + self.depth[node[done]] - both))
            found.append(leaf[fits])
            below, which = self._below(node[done])
            node, overlap, place, rank = (np.concatenate((x[~done], y)) for x, y in ((node, below), (overlap, overlap[done][which]), (place, place[done][which]), (rank, rank[done][which])))
            size *= 2
        hits = self.order[np.concatenate(found)] if found else np.zeros(0, np.int64)
        return hits[wanted[hits]]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    m = min(len(a), len(b))
    other = np.flatnonzero(a[:m] != b[:m])
    return int(other[0]) if len(other) else m


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def links_of(nodes: np.ndarray, comps: np.ndarray, sets_: list[np.ndarray], probe: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Links between probes (``probe`` is true) and the others, or among all if none is: enough to join what is similar."""
    probes, members = np.flatnonzero(probe), np.flatnonzero(~probe)
    among = not len(probes)
    if among:
        probes = members
    if not len(members):
        return []
    trie, comps, out = Trie([sets_[i] for i in members]), comps.copy(), []
    for i in probes.tolist():
        wanted = comps[members] != comps[i]
        if among:
            wanted &= members > i
        if not wanted.any():
            continue
        hits = members[trie.similar(sets_[i], least, wanted)]
        _, first = np.unique(comps[hits], return_index=True)
        for j in hits[first].tolist():
            out.append((int(nodes[i]), int(nodes[j])))
        if len(hits):
            comps[np.isin(comps, comps[hits])] = comps[i]
    return out


def judged(units: DataFrame, least: int) -> DataFrame:
    """(a, b): links found in units (leader, lo, hi, side, node, comp, s); side 0 are the probes of side 1."""

    def run(batches: Iterator[pa.RecordBatch]):
        held, last = [], None

        def found() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            side, node, comp = (table.column(n).to_numpy() for n in ("side", "node", "comp"))
            whole = [np.frombuffer(x, ">u8").astype(np.uint64) for x in table.column("s").to_pylist()]
            links = links_of(node, comp, whole, side == 0, least)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(n).to_numpy() for n in ("leader", "lo", "hi")], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                now = tuple(key[start].tolist())
                if held and now != last:
                    yield found()
                    held = []
                last = now
                held.append(batch.slice(start, end - start))
        if held:
            yield found()

    order = ["leader", "lo", "hi"]
    units = units.select(*order, "side", "node", "comp", "s").repartition(*order).sortWithinPartitions(*order, "side", "node")
    return units.mapInArrow(lean(run), "a long, b long")


def _blocks(spark: SparkSession, members: DataFrame, sized: DataFrame) -> DataFrame:
    """members (leader, node, ...) with blocks (of the leader's members: as many as BLOCK_BYTES asks for) and i (the node's)."""
    count = members.join(sized, "node").groupBy("leader").agg(F.ceil(F.sum(F.col("n") * 8) / BLOCK_BYTES).cast("int").alias("blocks"))
    # written, so that the join can leave a leader's many members where they are
    return members.join(stage(spark, count, "blocks"), "leader").withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def star_links(spark: SparkSession, stars: DataFrame, whole: DataFrame, least: int) -> DataFrame:
    """Links of leaders with their members."""
    cut = stage(spark, _blocks(spark, stars, whole.select("node", "n")), "cut")
    members = cut.select("leader", F.col("i").alias("lo"), F.lit(-1).alias("hi"), F.lit(1).alias("side"), "node")
    leads = cut.groupBy("leader", "i").agg(F.lit(0).alias("side")).select("leader", F.col("i").alias("lo"), F.lit(-1).alias("hi"), "side", F.col("leader").alias("node"))
    return judged(members.unionByName(leads).withColumn("comp", F.col("node")).join(whole.select("node", "s"), "node"), least)


def across(spark: SparkSession, stars: DataFrame, labels: DataFrame, whole: DataFrame, least: int) -> DataFrame:
    """Links between different components (node, label) that meet in one star, block by block of its members."""
    members = stars.unionByName(stars.select("leader", F.col("leader").alias("node")).distinct())
    of = members.join(labels, "node", "left").select("leader", "node", F.coalesce("label", "node").alias("comp"))
    several = of.groupBy("leader").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("leader")
    open_ = stage(spark, of.join(stage(spark, several, "several"), "leader"), "open")
    cut = _blocks(spark, open_, whole.select("node", "n"))
    cut = cut.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("i", "j"), F.greatest("i", "j")
    # of two blocks the first one's sets are probes; a block by itself has members only
    units = cut.select("leader", lo.alias("lo"), hi.alias("hi"), F.when(F.col("i") == hi, 1).otherwise(0).alias("side"), "node", "comp")
    return judged(units.join(whole.select("node", "s"), "node"), least)


def classes_and_links(spark: SparkSession, docs: DataFrame, least: int, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links between classes' nodes) of documents (_f, _r, id, t)."""
    rows = stage(spark, sketch(docs, width), "sketches")
    order = spark.sparkContext.broadcast(Order(frequent_ngrams(rows)))
    one = rows.where("n > 0").groupBy("key").agg(F.min("id").alias("id"), F.min(F.struct("_f", "_r", "n", "half", "k")).alias("x"))
    classes = stage(spark, one.select(F.monotonically_increasing_id().alias("node"), "key", "id", "x.*"), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    shared = shared_counts(docs, order, max(RANGES, -(-total // (2 * RANGE))), width)
    # of the n-grams that count, at most n - ceil(t n) may be a class's own
    survivors = stage(spark, classes.join(shared, "k", "left").where(F.coalesce("c", F.lit(0)) >= F.col("half") - (F.col("n") - F.ceil(F.col("n") * least / 100))).select("node", "_f", "_r"), "survivors")
    whole = stage(spark, full_sets(spark, survivors, docs, order, width), "sets")
    groups = prefixes(whole, least)
    company = stage(spark, groups.groupBy("g").agg(F.count("*").alias("c")).where("c > 1"), "company")
    live = stage(spark, groups.join(company, "g"), "groups")
    popular = live.groupBy("node").agg(F.sum("c").alias("p"))
    leaders = live.join(popular, "node").groupBy("g").agg(F.max(F.struct("p", (-F.col("node")).alias("m"))).alias("x")).select("g", (-F.col("x.m")).alias("leader"))
    stars = stage(spark, live.join(stage(spark, leaders, "leaders"), "g").where("node <> leader").select("leader", "node").distinct(), "stars")
    links = stage(spark, star_links(spark, stars, whole, least), "links")
    more = across(spark, stars, graph.components(spark, links), whole, least)
    return rows, classes, stage(spark, links.unionByName(more), "all-links")


def full_sets(spark: SparkSession, classes: DataFrame, docs: DataFrame, order, width: int) -> DataFrame:
    """(node, n, s): the classes' whole sets as ascending codes, from the text of the row that stands for each."""
    held = bloom.inner(spark, docs.select("_f", "_r", "t"), classes.select("_f", "_r", "node"), "_f", "_r").select("node", "t")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, j, data, at in texts.segments(batch.column(1)):
                value, first = sets(data, at, width)
                codes = order.value.codes(value)
                out = [np.sort(codes[a:b]).astype(">u8").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(first), pa.int64()), pa.array(out, pa.binary())], names=["node", "n", "s"])

    return held.mapInArrow(lean(run), "node long, n long, s binary")


def similar_groups(spark: SparkSession, docs: DataFrame, least: int = 85, width: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_shingles (n-grams of its set), component_id (smallest id reachable by links of at least ``least`` percent)."""
    keyed = with_row_key(spark, docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t")), "documents").select("_f", "_r", "id", "t")
    rows, classes, links = classes_and_links(spark, keyed, least, width)
    named = classes.select("node", "key", "id").join(graph.components(spark, links), "node", "left").withColumn("component", F.coalesce("label", "node"))
    ids = named.groupBy("component").agg(F.min("id").alias("component_id"))
    found = stage(spark, named.join(ids, "component").select("key", "component_id"), "components")
    out = rows.where("n >= 0").join(found, "key", "left")
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
