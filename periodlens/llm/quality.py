"""Quality classifier from weak labels.

Two questions are judged alike: is a text junk, is it toxic? For each, overlapping heuristic
labellers vote yes or nothing; the ``labels`` table is one more labeller, of the documents it
covers. Expectation-maximisation over the counts of vote patterns of the whole corpus
estimates the accuracy of each heuristic (the label's is given), and gives every pattern a
posterior label. Posterior labels of a bounded sample train a linear scorer over hashed words, word
stems and votes (follow-the-regularised-leader, which leaves most weights at zero), and the
scorer judges every document.

Toxic labellers are word lists drawn from two halves of the labelled sample (words and stems whose
odds differ), so there are none without toxic labels, and then nothing is toxic. The halves go by a hash of the id, and a
list has no vote on labelled documents of its own half when accuracies are estimated and the scorer is trained: there it
could hardly err.

Bounds: the sample has at most ``sample_rows`` rows (labelled ones first, then by hash of the id);
patterns are at most 3 ** labellers; weights are 2 ** 19 numbers. Statistics, votes and scores
cover all documents and whole texts.

Defined results: a text without words (null, empty) is rejected, its scores are null; null or repeated
ids are judged each; a document with several labels has the worst of them, a null label is no
vote; an empty table gives no rows; other columns are kept (filter_documents) or not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.llm import texts
from periodlens.llm.texts import lean

HEADS = ("junk", "toxic")
BITS = 18
SAMPLE_ROWS = 10_000
STEM = 5
YES, NO, NONE = 1, 0, 2
#: labellers of each head, the labels table last
LABELLERS = {"junk": ("symbols", "capitals", "stutter", "repeats", "label"), "toxic": ("words_a", "words_b", "stems_a", "stems_b", "label")}
#: the half of the labelled documents that each toxic list comes from
FOLD_OF = (0, 1, 0, 1)
#: first hashed feature of words, of stems, of votes
WORDS, STEMS, VOTES = 0, 1 << BITS, 2 << BITS
SIZE = (2 << BITS) + 64

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*|<>{}[]=+~^_\\/@!"]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_LETTER = _CAPITAL.copy()
_LETTER[97:123] = True


def _yes(cases: np.ndarray) -> np.ndarray:
    """A labeller that knows one kind of junk: yes, or nothing (its no would say nothing about the other kinds)."""
    return np.where(cases, YES, NONE).astype(np.int8)


class Read:
    """What the labellers and the scorer need of the texts of a segment."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        n = len(at) - 1
        self.n_docs = n
        start, end, self.hash, self.doc = texts.words(data, at, texts.ALNUM)
        self.n_words = np.bincount(self.doc, minlength=n) if len(self.doc) else np.zeros(n, np.int64)
        cut = np.minimum(end, start + STEM)
        up, down = texts.powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(texts._VALUES[texts._LOWER[data]] * up[: len(data)], out=total[1:])
            self.stem = texts.mix((total[cut] - total[start]) * down[start])
        self.data, self.at = data, at

    def _per_doc(self, mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[self.at[1:]] - total[self.at[:-1]]

    def _distinct(self, hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            key = np.sort(texts.mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(0xFFFFF) | doc.astype(np.uint64) & np.uint64(0xFFFFF))
        fresh = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
        return np.bincount((fresh & np.uint64(0xFFFFF)).astype(np.int64), minlength=self.n_docs)

    def junk_votes(self) -> np.ndarray:
        """Votes of the junk labellers, a row per document."""
        n = np.maximum(self.n_words, 1)
        some, more = self.n_words >= 12, self.n_words >= 20
        symbols = self._per_doc(_SYMBOL[self.data]) / n
        capitals = self._per_doc(_CAPITAL[self.data]) / np.maximum(self._per_doc(_LETTER[self.data]), 1)
        again = np.flatnonzero((self.hash[1:] == self.hash[:-1]) & (self.doc[1:] == self.doc[:-1]))
        stutter = np.bincount(self.doc[again], minlength=self.n_docs) / n
        h, d = texts.shingles(self.hash, self.doc, self.n_docs, 3)
        phrases = self._distinct(h, d) / np.maximum(np.bincount(d, minlength=self.n_docs) if len(d) else 0, 1)
        distinct = self._distinct(self.hash, self.doc) / n
        repeats = more & ((phrases < 0.5) | (distinct < 0.25))
        return np.stack([_yes((self.n_words > 3) & (symbols > 0.3)), _yes(some & (capitals > 0.4)), _yes(some & (stutter > 0.3)), _yes(repeats)], 1)

    def toxic_votes(self, lists: list[np.ndarray]) -> np.ndarray:
        out = []
        for k, known in enumerate(lists):
            hashes = self.stem if k >= 2 else self.hash
            if not len(known):
                out.append(np.full(self.n_docs, NONE, np.int8))
                continue
            hit = np.isin(hashes, known)
            out.append(_yes(np.bincount(self.doc[hit], minlength=self.n_docs) > 0))
        return np.stack(out, 1)

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashed feature, document) of words and stems, with repeats."""
        low = np.uint64((1 << BITS) - 1)
        return np.concatenate(((self.hash & low).astype(np.int64) + WORDS, (self.stem & low).astype(np.int64) + STEMS)), np.concatenate((self.doc, self.doc))


def vote_features(junk: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Features of a document's votes that aren't empty (a row per document, -1: none)."""
    votes = np.concatenate((junk, toxic), 1)
    return np.where(votes == NONE, -1, VOTES + 2 * np.arange(votes.shape[1]) + votes)


# ---- the label model

def chance_of(patterns: np.ndarray, accuracy: np.ndarray, leak: float) -> np.ndarray:
    """Chance of a yes given the heuristics' votes: none of those that say yes is right only if all of them err."""
    wrong = np.where(patterns[:, : len(accuracy)] == YES, 1 - accuracy, 1.0).prod(1)
    return 1 - (1 - leak) * wrong


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """(posterior of each pattern, chance of a yes without votes, accuracy of each heuristic).

    The last column of a pattern is the labels table, right in 99 of 100. A heuristic knows one
    kind of case, so its silence says nothing about other kinds; its accuracy is how
    often it is right by itself where it says yes. Expectation: the chance of a yes from the accuracies of
    those that vote, and the label, and each heuristic's share in it. Maximisation: each accuracy is its mean
    share where it votes, with two imagined votes at 0.8, where all start."""
    votes, label = patterns[:, :-1], patterns[:, -1]
    accuracy, leak = np.full(votes.shape[1], 0.8), 0.02
    silent = (votes != YES).all(1)
    odds = np.where(label == YES, 99.0, np.where(label == NO, 1 / 99.0, 1.0))
    post = np.zeros(len(patterns))
    for _ in range(rounds):
        p = np.clip(chance_of(votes, accuracy, leak), 1e-9, 1 - 1e-9)
        post = p * odds / (p * odds + 1 - p)
        for j in range(votes.shape[1]):
            own = counts * (votes[:, j] == YES)
            accuracy[j] = ((own * post / p).sum() * accuracy[j] + 2 * 0.8) / (own.sum() + 2)
        leak = float(np.clip(((counts * silent * post).sum() + 0.02) / ((counts * silent).sum() + 1), 1e-4, 0.4))
    return post, leak, accuracy


# ---- the scorer

def train(rows: list[np.ndarray], target: np.ndarray, epochs: int = 4, alpha: float = 0.3, l1: float = 2.0, l2: float = 1.0, seed: int = 5) -> np.ndarray:
    """Weights (the last one: bias) of a logistic scorer for soft labels, by FTRL-proximal."""
    z, n, w = np.zeros(SIZE + 1), np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            x = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[x].sum(), -35, 35)))
            g = p - target[i]
            root = np.sqrt(n[x])
            n[x] += g * g
            z[x] += g - (np.sqrt(n[x]) - root) / alpha * w[x]
            shrunk = np.where(x == SIZE, z[x], np.sign(z[x]) * np.maximum(np.abs(z[x]) - l1, 0))
            w[x] = -shrunk / ((1 + np.sqrt(n[x])) / alpha + l2)
    return w.astype(np.float32)


class Model:
    def __init__(self, lists: list[np.ndarray], weights: list[np.ndarray], chances: list[tuple[float, np.ndarray]]):
        self.lists, self.weights, self.chances = lists, weights, chances
        self.used = np.logical_or.reduce([w[:SIZE] != 0 for w in weights])

    def judge(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(has words, posteriors, scores, kept): a row per document, a column per head."""
        read = Read(data, at)
        junk, toxic = read.junk_votes(), read.toxic_votes(self.lists)
        bucket, doc = read.buckets()
        some = self.used[bucket]
        key = np.unique(doc[some] * np.int64(SIZE) + bucket[some])
        doc, bucket = key // SIZE, key % SIZE
        votes = vote_features(junk, toxic)
        score, posterior = [], []
        for head, w in enumerate(self.weights):
            margin = np.bincount(doc, w[bucket], minlength=read.n_docs) + w[SIZE] + np.where(votes >= 0, w[votes], 0).sum(1)
            score.append(1 / (1 + np.exp(-np.clip(margin, -35, 35))))
            leak, accuracy = self.chances[head]
            posterior.append(chance_of(junk if head == 0 else toxic, accuracy, leak))
        score, posterior, words = np.stack(score, 1), np.stack(posterior, 1), read.n_words > 0
        return words, posterior, score, words & (score < 0.5).all(1)


def _lists(rows: list[tuple], k: int) -> np.ndarray:
    """Hashes that occur in toxic texts of a part of the sample at far higher odds than elsewhere.

    Copies count once (texts with the same three least word hashes), or the words of a text that
    was copied often would look toxic."""
    rows = list({(r[0], r[1][:3].tobytes()): r for r in rows}.values())
    yes = [r[k] for r in rows if r[0] == YES]
    no = [r[k] for r in rows if r[0] == NO]
    if len(yes) < 5 or len(no) < 5:
        return np.zeros(0, np.uint64)
    value, count = np.unique(np.concatenate(yes), return_counts=True)
    other, others = np.unique(np.concatenate(no), return_counts=True)
    at = np.searchsorted(other, value)
    at[at == len(other)] = 0
    seen = np.where(other[at] == value, others[at], 0)
    odds = (count + 0.5) / (len(yes) + 1) / ((seen + 0.5) / (len(no) + 1))
    return value[(count >= 5) & (odds > 60)]


def cross_fitted(votes: np.ndarray, labelled: bool, fold: int | None) -> np.ndarray:
    """The toxic lists' votes on a document, without those of the lists that its own label may have helped to draw."""
    return np.where(np.array(FOLD_OF) == fold, NONE, votes).astype(np.int8) if labelled else votes


def _labels(labels: DataFrame) -> DataFrame:
    vote = lambda c, bad: F.max(F.when(F.col(c) == bad, YES).when(F.col(c).isNotNull(), NO))
    return labels.where("doc_id is not null").groupBy("doc_id").agg(vote("quality", 0).alias("l_junk"), vote("toxic", 1).alias("l_toxic"))


def _binary(a: np.ndarray) -> bytes:
    return a.tobytes()


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, text_column: str = "text", id_column: str = "doc_id") -> Model:
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("t"))
    given = _labels(labels)
    ids = docs.select("doc_id").where("doc_id is not null").distinct().join(given, "doc_id", "left")
    chosen = ids.orderBy(F.coalesce("l_toxic", "l_junk").isNull(), F.xxhash64("doc_id")).limit(sample_rows)

    def features(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, j, data, at in texts.segments(batch.column(1)):
                read = Read(data, at)
                votes, cut = read.junk_votes(), np.searchsorted(read.doc, np.arange(j - i + 1))
                part = [(np.unique(read.hash[a:b]), np.unique(read.stem[a:b])) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *[batch.column(c).slice(i, j - i) for c in (2, 3)], pa.array([_binary(v) for v in votes], pa.binary()), pa.array([_binary(w) for w, _ in part], pa.binary()), pa.array([_binary(s) for _, s in part], pa.binary())],
                    names=["doc_id", "l_junk", "l_toxic", "votes", "words", "stems"],
                )

    shape = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, l_junk int, l_toxic int, votes binary, words binary, stems binary"
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int")
    # at most sample_rows ids, a fixed bound; a repeated id may bring more rows, so the bound is set again
    sample = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "t", "l_junk", "l_toxic").mapInArrow(lean(features), shape).withColumn("fold", half).orderBy(F.xxhash64("doc_id", "words"), "doc_id").limit(sample_rows).collect()
    parse = lambda r: (NONE if r.l_toxic is None else r.l_toxic, np.frombuffer(r.words, np.uint64), np.frombuffer(r.stems, np.uint64), np.frombuffer(r.votes, np.int8), NONE if r.l_junk is None else r.l_junk, r.fold)
    rows = [parse(r) for r in sample]
    halves = [[r for r in rows if r[5] == fold] for fold in (0, 1)]
    lists = [_lists(halves[0], 1), _lists(halves[1], 1), _lists(halves[0], 2), _lists(halves[1], 2)]
    shared = spark.sparkContext.broadcast(lists)

    def votes_of(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, j, data, at in texts.segments(batch.column(1)):
                read = Read(data, at)
                pattern = np.concatenate((read.junk_votes(), read.toxic_votes(shared.value)), 1)[read.n_words > 0]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).filter(pa.array(read.n_words > 0)), pa.array([bytes(p) for p in pattern], pa.binary())], names=["doc_id", "votes"])

    voted = docs.mapInArrow(lean(votes_of), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, votes binary").join(given, "doc_id", "left")
    counted = voted.groupBy("votes", half.alias("fold"), "l_junk", "l_toxic").agg(F.count("*").alias("n")).collect()  # at most a row per pattern and half
    n_junk = len(LABELLERS["junk"]) - 1
    chances, weights = [], []
    features_of = []
    for label, words, stems, junk, _, fold in rows:
        low = np.uint64((1 << BITS) - 1)
        toxic = np.array([YES if len(k) and np.isin(stems if i >= 2 else words, k).any() else NONE for i, k in enumerate(lists)], np.int8)
        toxic = cross_fitted(toxic, label != NONE, fold)
        own = vote_features(junk[None], toxic[None])[0]
        features_of.append((np.unique(np.concatenate(((words & low).astype(np.int64) + WORDS, (stems & low).astype(np.int64) + STEMS, own[own >= 0], [SIZE]))), toxic))
    for head, part, label in ((0, slice(0, n_junk), "l_junk"), (1, slice(n_junk, None), "l_toxic")):
        total: dict[bytes, int] = {}
        for r in counted:
            votes = np.frombuffer(r.votes, np.int8)[part]
            if head == 1:
                votes = cross_fitted(votes, r.l_toxic is not None, r.fold)
            key = votes.tobytes() + bytes([NONE if r[label] is None else r[label]])
            total[key] = total.get(key, 0) + r.n
        patterns = np.array([list(k) for k in total], np.int64).reshape(len(total), len(LABELLERS[HEADS[head]]))
        posterior, leak, accuracy = em(patterns, np.array(list(total.values()), float))
        chances.append((leak, accuracy))
        of = dict(zip(total, posterior, strict=True))
        none = 0.0  # a sample row is one of the corpus, so its pattern was counted (but for texts without words)
        target = np.array([of.get((r[3] if head == 0 else f[1]).tobytes() + bytes([r[4] if head == 0 else r[0]]), none) for r, f in zip(rows, features_of, strict=True)])
        weights.append(train([f for f, _ in features_of], target))
    return Model(lists, weights, chances)


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, posteriors of the label model (from the heuristics alone), scores, kept."""
    model = spark.sparkContext.broadcast(fit(spark, docs, labels, sample_rows, text_column, id_column))
    docs = docs.select(id_column, text_column)
    numbers = [f"{h}_{x}" for x in ("posterior", "score") for h in HEADS]
    schema = T.StructType([docs.schema[id_column], *[T.StructField(n, T.DoubleType()) for n in numbers], T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, j, data, at in texts.segments(batch.column(1)):
                words, posterior, score, kept = model.value.judge(data, at)
                values = [pa.array(np.round(c, 6), mask=~words) for c in (*posterior.T, *score.T)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *values, pa.array(kept)], names=schema.names)

    return docs.mapInArrow(lean(run), schema)


def filter_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that are kept, all columns as they were."""
    model = spark.sparkContext.broadcast(fit(spark, docs, labels, sample_rows, text_column, id_column))
    at_text = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            kept = [model.value.judge(data, at)[3] for _, _, data, at in texts.segments(batch.column(at_text))]
            yield batch.filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool)))

    return docs.mapInArrow(lean(run), docs.schema)
