"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Fitting uses at most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` clean labelled rows (the documented bound;
those with the smallest hash of their id), one of each distinct text. Where the bounds change
the labels' proportion, clean examples count with the weight that restores it. The vocabulary is every word of theirs and
every beginning of ``PREFIX`` letters of longer words, without selection. A term's weight
is (1 + ln tf) * idf * relevance: document frequencies are counted over all documents, and the
relevance, between ``FLOOR`` and 1, grows with the lower confidence bound of the share of toxic examples
among those that have the term. Vectors have length one in the space of these terms. Clean examples
are indexed and vote like toxic ones.

The inverted index is cut into blocks of ``BLOCK`` examples. Of common terms, whose lists are long, each
block's largest weight is kept. A query adds up its rare terms' short lists, and bounds each block by its
largest such sum and the common terms' largest weights. It scores the blocks of highest bound in full,
and then those whose bound can reach the k-th best cosine: the k nearest are exact. Examples are ordered by the nearest of a few seeds among them, so that
a block's examples are alike and its bound tight. Votes are weighted by inverse distance and calibrated
by isotonic regression on the examples' leave-one-out votes, computed on the executors. The
nearest are returned as evidence.

The index is bounded by the texts of the examples and broadcast. Every whole
text of the table is scored, by its text alone. Defined results: texts without any known term
(null and empty ones among them) have no neighbours and get the share of toxic among such
examples, drawn to the share among all; without usable labels every score is 0; repeated rows
are scored alike; labels that are null or name no document are ignored; held_out is false
where the id is null; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, table

#: Labelled rows a model is fitted on at most, by label: toxic ones are few, and vary more.
MAX_TOXIC, MAX_CLEAN = 512, 1792
NEIGHBOURS = 15
#: Nearest examples that a result shows.
EVIDENCE = 5
BLOCK = 64
SEEDS = 64
#: Blocks visited first, for a k-th best cosine to hold the others' bounds against.
FIRST = 6
PREFIX = 5
FLOOR = 0.1
#: Distance added to every neighbour's, so that an equal text weighs 50 times as much as one without common terms.
NEAREST = 0.02
#: Terms that one example in so many has are kept dense.
DENSE = 16
#: Stored weights are of single precision.
_SLACK = 1e-6
_Z = 1.96
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def terms_of(text: str | None) -> Counter[str]:
    """Words, and their beginnings marked by a star, with their counts."""
    words = Counter(words_of(text))
    found = Counter(words)
    for w, n in words.items():
        if len(w) > PREFIX:
            found[w[:PREFIX] + "*"] += n
    return found


class _Known:
    """Numbers of the terms of a vocabulary, given in order as lines; that of an unknown one is their number."""

    def __init__(self, packed: str) -> None:
        terms = packed.split("\n") if packed else []
        self.none = len(terms)
        self.whole = {t: k for k, t in enumerate(terms) if t[-1] != "*"}.get
        self.begin = {t[:-1]: k for k, t in enumerate(terms) if t[-1] == "*"}.get

    def counted(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the text's known terms, ascending, their counts)."""
        words, begins = Counter(words_of(text)), {}
        for w, n in words.items():
            if len(w) > PREFIX:
                begin = w[:PREFIX]
                begins[begin] = begins.get(begin, 0) + n
        size = len(words) + len(begins)
        numbers = np.fromiter(chain(map(self.whole, words, repeat(self.none)), map(self.begin, begins, repeat(self.none))), np.int64, size)
        counts = np.fromiter(chain(words.values(), begins.values()), np.int64, size)
        known = np.flatnonzero(numbers != self.none)
        order = known[np.argsort(numbers[known])]
        return numbers[order], counts[order]


def lower_share(hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Wilson lower bound of hits / n."""
    p = hits / n
    return (p + _Z * _Z / (2 * n) - _Z * np.sqrt(p * (1 - p) / n + _Z * _Z / (4 * n * n))) / (1 + _Z * _Z / n)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, end), one after the other."""
    sizes = ends - starts
    upto = np.cumsum(sizes)
    return np.arange(upto[-1]) + np.repeat(starts - upto + sizes, sizes) if len(sizes) else np.empty(0, np.int64)


@dataclass
class Index:
    """Examples, their labels, and postings by term and block.

    Terms that over 1 / ``DENSE`` of the examples have are most of all postings: they keep a row
    of weights, and its maximum, for each block. The others have short lists of postings."""

    terms: dict[str, int] = field(default_factory=dict)
    idf: np.ndarray = field(default_factory=lambda: np.empty(0))
    n: np.ndarray = field(default_factory=lambda: np.empty(0))
    n_toxic: np.ndarray = field(default_factory=lambda: np.empty(0))
    weighing: np.ndarray = field(default_factory=lambda: np.empty(0))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    labels: np.ndarray = field(default_factory=lambda: np.empty(0))
    base_rate: float = 0.0
    clean_weight: float = 1.0

    def packed(self) -> str:
        return self.terms if isinstance(self.terms, str) else "\n".join(self.terms)

    def __getstate__(self) -> dict:
        """Workers get the terms as one text, of which they make what they look words up in."""
        return {k: v for k, v in vars(self).items() if k != "known"} | {"terms": self.packed()}

    def relevance(self, numbers: np.ndarray, left_out: int | None) -> np.ndarray:
        """Of terms, by the examples that have them; ``left_out`` is the label of one that has no say."""
        toxic = self.n_toxic[numbers].astype(np.float64)
        clean = self.n[numbers] - toxic
        if left_out is not None:
            toxic, clean = toxic - left_out, clean - (1 - left_out)
        n = toxic + self.clean_weight * clean
        share = np.where(n > 0, lower_share(toxic, np.where(n > 0, n, 1.0)), 0.0)
        return FLOOR + (1 - FLOOR) * np.maximum(0, share - self.base_rate) / max(1 - self.base_rate, 1e-9)

    def vector(self, text: str | None, left_out: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
        """(term numbers, weights of unit length), or None where no term is known."""
        if "known" not in vars(self):
            self.known = _Known(self.packed())
            if isinstance(self.terms, str):
                self.terms = ""
        return self.weigh(*self.known.counted(text), left_out)

    def weigh(self, numbers: np.ndarray, counts: np.ndarray, left_out: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
        """The same from the numbers and counts of a text's terms."""
        if not len(numbers):
            return None
        weights = (1 + np.log(counts)) * self.idf[numbers] * (self.weighing[numbers] if left_out is None else self.relevance(numbers, left_out))
        return numbers, weights / np.sqrt(weights @ weights)

    def fill(self, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, starts: np.ndarray, numbers: np.ndarray, weights: np.ndarray) -> None:
        """Postings of examples; example i's vector is at starts[i] : starts[i + 1]."""
        self._post(np.repeat(np.arange(len(ids)), np.diff(starts)), numbers, weights, len(ids))
        order = self._by_seeds(starts, numbers, weights, keys)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.ids, self.keys, self.labels = ids[order], keys[order], labels[order]
        self._post(np.repeat(place, np.diff(starts)), numbers, weights, len(ids))

    def _post(self, examples: np.ndarray, numbers: np.ndarray, weights: np.ndarray, n: int) -> None:
        self.size, self.n_blocks = n, -(-n // BLOCK)
        order = np.lexsort((examples, numbers))
        examples, numbers, weights = examples[order], numbers[order], weights[order].astype(np.float32)
        common = np.flatnonzero(np.bincount(numbers, minlength=len(self.terms)) * DENSE > n)
        self.row = np.full(len(self.terms), -1, np.int32)
        self.row[common] = np.arange(len(common))
        of = self.row[numbers]
        self.dense = np.zeros((self.n_blocks, len(common), BLOCK), np.float32)
        self.dense[examples[of >= 0] // BLOCK, of[of >= 0], examples[of >= 0] % BLOCK] = weights[of >= 0]
        self.dense_max = np.ascontiguousarray(self.dense.max(axis=2, initial=0).T)
        self.post_example, self.post_weight = examples[of < 0].astype(np.int32), weights[of < 0]
        self.term_start = np.searchsorted(numbers[of < 0], np.arange(len(self.terms) + 1)).astype(np.int32)

    def _by_seeds(self, starts: np.ndarray, numbers: np.ndarray, weights: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Examples by their nearest seed; seeds are those of smallest key, a hash."""
        best, of = np.full(self.size, -1.0), np.zeros(self.size, np.int64)
        for s, i in enumerate(np.argsort(keys, kind="stable")[:SEEDS]):
            part = slice(starts[i], starts[i + 1])
            near = self.scores(numbers[part], weights[part])
            of, best = np.where(near > best, s, of), np.maximum(near, best)
        return np.lexsort((keys, -best, of))

    def _rare(self, numbers: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(what rare terms add to each example's cosine by block, rows and weights of common terms)."""
        rows = self.row[numbers]
        rare = rows < 0
        a, b = self.term_start[numbers[rare]], self.term_start[numbers[rare] + 1]
        post = _ranges(a, b)
        scores = np.bincount(self.post_example[post], self.post_weight[post] * np.repeat(weights[rare], b - a), minlength=self.n_blocks * BLOCK)
        # of no rows bincount makes whole numbers
        return scores.astype(np.float64, copy=False).reshape(-1, BLOCK), rows[~rare], weights[~rare].astype(np.float32)

    def scores(self, numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Cosines of all examples."""
        scores, rows, of_row = self._rare(numbers, weights)
        return (scores + of_row @ self.dense[:, rows]).reshape(-1)[: self.size]

    def nearest(self, numbers: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> list[tuple[float, int]]:
        """Exact (cosine, example number) of the k nearest of positive cosine; ties to the smaller id."""
        scores, rows, of_row = self._rare(numbers, weights)
        bounds = scores.max(axis=1) + (of_row @ self.dense_max[rows] if len(rows) else 0)
        order = np.argsort(-bounds)
        found_scores = found_at = None
        worst = 0.0
        # a few blocks of highest bound give a k-th best that most others can't reach
        for now in (order[:FIRST], order[FIRST:]):
            now = now[(bounds[now] > 0) & (bounds[now] >= worst - _SLACK)]
            if not len(now):
                break
            self.visited += len(now)
            here = scores[now] + of_row @ self.dense[now[:, None], rows] if len(rows) else scores[now]
            block, at = np.nonzero(here > max(0.0, worst - _SLACK))
            examples, cosines = now[block] * BLOCK + at, here[block, at]
            if skip >= 0:
                examples, cosines = examples[examples != skip], cosines[examples != skip]
            if found_at is None:
                found_scores, found_at = cosines, examples
            else:
                found_scores, found_at = np.concatenate((found_scores, cosines)), np.concatenate((found_at, examples))
            if len(found_at) > k:
                hit = np.flatnonzero(found_scores >= -np.partition(-found_scores, k - 1)[k - 1])
                found_scores, found_at = found_scores[hit], found_at[hit]
            top = np.lexsort((self.ids[found_at], -found_scores))[:k]
            found_scores, found_at = found_scores[top], found_at[top]
            worst = found_scores[-1] if len(found_scores) == k else 0.0
        return [] if found_at is None else [(min(1.0, s), i) for s, i in zip(found_scores.tolist(), found_at.tolist(), strict=True)]

    #: Blocks scored so far, for tests and tuning.
    visited = 0

    def vote(self, near: list[tuple[float, int]]) -> float:
        labels = self.labels[[i for _, i in near]]
        weights = np.array([1 / (1 + NEAREST - s) for s, _ in near]) * np.where(labels == 1, 1.0, self.clean_weight)
        return float((weights @ labels + self.base_rate) / (weights.sum() + 1))


@dataclass
class Model:
    """An index and what turns its votes into scores."""

    index: Index
    steps: tuple[np.ndarray, np.ndarray] = (np.empty(0), np.empty(0))
    zero_score: float = 0.0
    shared: object = None
    #: The documents that the model was fitted on: (doc_id, held_out, numbers, counts) of their terms.
    documents: DataFrame | None = None

    def share(self, spark: SparkSession):
        """The index as a broadcast, made once."""
        if self.shared is None:
            self.shared = spark.sparkContext.broadcast(self.index)
        return self.shared

    def on_executors(self, spark: SparkSession) -> Callable[[], Model]:
        """What gives a worker this model; only the broadcast's name and the steps are shipped."""
        shared, steps, zero = self.share(spark), self.steps, self.zero_score  # and not the documents
        return lambda: Model(shared.value, steps, zero)

    def score(self, text: str | None) -> tuple[float, list[tuple[float, int]]]:
        return self.judge(self.index.vector(text))

    def judge(self, vector: tuple[np.ndarray, np.ndarray] | None) -> tuple[float, list[tuple[float, int]]]:
        """(score, nearest examples) of a text's vector."""
        near = self.index.nearest(*vector, NEIGHBOURS) if vector else []
        if not near:
            return self.zero_score, near
        edges, values = self.steps
        vote = self.index.vote(near)
        return (float(values[max(0, np.searchsorted(edges, vote, side="right") - 1)]) if len(edges) else vote), near


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Steps (left edges, values) of a monotone fit whose pools are shrunk by half a vote each way.

    Neighbouring pools are joined as long as their shrunk values fall, so the values grow."""
    weight = np.ones(len(x)) if weight is None else weight
    pools: list[list[float]] = []
    value = lambda p: (p[1] + 0.5) / (p[2] + 1)
    order = np.argsort(x, kind="stable")
    for a, b, w in zip(x[order], y[order], weight[order], strict=True):
        if pools and pools[-1][0] == a:
            pools[-1][1] += b * w
            pools[-1][2] += w
        else:
            pools.append([a, b * w, w])
        while len(pools) > 1 and value(pools[-2]) >= value(pools[-1]):
            last = pools.pop()
            pools[-1][1] += last[1]
            pools[-1][2] += last[2]
    return np.array([p[0] for p in pools]), np.array([value(p) for p in pools])


def is_held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _examples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, float]:
    """((key, id, toxic, text) of the sample, one row of each distinct text, weight of a clean one);
    key is a hash of the text."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col)))
    usable = known.select(F.col(id_col).alias("id"), (F.col("toxic") == 1).cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    of = lambda label, most: usable.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(most)
    chosen = cut(of(1, MAX_TOXIC).unionByName(of(0, MAX_CLEAN)), "chosen")  # bounded
    mine = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    one_each = mine.groupBy("text").agg(F.min("id").cast("long").alias("id"), F.max("toxic").alias("toxic"))
    scale = [max(1.0, n.get(label, 0) / most) for label, most in ((0, MAX_CLEAN), (1, MAX_TOXIC))]
    return cut(one_each.select(F.xxhash64("text").alias("key"), "id", "toxic", "text"), "examples"), scale[0] / scale[1]


def _vocabulary(examples: DataFrame) -> pa.Table:
    """(term, n, n_toxic) of every term of the examples, by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, toxic = Counter(), Counter()
        for batch in batches:
            for label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = terms_of(text).keys()
                n.update(found)
                if label:
                    toxic.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([toxic[t] for t in n], pa.int64())], names=["term", "n", "n_toxic"])

    counted = examples.select("toxic", "text").mapInArrow(run, "term string, n bigint, n_toxic bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")).orderBy("term").toArrow()


def _numbered(docs: DataFrame, shared, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, held_out, numbers, counts) of every row, by the broadcast vocabulary: texts are read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(shared.value)
        for batch in batches:
            found = [known.counted(text.as_py()) for text in batch.column(2)]
            ends = np.cumsum([0, *(len(numbers) for numbers, _ in found)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, np.concatenate([f[i] for f in found] or [np.empty(0)]).astype(np.int32)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["doc_id", "held_out", "numbers", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col))
    return cut(rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, numbers array<int>, counts array<int>"), "document-terms")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    examples, clean_weight = _examples(docs, labels, id_col, text_col)
    totals = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, n_toxic = sum(totals.values()), totals.get(1, 0)
    if not n:
        return Model(Index())
    words = _vocabulary(examples)
    index = Index(terms={t: i for i, t in enumerate(words["term"].to_pylist())}, base_rate=n_toxic / (n_toxic + clean_weight * (n - n_toxic)), clean_weight=clean_weight)
    vocabulary = spark.sparkContext.broadcast(index.packed())
    documents = _numbered(docs, vocabulary, id_col, text_col)
    n_docs, df = documents.count(), np.zeros(len(index.terms), np.int64)
    held = documents.select(F.explode("numbers").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n")).toArrow()
    df[held["k"].to_numpy()] = held["n"].to_numpy()
    index.n, index.n_toxic = words["n"].to_numpy().astype(np.int32), words["n_toxic"].to_numpy().astype(np.int32)
    index.idf = np.log((1 + n_docs) / (1 + df)) + 1
    index.weighing = index.relevance(np.arange(len(index.terms)), None)
    weights = (index.idf * index.weighing).astype(np.float32)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(vocabulary.value)
        for batch in batches:
            rows = [(k, i, y, *v) for k, i, y, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) if len((v := known.counted(text))[0])]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["key", "id", "toxic", "numbers", "counts"])

    found = examples.mapInArrow(counted, "key bigint, id bigint, toxic int, numbers array<int>, counts array<int>").toArrow().combine_chunks()
    vocabulary.destroy()
    found = found.take(np.lexsort((found["key"].to_numpy(), found["id"].to_numpy()))).combine_chunks()
    seen = int(found["toxic"].to_numpy().sum())
    zeros = n_toxic - seen, clean_weight * (n - len(found) - n_toxic + seen)
    model = Model(index, zero_score=(zeros[0] + index.base_rate) / (zeros[0] + zeros[1] + 1), documents=documents)
    if not len(found):
        return model
    starts = np.r_[0, np.cumsum(found["numbers"].combine_chunks().value_lengths().to_numpy())]
    numbers, counts = (found[c].combine_chunks().flatten().to_numpy() for c in ("numbers", "counts"))
    values = (1 + np.log(counts)) * weights[numbers]
    values /= np.repeat(np.sqrt(np.add.reduceat(values * values, starts[:-1])), np.diff(starts))
    index.fill(found["id"].to_numpy(), found["key"].to_numpy(), found["toxic"].to_numpy().astype(float), starts, numbers, values)
    del found, numbers, counts, values
    shared = model.share(spark)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = shared.value
        place = {int(k): i for i, k in enumerate(whole.keys)}
        for batch in batches:
            rows = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                label = whole.labels[place[key]] if key in place else None
                if label is not None and (vector := whole.vector(text, left_out=int(label))):
                    near = whole.nearest(*vector, NEIGHBOURS, skip=place[key])
                    rows.append((whole.vote(near) if near else whole.base_rate, label))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.float64()) for i in (0, 1)], names=["vote", "label"])

    # a few examples are much work: deal them to all cores
    votes = examples.select("key", "text").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key").mapInArrow(left_out, "vote double, label double").toArrow()
    labels_left = votes["label"].to_numpy()
    model.steps = isotonic(votes["vote"].to_numpy(), labels_left, np.where(labels_left == 1, 1.0, clean_weight))
    return model


_SCORED = "held_out boolean, score double, predicted int, evidence array<struct<example:bigint,cosine:double,toxic:int>>"


def _scored(ids: pa.Array, held_out: pa.Array, results: list[tuple[float, list[tuple[float, int]]]], index: Index) -> pa.RecordBatch:
    shown = [pair for _, near in results for pair in near[:EVIDENCE]]
    at = np.array([i for _, i in shown], np.int64)
    parts = pa.StructArray.from_arrays([pa.array(index.ids[at]), pa.array([c for c, _ in shown], pa.float64()), pa.array(index.labels[at].astype(np.int32))], names=["example", "cosine", "toxic"])
    evidence = pa.ListArray.from_arrays(np.cumsum([0, *(min(EVIDENCE, len(near)) for _, near in results)]).astype(np.int32), parts)
    scores = [s for s, _ in results]
    return pa.RecordBatch.from_arrays([ids, held_out, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), evidence], names=["doc_id", "held_out", "score", "predicted", "evidence"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, evidence (nearest examples)."""
    given = model.on_executors(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = given()
        for batch in batches:
            yield _scored(batch.column(0), batch.column(1), [model.score(t.as_py()) for t in batch.column(2)], model.index)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, {_SCORED}")


def score_fitted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same for the table that the model was fitted on, whose texts need no second reading."""
    if model.documents is None:
        return score(docs, model, id_col, text_col)
    given = model.on_executors(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = given()
        for batch in batches:
            numbers, counts = batch.column(2), batch.column(3)
            ends = numbers.offsets.to_numpy()
            flat, n = numbers.values.to_numpy().astype(np.int64), counts.values.to_numpy()
            results = [model.judge(model.index.weigh(flat[a:b], n[a:b])) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield _scored(batch.column(0), batch.column(1), results, model.index)

    kind = model.documents.schema["doc_id"].dataType.simpleString()
    return model.documents.mapInArrow(run, f"doc_id {kind}, {_SCORED}")


def remove_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay."""
    given = model.on_executors(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = given()
        for batch in batches:
            yield batch.filter(pa.array([model.score(t.as_py())[0] < 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_fitted(docs, fit(docs, table(spark, sf_dir, "labels")))
