"""Toxicity scores by a factorization machine over hashed terms.

Terms of a text are its distinct lower-cased words and the beginnings of words, hashed. The
machine gives every term a weight and a short vector: a text's margin is the bias, the sum of
its terms' weights and the dot products of all pairs of their vectors, so an insult next to a
group's name can weigh more than the two apart. The pair sum is half of (square of the sum less
sum of squares), linear in the number of terms.

Labels are learnt only from rows outside the fold that `held_out` marks. The model is fitted
on at most `sample_rows` labelled documents, those with the smallest hash of their id: that
bound is what the driver gathers, as term numbers, not texts. Terms that go along with the
label no better than chance (chi square below `least_association`, or fewer than
`least_documents` fitted documents) have no weight: a long text holds thousands of words, whose
noise would outweigh one insult. Scoring runs over whole texts in one pass without a shuffle; the
model sent to the executors holds at most 2**BITS terms.

Defined results: a null or empty text has no terms, its score is the bias alone; ids may be null
(never held out, never learnt from) or repeated, every input row gives one output row;
`labels` rows with nulls are left out, of several labels for one id the largest counts, of several
texts of one id the one with the smallest hash is fitted; without two classes of labels every
score is the share of toxic labels, drawn towards a quarter; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import slices

BITS = 20
SAMPLE_ROWS = 12_000
FACTORS = 4
FOLDS = 5
LEAST_DOCUMENTS = 3
#: Chi square with one degree of freedom that chance exceeds once in a thousand.
LEAST_ASSOCIATION = 10.83
BEGINNINGS = (3, 4, 5, 6)
CACHED_WORDS = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def terms_of(word: str) -> list[int]:
    """Hashed terms of a word: itself and its beginnings."""
    own = [f"w {word}", *(f"{n} {word[:n]}" for n in BEGINNINGS if len(word) > n)]
    return [xxhash.xxh64_intdigest(t) >> (64 - BITS) for t in own]


def all_terms(text: str) -> set[int]:
    return {t for w in words_of(text) for t in terms_of(w)}


@dataclass(frozen=True)
class Machine:
    """Bias, and the weight and vector of each kept term; `terms` is sorted."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def margin(self, places: np.ndarray) -> float:
        """The margin of a text whose kept terms stand at these places of `terms`."""
        v = self.vectors[places]
        total = v.sum(axis=0)
        return float(self.bias + self.weights[places].sum() + 0.5 * (total @ total - (v * v).sum()))


class Scorer:
    """Scores texts; the kept terms of the words seen are kept up to a bound."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.place = {int(t): i for i, t in enumerate(machine.terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def places(self, text: str) -> np.ndarray:
        found: set[int] = set()
        known = self.known
        for w in words_of(text):
            own = known.get(w)
            if own is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                own = tuple(self.place[t] for t in terms_of(w) if t in self.place)
                if len(w) <= 64:  # so that a bound on words is one on bytes
                    known[w] = own
            found.update(own)
        return np.array(sorted(found), dtype=np.int64)

    def score(self, text: str) -> tuple[float, int]:
        """Probability of the toxic label, and the number of kept terms."""
        places = self.places(text)
        margin = self.machine.margin(places)
        return (1 / (1 + np.exp(-margin)) if margin > -500 else 0.0), len(places)


def associated(features: list[np.ndarray], toxic: np.ndarray, least_documents: int, least_association: float) -> np.ndarray:
    """Sorted numbers of the terms that go along with the label, or with its absence."""
    size, n, positive = 1 << BITS, len(features), toxic.sum()
    found = np.bincount(np.concatenate(features), minlength=size).astype(float)
    marked = np.bincount(np.concatenate([np.empty(0, np.int64), *(f for f, t in zip(features, toxic, strict=True) if t)]).astype(np.int64),
                         minlength=size)
    expected = found * positive / n
    spread = expected * (1 - positive / n) * (1 - found / n)
    chi = np.divide((marked - expected) ** 2, spread, out=np.zeros(size), where=spread > 0)
    return np.flatnonzero((found >= least_documents) & (chi >= least_association))


def fit(features: list[np.ndarray], toxic: np.ndarray, factors: int = FACTORS, epochs: int = 20, batch: int = 64, rate: float = 0.1,
        decay: float = 1e-4, vector_decay: float = 1e-3, least_documents: int = LEAST_DOCUMENTS,
        least_association: float = LEAST_ASSOCIATION, seed: int = 7) -> Machine:
    """Weights and vectors of least logistic loss with squared penalties, by AdaGrad over small batches."""
    n, positive = len(features), float(toxic.sum())
    share = (positive + 0.5) / (n + 2)
    bias = float(np.log(share / (1 - share)))
    none = Machine(bias, np.empty(0, np.int64), np.empty(0), np.empty((0, factors)))
    if not 0 < positive < n or not sum(map(len, features)):
        return none
    terms = associated(features, toxic, least_documents, least_association)
    rows = [np.searchsorted(terms, f[np.isin(f, terms)]) for f in features]
    random = np.random.default_rng(seed)
    w, v = np.zeros(len(terms)), random.normal(0, 0.02, (len(terms), factors))
    steep_w, steep_v, steep_b = np.full(len(terms), 1e-6), np.full((len(terms), factors), 1e-6), 1e-6
    y = toxic.astype(float)
    for _ in range(epochs):
        order = random.permutation(n)
        for at in range(0, n, batch):
            chosen = order[at:at + batch]
            counts = np.array([len(rows[i]) for i in chosen])
            flat, own = np.concatenate([rows[i] for i in chosen]), np.repeat(np.arange(len(chosen)), counts)
            vectors = v[flat]
            total = np.stack([np.bincount(own, vectors[:, j], len(chosen)) for j in range(factors)], axis=1)
            squares = np.bincount(own, (vectors * vectors).sum(axis=1), len(chosen))
            margin = bias + np.bincount(own, w[flat], len(chosen)) + 0.5 * ((total * total).sum(axis=1) - squares)
            slope = (1 / (1 + np.exp(-margin.clip(-30, 30))) - y[chosen]) / len(chosen)
            bias_slope = slope.sum()
            steep_b += bias_slope**2
            bias -= rate * bias_slope / np.sqrt(steep_b)
            if not len(flat):
                continue
            used, where = np.unique(flat, return_inverse=True)
            by_w = np.bincount(where, slope[own], len(used)) + decay * w[used]
            each = slope[own][:, None] * (total[own] - vectors)
            by_v = np.stack([np.bincount(where, each[:, j], len(used)) for j in range(factors)], axis=1) + vector_decay * v[used]
            steep_w[used] += by_w**2
            steep_v[used] += by_v**2
            w[used] -= rate * by_w / np.sqrt(steep_w[used])
            v[used] -= 0.3 * rate * by_v / np.sqrt(steep_v[used])
    return Machine(float(bias), terms, w, v)


def learnt_rows(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, sample_rows: int) -> DataFrame:
    """Terms and labels of the documents to fit: doc_id, toxic, terms; none of the held-out fold."""
    label_id, toxic = F.col("doc_id").cast("long"), F.col("toxic").cast("int")
    marked = labels.filter(label_id.isNotNull() & toxic.isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        label_id.alias("doc_id")).agg(F.max(toxic).alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # at most sample_rows rows of two numbers
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).join(
        F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min(F.struct(F.xxhash64(text).alias("hash"), text.alias("text"))).alias("first")).select("doc_id", "first.text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [np.fromiter(s := all_terms(t), np.int32, len(s)) for t in b.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            terms = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), terms], ["doc_id", "toxic", "terms"])

    return texts.mapInArrow(run, "doc_id long, toxic int, terms array<int>")


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          sample_rows: int = SAMPLE_ROWS, **settings) -> Machine:
    """The fitted machine; gathers at most `sample_rows` rows, as Arrow columns."""
    found = learnt_rows(docs, labels, id_column, text_column, sample_rows).toArrow().combine_chunks().sort_by("doc_id")
    if not found.num_rows:
        return fit([], np.empty(0, np.int32), **settings)
    terms = pa.concat_arrays(found.column("terms").chunks)
    flat, offsets = terms.flatten().to_numpy(), terms.offsets.to_numpy()
    offsets = offsets - offsets[0]
    features = [np.sort(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return fit(features, (found.column("toxic").to_numpy() == 1).astype(np.int32), **settings)


def score_documents(docs: DataFrame, machine: Machine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_terms (kept terms in the text)."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(sent.value)
        for b in slices(batches):
            found = [own.score(t or "") for t in b.column(2).to_pylist()]
            scores = pa.array([s for s, _ in found], pa.float64())
            predicted = pa.array([int(s >= 0.5) for s, _ in found], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), scores, predicted, pa.array([n for _, n in found], pa.int64())],
                                             ["doc_id", "held_out", "score", "predicted", "n_terms"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(F.col(id_column)).alias("held_out"),
                       F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_terms long")
