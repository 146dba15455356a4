"""Quality grades by ordinal cumulative-link regression on hashed text.

Labelled documents have a grade: 0 for toxic, 1 for poor, 2 for good text. One weight per
hashed feature is shared by all grades; ordered thresholds cut the score:
P(grade <= k) = logistic(threshold_k - score). The score gives the expected grade and the
tail probability P(grade >= best), by which documents are kept.

The model is fitted on at most `sample_rows` labelled documents, those with the smallest
hash of their id; that bound is what the driver gathers, as feature numbers in Arrow columns, not texts.
A feature that goes along with the grade no better than chance (chi square for every cut between grades below
`least_association`), or of fewer than `least_documents` fitted documents, has no weight: long texts
hold thousands of words, whose noise would outweigh a few telling ones. The penalty of the weights and the
probability from which documents are kept are results of the fit: on folds of the sample, the
penalty of the largest held-out likelihood and the cut with the fewest held-out errors. Everything
else runs over all rows: whole texts are scored in one pass without a shuffle, with a weight table
of fixed size sent to the executors.

Defined results: a null or empty text has only the feature of its length class; ids may be
null or repeated, every input row gives one output row; rows of `labels` with nulls are
left out, of several labels for one id the lowest grade counts,
of several texts of one id the one with the smallest hash is fitted; where fewer than two grades
are labelled nothing can be learnt: grade and probability are null and all rows are kept.
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

from fieldmart.llm.common import slices, text_rows

BITS = 21
SAMPLE_ROWS = 12_000
LEAST_DOCUMENTS = 10
#: For `train`, where the association is asked for as well.
LEAST_SAMPLED = 3
#: Chi square with one degree of freedom that chance exceeds once in a thousand.
LEAST_ASSOCIATION = 10.83
#: Penalties tried on folds of the sample, and the number of folds.
DECAYS, FOLDS = (1.5e-4, 1e-3), 3
#: Fewer fitted documents than this aren't split into folds.
LEAST_FOLDED = 30
BEGINNINGS = (4, 5)
CACHED_WORDS = 200_000

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_SPACES = re.compile(r"\s+")


def grade(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, 0).when(quality == 0, 1).otherwise(2)


def _bucket(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) >> (64 - BITS)


def shape_features(text: str, tokens: list[str], distinct: int) -> list[str]:
    """Classes of a text's length, repetition, symbols, word length and line length."""
    n = len(tokens)
    if not n:
        return ["#empty"]
    size = len(text)
    symbols = sum(len(t) for t in tokens if not t[0].isalnum())
    lines = text.count("\n") + 1
    rate = 10 * distinct // n
    return [f"#length {n.bit_length()}", f"#distinct {rate}", f"#distinct {rate} length {n.bit_length()}",
            f"#symbols {min(20, 50 * symbols // size)}", f"#mean {min(20, (size - symbols) // n)}",
            f"#lines {min(12, (n // lines).bit_length())}", f"#upper {min(10, 20 * sum(map(str.isupper, text)) // size)}"]


class Features:
    """Feature numbers of texts: one per distinct lower-cased word or run of symbols and per beginning of a word, and the classes of the shape."""

    def __init__(self):
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str) -> np.ndarray:
        tokens = _TOKEN.findall(text.lower())
        distinct = set(tokens)
        known = self.known
        out: set[int] = set()
        for t in distinct:
            numbers = known.get(t)
            if numbers is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                numbers = (_bucket(t), *(_bucket(f"{n} {t[:n]}") for n in BEGINNINGS if len(t) > n and t[0].isalnum()))
                if len(t) <= 64:  # so that a bound on words is one on bytes
                    known[t] = numbers
            out.update(numbers)
        out.update(_bucket(f) for f in shape_features(text, tokens, len(distinct)))
        return np.fromiter(out, np.int32, len(out))


@dataclass(frozen=True)
class Model:
    """Weights by feature number, the ordered thresholds, and the tail probability from which documents are kept."""

    weights: np.ndarray
    thresholds: np.ndarray
    keep_from: float = 0.5
    decay: float = 1.5e-4

    def judge(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grades and tail probabilities of the best grade."""
        above = 1 / (1 + np.exp((self.thresholds[None, :] - scores[:, None]).clip(-500, 500)))
        return above.sum(axis=1), above[:, -1]


def associated(features: list[np.ndarray], grades: np.ndarray, least_association: float) -> np.ndarray:
    """Whether each feature goes along with a grade above some cut: the chi square reaches the bound."""
    size, n = 1 << BITS, len(features)
    flat, counts = np.concatenate(features), [len(f) for f in features]
    found, out = np.bincount(flat, minlength=size), np.zeros(size, bool)
    for cut in range(int(grades.max())):
        above = (grades > cut).astype(float)
        moved = np.bincount(flat, np.repeat(above - above.mean(), counts), minlength=size)
        spread = above.var() * found * (1 - found / n)
        out |= np.divide(moved**2, spread, out=np.zeros(size), where=spread > 0) >= least_association
    return out


def scores_of(model: Model, features: list[np.ndarray]) -> np.ndarray:
    return np.array([model.weights[f].sum(dtype=np.float64) for f in features])


def best_cut(tails: np.ndarray, good: np.ndarray) -> float:
    """The cut between two tail probabilities that errs least; of equal ones the nearest to a half."""
    order = np.argsort(tails)
    tails, good = tails[order], good[order].astype(int)
    cuts = np.concatenate([[0.0], (tails[1:] + tails[:-1]) / 2, [1.0]])
    errors = np.concatenate([[0], np.cumsum(good)]) + np.concatenate([np.cumsum((1 - good)[::-1])[::-1], [0]])
    least = cuts[errors == errors.min()]
    return float(least[np.argmin(np.abs(least - 0.5))])


def fit_on_folds(features: list[np.ndarray], grades: np.ndarray, decays: tuple[float, ...] = DECAYS, folds: int = FOLDS, **settings) -> Model:
    """The fit with the penalty and the cut that do best on held-out folds."""
    top, fold = int(grades.max()), np.random.default_rng(0).permutation(len(features)) % folds
    if len(features) < LEAST_FOLDED or any(len(np.unique(grades[fold != k])) <= top for k in range(folds)):
        return fit(features, grades, decay=decays[0], **settings)
    found = []
    for decay in decays:
        tails, likely = np.zeros(len(features)), 0.0
        for k in range(folds):
            inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            model = fit([features[i] for i in inside], grades[inside], decay=decay, **settings)
            scores = scores_of(model, [features[i] for i in outside])
            above = 1 / (1 + np.exp((model.thresholds[None, :] - scores[:, None]).clip(-30, 30)))
            each = -np.diff(np.hstack([np.ones((len(outside), 1)), above, np.zeros((len(outside), 1))]), axis=1)
            likely += np.log(each[np.arange(len(outside)), grades[outside]].clip(1e-9)).sum()
            tails[outside] = above[:, -1]
        found.append((likely, decay, best_cut(tails, grades == top)))
    _, decay, cut = max(found)
    model = fit(features, grades, decay=decay, **settings)
    return Model(model.weights, model.thresholds, cut, decay)


def fit(features: list[np.ndarray], grades: np.ndarray, rounds: int = 200, decay: float = 1.5e-4, rate: float = 0.08,
        least_documents: int = LEAST_DOCUMENTS, least_association: float = 0.0) -> Model:
    """Most likely weights and thresholds with a squared penalty, by Adam over all rows at once."""
    if least_association:
        telling = associated(features, grades, least_association)
        features = [f[telling[f]] for f in features]
    flat, where = np.unique(np.concatenate(features), return_inverse=True)
    counts = np.array([len(f) for f in features])
    rows = np.repeat(np.arange(len(features)), counts)
    top = int(grades.max())
    # a feature of a few documents can't be told from noise; 1 gives every feature a weight
    common = np.bincount(where, minlength=len(flat)) >= least_documents
    free = np.concatenate([np.zeros(len(flat)), [np.log(3.0)] * top])
    share = np.array([(grades > k).mean() for k in range(top)]).clip(1e-3, 1 - 1e-3)
    free[len(flat)] = -np.log(share[0] / (1 - share[0]))
    first, second = np.zeros_like(free), np.zeros_like(free)
    n, eps = len(features), 1e-9
    for step in range(1, rounds + 1):
        w = free[:len(flat)]
        cuts = free[len(flat)] + np.concatenate([[0.0], np.cumsum(np.exp(free[len(flat) + 1:]))])
        score = np.bincount(rows, w[where], len(features))
        below = 1 / (1 + np.exp((score[:, None] - cuts[None, :]).clip(-50, 50)))
        slope = below * (1 - below)
        padded = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        steep = np.hstack([np.zeros((n, 1)), slope, np.zeros((n, 1))])
        at = np.arange(n)
        likely = (padded[at, grades + 1] - padded[at, grades]).clip(eps)
        # slopes of the mean negative log likelihood
        by_score = (steep[at, grades + 1] - steep[at, grades]) / likely / n
        by_cut = np.zeros(top)
        np.add.at(by_cut, grades[grades < top], -(steep[at, grades + 1] / likely)[grades < top] / n)
        np.add.at(by_cut, grades[grades > 0] - 1, (steep[at, grades] / likely)[grades > 0] / n)
        tail = np.cumsum(by_cut[::-1])[::-1]
        slopes = np.concatenate([(np.bincount(where, by_score[rows], len(flat)) + decay * w) * common,
                                 [tail[0]], tail[1:] * np.exp(free[len(flat) + 1:])])
        first = 0.9 * first + 0.1 * slopes
        second = 0.99 * second + 0.01 * slopes**2
        slower = rate * (1 - (step - 1) / rounds)
        free = free - slower * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[flat] = free[:len(flat)]
    return Model(weights, free[len(flat)] + np.concatenate([[0.0], np.cumsum(np.exp(free[len(flat) + 1:]))]))


def sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, sample_rows: int) -> DataFrame:
    """Feature numbers and grades of the labelled documents with the smallest id hashes."""
    graded = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade(F.col("quality"), F.col("toxic"))).alias("grade"))
    chosen = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # at most sample_rows rows of two numbers
    text = F.col("text")
    marked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).join(
        F.broadcast(chosen), "doc_id").groupBy("doc_id", "grade").agg(F.min(F.struct(F.xxhash64(text), text)).alias("first")).select(
        "doc_id", "first.text", "grade")  # one row of an id, by the hash of its text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Features()
        for b in slices(batches):
            found = [own.of(t or "") for t in b.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), lists], ["doc_id", "grade", "features"])

    return marked.mapInArrow(run, "doc_id long, grade int, features array<int>")


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          sample_rows: int = SAMPLE_ROWS, least_documents: int = LEAST_SAMPLED, least_association: float = LEAST_ASSOCIATION) -> Model | None:
    """The fitted model, or None where fewer than two grades are labelled."""
    rows = sample(docs, labels, id_column, text_column, sample_rows).toArrow().sort_by("doc_id")
    found, grades = np.unique(rows.column("grade").to_numpy(), return_inverse=True)
    if len(found) < 2:
        return None
    lists = rows.column("features").combine_chunks()
    flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    features = [np.sort(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return fit_on_folds(features, grades, least_documents=least_documents, least_association=least_association)


def grade_documents(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text",
                    keep_from: float | None = None) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail_probability, kept."""
    if model is None:
        return docs.select(F.col(id_column).alias("doc_id"), F.lit(None).cast("double").alias("expected_grade"),
                           F.lit(None).cast("double").alias("tail_probability"), F.lit(True).alias("kept"))
    cut = model.keep_from if keep_from is None else keep_from
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights of 4 bytes, whatever the data

    def build(pairs):
        own, fitted = Features(), sent.value
        for ids, texts in pairs:
            scores = np.array([fitted.weights[own.of(t)].sum(dtype=np.float64) for t in texts])
            grades, tails = fitted.judge(scores)
            yield [ids.cast(pa.int64()), pa.array(grades), pa.array(tails), pa.array(tails >= cut)]

    return text_rows(docs, id_column, text_column, "doc_id long, expected_grade double, tail_probability double, kept boolean", build)


def keep_good(docs: DataFrame, model: Model | None, text_column: str = "text", keep_from: float | None = None) -> DataFrame:
    """The rows whose text is likely of the best grade, with all their columns."""
    if model is None:
        return docs
    cut = model.keep_from if keep_from is None else keep_from
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, fitted = Features(), sent.value
        for b in slices(batches):
            scores = np.array([fitted.weights[own.of(t or "")].sum(dtype=np.float64) for t in b.column(at).to_pylist()])
            yield b.filter(pa.array(fitted.judge(scores)[1] >= cut))

    return docs.mapInArrow(run, docs.schema)
