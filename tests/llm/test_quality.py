"""The ordinal model on held-out documents, its slopes, and awkward rows."""

import random

import numpy as np
import pytest

from fieldmart.llm import quality


@pytest.fixture(scope="module")
def graded(spark):
    rnd = random.Random(2)
    vocabulary = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        grade = i % 3
        words = rnd.choices(vocabulary, k=rnd.randint(30, 200))
        if grade == 0:
            for w in rnd.sample(["nasty", "vile", "foul"], 2):
                words.insert(rnd.randrange(len(words)), w)
        if grade == 1:
            words = [w + rnd.choice(["***", "%%%", "$$$"]) for w in words]
        rows.append((i, " ".join(words), "x"))
        if i < 600:
            labels.append((i, 0 if grade == 1 else 1, 1 if grade == 0 else 0))
    labels += [(None, 1, 0), (0, 1, 0), (1, None, 1), (5000, 0, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, kept string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(graded):
    docs, labels = graded
    model = quality.train(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    found = {r.doc_id: r for r in quality.grade_documents(docs, model).collect()}
    held_out = [found[i] for i in range(600, 900)]
    right = [r.kept == (r.doc_id % 3 == 2) for r in held_out]
    assert np.mean(right) > 0.95
    means = [np.mean([r.expected_grade for r in held_out if r.doc_id % 3 == g]) for g in range(3)]
    assert means[2] == max(means) and all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in held_out)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in found.items() if r.kept)


def test_sample_bound(graded):
    docs, labels = graded
    assert quality.sample(docs, labels, "doc_id", "text", 50).count() <= 50


def test_awkward(awkward, nothing, graded):
    model = quality.train(*graded)
    assert quality.grade_documents(awkward, model).count() == awkward.count()
    assert quality.keep_good(awkward, model).columns == awkward.columns
    assert quality.grade_documents(nothing, model).count() == quality.keep_good(nothing, model).count() == 0
    none = quality.train(graded[0], graded[1].limit(0))
    assert none is None and quality.keep_good(awkward, none).count() == awkward.count()
    assert all(r.kept and r.expected_grade is None for r in quality.grade_documents(awkward, none).collect())


def test_fit_prefers_true_thresholds():
    rng = np.random.default_rng(0)
    features = [np.unique(rng.integers(0, 30, 8)) for _ in range(3000)]
    weights = rng.normal(size=30)
    score = np.array([weights[f].sum() for f in features])
    grades = (score[:, None] + rng.logistic(size=(3000, 1)) > np.array([-1.0, 1.5])).sum(axis=1)
    model = quality.fit(features, grades, rounds=400)
    fitted = np.array([model.weights[f].sum() for f in features])
    assert np.corrcoef(fitted, score)[0, 1] > 0.97 and 1.5 < np.diff(model.thresholds)[0] < 3.2


def test_capitals_are_counted_over_the_whole_text():
    def upper(text):
        return quality.shape_features(text, text.lower().split(), 1)[-1]

    assert upper("A cat sat down") == "#upper 1" and upper("aBBBBBBbBBBBBB") == "#upper 10"


def test_the_least_number_of_documents_is_a_parameter():
    features = [np.array([1, 2]) for _ in range(40)] + [np.array([1, 2, 3]) for _ in range(3)] + [np.array([1, 4]) for _ in range(5)]
    grades = np.array([1] * 40 + [0] * 8)
    assert quality.fit(features, grades).weights[3] == 0 and quality.fit(features, grades, least_documents=3).weights[3] < -0.1
    assert quality.fit(features, grades, least_documents=4).weights[3] == 0


def test_sample_bound_holds_for_repeated_ids(spark, graded):
    docs, labels = graded
    repeated = docs.unionByName(docs.withColumn("doc_id", docs.doc_id % 3))
    found = quality.sample(repeated, labels, "doc_id", "text", 50).collect()
    assert len(found) == 50 == len({r.doc_id for r in found})
    assert len(quality.sample(repeated, labels, "doc_id", "text", 12_000).collect()) == 600
