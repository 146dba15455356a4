"""Factorization machine: pairs that linear weights miss, the held-out fold, awkward rows, held-out accuracy."""

import zlib

import numpy as np
import pytest

from fieldmart.llm import toxicity
from tests.llm.test_queries import FOLDER, pytestmark  # noqa: F401


def out_of_fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def marked(spark):
    """Toxic where an insult and a group meet; either alone is clean, so no linear weights fit."""
    rows, labels, rng = [], [], np.random.default_rng(3)
    for i in range(1500):
        insult, group = i % 2 == 0, (i // 2) % 2 == 0
        words = [f"fill{''.join(chr(97 + c) for c in rng.integers(0, 26, 2))}" for _ in range(12)]
        words += ["zounds"] * insult + ["martians"] * group
        rows.append((i, " ".join(rng.permutation(words)), "x"))
        labels.append((i, 1, int(insult and group)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_pairs_are_learnt(marked):
    docs, labels = marked
    machine = toxicity.train(docs, labels)
    found = {r.doc_id: r for r in toxicity.score_documents(docs, machine).collect()}
    assert len(found) == 1500
    right = [r.predicted == int(i % 4 == 0) for i, r in found.items() if r.held_out]
    assert len(right) > 200 and np.mean(right) > 0.97
    assert all(r.held_out == out_of_fold(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in found.items())


def test_held_out_labels_have_no_influence(spark, marked):
    docs, labels = marked
    turned = labels.selectExpr("doc_id", "quality", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert a.bias == b.bias and (a.terms == b.terms).all() and (a.weights == b.weights).all() and (a.vectors == b.vectors).all()


def test_scores_equal_all_pairs(marked):
    docs, labels = marked
    machine = toxicity.train(docs, labels)
    scorer = toxicity.Scorer(machine)
    for row in docs.limit(40).collect():
        own = [int(np.searchsorted(machine.terms, t)) for t in sorted(toxicity.all_terms(row.text)) if t in scorer.place]
        margin = machine.bias + sum(machine.weights[i] for i in own) + sum(
            machine.vectors[i] @ machine.vectors[j] for k, i in enumerate(own) for j in own[:k])
        assert scorer.score(row.text)[0] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 1, 0), (None, 1, 1), (3, 1, None), (8, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    machine = toxicity.train(awkward, labels)
    found = toxicity.score_documents(awkward, machine).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 for r in found)
    assert {r.held_out for r in found if r.doc_id is None} == {False}
    assert len({r.score for r in found if r.doc_id in (3, 4, 5)}) == 1
    assert toxicity.score_documents(nothing, machine).count() == 0
    empty = toxicity.train(nothing, labels.limit(0))
    assert {(round(r.score, 9), r.predicted) for r in toxicity.score_documents(awkward, empty).collect()} == {(0.25, 0)}


def test_repeated_labels_take_the_largest(spark, awkward):
    labels = spark.createDataFrame([(7, 1, 1), (7, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    found = {(r.doc_id, r.toxic) for r in toxicity.learnt_rows(awkward, labels, "doc_id", "text", 10).collect()}
    assert found == {(i, t) for i, t in ((7, 1), (9, 0)) if not out_of_fold(i)}


def test_held_out_accuracy_of_driver_tables(spark):
    folder = FOLDER.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = [r for r in scored if r.toxic], [r for r in scored if not r.toxic]
    assert np.mean([r.predicted for r in toxic]) > 0.8 and np.mean([r.predicted for r in clean]) < 0.01
