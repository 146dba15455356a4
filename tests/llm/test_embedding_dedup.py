"""Links of vectors against brute force: none too many, nearly all found."""

import numpy as np
import pytest

from fieldmart.llm import embedding_dedup


def brute(vectors):
    """(links, smallest index reachable) by cosine, for usable vectors."""
    v = np.array(vectors, np.float64)
    norm = np.sqrt((v**2).sum(axis=1))
    near = (v @ v.T) / np.outer(norm, norm) >= embedding_dedup.THRESHOLD
    np.fill_diagonal(near, False)
    name = np.arange(len(v))
    while True:
        lower = np.array([min(name[i], name[near[i]].min(initial=name[i])) for i in range(len(v))])
        if (lower == name).all():
            return near.sum(axis=1), name
        name = lower


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 48))
    near = np.repeat(centres, 12, axis=0) + rng.normal(size=(480, 48)) * rng.uniform(0.02, 0.45, (480, 1))
    copies = np.repeat(centres[:5], 30, axis=0)
    return np.concatenate([rng.normal(size=(400, 48)), near, copies, near[:20] * 3]).astype(np.float32)


@pytest.mark.parametrize("bucket_rows", [4096, 8])
def test_against_brute_force(spark, vectors, monkeypatch, bucket_rows):
    monkeypatch.setattr(embedding_dedup, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(embedding_dedup, "QUERY_ROWS", 16 if bucket_rows == 8 else 512)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors)]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int").repartition(4)).collect()
    got = {r.vec_id: r for r in found}
    links, names = brute(vectors)
    own = np.array([got[i].n_links for i in range(len(rows))])
    assert (own <= links).all() and own.sum() >= 0.97 * links.sum()
    assert np.mean([got[i].component_id == names[i] for i in range(len(rows))]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_unusable_vectors(spark):
    one = [1.0, 0.0, 2.0]
    rows = [(1, one), (2, one), (None, one), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 2.0]),
            (8, [1.0, float("nan"), 2.0]), (9, [float("inf"), 0.0, 0.0]), (10, [1.0, 0.0, 2.0, 0.0]), (2, one), (None, None)]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found), key=str)
    expected = [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (None, 3, 1, True)] + [(i, 0, i, True) for i in range(3, 11)] + [(None, 0, None, True)]
    assert len(got) == len(expected)
    assert [g for g in got if g[0] is not None] == sorted((e for e in expected if e[0] is not None), key=str)
    assert sorted(g[1:3] for g in got if g[0] is None and g[1]) == [(3, 1)]


def test_empty_table(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(embedding_dedup.hadamard(embedding_dedup.hadamard(x)), x)
