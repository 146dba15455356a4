"""Targets, draws and permutations, and what the mix takes."""

import re

import numpy as np
import pytest

from fieldmart.llm import mixing


def test_targets():
    assert mixing.targets([100, 100, 100]) == pytest.approx([187.5, 75.0, 37.5])
    found = mixing.targets([10, 1000, 1000, 0])
    assert found == pytest.approx([30, 1320, 660, 0]) and sum(found) == pytest.approx(2010)
    for sizes in ([5], [0, 0], [], [1, 50, 3, 200, 7, 7, 1000]):
        found = mixing.targets(sizes)
        assert sum(found) == pytest.approx(sum(sizes)) and all(t <= 3 * s + 1e-9 for t, s in zip(found, sizes))


def test_permutations():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        for key in (0, 1, 1 << 40):
            assert sorted(mixing.permuted(np.arange(n), n, key).tolist()) == list(range(n))
    assert mixing.permuted(np.arange(50), 50, 1).tolist() != mixing.permuted(np.arange(50), 50, 2).tolist()


def test_shards_share_out_all_slots():
    slots, size = [700, 0, 1300, 55], 64
    shards = -(-sum(slots) // size)
    seen = np.zeros(4, np.int64)
    for k in range(shards):
        counts, before = mixing.shard_counts(slots, k, size)
        assert (before == seen).all() and counts.sum() == min(size, sum(slots) - k * size)
        seen += counts
    assert seen.tolist() == slots
    huge, _ = mixing.shard_counts([2 * 10**9, 10**9], 5)
    assert huge.sum() == mixing.SHARD_SLOTS and abs(huge[0] / huge.sum() - 2 / 3) < 0.05


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(f"{s}{i}_{j}" for j in range(20 + i * 7 % 300)), s, i) for i in range(600) for s in ["src1" if i % 3 else ["src0", "é", None][i % 9 // 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(3)


def test_taken_words_follow_targets(docs):
    found = mixing.mix(docs).collect()
    size = {r.doc_id: len(r.text.split()) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    order = ["src0", "src1", "é", None]
    sizes = [sum(size[d] for d in size if source[d] == s) for s in order]
    expected = dict(zip(order, zip(sizes, mixing.targets(sizes))))
    taken = dict.fromkeys(order, 0)
    for r in found:
        assert r["size"] == size[r.doc_id] and 0 <= r.taken <= 3 * r["size"]
        assert (r.source_size, r.target) == expected[source[r.doc_id]]
        taken[source[r.doc_id]] += r.taken
    for s in order:
        assert abs(taken[s] - expected[s][1]) <= 0.02 * expected[s][1] + mixing.BLOCK_WORDS
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mix(docs).collect()))


def test_mixed_texts_hold_the_taken_words(docs):
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = {r.doc_id: r.text.split() for r in mixed.collect()}
    assert {d: len(w) for d, w in words.items()} == {d: n for d, n in taken.items() if n}
    texts = {r.doc_id: r.text.split() for r in docs.collect()}
    for d, own in words.items():
        assert set(own) <= set(texts[d]) and max(own.count(w) for w in set(own)) <= 3


def test_cut_keeps_white_space():
    parts = [{"word": 0, "words": 2, "times": 2}, {"word": 2, "words": 2, "times": 1}]
    assert mixing.cut(" a\tb\n c d ", parts) == " a\tb\n c d \na\tb"


def test_documents(awkward, nothing):
    found = mixing.mix(awkward).collect()
    sizes = sorted(len(re.findall(mixing.WORD, r.text or "")) for r in awkward.collect())
    assert sorted(r["size"] for r in found) == sizes
    assert all(r.taken <= 3 * r["size"] for r in found)
    assert mixing.mix(nothing).count() == mixing.mixed_documents(nothing).count() == 0
    assert mixing.mixed_documents(awkward).columns == awkward.columns


def test_draws_of_any_size_are_random_and_exact_in_sum():
    counts = np.array([6_000_000_000_000, 3_000_000_000, 1_000_000_007, 0, 5])
    whole = int(counts.sum())
    part = whole // 2 + 1
    draws = [mixing._split_counts(counts, part, whole, np.random.default_rng(s)) for s in range(200)]
    assert all(int(d.sum()) == part and (d >= 0).all() and (d <= counts).all() for d in draws)
    second = np.array([int(d[1]) for d in draws])
    mean = part * (int(counts[1]) / whole)
    sd = (mean * (1 - int(counts[1]) / whole) * (whole - part) / (whole - 1)) ** 0.5
    assert len(set(second.tolist())) > 150 and 0.7 * sd < second.std() < 1.3 * sd
    assert abs(second.mean() - mean) < 5 * sd / 200**0.5
    slots = [4_000_000_000, 2_000_000_000]
    count, before = mixing.shard_counts(slots, 10, shard_slots=1_000_000)
    assert count.sum() == 1_000_000 and before.sum() == 10_000_000
