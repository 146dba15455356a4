"""Repeated passages against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

from fieldmart.llm import suffix_dedup


def plain(texts, length, first_stays):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    seen, out = set(), []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            w = d[i:i + length]
            if (w in seen) if first_stays else count[w] > 1:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), runs, bytes(x for x, g in zip(d, gone) if not g)))
    return out


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    draw = lambda n: "".join(rnd.choice("abé ") for _ in range(n))
    passages = [draw(n) for n in (25, 40, 60, 200)]
    out = [draw(rnd.randint(0, 300)) for _ in range(60)]
    out += [draw(rnd.randint(0, 50)) + rnd.choice(passages) + draw(rnd.randint(0, 50)) + rnd.choice(passages)[rnd.randint(0, 9):] for _ in range(80)]
    return out + ["a" * 500, "ab" * 300, "ab" * 11, out[0], out[0], None, "", "x" * 29, passages[3] + "y" + passages[3]]


@pytest.mark.parametrize(("first_stays", "hot", "group_bytes"), [(False, 20_000, 4 << 20), (False, 3, 2000), (True, 20_000, 2000), (True, 3, 4 << 20)])
def test_against_plain(spark, texts, monkeypatch, first_stays, hot, group_bytes):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 700)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = suffix_dedup.remove_repeats(docs, length=30, gram=8, hot=hot, first_stays=first_stays).collect()
    got = [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sorted(found, key=lambda r: r.doc_id)]
    assert got == plain(texts, 30, first_stays)


def test_documents(awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    expected = sorted(((str(r.doc_id), *p[:3]) for r, p in zip(rows, plain([r.text for r in rows], 200, False))), key=str)
    found = suffix_dedup.remove_repeats(awkward).collect()
    assert sorted(((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in found), key=str) == expected
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_factor_marks():
    rnd = np.random.default_rng(1)
    for _ in range(100):
        words = rnd.integers(0, 4, 30)
        order = np.argsort(words, kind="stable")[::1]
        order = np.concatenate([rnd.permutation(order[words[order] == w]) for w in range(4)]).astype(int)
        agrees = np.r_[False, words[order][1:] == words[order][:-1]]
        previous, following = suffix_dedup.factor_marks(order, agrees, np.arange(30))
        assert previous.tolist() == [w in words[:i] for i, w in enumerate(words)]
        assert following.tolist() == [w in words[i + 1:] for i, w in enumerate(words)]
