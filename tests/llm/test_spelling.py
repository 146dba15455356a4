"""Words, neighbours, forms and roots against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from fieldmart.llm import spelling


def plain_words(docs, least=7, least_count=2):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= least_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("letters", ["ab", "abcdé", "ax×ÿ"])
def test_neighbours_equal_brute_force(spark, letters):
    """Few letters: crowded nodes, repeated letters, every place and kind of edit."""
    rng = random.Random(letters)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 12))): rng.randint(2, 5000) for _ in range(250)}
    for w in list(words)[:60]:
        at = rng.randrange(len(w))
        for v in (w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:]):
            if len(v) >= 7:
                words.setdefault(v, rng.randint(2, 50))
    got = spelling.neighbours(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert len(got) == len({(r.word, r.near) for r in got})
    assert {(r.word, r.near) for r in got} == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert all(r.n == words[r.word] and r.near_n == words[r.near] for r in got)


def test_groups_of_documents(spark):
    rng = random.Random(5)
    base = ["government", "Éléphante", "straße", "PARLIAMENT", "überraschung", "seven77lettersx", "committee", "aaaaaaa", "aaaaaaaa"]
    docs = []
    for i in range(400):
        ws = [rng.choice(base) for _ in range(40)]
        for k in range(2):
            w = rng.choice(base)
            at = rng.randrange(len(w))
            ws.append(w[:at] + rng.choice("xyé") + w[at + rng.randint(0, 1):])
        docs.append((i, " ".join(ws)))
    docs += [(None, "government governmen governmen"), (3, None), (4, ""), (7, "x" * 20_000), (7, "x" * 20_000)]
    got = found(spelling.group_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    expected = plain_groups(plain_words(docs))
    assert got == expected and any(v[0] for v in got.values()) and "x" * 20_000 in got


def test_chain_of_forms_and_ties(spark):
    words = spark.createDataFrame([("aaaaaaax", 2000), ("aaaaaaay", 200), ("aaaaaaby", 20), ("aaaaabby", 2), ("zzzzzzzz", 9),
                                   ("qqqqqqqa", 70), ("qqqqqqqb", 70), ("qqqqqqqc", 7)], "word string, n long")
    table = spelling.forms(words, spelling.neighbours(words))
    assert {r.word: r.form for r in table.collect()} == {
        "aaaaaaax": None, "aaaaaaay": "aaaaaaax", "aaaaaaby": "aaaaaaay", "aaaaabby": "aaaaaaby", "zzzzzzzz": None,
        "qqqqqqqa": None, "qqqqqqqb": None, "qqqqqqqc": "qqqqqqqa"}
    assert {r.word: r.root for r in spelling.roots(table.filter("form is not null")).collect()} == {
        "aaaaaaay": "aaaaaaax", "aaaaaaby": "aaaaaaax", "aaaaabby": "aaaaaaax", "qqqqqqqc": "qqqqqqqa"}


def test_awkward_and_empty(spark, awkward, nothing):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(spelling.group_variants(awkward)) == plain_groups(plain_words(docs))
    assert spelling.group_variants(nothing).count() == 0


def test_tasks_pass_counts_on(spark, awkward, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED_WORDS", 3)
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert {r.word: r.n for r in spelling.count_words(awkward).collect()} == plain_words(docs)
