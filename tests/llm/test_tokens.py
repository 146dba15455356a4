"""BPE encoding, decoding and counting against the tokenizers library."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

from fieldmart.llm import bpe, token_count

VOCABULARY = bpe.default_vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def random_texts(n):
    rnd = random.Random(5)
    signs = "aAbBcé'sStTrReve 12½²ßÉ\n\t,.!?$-_<>|ñ" + "".join(map(chr, [0x1C, 0x85, 0xA0, 0x2019, 0x3A3, 0x130, 0x300, 0x4E2D, 0x1F600, 0x200B, 0]))
    words = "the thing international abababab mississippi understanding zzzzzz hahaha don't we'll".split()
    out = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40))) for _ in range(n)]
    out += ["".join(rnd.choice(words) for _ in range(5)) for _ in range(n)]
    return out + ["a" * 3000, "THE" * 2000, "<|endoftext|>x<|startoftext|>", "<|endoftext", "", "ababab" * 50 + "a"]


def lists(encoded):
    ids, ends = encoded
    return [part.tolist() for part in np.split(ids, ends[:-1])]


def test_trie_and_heap_equal_library(library):
    texts = random_texts(800)
    own, counter = bpe.TrieEncoder(VOCABULARY), token_count.PairMerger(VOCABULARY)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert lists(own.encode(texts)) == expected
    assert [counter.count_text(t) for t in texts] == list(map(len, expected))


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORD_BYTES", 5_000)
    monkeypatch.setattr(token_count, "CACHED_WORDS", 20)
    own, counter = bpe.TrieEncoder(VOCABULARY), token_count.PairMerger(VOCABULARY)
    for text in random_texts(40):
        ids = library.encode(text, add_special_tokens=False).ids
        assert lists(own.encode([text])) == [ids] and counter.count_text(text) == len(ids)


def test_documents(awkward, library):
    rows = awkward.select("doc_id", "text").collect()
    expected = sorted((str(r.doc_id), library.encode(r.text or "", add_special_tokens=False).ids) for r in rows)
    encoded = bpe.encode(awkward, VOCABULARY)
    assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == expected
    decoded = bpe.decode(encoded, VOCABULARY).collect()
    both = bpe.encode_and_decode(awkward, VOCABULARY).collect()
    assert sorted(map(str, both)) == sorted(map(str, decoded))
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in decoded)
    counted = token_count.count_tokens(awkward, VOCABULARY, limit=50).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in counted) == sorted((d, len(i)) for d, i in expected)
    assert sorted(r.n_bytes for r in counted) == sorted(len((r.text or "").encode()) for r in rows)
    assert all(r.over_limit == (r.n_tokens > 50) for r in counted)


def test_empty_table(nothing):
    assert bpe.decode(bpe.encode(nothing, VOCABULARY), VOCABULARY).count() == 0
    assert token_count.count_tokens(nothing, VOCABULARY).count() == 0


def test_small_caches_and_batches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORD_BYTES", 3000)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 20)
    own, texts = bpe.TrieEncoder(VOCABULARY), random_texts(60)
    for start, end in bpe.by_bytes(texts, 200):
        assert lists(own.encode(texts[start:end])) == [e.ids for e in library.encode_batch(texts[start:end], add_special_tokens=False)]
    assert list(bpe.by_bytes(["a" * 9, "", "b", "c" * 50, "d"], 10)) == [(0, 3), (3, 4), (4, 5)] and not list(bpe.by_bytes([], 10))


WORKER = """
import random
from fieldmart.llm import bpe

def used():
    return int(open("/proc/self/smaps_rollup").read().split("Pss_Anon:")[1].split()[0]) / 1024

rnd, own = random.Random(1), bpe.encoder(bpe.default_vocabulary())
start, most = used(), 0
for _ in range(40):
    own.encode([" ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(3, 14))) for _ in range(20000))])
    most = max(most, own.bytes)
print(start, used(), most)
"""


def test_a_worker_with_full_caches_stays_small():
    """The tables, and the caches when they have been full more than once, in MB of a process of their own."""
    out = subprocess.run([sys.executable, "-c", WORKER], capture_output=True, text=True, check=True, timeout=300,
                         env=os.environ | {"PYTHONPATH": os.pathsep.join(p or "." for p in sys.path)})
    start, full, most = map(float, out.stdout.split())
    assert start < 120 and full < 260 and 0.7 * bpe.CACHED_WORD_BYTES < most <= bpe.CACHED_WORD_BYTES
