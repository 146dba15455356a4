"""BPE encoding by a prefix-sharing trie, and decoding.

The distinct new words of a batch are put in order, which walks their trie depth-first:
two neighbours share the states of their common prefix, so each prefix is encoded once. The
state of a prefix is the last token of its encoding. The last token of a longer prefix is
the one vocabulary token that ends there and may follow the last token of what stands
before it; whether two tokens may stand side by side is found by undoing their merges.
Walking back over the states gives a word's tokens.

A task encodes and decodes in one pass over its rows. The words it has encoded and the pairs of
tokens it has judged are kept up to a number of bytes, then forgotten; the vocabulary's tables are arrays and
dictionaries of numbers. The vocabulary file's path must be readable on every executor.

Defined results: a null or empty text has no tokens and decodes to an empty text; strings of
added tokens inside a text become those tokens; every input row gives one output row; other
columns of the input are left out.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from fieldmart.llm.common import slices, text_rows
from fieldmart.llm.words import END, Splitter, symbols_of

#: Bytes of the words that a task keeps with their tokens, about.
CACHED_WORD_BYTES = 64_000_000
#: What a kept word takes besides its letters: its string, number, dictionary entry and tokens.
WORD_BYTES = 180
#: Pairs of tokens of which a task keeps whether they may stand side by side: about 100 bytes each.
CACHED_PAIRS = 250_000
#: Bytes of text turned into Python objects at a time.
TEXT_BYTES = 2_000_000
#: Marks the number of an added token among words; no word of a text starts with it, as the splitter drops line feeds.
ADDED = "\n"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Merges:
    """Tokens numbered in the order in which merges make them, single symbols first.

    A pair of tokens is one number, left * `count` + right.
    """

    def __init__(self, model: dict):
        made = [a + b for a, b in model["merges"]]
        merged = set(made)
        texts = [t for t in model["vocab"] if t not in merged] + made
        self.number = {t: i for i, t in enumerate(texts)}
        self.vocab_id = array("i", (model["vocab"][t] for t in texts))
        self.count, self.first = len(texts), len(texts) - len(made)
        self.left, self.right = array("i", range(self.first)), array("i", range(self.first))
        for a, b in model["merges"]:
            self.left.append(self.number[a])
            self.right.append(self.number[b])
        self.pair = {self.left[i] * self.count + self.right[i]: i for i in range(self.first, self.count)}
        self.longest = max(map(len, texts))
        self.side_by_side: dict[int, bool] = {}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether no merge would ever join across the border of the two tokens."""
        if len(self.side_by_side) >= CACHED_PAIRS:
            self.side_by_side.clear()
        follows = self.side_by_side[left * self.count + right] = self._undo(left, right)
        return follows

    def _undo(self, left: int, right: int) -> bool:
        """Undo the later merge of the two again and again; a pair at the border that would have merged before it forbids."""
        bound = self.count
        while True:
            if self.pair.get(left * self.count + right, bound) < bound:
                return False
            if left > right:
                can_left, can_right = left >= self.first, False
            else:
                can_left, can_right = False, right >= self.first
            if not (can_left or can_right):
                can_left, can_right = left >= self.first, right >= self.first
                if not (can_left or can_right):
                    return True
            if can_left:
                bound, left = left, self.right[left]
            else:
                bound, right = right + 1, self.left[right]

    @functools.cached_property
    def usable(self) -> bytearray:
        """Whether a token is the encoding of its own text."""
        out = bytearray(b"\1" * self.first)
        for token in range(self.first, self.count):
            a, b = self.left[token], self.right[token]
            out.append(out[a] and out[b] and self._joined(a, b, token))
        return out

    def _joined(self, a: int, b: int, token: int) -> bool:
        """Whether the halves meet in this very merge: nothing at their border merges earlier."""
        left, right, bound = a, b, token
        while True:
            if self.pair.get(left * self.count + right, bound) < bound:
                return False
            if left > right and left >= self.first:
                bound, left = min(bound, left), self.right[left]
            elif right >= self.first:
                bound, right = min(bound, right + 1), self.left[right]
            elif left >= self.first:
                bound, left = min(bound, left), self.right[left]
            else:
                return True


class TrieEncoder:
    """Encodes words through the trie of the words not seen before."""

    def __init__(self, path: str):
        self.splitter = Splitter(path)
        model = self.splitter.release()
        self.merges = Merges(model)
        by_id = {i: t for t, i in chain(model["vocab"].items(), self.splitter.added.items())}
        #: Token texts by id.
        self.pieces = pa.array([by_id.get(i, "") for i in range(max(by_id) + 1)])
        self.clear()

    def clear(self) -> None:
        """Forget all words: their numbers, and the tokens of each number."""
        self.number: dict[str, int] = {}
        self.tokens, self.ends, self.bytes = array("i"), array("q", [0]), 0

    def learn(self, words: set[str]) -> None:
        """Encode the new words: depth-first over their trie, in sorted order of their symbols."""
        merges, number, usable = self.merges, self.merges.number, self.merges.usable
        known, longest, vocab_id, count = merges.side_by_side, merges.longest, merges.vocab_id, merges.count
        path = ""
        last: list[int] = [-1]        # last token of each prefix
        size: list[int] = [0]         # and its number of symbols
        for symbols, word in sorted((symbols_of(w), w) for w in words):
            final = len(symbols)
            shared, most = 0, min(len(path), final - 1, len(last) - 1)
            while shared < most and path[shared] == symbols[shared]:
                shared += 1
            del last[shared + 1:], size[shared + 1:]
            for end in range(shared + 1, final + 1):
                upto = symbols if end < final else symbols + END
                stop = end if end < final else None
                for start in range(max(0, end - longest), end):
                    token = number.get(upto[start:stop])
                    if token is not None and usable[token]:
                        if start:
                            left = last[start]
                            follows = known.get(left * count + token)
                            if follows is None:
                                follows = merges.may_follow(left, token)
                            if not follows:
                                continue
                        last.append(token)
                        size.append(end - start)
                        break
            at, back = final, []
            while at:
                back.append(vocab_id[last[at]])
                at -= size[at]
            back.reverse()
            self._keep(word, back)
            path = symbols
            last.pop()                # the last state belongs to the word's end, which no other word shares
            size.pop()

    def _keep(self, word: str, ids: list[int]) -> None:
        self.number[word] = len(self.number)
        self.bytes += WORD_BYTES + len(word)
        self.tokens.extend(ids)
        self.ends.append(len(self.tokens))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts behind each other, and where each text's ids end."""
        split: list[list[str]] = []
        for text in texts:
            words: list[str] = []
            for part in self.splitter.parts(text):
                words += part if isinstance(part, list) else [f"{ADDED}{part}"]
            split.append(words)
        new = set(chain.from_iterable(split)).difference(self.number)
        if self.bytes + sum(map(len, new)) + WORD_BYTES * len(new) > CACHED_WORD_BYTES:
            self.clear()
            new = set(chain.from_iterable(split))
        added = {w for w in new if w[0] == ADDED}
        for w in sorted(added):
            self._keep(w, [int(w[1:])])
        self.learn(new - added)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        tokens, ends = np.array(self.tokens, np.int32), np.array(self.ends, np.int64)
        first, size = ends[numbers], ends[numbers + 1] - ends[numbers]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = tokens[np.arange(upto[-1]) + np.repeat(first - upto[:-1], size)]
        return ids, upto[np.cumsum(counts)]


    def decode(self, ids: pa.Array, ends: np.ndarray) -> pa.Array:
        """The token texts of each row of ids, joined by spaces, as for a file without a decoder."""
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, self.pieces.take(ids)), " ")


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def by_bytes(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about so many letters, one row at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _rows(docs: DataFrame, vocabulary: str, id_column: str, text_column: str, schema: str, decoded: bool) -> DataFrame:
    def build(pairs):
        own = encoder(vocabulary)
        for ids, texts in pairs:
            for start, end in by_bytes(texts, TEXT_BYTES):
                tokens, ends = own.encode(texts[start:end])
                offsets, tokens = pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(tokens)
                yield [ids.slice(start, end - start).cast(pa.int64()), pa.ListArray.from_arrays(offsets, tokens),
                       *([own.decode(tokens, ends)] if decoded else [])]

    return text_rows(docs, id_column, text_column, schema, build)


def encode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, ids."""
    return _rows(docs, vocabulary, id_column, text_column, "doc_id long, ids array<int>", decoded=False)


def encode_and_decode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, ids, and the text that the ids decode to."""
    return _rows(docs, vocabulary, id_column, text_column, "doc_id long, ids array<int>, decoded string", decoded=True)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """The encoded rows with `decoded`: the token texts joined by spaces, as for a file without a decoder."""
    def run(batches):
        own = encoder(vocabulary)
        for b in slices(batches):
            ids = b.column(1)
            ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(ids), 0)).to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), ids, own.decode(ids.flatten(), ends)], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
