"""Token counts by byte-pair merging with a heap over a linked list; no token ids are made.

Each adjacent pair of symbols that has a merge lies in a heap under its rank and place. The
lowest is popped, merged into its left neighbour in the linked list, and the two new pairs
are pushed; entries whose neighbours have changed are skipped. The count is the number of
first symbols less the number of merges. Counts of words are kept in a cache of bounded size.

Defined results: a null or empty text has 0 tokens and 0 bytes; added tokens inside a text
count as one each; every input row gives one output row; other columns are left out.
"""

from __future__ import annotations

import functools
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from fieldmart.llm.common import text_rows
from fieldmart.llm.words import END, Splitter, symbols_of

CACHED_WORDS = 400_000
LIMIT = 2048


class PairMerger:
    """Counts the tokens of words for the vocabulary file at `path`."""

    def __init__(self, path: str):
        self.splitter = Splitter(path)
        number: dict[str, int] = {}
        as_number = lambda t: number.setdefault(t, len(number))
        self.number = number
        self.rank = {(as_number(a), as_number(b)): (rank, as_number(a + b)) for rank, (a, b) in enumerate(self.splitter.model["merges"])}
        self.cache: dict[str, int] = {}

    def count(self, word: str) -> int:
        table, ranks = self.number, self.rank
        text = symbols_of(word)
        symbols = [table.get(c, -1) for c in text[:-1]]
        symbols.append(table.get(text[-1] + END, -1))
        n = len(symbols)
        heap = []
        for i in range(n - 1):
            found = ranks.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, found[1]))
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            rank, i, made = heappop(heap)
            left, j = symbols[i], after[i]
            if left is None or j >= n:
                continue
            found = ranks.get((left, symbols[j]))
            if not found or found[0] != rank:
                continue
            merges += 1
            symbols[i], symbols[j] = made, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = ranks.get((made, symbols[k]))
                if found:
                    heappush(heap, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = ranks.get((symbols[h], made))
                if found:
                    heappush(heap, (found[0], h, found[1]))
        return n - merges

    def count_text(self, text: str) -> int:
        total, cache = 0, self.cache
        for part in self.splitter.parts(text):
            if isinstance(part, int):
                total += 1
                continue
            for w in {w for w in part if w not in cache}:
                cache[w] = self.count(w)
            total += sum(map(cache.__getitem__, part))
        if len(cache) > CACHED_WORDS:
            cache.clear()
        return total


@functools.lru_cache(maxsize=2)
def merger(path: str) -> PairMerger:
    return PairMerger(path)


def count_tokens(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    def build(pairs):
        own = merger(vocabulary)
        for ids, texts in pairs:
            counts = pa.array([own.count_text(t) for t in texts], pa.int64())
            sizes = pa.array([len(t.encode("utf-8")) for t in texts], pa.int64())
            yield [ids.cast(pa.int64()), sizes, counts, pa.array([c.as_py() > limit for c in counts], pa.bool_())]

    return text_rows(docs, id_column, text_column, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", build)
