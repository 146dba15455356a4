"""Mixing sources to target weights by blocks of words.

The words of a source, document after document, form a stream that is cut into blocks of
`block_words`. A source's target asks for a number of block slots. The slots of all sources
are dealt to output shards: each shard's source counts are drawn at random given the totals
(a multinomial held to its totals), by halving the range of shards with a seeded draw for
each half, so any shard finds its counts alone. A source's slots run through pseudorandom
permutations of its block numbers, a new one for each pass, and slots and blocks are joined
by number. So every block is taken the rounded-down or rounded-up average of times.

Scale: the documents of a source are ordered by a hash of id and text, in `BUCKETS` ranges
of their own, so no step gathers a source; only a bucket's total is put in order per source.
Rows that are shuffled hold numbers, not texts. Per-source totals are collected: their
number is the number of sources.

Defined results: a null text has size 0; a null source comes last; ids may be null or
repeated; a document without words takes 0 words; every input row gives one output row; an
empty table gives an empty one; other columns are left out by `mix` and kept by
`mixed_documents`. The result depends on the rows alone, not on their order or partitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldmart.llm.common import WORD, materialized, row_key, slices

WEIGHTS = (5.0, 2.0, 1.0)
AT_MOST = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 8192
SEED = 20240
BUCKETS = 4096


@dataclass(frozen=True)
class Source:
    """A source's place in the order, its words, target, number of blocks and of slots."""

    key: str
    size: int
    target: float
    blocks: int
    slots: int


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, at_most: float = AT_MOST) -> list[float]:
    """Shares of the total by repeating weights; none above `at_most` times its size, the excess shared anew."""
    out, left = [0.0] * len(sizes), float(sum(sizes))
    free = list(range(len(sizes)))
    while free:
        unit = left / sum(weights[i % len(weights)] for i in free)
        full = [i for i in free if unit * weights[i % len(weights)] > at_most * sizes[i]]
        if not full:
            for i in free:
                out[i] = unit * weights[i % len(weights)]
            break
        for i in full:
            out[i] = float(at_most * sizes[i])
            left -= out[i]
        full_set = set(full)
        free = [i for i in free if i not in full_set]
    return out


def _split_counts(counts: np.ndarray, part: int, whole: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each source are among `part` of `whole` slots drawn without putting back."""
    if whole < 1_000_000_000:
        return rng.multivariate_hypergeometric(counts, part, method="marginals")
    # beyond that generator's range each source's number is drawn from the normal law of the same mean and spread,
    # which such counts follow closely, and kept within what is left of the source and of the part
    out = np.zeros_like(counts)
    left, open_slots = whole, part
    for i, n in enumerate(counts.tolist()):
        others = left - n
        share = n / left if left else 0.0
        spread = (open_slots * share * (1 - share) * ((left - open_slots) / max(1, left - 1))) ** 0.5
        drawn = round(open_slots * share + spread * float(rng.standard_normal()))
        out[i] = min(max(drawn, 0, open_slots - others), n, open_slots)
        left, open_slots = others, open_slots - int(out[i])
    return out


def shard_counts(slots: list[int], shard: int, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Source counts of a shard, and of all shards before it."""
    counts = np.array(slots, dtype=np.int64)
    total = int(counts.sum())
    low, high = 0, -(-total // shard_slots)
    before = np.zeros_like(counts)
    while high - low > 1:
        middle = (low + high) // 2
        part = (middle - low) * shard_slots
        left = _split_counts(counts, part, int(counts.sum()), np.random.default_rng([seed, low, high]))
        if shard < middle:
            counts, high = left, middle
        else:
            before, counts, low = before + left, counts - left, middle
    return counts, before


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 .. n-1: four Feistel rounds, walked on until the image is below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = [int(x) for x in np.random.default_rng([SEED, key & 0xFFFFFFFF, key >> 32]).integers(1, 2**62, 4)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in rounds:
            mixed = (right + np.uint64(r)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return left << np.uint64(half) | right

    out = once(index.astype(np.uint64))
    while (away := out >= n).any():
        out[away] = once(out[away])
    return out.astype(np.int64)


def _placed(docs: DataFrame, id_column: str, text_column: str, source_column: str, *more: str) -> DataFrame:
    """Written rows with their source's key, size, a number, and a bucket by the hash of id and text."""
    doc_id, text = F.col(id_column).cast("long"), F.col(text_column)
    return materialized(docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_column).cast("string")), F.lit("t")).alias("key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"), *row_key(doc_id, text), *more), "sizes").withColumn(
        "bucket", F.pmod(F.xxhash64("k1", "k2"), F.lit(BUCKETS)))


def plan_sources(placed: DataFrame, weights=WEIGHTS, at_most=AT_MOST, block_words=BLOCK_WORDS) -> list[Source]:
    """Sources in code point order, null last, with targets and slots."""
    found = sorted((r["key"], r["n"]) for r in placed.groupBy("key").agg(F.sum("size").alias("n")).collect())
    out = []
    for (key, size), target in zip(found, targets([n for _, n in found], weights, at_most), strict=True):
        blocks = -(-size // block_words)
        slots = min(int(at_most * blocks), round(target * blocks / size)) if size else 0
        out.append(Source(key, size, target, blocks, slots))
    return out


def slots(session, sources: list[Source], shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row per slot of the mix: shard, source number, block number."""
    wanted, blocks = [s.slots for s in sources], [s.blocks for s in sources]
    shards = -(-sum(wanted) // shard_slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                counts, before = shard_counts(wanted, shard, shard_slots)
                for number in np.flatnonzero(counts).tolist():
                    at = np.arange(before[number], before[number] + counts[number])
                    turn, index = at // blocks[number], at % blocks[number]
                    block = np.empty_like(index)
                    for t in np.unique(turn):
                        block[turn == t] = permuted(index[turn == t], blocks[number], int(t) << 32 | number)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), shard)), pa.array(np.full(len(at), number)), pa.array(block)],
                        ["shard", "source", "block"])

    ids = session.range(0, shards, 1, max(1, min(shards, 4 * session.sparkContext.defaultParallelism)))
    return ids.mapInArrow(run, "shard long, source long, block long")


def _pieces(placed: DataFrame, sources: list[Source], block_words: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their source's figures and start in its stream, and one row per part of a document in a block."""
    session = placed.sparkSession
    known = session.createDataFrame([(s.key, i, s.size, s.target) for i, s in enumerate(sources)],
                                    "key string, source long, source_size long, target double")
    ends = placed.groupBy("key", "bucket").agg(F.sum("size").alias("n"))
    ahead = F.sum("n").over(W.partitionBy("key").orderBy("bucket")) - F.col("n")
    starts = materialized(ends.select("key", "bucket", ahead.alias("start")).join(known, "key"), "starts")
    inside = W.partitionBy("key", "bucket").orderBy("k2", "k1", "row").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = placed.withColumn("ahead", F.sum("size").over(inside) - F.col("size")).join(starts, ["key", "bucket"]).withColumn(
        "start", F.col("start") + F.col("ahead")).drop("ahead", "bucket", "key", "k1", "k2")
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    parts = rows.filter("size > 0").select("row", "source", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.col("block") * block_words, F.col("start"))
    high = F.least((F.col("block") + 1) * block_words, F.col("start") + F.col("size"))
    return rows, parts.select("row", "source", "block", (low - F.col("start")).alias("word"), (high - low).alias("words"))


def _taken(placed: DataFrame, sources: list[Source], block_words: int) -> tuple[DataFrame, DataFrame]:
    """Rows, and their parts with how often the mix takes them."""
    rows, parts = _pieces(placed, sources, block_words)
    times = slots(placed.sparkSession, sources).groupBy("source", "block").agg(F.count("*").alias("times"))
    # the slots' number can't be told from the shards' number before the run, so no side may be broadcast
    return rows, parts.join(times.hint("merge"), ["source", "block"])


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights=WEIGHTS, at_most=AT_MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    placed = _placed(docs, id_column, text_column, source_column)
    sources = plan_sources(placed, weights, at_most, block_words)
    rows, parts = _taken(placed, sources, block_words)
    taken = parts.groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return rows.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


_WORD = re.compile(WORD)


def cut(text: str, parts: list[dict]) -> str:
    """The taken words: first all parts once, then those taken twice, and so on; runs of parts keep their white space."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out = []
    for turn in range(max(p["times"] for p in parts)):
        runs: list[list[int]] = []
        for p in parts:
            if p["times"] > turn:
                if runs and runs[-1][1] == p["word"]:
                    runs[-1][1] += p["words"]
                else:
                    runs.append([p["word"], p["word"] + p["words"]])
        out += [text if (a, b) == (0, len(spans)) else text[spans[a][0]:spans[b - 1][1]] for a, b in runs]
    return "\n".join(out)


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
                    weights=WEIGHTS, at_most=AT_MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that the mix takes words of, with all their columns; the text holds the taken words."""
    names = docs.columns
    packed = docs.withColumn("__llm_doc", F.struct(*[F.col(c) for c in names]))
    placed = _placed(packed, id_column, text_column, source_column, "__llm_doc")
    sources = plan_sources(placed, weights, at_most, block_words)
    _, parts = _taken(placed.drop("__llm_doc"), sources, block_words)
    chosen = parts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("word", "words", "times"))).alias("__llm_parts"))
    joined = placed.select("row", "__llm_doc").join(chosen, "row").select("__llm_doc.*", "__llm_parts")
    at = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [cut(t, p) for t, p in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist(), strict=True)]
            columns = [*b.columns[:at], pa.array(texts, pa.string()), *b.columns[at + 1:len(names)]]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, docs.schema)
