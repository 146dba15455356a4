"""Repeated passages by longest-previous-factor arrays over suffixes that Spark deals out.

A byte is removed when a string of `LENGTH` bytes that covers it also starts elsewhere.

1. Every window of `LENGTH` bytes has an anchor: the place of the smallest hash of `GRAM`
   bytes in it. Equal windows have equal anchors at equal places, so it is enough to compare
   windows of equal anchors. Anchors that occur once are dropped.
2. Texts meet their repeated anchors; each anchor's windows, as one short context of bytes,
   go to the task of the anchor. Equal contexts of a task travel once. The windows of an
   anchor above `HOT` places go to tasks by their own hash instead, so no group is unbounded.
3. A task sorts the suffixes that start at its windows (names of 8, 16 .. 128 bytes by
   doubling, two of which overlap to a window), and takes the previous and next smaller
   positions in suffix order: a suffix with a smaller position among neighbours that agree
   in a whole window has a longest previous factor of at least `LENGTH`; with larger ones, a
   longest next factor. Either marks the window (`first_stays` marks by the previous alone,
   so the first copy stays).
4. Marked runs of windows return to their documents as intervals of bytes.

Defined results: texts are UTF-8 bytes, null is empty; matches never cross rows; texts
shorter than `LENGTH` lose nothing; repeated rows match each other; every input row gives
one output row; ids may be null; other columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import materialized, row_key, slices

LENGTH, GRAM = 200, 50
HOT = 20_000
PIECE_BYTES = 4 << 20
GROUP_BYTES = 4 << 20
CHUNK_BYTES = 24 << 20

_POSITION = np.uint64((1 << 28) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(11).integers(1, 2**63, 256).astype(np.uint64)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the `gram` bytes at each place."""
    n = len(data)
    up = np.full(n, _BASE)
    up[0] = 1
    down = np.full(n, _INVERSE)
    down[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * np.multiply.accumulate(up))])
    h = (sums[gram:] - sums[:-gram]) * np.multiply.accumulate(down)[:n - gram + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours: running minima from both ends of blocks."""
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:len(x) - width + 1], ahead[width - 1:len(x)])


def window_anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor: (text number, place in the text of the first window, windows, anchor's hash)."""
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    hashes = _gram_hashes(data, gram)
    marked = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_sliding_least(marked, length - gram + 1) & _POSITION).astype(np.int64)
    place = np.arange(len(anchor))
    text = np.searchsorted(starts, place, side="right") - 1
    fits = place + length <= ends[text]
    place, anchor, text = place[fits], anchor[fits], text[fits]
    if not len(place):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    windows = np.diff(np.r_[first, len(place)])
    return text[first], place[first] - starts[text[first]], windows, hashes[anchor[first]].view(np.int64)


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[list[int], list[int], list[int], list[int]]]:
    """Cut consecutive texts into pieces of bounded bytes; long texts overlap by a window less one byte."""
    numbers, starts, ends, shift = [], [], [], []
    size = 0
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        at = a
        while True:
            stop = min(b, at + PIECE_BYTES)
            numbers.append(i)
            starts.append(at)
            ends.append(stop)
            shift.append(at - a)
            size += stop - at
            if size >= PIECE_BYTES:
                yield numbers, starts, ends, shift
                numbers, starts, ends, shift, size = [], [], [], [], 0
            if stop == b:
                break
            at = stop - length + 1
    if numbers:
        yield numbers, starts, ends, shift


def _anchor_rows(length: int, gram: int):
    """Map (k1, k2, data) to (anchor, k1, k2, low, windows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024):
            column = b.column(2)
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
            buffer = column.buffers()[2]
            data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            for numbers, starts, ends, shift in _pieces(offsets, length):
                joint = np.concatenate([data[s:e] for s, e in zip(starts, ends, strict=True)])
                sizes = np.array(ends) - np.array(starts)
                begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                keep = sizes > 0
                if not keep.any():
                    continue
                text, low, windows, anchor = window_anchors(joint, begin[keep], (begin + sizes)[keep], length, gram)
                number, moved = np.array(numbers)[keep][text], np.array(shift)[keep][text]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, k1[number], k2[number], (low + moved) << 8 | windows)],
                                                 ["anchor", "k1", "k2", "place"])

    return run


def _contexts(length: int, first_stays: bool):
    """Map (doc_id, k1, k2, data, marks) to contexts; equal contexts of a chunk travel once, the others are resolved at once."""
    names = ["anchor", "context", "k1", "k2", "low", "windows", "many"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def emit() -> pa.RecordBatch:
            rows = []
            for context, places in held.items():
                places.sort()
                k1, k2, low, windows, anchor = places[0]
                many = len(places) > 1
                rows.append((anchor, context, k1, k2, low, windows, many))
                for k1, k2, low, windows, _ in places if many and not first_stays else places[1:]:
                    rows.append((xxhash.xxh64_intdigest(f"{k1} {k2} {low}") - 2**63, None, k1, k2, low, windows, True))
            held.clear()
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

        for b in slices(batches, 64):
            for k1, k2, data, marks in zip(*(b.column(i).to_pylist() for i in range(1, 5)), strict=True):
                for m in marks:
                    low, windows = m["place"] >> 8, m["place"] & 255
                    if m["hot"]:
                        for at in range(low, low + windows):
                            context = data[at:at + length]
                            held.setdefault(context, []).append((k1, k2, at, 1, xxhash.xxh64_intdigest(context) - 2**63))
                            size += length
                    else:
                        context = data[low:low + windows + length - 1]
                        held.setdefault(context, []).append((k1, k2, low, windows, m["anchor"]))
                        size += len(context)
                if size > CHUNK_BYTES:
                    yield emit()
                    size = 0
        yield emit()

    return run


def _named(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.uint64)


def window_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at `starts` in lexicographic order of their first `length` bytes, and whether each agrees with the one before.

    Names of 8 bytes are their big-endian value's rank; two names that lie a name's length
    apart make the name of twice the length; the last two names overlap to the whole length.
    """
    wide = 8
    while wide * 2 <= length:
        wide *= 2
    needed = {wide: np.unique(np.concatenate([starts, starts + length - wide]))}
    size = wide
    while size > 8:
        size //= 2
        needed[size] = np.unique(np.concatenate([needed[size * 2], needed[size * 2] + size]))
    at = needed[8]
    eight = np.zeros(len(at), np.uint64)
    for i in range(8):
        eight = eight << np.uint64(8) | data[at + i]
    names = _named(eight)
    size = 8
    while size < wide:
        places = needed[size]
        left, right = np.searchsorted(places, needed[size * 2]), np.searchsorted(places, needed[size * 2] + size)
        names = _named(names[left] << np.uint64(32) | names[right])
        size *= 2
    places = needed[wide]
    pair = names[np.searchsorted(places, starts)] << np.uint64(32) | names[np.searchsorted(places, starts + length - wide)]
    order = np.argsort(pair, kind="stable")
    agrees = np.r_[False, pair[order][1:] == pair[order][:-1]]
    return order, agrees


def factor_marks(order: np.ndarray, agrees: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per suffix: whether its longest previous, and its longest next factor reach the length.

    `position` orders the suffixes in the text. Inside a run of suffixes that agree, the
    previous or next smaller position in suffix order exists exactly where the running
    minimum from the left or from the right is below the suffix's own position.
    """
    run = np.cumsum(~agrees) - 1
    n = len(order)
    p = position[order].astype(np.int64)
    top = n + 1

    def nearest(run, p):
        """The least position before each place in its run; `top` if none."""
        least = np.minimum.accumulate(p - run * top) + run * top      # later runs lie lower, so a run never sees an earlier one
        out = np.full(n, top)
        same = run[1:] == run[:-1]
        out[1:][same] = least[:-1][same]
        return out

    back = slice(None, None, -1)
    last = run[-1] if n else 0
    smaller = np.minimum(nearest(run, p), nearest((last - run)[back], p[back])[back]) < p
    mirrored = n - p
    larger = np.minimum(nearest(run, mirrored), nearest((last - run)[back], mirrored[back])[back]) < mirrored
    previous, following = np.zeros(n, bool), np.zeros(n, bool)
    previous[order], following[order] = smaller, larger
    return previous, following


def repeated_windows(contexts: list[bytes], windows: np.ndarray, length: int, first_stays: bool) -> np.ndarray:
    """Marks of all windows of the contexts, which stand in text order."""
    sizes = np.array([len(c) for c in contexts])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    firsts = np.concatenate([[0], np.cumsum(windows)[:-1]])
    starts = np.repeat(begin - firsts, windows) + np.arange(int(windows.sum()))
    order, agrees = window_order(data, starts, length)
    previous, following = factor_marks(order, agrees, np.arange(len(starts)))
    return previous if first_stays else previous | following


def _intervals(length: int, first_stays: bool):
    """Map context rows sorted by anchor to marked intervals (k1, k2, low, high)."""
    names = ["k1", "k2", "low", "high"]

    def judge(rows: list[tuple]) -> list[tuple]:
        """Rows (anchor, context, k1, k2, low, windows, many) of whole anchors, contexts given."""
        out, same, by_anchor = [], {}, {}
        for r in sorted(rows, key=lambda r: r[2:5]):
            same.setdefault((r[0], r[1]), []).append(r)
        for (anchor, _), group in same.items():
            many = len(group) > 1 or group[0][6]
            out += [(r[2], r[3], r[4], r[4] + r[5] - 1 + length) for r in (group[1:] if first_stays else group if many else ())]
            by_anchor.setdefault(anchor, []).append((group[0], many))
        asked = [g for g in by_anchor.values() if len(g) > 1 and (first_stays or not all(many for _, many in g))]
        if asked:
            contexts = sorted((c for g in asked for c in g), key=lambda c: c[0][2:5])
            windows = np.array([c[0][5] for c in contexts])
            marks = repeated_windows([c[0][1] for c in contexts], windows, length, first_stays)
            edges = np.cumsum(windows)
            for (r, many), end, count in zip(contexts, edges.tolist(), windows.tolist(), strict=True):
                if many and not first_stays:
                    continue
                own = np.r_[False, marks[end - count:end], False].astype(np.int8)
                turn = np.diff(own)
                for a, b in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist(), strict=True):
                    out.append((r[2], r[3], r[4] + a, r[4] + b - 1 + length))
        return out

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, done = [], 0, []
        for b in slices(batches, 1024):
            for r in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
                if r[1] is None:
                    done.append((r[2], r[3], r[4], r[4] + r[5] - 1 + length))
                    continue
                if size > GROUP_BYTES and r[0] != held[-1][0]:
                    yield batch(judge(held))
                    held, size = [], 0
                held.append(r)
                size += len(r[1])
            if done:
                yield batch(done)
                done = []
        yield batch(judge(held))

    return run


def _cut(data: bytes, intervals: list[tuple[int, int]]) -> tuple[list[bytes], int, int]:
    """What stays of a text, the number of removed bytes, and of maximal removed runs."""
    kept, at, removed, spans, high = [], 0, 0, 0, -1
    for low, end in sorted(intervals):
        if low > high:
            spans += 1
            kept.append(data[at:low])
            removed += end - low
            at = high = end
        elif end > high:
            removed += end - high
            at = high = end
    kept.append(data[at:])
    return kept, removed, spans


def repeated_intervals(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
                       first_stays: bool = False) -> DataFrame:
    """Intervals of repeated bytes (k1, k2, low, high) of rows (doc_id, k1, k2, data); intervals may overlap."""
    # found twice, as that costs less than a table of them would fill
    anchors = keyed.select("k1", "k2", "data").mapInArrow(_anchor_rows(length, gram), "anchor long, k1 long, k2 long, place long")
    repeated = materialized(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select(
        "anchor", (F.col("n") > hot).alias("hot")), "repeated-anchors")
    marks = anchors.join(repeated, "anchor").groupBy("k1", "k2").agg(F.collect_set(F.struct("anchor", "place", "hot")).alias("marks"))
    # all columns of `keyed`, so that Spark shuffles the texts once for this join and the last one
    texts = keyed.join(marks, ["k1", "k2"]).select("doc_id", "k1", "k2", "data", "marks")
    contexts = texts.mapInArrow(_contexts(length, first_stays), "anchor long, context binary, k1 long, k2 long, low long, windows int, many boolean")
    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _intervals(length, first_stays), "k1 long, k2 long, low long, high long")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH,
                   gram: int = GRAM, hot: int = HOT, first_stays: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), kept_sha256."""
    doc_id, text = F.col(id_column).cast("long"), F.col(text_column)
    keyed = docs.select(doc_id.alias("doc_id"), *row_key(doc_id, text), F.coalesce(text, F.lit("")).cast("binary").alias("data"))
    found = repeated_intervals(keyed, length, gram, hot, first_stays)
    lists = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("low", "high")).alias("intervals"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            rows = []
            for doc, data, intervals in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                kept, removed, spans = _cut(data, [(i["low"], i["high"]) for i in intervals or ()])
                whole = b"".join(kept)
                rows.append((doc, len(data), removed, spans, whole, hashlib.sha256(whole).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    joined = keyed.join(lists, ["k1", "k2"], "left").select("doc_id", "data", "intervals")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
