"""Trie of conversation beginnings, rolled up by centroid decomposition.

A node is a distinct sequence of first turns. A turn's digest is tagged with its depth, and a
sequence's name is the sum of its turns' digests (two sums of 60-bit numbers, kept below 2**62),
so names of all beginnings are running sums: within blocks of turns by a window, across the
blocks of a long conversation by the sums of the blocks before. A node goes by its smallest member
and its depth; `paths` lists for every conversation the node at each depth.

Sums over subtrees follow the centroid decomposition of the parent edges. A component with
more than `component_rows` member turns is split: its centroid is the deepest node with at least half
of the turns below it; the parts below the centroid's children and the part above become components.
Components of at most that size are read by one task each, which decomposes them on the same rule in
memory. Each centroid's total is then added to the nodes on its path to its component's top. Sizes at least halve, so there are
few rounds, whatever the tree's shape; a path is read from `paths`, never walked by edges.

Nothing gathers a group: turns are numbered by ranges of the order, frequent beginnings are combined
before the shuffle, members of a node that many conversations end in are sorted by range and cut
into pieces by their tasks. Only the digest of such a node runs over its pieces in one task, as
SHA-256 must, in bounded memory.

Defined results: rows with a null conv_id are left out; null roles and texts are empty; turns of
equal number are ordered by role and text; repeated rows are turns of their own; conversations
whose rebuilt form has no turns are members of the root only; an empty table has no nodes;
other columns are not read. The remainder of a negative conv_id has its sign, as in SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.llm.common import materialized
from fieldmart.operators.ranks import with_group_place

#: Member turns of a component that one task reads.
COMPONENT_ROWS = 50_000
#: Turns of a conversation whose names one window sums up.
BLOCK_TURNS = 4096
#: Bytes of conv_ids in one piece of a node's list.
PIECE_BYTES = 1 << 16
#: Conversations of one family share a start, of fewer turns than the second number.
FAMILY, KEPT_TURNS = 5, 9

_NAMES_BELOW = 1 << 62
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, at, n, role, text): the turns of each conversation numbered from 0, and how many there are."""
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return with_group_place(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "text"], "at", size="n").drop("turn")


def rebuilt(conversations: DataFrame, family: int = FAMILY, kept_turns: int = KEPT_TURNS) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of the conversations that start as the first of their family does.

    The turns are (conv_id, depth, length, role, text) with depths from 1; the lengths are (conv_id, length) of
    every conversation, also of those without turns.
    """
    turns = materialized(numbered_turns(conversations), "numbered-turns")
    whole = turns.filter("at = 0").select("conv_id", "n")
    shapes = whole.withColumns({
        "first": F.col("conv_id") - F.col("conv_id") % family,
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % kept_turns})
    shapes = shapes.join(whole.select(F.col("conv_id").alias("first"), F.col("n").alias("first_n")), "first", "left")
    shapes = materialized(shapes.withColumn("kept", F.least("h", F.coalesce("first_n", F.lit(0)))).select(
        "conv_id", "first", "h", "kept", (F.col("kept") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "shapes")
    own = turns.join(shapes, "conv_id").filter("at >= h").select(
        "conv_id", (F.col("kept") + F.col("at") - F.col("h") + 1).alias("depth"), "length", "role", "text")
    starts = turns.filter(F.col("at") < kept_turns).select(F.col("conv_id").alias("first"), "at", "role", "text")
    start = starts.join(shapes, "first").filter("at < h").select("conv_id", (F.col("at") + 1).alias("depth"), "length", "role", "text")
    return own.unionByName(start), shapes.select("conv_id", "length")


def _number(digest: Column, start: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")


def named_beginnings(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Rows (conv_id, depth, length, name_a, name_b, bytes): the name of each beginning, and its last text's size."""
    tagged = F.concat_ws(":", F.col("depth").cast("string"), F.length("role").cast("string"), F.concat("role", "text"))
    digests = turns.select("conv_id", "depth", "length", F.md5(tagged.cast("binary")).alias("digest"), F.octet_length("text").cast("long").alias("bytes"))
    digests = materialized(digests.select(
        "conv_id", "depth", "length", "bytes", F.floor((F.col("depth") - 1) / block_turns).alias("block"),
        _number(F.col("digest"), 1).alias("a"), _number(F.col("digest"), 16).alias("b")), "turn-digests")
    blocks = digests.filter(F.col("length") > block_turns).groupBy("conv_id", "block").agg(
        (F.sum("a") % _NAMES_BELOW).alias("a"), (F.sum("b") % _NAMES_BELOW).alias("b"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("conv_id", "block", F.sum("a").over(before).alias("more_a"), F.sum("b").over(before).alias("more_b"))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = digests.withColumns({"a": F.sum("a").over(inside), "b": F.sum("b").over(inside)}).join(carried, ["conv_id", "block"], "left")
    return summed.select("conv_id", "depth", "length", "bytes", *[
        ((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))) % _NAMES_BELOW).cast("long").alias(f"name_{c}") for c in "ab"])


def paths_and_nodes(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`paths`: (conv_id, depth, node, length) from depth 0; `nodes`: (node, depth, parent, n_convs, n_children, bytes, size).

    A node is its smallest member; with its depth that is unique. Size is the number of member turns in its subtree.
    """
    beginnings = materialized(named_beginnings(turns), "beginnings")
    name = ["depth", "name_a", "name_b"]
    nodes = materialized(beginnings.groupBy(*name).agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("size")), "nodes")
    all_convs = lengths.agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.sum(F.col("length") + 1).alias("size"))
    zero = F.lit(0).cast("long")
    top = lengths.select("conv_id", zero.alias("depth"), F.lit(all_convs.first()["node"]).cast("long").alias("node"), "length")
    paths = materialized(beginnings.join(nodes.select(*name, "node"), name).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "node", "length").unionByName(top), "paths")
    parents = paths.select(F.col("conv_id").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    linked = nodes.select("node", "depth", "n_convs", "bytes", "size").join(parents, ["node", "depth"])
    root = all_convs.filter("n_convs > 0").select("node", zero.alias("depth"), "n_convs", zero.alias("bytes"), "size",
                                                  F.lit(None).cast("long").alias("parent"))
    linked = materialized(linked.unionByName(root), "linked-nodes")
    children = linked.filter("parent is not null").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    return paths, linked.join(children, ["node", "depth"], "left").fillna(0, ["n_children"])


def centroid_sums(parent: list[int], *weights: list[int]) -> list[list[int]]:
    """Sums of each list of weights over subtrees. `parent` has the place of each node's parent, which is smaller; the top's is -1.

    Each component's centroid adds what lies below it to its path up to the component's top; then the component falls apart at it.
    """
    n = len(parent)
    sums = [[0] * n for _ in weights]
    label, size, below = [0] * n, [0] * n, [[0] * n for _ in weights]
    waiting, labels = [list(range(n))] if n else [], 1
    while waiting:
        nodes = waiting.pop()
        top = nodes[0]
        if len(nodes) == 1:
            for to, w in zip(sums, weights, strict=True):
                to[top] += w[top]
            continue
        for v in nodes:
            size[v] = 1
        for v in reversed(nodes[1:]):
            size[parent[v]] += size[v]
        centroid = min((v for v in nodes if 2 * size[v] >= len(nodes)), key=size.__getitem__)
        for total, to, w in zip(below, sums, weights, strict=True):
            for v in nodes:
                total[v] = w[v]
            for v in reversed(nodes[1:]):
                total[parent[v]] += total[v]
            v, more = centroid, total[centroid]
            while v != top:
                to[v] += more
                v = parent[v]
            to[top] += more
        own = label[top]
        parts: dict[int, list[int]] = {own: []}
        label[centroid] = -1
        for v in nodes:
            if v == centroid:
                continue
            if v != top:
                label[v] = label[parent[v]]
            if label[v] == -1:
                label[v], labels = labels, labels + 1
                parts[label[v]] = []
            parts[label[v]].append(v)
        waiting.extend(p for p in parts.values() if p)
    return sums


_SUMS = "node long, depth long, part_node long, part_depth long, n_leaves long, saved_tokens long, under array<struct<node: long, depth: long>>"


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums within each component; the rows come sorted by component and depth."""
    def finish(rows: pa.Table) -> pa.RecordBatch:
        node, depth, above = (rows.column(c).to_pylist() for c in ("node", "depth", "parent"))
        place = {(n, d): i for i, (n, d) in enumerate(zip(node, depth, strict=True))}
        parent = [place[p, d - 1] if i else -1 for i, (p, d) in enumerate(zip(above, depth, strict=True))]
        sums = centroid_sums(parent, *(rows.column(c).to_pylist() for c in ("leaf", "saved")))
        columns = [rows.column(c).combine_chunks() for c in ("node", "depth", "part_node", "part_depth")]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.int64()) for x in sums), rows.column("under").combine_chunks()],
                                          ["node", "depth", "part_node", "part_depth", "n_leaves", "saved_tokens", "under"])

    kept: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        a, d = b.column("part_node").to_numpy(), b.column("part_depth").to_numpy()
        cuts = [0, *(np.flatnonzero((a[1:] != a[:-1]) | (d[1:] != d[:-1])) + 1).tolist(), b.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            piece = b.slice(start, end - start)
            if kept and (kept[-1].column("part_node")[0], kept[-1].column("part_depth")[0]) != (piece.column("part_node")[0], piece.column("part_depth")[0]):
                yield finish(pa.Table.from_batches(kept))
                kept = []
            kept.append(piece)
    if kept:
        yield finish(pa.Table.from_batches(kept))


def subtree_sums(paths: DataFrame, nodes: DataFrame, component_rows: int = COMPONENT_ROWS) -> DataFrame:
    """Rows (node, depth, n_leaves, saved_tokens): the number of leaves and the saved bytes of each node's subtree."""
    leaf, saved = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), (F.col("n_convs") - 1) * F.col("bytes")
    none = F.lit([]).cast("array<struct<node: long, depth: long>>")
    root = nodes.filter("depth = 0").agg(F.max("node")).first()[0]
    live = materialized(nodes.select(
        "node", "depth", "parent", "size", leaf.alias("leaf"), saved.alias("saved"), F.lit(root).cast("long").alias("part_node"),
        F.lit(0).cast("long").alias("part_depth"), none.alias("under")), "trie-parts")
    part = ["part_node", "part_depth"]
    finished, splits, steps = [], [], []
    while True:
        totals = live.groupBy(*part).agg(F.max("size").alias("total"))
        dealt = materialized(live.join(totals, part), "trie-parts")
        finished.append(dealt.filter(F.col("total") <= component_rows).drop("total", "size"))
        large = dealt.filter(F.col("total") > component_rows)
        if large.isEmpty():
            break
        # the deepest node with at least half of the component's turns below it; such nodes lie on one path
        chosen = large.filter(2 * F.col("size") >= F.col("total")).groupBy(*part).agg(
            F.min_by(F.struct("node", "depth", "size", "leaf", "saved", "under"), "size").alias("c"))
        centroids = materialized(chosen.select(*part, "c.*"), "centroids")
        splits.append(centroids)
        mark = centroids.select(*part, F.col("node").alias("c_node"), F.col("depth").alias("c_depth"), F.col("size").alias("c_size"))
        step = materialized(mark.join(paths, mark["c_node"] == paths["conv_id"]).filter(
            (F.col("depth") >= F.col("part_depth")) & (F.col("depth") < F.col("c_depth"))).select("node", "depth", "c_node", "c_depth", "c_size"), "centroid-paths")
        steps.append(step.select("node", "depth", "c_node", "c_depth"))
        at = paths.select(F.col("conv_id").alias("node"), F.col("depth").alias("c_depth"), F.col("node").alias("on"))
        next_at = paths.select(F.col("conv_id").alias("node"), (F.col("depth") - 1).alias("c_depth"), F.col("node").alias("child"))
        placed = large.drop("total").join(mark, part).filter("node <> c_node or depth <> c_depth").join(
            at, ["node", "c_depth"], "left").join(next_at, ["node", "c_depth"], "left")
        under = (F.col("depth") > F.col("c_depth")) & (F.col("on") == F.col("c_node"))
        less = step.select("node", "depth", F.col("c_size").alias("less"))
        live = materialized(placed.join(less, ["node", "depth"], "left").select(
            "node", "depth", "parent", (F.col("size") - F.coalesce("less", F.lit(0))).alias("size"), "leaf", "saved",
            F.when(under, F.col("child")).otherwise(F.col("part_node")).alias("part_node"),
            F.when(under, F.col("c_depth") + 1).otherwise(F.col("part_depth")).alias("part_depth"),
            F.when(under, F.concat("under", F.array(F.struct(F.col("c_node").alias("node"), F.col("c_depth").alias("depth"))))).otherwise(
                F.col("under")).alias("under")), "trie-parts")
    parts = finished[0]
    for f in finished[1:]:
        parts = parts.unionByName(f)
    ordered = parts.repartition(*part).sortWithinPartitions(*part, "depth", "node")
    local = ordered.select("node", "depth", "parent", "leaf", "saved", *part, "under").mapInArrow(_sum_parts, _SUMS)
    if not splits:
        return local.select("node", "depth", "n_leaves", "saved_tokens")
    local = materialized(local, "part-sums")
    tops = local.filter("node = part_node and depth = part_depth").select(F.explode("under").alias("c"), "n_leaves", "saved_tokens")
    for s in splits:
        own = F.concat("under", F.array(F.struct("node", "depth")))
        tops = tops.unionByName(s.select(F.explode(own).alias("c"), F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens")))
    total = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    below = materialized(tops.groupBy(F.col("c.node").alias("node"), F.col("c.depth").alias("depth")).agg(*total), "centroid-totals")
    added = steps[0]
    for s in steps[1:]:
        added = added.unionByName(s)
    added = added.join(below.select(F.col("node").alias("c_node"), F.col("depth").alias("c_depth"), "n_leaves", "saved_tokens"), ["c_node", "c_depth"])
    return local.select("node", "depth", "n_leaves", "saved_tokens").unionByName(below).unionByName(
        added.select("node", "depth", "n_leaves", "saved_tokens")).groupBy("node", "depth").agg(*total)


_PIECE = "node long, depth long, first long, piece binary, ends_sha256 string"


def _ends_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the nodes whose members lie inside this task; pieces of the first and the last node, which may go on in another."""
    out: list[tuple] = []
    key, first, text, opening = None, None, bytearray(), True

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()))], ["node", "depth", "first", "piece", "ends_sha256"])
        out.clear()
        return made

    for b in batches:
        for node, depth, conv in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if (node, depth) != key:
                if key is not None:
                    closed = not opening
                    out.append((*key, first, None, hashlib.sha256(text).hexdigest()) if closed else (*key, first, bytes(text), None))
                    opening = False
                key, first, text = (node, depth), conv, bytearray()
            elif len(text) > PIECE_BYTES:  # a node that long is passed on in pieces, also from the middle of a task
                out.append((*key, first, bytes(text), None))
                first, text, opening = conv, bytearray(), True
            text += (b"," if text else b"") + str(conv).encode()
            if len(out) >= 64:
                yield batch()
    if key is not None:
        out.append((*key, first, bytes(text), None))
    yield batch()


def _joined_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the nodes given in pieces, which come sorted."""
    def row():
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([digest.hexdigest()])],
                                          ["node", "depth", "ends_sha256"])

    key, digest = None, None
    for b in batches:
        for node, depth, piece in zip(*(b.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if (node, depth) == key:
                digest.update(b",")
            else:
                if key is not None:
                    yield row()
                key, digest = (node, depth), hashlib.sha256()
            digest.update(piece)
    if key is not None:
        yield row()


def end_digests(paths: DataFrame) -> DataFrame:
    """Rows (node, depth, ends_sha256) of the nodes that conversations end in."""
    ends = paths.filter("depth = length").select("node", "depth", "conv_id")
    order = ["depth", "node", "conv_id"]
    pieces = materialized(ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_ends_pieces, _PIECE), "end-pieces")
    whole = pieces.filter("ends_sha256 is not null").select("node", "depth", "ends_sha256")
    cut = pieces.filter("ends_sha256 is null").repartition("node", "depth").sortWithinPartitions("depth", "node", "first")
    return whole.unionByName(cut.mapInArrow(_joined_pieces, "node long, depth long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, lengths: DataFrame, component_rows: int = COMPONENT_ROWS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `turns` are (conv_id, depth, length, role, text), `lengths` (conv_id, length) of all conversations.
    """
    paths, nodes = paths_and_nodes(turns, lengths)
    nodes = materialized(nodes, "trie-nodes")
    sums = subtree_sums(paths, nodes, component_rows)
    return nodes.join(sums, ["node", "depth"]).join(end_digests(paths), ["node", "depth"], "left").select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))
