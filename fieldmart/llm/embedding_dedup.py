"""Near-duplicate vectors by cross-polytope hashing, with every link verified.

Equal vectors are one class. Each class is rotated by three rounds of random signs and the
fast Hadamard transform; its hash is the largest coordinate and its sign. `HASHES` such
hashes make a bucket of a table, there are `TABLES` tables, and a class also probes the
buckets of its second choices. In a bucket the exact cosine in double precision decides.

A row carries the bucket numbers of all tables, so a pair that meets several times is
counted in its first meeting alone; a task puts out link counts and the edges of a spanning
forest, never pairs. A bucket of more than `BUCKET_ROWS` rows is dealt to several tasks,
each with a share of the index rows and all query rows as a stream: exact, and bounded.

The index holds all rows; links below the threshold are never reported. What share of the
links is found is measured in the tests against brute force.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; vectors of different length link with nothing; ids may be null or
repeated (a null id takes no part in component ids unless alone); every input row gives one
output row; other columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import materialized
from fieldmart.llm.components import components, union

THRESHOLD = 0.95
TABLES = 6
HASHES = 2
SEED = 7
BUCKET_ROWS = 4096
QUERY_ROWS = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, by halving steps."""
    n, step = x.shape[1], 1
    while step < n:
        y = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def buckets(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers: own ones (rows x TABLES), and probes (rows x TABLES x HASHES) with one hash at its second choice."""
    rows, dim = vectors.shape
    n = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((rows, n))
    padded[:, :dim] = vectors
    rng = np.random.default_rng([SEED, n])
    own, probes = np.zeros((rows, TABLES), np.int64), np.zeros((rows, TABLES, HASHES), np.int64)
    at = np.arange(rows)
    for t in range(TABLES):
        first, second = [], []
        for _ in range(HASHES):
            x = padded
            for _ in range(3):
                x = hadamard(x * rng.choice((-1.0, 1.0), n))
            order = np.argpartition(-np.abs(x), 1, axis=1)[:, :2]
            swap = np.abs(x[at, order[:, 0]]) < np.abs(x[at, order[:, 1]])
            order[swap] = order[swap][:, ::-1]
            for out, c in ((first, order[:, 0]), (second, order[:, 1])):
                out.append(2 * c + (x[at, c] < 0))
        base = np.full(rows, dim * TABLES + t, np.int64)
        for choice, target in [(first, own[:, t])] + [(first[:h] + [second[h]] + first[h + 1:], probes[:, t, h]) for h in range(HASHES)]:
            number = base.copy()
            for c in choice:
                number = number * (2 * n) + c
            target[:] = number
    return own, probes


def _classes(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """Written rows (vec_id, c1, c2, usable) and written classes of equal usable vectors."""
    v = F.col("v")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")).select(
        "vec_id", "v", F.coalesce(fine, F.lit(False)).alias("usable"), F.xxhash64(F.lit(1), "v").alias("c1"), F.xxhash64(F.lit(2), "v").alias("c2"))
    classes = rows.filter("usable").groupBy("c1", "c2", "v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"))
    return rows.drop("v"), materialized(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")


def _hashed(classes: DataFrame) -> DataFrame:
    """Written classes with their bucket numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths):
                part = b.filter(pa.array(lengths == dim))
                own, probes = buckets(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, int(dim)))
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                         for x in (own, probes.reshape(len(probes), -1))]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], ["cls", "n", "v", "own", "probes"])

    return materialized(classes.select("cls", "n", "v").mapInArrow(
        run, "cls long, n long, v array<double>, own array<long>, probes array<long>"), "vector-buckets")


def _dealt(hashed: DataFrame) -> DataFrame:
    """One row per class and bucket it lies in or probes, a large bucket's rows once per share; index rows first."""
    lies = hashed.select(F.explode("own").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("rows"))
    large = materialized(lies.filter(F.col("rows") > BUCKET_ROWS).select(
        "bucket", F.ceil(F.col("rows") / BUCKET_ROWS).cast("int").alias("shares")), "large-buckets")
    both = F.concat(F.transform("own", lambda b: F.struct(b.alias("bucket"), F.lit(True).alias("lies"))),
                    F.transform("probes", lambda b: F.struct(b.alias("bucket"), F.lit(False).alias("lies"))))
    rows = hashed.select("*", F.explode(both).alias("at")).select("at.*", "cls", "n", "v", "own", "probes")
    shares = rows.join(large, "bucket", "left").withColumn("shares", F.coalesce("shares", F.lit(1))).withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    index = F.col("lies") & (F.pmod(F.xxhash64("cls"), F.col("shares")) == F.col("share"))
    return shares.withColumn("index", index).select("bucket", "share", "index", "lies", "cls", "n", "v", "own", "probes")


def _first_meeting(qo, qp, io, ip, table, q_lies, q_smaller):
    """Whether no earlier table, and no earlier kind in this table, brings the two together."""
    same = qo == io
    probes = lambda p, o: (p == o[:, :, None]).any(axis=2)
    q_finds, i_finds = probes(qp, io), probes(ip, qo)
    low, high = np.where(q_smaller[:, None], q_finds, i_finds), np.where(q_smaller[:, None], i_finds, q_finds)
    kind = np.where(same, 0, np.where(low, 1, np.where(high, 2, 9)))
    first = (kind < 9).argmax(axis=1)
    now = np.where(q_lies, 0, np.where(q_smaller, 1, 2))
    return (first == table) & (kind[np.arange(len(kind)), first] == now)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream sorted rows group by group: index rows are kept, query rows are compared in small batches."""
    group, index = None, None
    added: dict[int, int] = {}
    parent: dict[int, int] = {}

    def arrays(b: pa.RecordBatch):
        column = {n: b.column(i) for i, n in enumerate(("bucket", "share", "index", "lies", "cls", "n", "v", "own", "probes"))}
        table = lambda n: column[n].flatten().to_numpy().reshape(b.num_rows, -1)
        return {"lies": column["lies"].to_numpy(zero_copy_only=False).astype(bool), "index": column["index"].to_numpy(zero_copy_only=False).astype(bool),
                "cls": column["cls"].to_numpy(), "n": column["n"].to_numpy(), "v": table("v"), "own": table("own"),
                "probes": table("probes").reshape(b.num_rows, TABLES, HASHES)}

    def compare(q, i, bucket):
        q_norm, i_norm = np.sqrt((q["v"] ** 2).sum(axis=1)), np.sqrt((i["v"] ** 2).sum(axis=1))
        near = (q["v"] @ i["v"].T) / np.outer(q_norm, i_norm) >= THRESHOLD
        a, b = np.nonzero(near)
        # of two rows that both lie here the smaller asks; a row never asks itself
        use = (q["cls"][a] != i["cls"][b]) & (~q["lies"][a] | (q["cls"][a] < i["cls"][b]))
        a, b = a[use], b[use]
        if not len(a):
            return
        table = np.argmax(i["own"][b] == bucket, axis=1)
        first = _first_meeting(q["own"][a], q["probes"][a], i["own"][b], i["probes"][b], table, q["lies"][a], q["cls"][a] < i["cls"][b])
        a, b = a[first], b[first]
        for x, y, nx, ny in zip(q["cls"][a].tolist(), i["cls"][b].tolist(), q["n"][a].tolist(), i["n"][b].tolist(), strict=True):
            added[x] = added.get(x, 0) + ny
            added[y] = added.get(y, 0) + nx
            union(parent, x, y)

    def emit():
        from fieldmart.llm.components import root

        nodes = list(added)
        out = pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(parent, n) for n in nodes], pa.int64()),
                                          pa.array([added[n] for n in nodes], pa.int64())], ["cls", "with", "links"])
        added.clear()
        parent.clear()
        return out

    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        start = 0
        while start < len(keys):
            end = start
            while end < len(keys) and keys[end] == keys[start] and end - start < QUERY_ROWS:
                end += 1
            part = arrays(batch.slice(start, end - start))
            if keys[start] != group:
                group, index = keys[start], None
                if len(added) > 50_000:
                    yield emit()
            own = {k: v[part["index"]] for k, v in part.items()}
            if len(own["cls"]):
                if index is not None:
                    compare(own, index, group[0])       # earlier index rows are asked by the later ones and
                    compare(index, own, group[0])       # the other way about
                index = own if index is None else {k: np.concatenate([index[k], own[k]]) for k in own}
                compare(own, own, group[0])
            asks = {k: v[~part["index"]] for k, v in part.items()}
            if len(asks["cls"]) and index is not None:
                compare(asks, index, group[0])
            start = end
    yield emit()


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows, classes = _classes(vectors, id_column, vector_column)
    dealt = _dealt(_hashed(classes)).repartition("bucket", "share").sortWithinPartitions("bucket", "share", F.desc("index"))
    links = materialized(dealt.mapInArrow(_links, "cls long, with long, links long"), "vector-links")
    counts = links.groupBy("cls").agg(F.sum("links").alias("links"))
    member = components(links, "cls", "with").withColumnRenamed("node", "cls")
    named = materialized(classes.select("c1", "c2", "cls", "n", "first_id").join(counts, "cls", "left").join(member, "cls", "left").withColumn(
        "component", F.coalesce("component", "cls")), "vector-components")
    lowest = materialized(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "vector-lowest")
    known = materialized(named.join(lowest, "component").select(
        "c1", "c2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "vector-known")
    out = rows.join(known.withColumn("usable", F.lit(True)), ["c1", "c2", "usable"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
