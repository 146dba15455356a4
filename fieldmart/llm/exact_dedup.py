"""Exact duplicates by deterministic block naming, in DataFrame operations only.

Each normalised text is cut into fixed-size blocks of bytes. The distinct blocks are sorted
and named by integers; then adjacent names of a document are paired, the distinct pairs are
sorted and named, and so on until each document has a single name. Two texts have the same
(level, name) exactly when they are equal: a name stands for one block or one pair only.

A block travels to its name under a 128-bit fingerprint instead of its bytes. While naming,
all blocks of one fingerprint are gathered as a set; should two different blocks ever share
one, all blocks are fingerprinted anew with another seed, so no collision can pass.

Scale: the bytes of the distinct blocks are shuffled once, combined before the shuffle, so a
block that a third of all documents share is one row per task. Names join back by a
sort-merge join between two exchanges, which adaptive execution splits at hot names.
Every level is a written table; nothing is collected but the largest block count.

Defined results: a null text is an empty text; the row with the largest doc_id stays (null
ids are smallest; of repeated rows with that id one row stays); every input row gives one
output row; other columns of the input are left out; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import first_of_each, lower_ascii, materialized

BLOCK_BYTES = 4096


def fingerprint(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed), block), F.xxhash64(F.lit(2 * seed + 1), block)]


def _blocks(data: Column, block_bytes: int) -> Column:
    last = F.greatest(F.ceil(F.length(data) / block_bytes) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)))


def _name(distinct: DataFrame, *keys: str) -> DataFrame:
    """Each row's place in the order of its keys, as an integer that no other row has."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _name_blocks(texts: DataFrame, block_bytes: int, seed: int, marks: Callable) -> tuple[DataFrame, DataFrame]:
    """Rows with their blocks' fingerprints, and the named blocks."""
    cut = texts.withColumn("blocks", _blocks(F.col("data"), block_bytes))
    marked = F.transform("blocks", lambda b: F.struct(*[m.alias(f"f{i}") for i, m in enumerate(marks(b, seed))]))
    rows = materialized(cut.select("doc_id", F.monotonically_increasing_id().alias("row"), F.length("data").cast("long").alias("n_bytes"),
                                   F.sha2("data", 256).alias("text_sha256"), marked.alias("marks")), "block-rows")
    each = cut.select(F.explode("blocks").alias("block")).select(
        *[m.alias(f"f{i}") for i, m in enumerate(marks(F.col("block"), seed))], "block")
    sets = each.groupBy("f0", "f1").agg(F.collect_set("block").alias("same"))
    names = _name(sets, "f0", "f1").select("f0", "f1", "name", (F.size("same") > 1).alias("clash"))
    return rows, materialized(names, "block-names")


def text_names(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               block_bytes: int = BLOCK_BYTES, marks: Callable = fingerprint) -> DataFrame:
    """One row per document: doc_id, row, n_bytes, text_sha256 and its identity (level, name)."""
    texts = docs.select(F.col(id_column).alias("doc_id"), lower_ascii(F.col(text_column)).cast("binary").alias("data"))
    seed = 0
    while True:
        rows, names = _name_blocks(texts, block_bytes, seed, marks)
        if names.filter("clash").isEmpty():
            break
        seed += 1
    most = rows.agg(F.max(F.size("marks"))).first()[0] or 1
    placed = rows.select("row", F.size("marks").alias("n"), F.posexplode("marks").alias("i", "m")).select("row", "n", "i", "m.*")
    level = materialized(placed.join(names.select("f0", "f1", "name"), ["f0", "f1"]).select("row", "n", "i", "name"), "names-0")
    done = [level.filter("n = 1").select("row", F.lit(0).alias("level"), "name")]
    k = 0
    while most > 1:
        k, most = k + 1, (most + 1) // 2
        side = lambda odd: F.max(F.when(F.col("i") % 2 == odd, F.col("name")))
        pairs = materialized(level.filter("n > 1").groupBy("row", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.floor(F.col("i") / 2).cast("int").alias("i")).agg(
            side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b")), f"pairs-{k}")
        named = materialized(_name(pairs.select("a", "b").distinct(), "a", "b"), f"pair-names-{k}")
        level = materialized(pairs.join(named, ["a", "b"]).select("row", "n", "i", "name"), f"names-{k}")
        done.append(level.filter("n = 1").select("row", F.lit(k).alias("level"), "name"))
    named = done[0]
    for d in done[1:]:
        named = named.unionByName(d)
    return rows.drop("marks").join(named, "row")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     block_bytes: int = BLOCK_BYTES, marks: Callable = fingerprint) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_bytes."""
    named = materialized(text_names(docs, id_column, text_column, block_bytes, marks), "text-names")
    groups = materialized(named.groupBy("level", "name").agg(
        F.max("doc_id").alias("keep_id"), F.coalesce(F.max_by("row", "doc_id"), F.min("row")).alias("keep_row"),
        F.count("*").alias("group_size")), "text-groups")
    return named.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", "n_bytes")


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows repeated with id and text one."""
    kept = exact_duplicates(docs, id_column, text_column).filter("kept").select(
        F.col("doc_id").alias("__llm_kept_id"), F.col("text_sha256").alias("__llm_kept_sha"))
    marked = docs.withColumn("__llm_id", F.col(id_column)).withColumn("__llm_sha", F.sha2(lower_ascii(F.col(text_column)).cast("binary"), 256))
    same = F.col("__llm_id").eqNullSafe(F.col("__llm_kept_id")) & (F.col("__llm_sha") == F.col("__llm_kept_sha"))
    return first_of_each(marked.join(kept, same, "left_semi"), "__llm_id", "__llm_sha").select(*docs.columns)
