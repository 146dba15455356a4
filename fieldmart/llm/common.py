"""Shared helpers: written tables, normalised text, row keys, Arrow row streams."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldmart.session import materialized

#: The only letters that lower-casing touches, and what separates words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows turned into Python objects at a time inside a task.
ROWS_AT_A_TIME = 256

__all__ = ["LOWER", "ROWS_AT_A_TIME", "UPPER", "WORD", "first_of_each", "lower_ascii", "materialized", "row_key", "ship", "slices", "text_rows"]


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, unless their Python path has it already."""
    root, context = Path(__file__).resolve().parents[2], spark.sparkContext
    on_path = any(p and Path(p).resolve() == root for p in os.environ.get("PYTHONPATH", "").split(os.pathsep))
    if not on_path and not any(f.startswith("fieldmart") for f in context._python_includes):
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/fieldmart", "zip", root, "fieldmart")
        context.addPyFile(archive)


def lower_ascii(text: Column) -> Column:
    """The text with A-Z lower-cased and null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Two longs that name a row the same way in every scan: rows equal in both are equal in id and text."""
    return [F.coalesce(doc_id.cast("long"), F.lit(-1)).alias("k1"),
            F.xxhash64(doc_id.isNull(), F.coalesce(text, F.lit(""))).alias("k2")]


def first_of_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of each key; rows of one key are taken to be alike."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(keys[0]))
    return rows.withColumn("__llm_place", place).filter("__llm_place = 1").drop("__llm_place")


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_A_TIME) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that only few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_rows(docs: DataFrame, id_column: str, text_column: str, schema: str,
              build: Callable[[Iterator[tuple[pa.Array, list[str]]]], Iterator[list]]) -> DataFrame:
    """Map (ids, texts) batches to columns of `schema`; null texts are empty and all other columns are left out."""
    arrow = docs.sparkSession.createDataFrame([], schema).schema
    names = arrow.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((b.column(0), [t or "" for t in b.column(1).to_pylist()]) for b in slices(batches))
        for columns in build(pairs):
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_column, text_column).mapInArrow(run, arrow)
