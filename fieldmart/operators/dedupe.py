"""Business-key deduplication, reject splitting and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key: the first by `order`, then by all remaining columns.

    The filter on `row_number` lets Spark cut each map task to one row per key
    before the shuffle, so many copies of one key stay cheap. The leading hash lets the
    sorts compare one long before any text.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in key]
    window = Window.partitionBy("_k", *key).orderBy(*(order or []), *rest)
    return (df.withColumn("_k", F.xxhash64(*key)).withColumn("_rn", F.row_number().over(window))
            .where(F.col("_rn") == 1).drop("_rn", "_k"))


def duplicate_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of second and later occurrences of the key, one row."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def price_contradiction(low: str = "min_price", mid: str = "modal_price",
                        high: str = "max_price") -> Column:
    """min above modal or modal above max; a missing price contradicts nothing."""
    return F.coalesce(F.col(low) > F.col(mid), F.lit(False)) | F.coalesce(
        F.col(mid) > F.col(high), F.lit(False))


def quarantine(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): a null condition keeps the row, so no row is lost or doubled."""
    flag = F.coalesce(bad, F.lit(False))
    return df.where(~flag), df.where(flag)
