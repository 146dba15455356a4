"""Row numbers over a whole table or a group, without a window over the rows.

The rows are dealt out by ranges of the order and sorted in their tasks. Each task's number
of rows is a table with one row per task; running totals of that table are the offsets that
turn a row's place in its task into its place in the table. A group's first place, joined back,
gives the place in the group. So a group that holds most rows, or all of them, is spread over
tasks like any other. What a window or a broadcast sees is one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.session import materialized

#: `monotonically_increasing_id` keeps a row's place in its task in the lower bits.
_TASK_BITS = 33


def _columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_place(df: DataFrame, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """Add the row's number from 0 in the order; rows equal in it are numbered in any order.

    The sorted rows are a written table, so numbers stay the same however often they are read.
    """
    # equal rows are told apart by their place in the input, so that they too are dealt out
    dealt = df.withColumn("_tie", F.monotonically_increasing_id())
    columns = [*_columns(order), F.col("_tie")]
    sorted_rows = dealt.repartitionByRange(*columns).sortWithinPartitions(*columns).drop("_tie")
    written = materialized(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "places")
    task = F.shiftright("_at", _TASK_BITS)
    counts = written.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))  # one row per task
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_offset") + F.col("_at") - F.shiftleft(task, _TASK_BITS)
    return written.withColumn("_task", task).join(offsets, "_task").select(*df.columns, place.cast("long").alias(name))


def with_group_place(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "place",
                     size: str | None = None) -> DataFrame:
    """Add the row's number from 0 in its group, and the group's number of rows; null keys are a group."""
    placed = with_place(df, [*keys, *order], "_place")
    groups = placed.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size"))
    same = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    sized = [F.col("_size").alias(size)] if size else []
    return placed.join(groups, same).select(*df.columns, (F.col("_place") - F.col("_first")).alias(name), *sized)


def with_codes(df: DataFrame, reference: DataFrame, columns: Sequence[str], suffix: str = "_ordinal") -> DataFrame:
    """Add the number of each column's value among the distinct sorted values of `reference`, from 0.

    A value that `reference` lacks, and null, get the number of distinct values, as one unknown label.
    """
    for c in columns:
        values = reference.select(F.col(c).alias(f"_v_{c}")).filter(F.col(f"_v_{c}").isNotNull()).distinct()
        codes = with_place(values, [f"_v_{c}"], f"_c_{c}")
        unknown = codes.agg(F.count(F.lit(1))).scalar()
        df = df.join(codes, F.col(c) == F.col(f"_v_{c}"), "left").withColumn(
            f"{c}{suffix}", F.coalesce(f"_c_{c}", unknown).cast("double")).drop(f"_v_{c}", f"_c_{c}")
    return df
