"""Exact group quantiles that never bring one group into one task.

The built-in exact `percentile` keeps every distinct value of a group in one
aggregation buffer, so a group with a third of all rows would land in one task.
Here the values are first counted (combined before the shuffle, so copies of one
value are cheap). Each value has an order-preserving 64-bit image; its leading bits are the
value's bucket. Only the buckets that hold wanted ranks are read value by value, and of
those a bucket with more than `SPLIT_VALUES` distinct values is split again by its next
bits first, so that a group whose values lie close together is divided like any other. What
is left differs in the last bits only and is bounded. The result is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.session import materialized

#: Leading bits of the image that name a bucket: sign, exponent and 12 bits of the fraction, about 0.02 % wide.
BUCKET_BITS = 24
#: Further bits by which a large bucket is split; the 20 bits behind them bound what one task orders.
SPLIT_BITS = 20
#: Distinct values of a bucket that a task orders without another split.
SPLIT_VALUES = 100_000

_FRACTION = 52  # bits of a double's fraction


def ordered_image(value: Column) -> Column:
    """A long in the same order as the double: its bits, negated below zero; both zeros have 0."""
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("double")
    power = F.pow(F.lit(2.0), guess)
    # the logarithm may round over a power of two; below the least exponent the fraction has no leading one
    exponent = F.greatest(guess + F.when(size < power, -1.0).when(size >= power * 2, 1.0).otherwise(0.0), F.lit(-1022.0))
    fraction = size / F.pow(F.lit(2.0), exponent)
    one = float(1 << _FRACTION)
    image = (exponent + 1022.0).cast("long") * F.lit(1 << _FRACTION) + (fraction * one).cast("long")
    positive = F.when(size == float("inf"), F.lit(2047 << _FRACTION)).when(size > 0, image).otherwise(F.lit(0).cast("long"))
    return F.when(value < 0, -positive).otherwise(positive)


def _bucket(value: Column) -> Column:
    """Never null, so joins add no filter to one branch only."""
    return F.coalesce(F.shiftright(ordered_image(value), 64 - BUCKET_BITS), F.lit(0).cast("long"))


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float],
                    weight: str | None = None, count_as: str | None = None, split_values: int = SPLIT_VALUES,
                    written: bool = False) -> DataFrame:
    """Linear-interpolated quantiles of `value` per key, nulls ignored.

    `quantiles` maps output column names to probabilities, `weight` names a column of
    copy counts (0 for a null value), `count_as` an output column for the number of
    values. Without keys the result has one row (none when there is no value). With `written`
    the counted values become a table that all steps read; without it Spark counts them
    again wherever it can't reuse a shuffle.
    """
    names, v = list(keys), F.col(value).cast("double")
    if names:  # a leading hash lets the sorts compare one long before any text
        df = df.withColumn("_k", F.xxhash64(*names))
    keys = ["_k", *names] if names else []
    present = F.col(weight) > 0 if weight else v.isNotNull() & ~F.isnan(v)
    counted = (
        df.where(present)
        .groupBy(*keys, v.alias("_v"))
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_c"))
        .withColumn("_b", _bucket(F.col("_v")))
    )
    if written:
        counted = materialized(counted, "counted_values")

    def rank(p: float, side):
        return side(F.lit(float(p)) * (F.col("_total") - 1)).cast("long")

    def wanted(start: Column, end: Column) -> Column:
        """Whether a range of ranks holds one that is asked for."""
        ranks = [rank(p, side) for p in quantiles.values() for side in (F.floor, F.ceil)]
        held = F.lit(False)
        for r in ranks:
            held = held | ((start <= r) & (r < end))
        return held

    def running(part: Sequence[str], order: str, count: str) -> Column:
        return F.sum(count).over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))

    # bucket totals only, a bounded number per group
    buckets = counted.groupBy(*keys, "_b").agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d")).withColumns({
        "_total": F.sum("_n").over(Window.partitionBy(*keys)), "_before": running(keys, "_b", "_n") - F.col("_n")})
    targets = buckets.where(wanted(F.col("_before"), F.col("_before") + F.col("_n"))).select(*keys, "_b", "_d", "_total", "_before")

    small = counted.join(targets.where(F.col("_d") <= split_values).drop("_d"), [*keys, "_b"])
    part = F.shiftright(ordered_image(F.col("_v")), 64 - BUCKET_BITS - SPLIT_BITS)
    large = counted.join(targets.where(F.col("_d") > split_values).drop("_d"), [*keys, "_b"]).withColumn("_s", part)
    # totals of at most 2 ** SPLIT_BITS parts of a bucket
    parts = large.groupBy(*keys, "_b", "_s", "_total", "_before").agg(F.sum("_c").alias("_n")).withColumn(
        "_before", F.col("_before") + running([*keys, "_b"], "_s", "_n") - F.col("_n"))
    chosen = parts.where(wanted(F.col("_before"), F.col("_before") + F.col("_n"))).select(*keys, "_s", F.col("_before").alias("_from"))
    divided = large.join(chosen, [*keys, "_s"])
    ranked = small.select(*keys, "_v", "_c", "_total", (F.col("_before") + running([*keys, "_b"], "_v", "_c")).alias("_end")).unionByName(
        divided.select(*keys, "_v", "_c", "_total", (F.col("_from") + running([*keys, "_s"], "_v", "_c")).alias("_end")))
    ranked = ranked.withColumn("_start", F.col("_end") - F.col("_c"))

    def holds(r):
        return (F.col("_start") <= r) & (r < F.col("_end"))

    picks, outputs = [], []
    for i, (name, p) in enumerate(quantiles.items()):
        lo, hi = rank(p, F.floor), rank(p, F.ceil)
        picks += [F.max(F.when(holds(lo), F.col("_v"))).alias(f"_lo{i}"),
                  F.max(F.when(holds(hi), F.col("_v"))).alias(f"_hi{i}"),
                  F.max(F.lit(float(p)) * (F.col("_total") - 1) - lo).alias(f"_t{i}")]
        outputs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_t{i}"))
                       .alias(name))
    if count_as:
        picks.append(F.max("_total").alias(count_as))
        outputs.append(F.col(count_as))
    result = ranked.groupBy(*keys).agg(*picks)
    if not keys:
        result = result.where(F.col("_t0").isNotNull())
    return result.select(*names, *outputs)


def attach_quantiles(df: DataFrame, cohort: DataFrame, wanted: Mapping[str, tuple[str, float]],
                     count_as: str | None = None) -> DataFrame:
    """Add cohort-wide quantiles to every row as one scalar subquery (no join).

    `wanted` maps an output column to (cohort column, probability). All columns are
    ranked in one pass over the cohort in long form; `count_as` adds the number of
    values of the first wanted column.
    """
    columns = list(dict.fromkeys(column for column, _ in wanted.values()))
    probabilities = {f"_q{i}": p for i, p in enumerate(dict.fromkeys(p for _, p in wanted.values()))}
    name_of = {p: name for name, p in probabilities.items()}
    long = cohort.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "_column", "_value")
    ranked = group_quantiles(long, ["_column"], "_value", probabilities, count_as="_n")
    picks = [F.max(F.when(F.col("_column") == column, F.col(name_of[p]))).alias(name)
             for name, (column, p) in wanted.items()]
    if count_as:
        picks.append(F.max(F.when(F.col("_column") == columns[0], F.col("_n"))).alias(count_as))
    row = ranked.agg(*picks)
    out = df.withColumn("_row", row.select(F.struct("*")).scalar())
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "_row.*")
