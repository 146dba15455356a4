"""Geography catalog: integrity problems and membership."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the monitored country and states that must not occur in it.
LATITUDE = (6.0, 37.0)
LONGITUDE = (68.0, 98.0)
FOREIGN_STATES = ["Iowa", "Texas", "California", "Wisconsin"]


def _repeated(geo: DataFrame, key: Sequence[str], problem: str, per_copy: bool) -> DataFrame:
    """One row per repeated key and extra copy, or one row in all."""
    copies = geo.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    subject = F.concat_ws(" / ", *key)
    if not per_copy:
        return copies.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 0).select(
            F.lit(problem).alias("problem"), F.lit("").alias("subject"))
    return copies.select(F.lit(problem).alias("problem"), subject.alias("subject"),
                         F.explode(F.sequence(F.lit(2), F.col("_n").cast("int"))).alias("_copy")).drop("_copy")


def _rows(geo: DataFrame, bad: Column, problem: str, subject: Column) -> DataFrame:
    return geo.where(F.coalesce(bad, F.lit(True))).select(F.lit(problem).alias("problem"), subject.alias("subject"))


def catalog_problems(geo: DataFrame) -> DataFrame:
    """All integrity problems (problem, subject); empty for a clean catalog."""
    code = F.col("district_code").cast("string")
    valid_code = F.coalesce(code.rlike(r"^\d+$"), F.lit(False))
    inside = F.col("latitude").between(*LATITUDE) & F.col("longitude").between(*LONGITUDE)
    region = F.col("region_name")
    return reduce(DataFrame.unionByName, [
        _repeated(geo, ["region_name"], "duplicate region_name values", per_copy=False),
        _repeated(geo, ["state_code", "district"], "duplicate geography record", per_copy=True),
        _rows(geo, ~valid_code, "district_code missing/invalid", region),
        _repeated(geo.where(valid_code), ["district_code"], "duplicate district_code", per_copy=True),
        _rows(geo, F.length("state_code") != 2, "state_code not 2 chars", region),
        _rows(geo, ~inside, "coordinates outside bounds", region),
        geo.where(F.col("state_ut").isin(FOREIGN_STATES)).select(
            F.lit("foreign state in catalog").alias("problem"), F.col("state_ut").alias("subject")),
    ])


def known_places(df: DataFrame, geo: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key is a known pair; `on` maps columns of `df` to columns of `geo`."""
    return _membership(df, geo, on, "left_semi")


def unknown_pairs(df: DataFrame, geo: DataFrame, on: dict[str, str]) -> DataFrame:
    return _membership(df, geo, on, "left_anti")


def _membership(df: DataFrame, geo: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    right = geo.select(*[F.col(g).cast("string").alias(f"_g_{g}") for g in on.values()]).distinct()
    condition = reduce(Column.__and__, [F.col(c).cast("string") == F.col(f"_g_{g}") for c, g in on.items()])
    return df.join(right, condition, how)


def mandi_options(geo: DataFrame) -> DataFrame:
    """Distinct non-empty market names per district."""
    names = [F.col(c) for c in ("mandi", "apmc", "mandi_apmc") if c in geo.columns]
    listed = geo.select("state_ut", "district", F.explode(F.array(*names)).alias("mandi"))
    return listed.where(F.coalesce("mandi", F.lit("")) != "").distinct()
