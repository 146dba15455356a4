"""Filtered slices: historical and latest records, location options and forecast cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.operators.dedupe import keep_first

DEFAULT_SEASON = "Whole Year"


def where_equal(df: DataFrame, filters: Mapping[str, str | None]) -> DataFrame:
    """Equality on every given filter, as plain predicates that reach the scan."""
    for column, value in filters.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


def historical(df: DataFrame, filters: Mapping[str, str | None] | None = None, start=None, end=None,
               date: str = "date") -> DataFrame:
    """The whole slice under filters and inclusive dates; unparseable dates drop only under a range."""
    out = where_equal(df, filters or {})
    text = dict(df.dtypes)[date] == "string"
    day = F.col(date).try_cast("timestamp") if text else F.col(date)
    if start is not None:
        out = out.where(day >= F.lit(start).cast("timestamp"))
    if end is not None:
        out = out.where(day <= F.lit(end).cast("timestamp"))
    return out


def latest_available(df: DataFrame, filters: Mapping[str, str | None] | None = None, date: str = "date") -> DataFrame:
    """All records of the newest day under the filters."""
    picked = where_equal(df, filters or {})
    newest = picked.agg(F.max(date)).scalar()
    return picked.where(F.col(date) == newest)


def latest_metadata(df: DataFrame, filters: Mapping[str, str | None] | None = None, date: str = "date") -> DataFrame:
    """latest_date and total_available of the latest slice."""
    per_day = where_equal(df, filters or {}).groupBy(date).agg(F.count(F.lit(1)).alias("n"))
    return per_day.agg(F.max(date).alias("latest_date"), F.max_by("n", date).alias("total_available"))


def location_options(geo: DataFrame, available: DataFrame | None = None,
                     state: str | None = None, district: str | None = None) -> DataFrame:
    """Distinct State > District > Mandi rows, restricted to regions with data and the selection."""
    places = where_equal(geo, {"state_ut": state, "district": district})
    if available is not None:
        places = places.join(available.select("region_name").distinct(), "region_name", "left_semi")
    return places.select("state_ut", "district", F.nullif(F.col("mandi_apmc"), F.lit("")).alias("mandi_apmc")).distinct()


def cascade_options(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Every non-null combination of the cascade levels present in the data."""
    for level in levels:
        df = df.where(F.col(level).isNotNull())
    return df.select(*levels).distinct()


def default_season(seasons: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per cell group the whole-year season if present, else the first in name order."""
    distinct = seasons.where(F.col("season").isNotNull()).select(*by, "season").distinct()
    return keep_first(distinct, by, [F.when(F.col("season") == DEFAULT_SEASON, 0).otherwise(1), F.col("season")])


def cell_series(panel: DataFrame, forecasts: DataFrame, cells: Column | None = None) -> DataFrame:
    """History and forecast points of the cells: year, production, band and kind."""
    keys = ["state", "district", "crop", "season"]
    none = F.lit(None).cast("double")
    history = panel.where(F.col("year_start").isNotNull() & F.col("production").isNotNull()).select(
        *keys, F.col("year_start").cast("long").alias("year"), F.col("production").alias("production_t"),
        none.alias("lower_t"), none.alias("upper_t"), F.lit("history").alias("kind"))
    ahead = forecasts.select(
        *keys, F.substring("forecast_year", 1, 4).cast("long").alias("year"),
        F.col("forecast_production_tonnes").alias("production_t"),
        F.col("forecast_lower_tonnes").alias("lower_t"), F.col("forecast_upper_tonnes").alias("upper_t"),
        F.lit("forecast").alias("kind"))
    if cells is not None:
        history, ahead = history.where(cells), ahead.where(cells)
    return history.unionByName(ahead)
