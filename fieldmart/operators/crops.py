"""Crop-by-year panel and the integrated crop summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.text import match_key
from fieldmart.operators.climate import district_weather
from fieldmart.operators.dedupe import keep_first
from fieldmart.operators.market import PRICE_UNIT, commodity_block

IDENTITY = ["state", "district", "crop", "season", "year_start"]
PANEL_COLUMNS = ["state", "district", "crop", "crop_type", "season", "year_start",
                 "year", "area", "production", "yield", "state_code", "district_code"]
SUMMARY_KEY = ["state", "district", "crop", "crop_type"]
MARKET_FIELDS = ["n_market_records", "n_markets", "latest_market_date", "latest_modal_price",
                 "latest_min_price", "latest_max_price", "avg_modal_price_7d", "modal_price_change_pct_7d"]
WEATHER_FIELDS = ["weather_status", "obs_temp_max_c", "obs_temp_min_c", "obs_precip_mm", "obs_humidity_pct"]


def crop_year_panel(agri: DataFrame, order: Sequence[str] = ("id",)) -> DataFrame:
    """State, district, crop, season and year grain: rows without a year drop out."""
    rows = agri.withColumn("year_start", F.col("year_start").try_cast("int")).where(
        F.col("year_start").isNotNull())
    first = keep_first(rows, IDENTITY, [c for c in order if c in agri.columns])
    return first.select(*[c for c in PANEL_COLUMNS if c in first.columns])


def crop_block(panel: DataFrame) -> DataFrame:
    """Per location and crop: history, latest season and totals.

    Area sums to 0 without values, production stays null. A null key drops the row. The
    years are counted as a set: a panel group holds at most the years on record, and a
    distinct count would cost further shuffles.
    """
    rows = panel
    for k in SUMMARY_KEY:
        rows = rows.where(F.col(k).isNotNull())
    when = F.struct("year_start", "season")
    latest = F.struct("year_start", "season", "area", "production", "yield")
    known = {c: F.min_by(c, F.when(F.col(c).isNotNull(), when)).alias(c)
             for c in ("state_code", "district_code")}
    return rows.groupBy(*SUMMARY_KEY).agg(
        *known.values(),
        F.count(F.lit(1)).alias("n_year_season_rows"),
        F.size(F.collect_set("year_start")).cast("long").alias("years_observed"),
        F.min("year_start").alias("first_year"),
        F.max("year_start").alias("last_year"),
        F.max_by(latest, when).alias("_latest"),
        F.coalesce(F.sum("area"), F.lit(0.0)).alias("total_area_ha"),
        F.sum("production").alias("total_production_t"),
    ).select(
        *SUMMARY_KEY, "state_code", "district_code", "n_year_season_rows", "years_observed",
        "first_year", "last_year",
        F.col("_latest.year_start").alias("latest_year"),
        F.col("_latest.season").alias("latest_season"),
        F.col("_latest.area").alias("latest_area_ha"),
        F.col("_latest.production").alias("latest_production_t"),
        F.col("_latest.yield").alias("latest_yield_t_per_ha"),
        "total_area_ha", "total_production_t",
    )


def match_market(crops: DataFrame, block: DataFrame, include_state: bool = False) -> DataFrame:
    """Attach the market block by folded district and normalized name, never fuzzily.

    When several commodities normalize to one key the last in name order counts.
    With `include_state` equal district names of two states stay apart.
    """
    place = [F.lower("district").alias("_d"), *([F.lower("state").alias("_st")] if include_state else [])]
    on = ["_d", "_crop", *(["_st"] if include_state else [])]
    left = crops.select("*", *place, match_key(F.col("crop")).alias("_crop"))
    right = (
        block.select(*place, match_key(F.col("commodity")).alias("_crop"),
                     F.struct("commodity", *MARKET_FIELDS).alias("_m"),
                     F.struct("district", "commodity").alias("_order"))
        .groupBy(*on).agg(F.max_by("_m", "_order").alias("_m"))
    )
    joined = left.join(right, on, "left")
    found = F.col("_m").isNotNull()
    counts = ("n_market_records", "n_markets")
    return joined.select(
        *[F.col(f"`{c}`") for c in crops.columns],
        F.when(found, "matched").otherwise("no_records").alias("market_status"),
        F.col("_m.commodity").alias("matched_commodity"),
        *[(F.coalesce(F.col(f"_m.{c}"), F.lit(0)) if c in counts else F.col(f"_m.{c}")).alias(c)
          for c in MARKET_FIELDS],
    )


def match_weather(crops: DataFrame, weather: DataFrame) -> DataFrame:
    """Attach district weather by folded district; without one the status is no_records."""
    block = weather.select(F.lower("district").alias("_d"), F.col("district").alias("_name"), *WEATHER_FIELDS)
    one = keep_first(block, ["_d"], [F.col("_name").desc()]).drop("_name")
    joined = crops.withColumn("_d", F.lower("district")).join(one, "_d", "left").drop("_d")
    return joined.withColumn("weather_status", F.coalesce("weather_status", F.lit("no_records")))


def crop_summary(agri: DataFrame, trades: DataFrame, region_features: DataFrame,
                 price_unit: str | None = PRICE_UNIT, tie: Sequence[str] = (), include_state: bool = False) -> DataFrame:
    """Agriculture, market and weather blocks per location and crop.

    With `include_state` equal district names of two states have market blocks of their own.
    """
    crops = crop_block(crop_year_panel(agri))
    keys = [*(["state"] if include_state else []), "district", "commodity"]
    matched = match_market(crops, commodity_block(trades, price_unit, keys, tie), include_state)
    return match_weather(matched, district_weather(region_features)).withColumn(
        "weather_warning", F.lit(None).cast("string"))
