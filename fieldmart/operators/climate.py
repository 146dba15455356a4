"""Daily weather features joined to the geography, and region summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.labels import weather_window
from fieldmart.operators.dedupe import keep_first

GEO_COLUMNS = ["state_ut", "state_code", "district", "mandi_apmc", "latitude", "longitude"]
SUMMARY_KEYS = ["region_name", "state_ut", "state_code", "district", "mandi_apmc"]


def mean_temperature(high: str = "temp_max_c", low: str = "temp_min_c") -> Column:
    return (F.col(high) + F.col(low)) / 2


def one_per_region(geo: DataFrame, columns: list[str]) -> DataFrame:
    """The geography with one row per region."""
    return keep_first(geo.select("region_name", *columns), ["region_name"])


def daily_features(weather: DataFrame, geo: DataFrame, market_daily: DataFrame | None = None) -> DataFrame:
    """Region by day: weather, geography and, when given, the daily market signal.

    `market_daily` has one row per region and day, so the grain stays the same. No
    join is hinted: Spark broadcasts the geography below its own size limit and
    splits hot regions of a sort-merge join above it.
    """
    weather_columns = ["region_name", "date", "temp_max_c", "temp_min_c",
                       mean_temperature().alias("temp_avg_c"),
                       "precipitation_mm", "humidity_pct", "windspeed_max_kmh"]
    out = weather.select(*weather_columns).join(one_per_region(geo, GEO_COLUMNS), "region_name", "left")
    if market_daily is not None:
        out = out.join(market_daily, ["region_name", "date"], "left")
    return out


def region_summary(daily: DataFrame) -> DataFrame:
    """Per region: mean temperature (2 decimals), total rain and mean humidity (1)."""
    aggs = [
        F.round(F.avg("temp_avg_c"), 2).alias("avg_temp_c"),
        F.round(F.sum("precipitation_mm"), 1).alias("total_precip_mm"),
        F.round(F.avg("humidity_pct"), 1).alias("avg_humidity_pct"),
    ]
    if "avg_market_price_inr_per_quintal" in daily.columns:
        aggs += [
            F.round(F.avg("avg_market_price_inr_per_quintal"), 2).alias("avg_market_price_inr_per_quintal"),
            F.round(F.sum("total_arrivals_quintal"), 1).alias("total_arrivals_quintal"),
        ]
    return daily.groupBy(*SUMMARY_KEYS).agg(*aggs)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0))


def region_profile(daily: DataFrame) -> DataFrame:
    """Per region unrounded mean, sum and maximum, with the first known location."""
    return daily.groupBy("region_name").agg(
        F.avg("temp_avg_c").alias("avg_temp_c"),
        _total("precipitation_mm").alias("total_precip_mm"),
        F.avg("humidity_pct").alias("avg_humidity_pct"),
        F.max("windspeed_max_kmh").alias("max_windspeed_kmh"),
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in ("state_ut", "district")],
    )


def region_model_features(daily: DataFrame) -> DataFrame:
    """Per region weather features; with market columns also the price signal and arrivals."""
    aggs = [
        F.avg("temp_avg_c").alias("avg_temp_c"),
        _total("precipitation_mm").alias("total_precip_mm"),
        F.avg("humidity_pct").alias("avg_humidity_pct"),
    ]
    if "avg_market_price_inr_per_quintal" in daily.columns:
        aggs += [
            F.avg("avg_market_price_inr_per_quintal").alias("market_price_signal_inr_per_quintal"),
            _total("total_arrivals_quintal").alias("total_arrivals_quintal"),
        ]
    return daily.groupBy("region_name").agg(*aggs)


def attach_region_market(features: DataFrame, market_by_region: DataFrame) -> DataFrame:
    """Region features with a separately aggregated market block, none is null."""
    return features.join(market_by_region, "region_name", "left")


def district_weather(region_features: DataFrame) -> DataFrame:
    """Mean observed weather per district and whether any temperature was reported."""
    return region_features.where(F.col("district").isNotNull()).groupBy("district").agg(
        F.avg("temp_max_c").alias("obs_temp_max_c"),
        F.avg("temp_min_c").alias("obs_temp_min_c"),
        F.avg("precipitation_mm").alias("obs_precip_mm"),
        F.avg("humidity_pct").alias("obs_humidity_pct"),
        F.avg("windspeed_max_kmh").alias("windspeed_max_kmh"),
        F.when(F.count("temp_max_c") > 0, "reported").otherwise("no_records").alias("weather_status"),
    )


def headline(daily: DataFrame) -> DataFrame:
    """Number of regions and the mean of the regions' mean temperatures."""
    return daily.groupBy("region_name").agg(F.avg("temp_avg_c").alias("_t")).agg(
        F.count(F.lit(1)).alias("regions"), F.avg("_t").alias("mean_temp_c"))


def split_window(daily: DataFrame, ingested_on) -> DataFrame:
    """Mark each day as observed or forecast relative to the ingestion day."""
    return daily.withColumn("window", weather_window(F.col("date"), ingested_on))
