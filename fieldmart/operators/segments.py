"""Rule-based weather-exposure segments from cohort terciles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.labels import tercile_label
from fieldmart.operators.quantiles import attach_quantiles
from fieldmart.operators.ranks import with_group_place

# Tercile probabilities and the sentence that cites the thresholds.
LOWER, UPPER = 0.333, 0.667
REASON = (
    "%s: %.0fmm total precipitation (%s; terciles <= %.0fmm / >= %.0fmm), "
    "%.1fC avg temp (%s; terciles <= %.1fC / >= %.1fC), %.0f%% humidity (%s). "
    "Overall weather-exposure tier: %s (dominant driver: %s). "
    "This describes observed weather exposure over the window, not a forecast."
)


def cohort_thresholds(features: DataFrame) -> DataFrame:
    """Add the cohort's terciles and medians to every region row."""
    return attach_quantiles(features, features, {
        "precip_low": ("total_precip_mm", LOWER),
        "precip_high": ("total_precip_mm", UPPER),
        "precip_median": ("total_precip_mm", 0.5),
        "temp_low": ("avg_temp_c", LOWER),
        "temp_high": ("avg_temp_c", UPPER),
        "temp_median": ("avg_temp_c", 0.5),
        "humid_median": ("avg_humidity_pct", 0.5),
    })


def with_tiers(t: DataFrame) -> DataFrame:
    """Rain, heat and humidity labels; the tercile bounds belong to the outer tiers."""
    rain, heat = F.col("total_precip_mm"), F.col("avg_temp_c")
    return t.withColumns({
        "rain_tier": F.when(rain >= F.col("precip_high"), "High-Rainfall")
        .when(rain <= F.col("precip_low"), "Water-Limited").otherwise("Moderate-Rainfall"),
        "heat_tier": F.when(heat >= F.col("temp_high"), "Heat-Stress")
        .when(heat <= F.col("temp_low"), "Cool-Regime").otherwise("Moderate-Heat"),
        "humidity_label": F.when(F.col("avg_humidity_pct") >= F.col("humid_median"), "Humid")
        .otherwise("Dry-Air"),
    })


def with_dominant_factor(t: DataFrame) -> DataFrame:
    """The signal farther from its median, relative to its scale; a tie is precipitation."""
    median = F.col("precip_median")
    rain = F.abs(F.col("total_precip_mm") - median) / F.when(median != 0, median).otherwise(1.0)
    heat = F.abs(F.col("avg_temp_c") - F.col("temp_median")) / F.greatest(
        F.abs("temp_low"), F.abs("temp_high"), F.lit(1.0))
    return t.withColumn("dominant_factor", F.when(rain >= heat, "precipitation").otherwise("temperature"))


def with_exposure_tier(t: DataFrame) -> DataFrame:
    """The stronger of the rain and heat scores."""
    rain = F.when(F.col("rain_tier") == "High-Rainfall", 3).when(
        F.col("rain_tier") == "Moderate-Rainfall", 2).otherwise(1)
    heat = F.when(F.col("heat_tier") == "Heat-Stress", 3).when(
        F.col("heat_tier") == "Moderate-Heat", 2).otherwise(1)
    score = F.greatest(rain, heat)
    return t.withColumn("exposure_tier", F.when(score == 3, "High-Exposure")
                        .when(score == 2, "Moderate-Exposure").otherwise("Low-Exposure"))


def with_reason(t: DataFrame) -> DataFrame:
    label = F.concat_ws(" > ", "rain_tier", "heat_tier", "humidity_label")
    reason = F.format_string(
        REASON, "region_name", "total_precip_mm", F.lower("rain_tier"), "precip_low", "precip_high",
        "avg_temp_c", F.lower("heat_tier"), "temp_low", "temp_high",
        "avg_humidity_pct", "humidity_label", "exposure_tier", "dominant_factor")
    return t.withColumns({"segment": label, "segment_reason": reason})


def assign_segments(features: DataFrame) -> DataFrame:
    """Region features (region_name, avg_temp_c, total_precip_mm, avg_humidity_pct) to segments."""
    tiers = with_exposure_tier(with_dominant_factor(with_tiers(cohort_thresholds(features))))
    return with_reason(tiers).select(
        "region_name", "segment", "segment_reason", "exposure_tier", "dominant_factor")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def names_per_segment(segments: DataFrame) -> DataFrame:
    """The region names of each segment with their rank in name order, one row each."""
    ranked = with_group_place(segments.select("segment", "region_name"), ["segment"], ["region_name"], "_place")
    return ranked.select("segment", (F.col("_place") + 1).cast("int").alias("rank"), "region_name")


def segment_overview(segments: DataFrame, profile: DataFrame) -> DataFrame:
    """Segments with strict tercile labels of rain and temperature."""
    cohort = profile.select("region_name", "total_precip_mm", "avg_temp_c")
    joined = attach_quantiles(segments.join(cohort, "region_name", "left"), cohort, {
        "_p_lo": ("total_precip_mm", LOWER), "_p_hi": ("total_precip_mm", UPPER),
        "_t_lo": ("avg_temp_c", LOWER), "_t_hi": ("avg_temp_c", UPPER),
    })
    rain = tercile_label(F.col("total_precip_mm"), F.col("_p_lo"), F.col("_p_hi"))
    heat = tercile_label(F.col("avg_temp_c"), F.col("_t_lo"), F.col("_t_hi"))
    return joined.select(
        "region_name", "dominant_factor", "exposure_tier",
        F.concat(rain, F.lit(" precip / "), heat, F.lit(" temp")).alias("weather_signal"), "segment")
