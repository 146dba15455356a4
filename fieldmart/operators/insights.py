"""Explainable insight cards for all regions: title, what, why, period, source_method."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.functions.labels import strongest_level, tercile_label
from fieldmart.functions.text import period_label
from fieldmart.operators.quantiles import attach_quantiles
from fieldmart.operators.segments import LOWER, UPPER

CARD = ["region_name", "title", "what", "why", "period", "source_method"]
PRICE_SUFFIX = "_inr_per_quintal"

# The card sentences.
WEATHER_WHAT = "%s recorded %s°C average temperature and %s mm total precipitation over the window."
WEATHER_WHY = (
    "Compared with the %d monitored districts (cohort terciles), temperature is %s and "
    "precipitation is %s, giving an overall %s weather-exposure signal. "
    "Levels are relative to the observed cohort only."
)
MIX_WHAT = ("Highest observed price signal in %s is %s at ₹%s/quintal "
            "(%s%% of the observed basket).")
MIX_WHY = "Observed commodity prices (INR/quintal): %s."
SEGMENT_WHAT = "%s is grouped as %s (exposure tier %s, dominant driver %s)."
SEGMENT_PERIOD = "Observed weather window (see reason for tercile thresholds)."
MODEL_TITLE = "Model signal: prototype (in-sample)"
MODEL_WHAT = ("Prototype model estimates the market-price signal for %s on weather features at "
              "₹%s/quintal vs the observed ₹%s/quintal.")
MODEL_WHY = ("Linear-regression prototype; metrics are in-sample and must not be read as "
             "out-of-sample accuracy.")
DIVERSIFIED_BELOW = 0.40


def figure(value: Column, pattern: str) -> Column:
    """A formatted number; a missing one reads 'nan'."""
    return F.when(value.isNotNull(), F.format_string(pattern, value)).otherwise("nan")


def money(value: Column) -> Column:
    return figure(value, "%,.0f")


def region_periods(daily: DataFrame) -> DataFrame:
    return daily.groupBy("region_name").agg(
        period_label(F.min("date"), F.max("date")).alias("period"))


def weather_cards(daily: DataFrame) -> DataFrame:
    """Temperature and rain against the cohort's terciles, one card per region."""
    regions = daily.groupBy("region_name").agg(
        F.avg("temp_avg_c").alias("t"),
        F.coalesce(F.sum("precipitation_mm"), F.lit(0.0)).alias("p"),
        period_label(F.min("date"), F.max("date")).alias("period"),
    )
    cohort = attach_quantiles(regions, regions, {
        "p_lo": ("p", LOWER), "p_hi": ("p", UPPER), "t_lo": ("t", LOWER), "t_hi": ("t", UPPER),
    }, count_as="n")
    levels = cohort.withColumns({
        "t_level": tercile_label(F.col("t"), F.col("t_lo"), F.col("t_hi")),
        "p_level": tercile_label(F.col("p"), F.col("p_lo"), F.col("p_hi")),
    }).withColumn("overall", strongest_level(F.col("t_level"), F.col("p_level")))
    return levels.select(
        "region_name",
        F.concat(F.lit("Weather exposure: "), "overall").alias("title"),
        F.format_string(WEATHER_WHAT, "region_name", figure(F.col("t"), "%.1f"), figure(F.col("p"), "%.0f")).alias("what"),
        F.format_string(WEATHER_WHY, "n", "t_level", "p_level", "overall").alias("why"),
        "period",
        F.lit("Mean temperature and summed precipitation of the daily region features.").alias("source_method"),
    )


def price_columns(daily: DataFrame) -> list[str]:
    return [c for c in daily.columns if c.endswith(PRICE_SUFFIX)]


def unpivot_prices(daily: DataFrame) -> DataFrame:
    """Every price column to (region_name, date, commodity, price)."""
    named = daily.select("region_name", "date", *[
        F.col(c).cast("double").alias(c.removesuffix(PRICE_SUFFIX).replace("_", " ").title())
        for c in price_columns(daily)])
    values = [c for c in named.columns if c not in ("region_name", "date")]
    return named.unpivot(["region_name", "date"], values, "commodity", "price")


def ranked_mix(prices: DataFrame) -> DataFrame:
    """Highest price per region and commodity with its rank and share of the basket.

    `prices` is in long form (region_name, date, commodity, price), as `unpivot_prices`
    makes it of a wide table. The window holds one row per commodity of a region.
    """
    best = prices.groupBy("region_name", "commodity").agg(F.max("price").alias("price"))
    region = Window.partitionBy("region_name")
    return best.withColumns({
        "rank": F.row_number().over(region.orderBy(F.col("price").desc_nulls_last(), "commodity")),
        "share": F.coalesce(F.try_divide(F.col("price"), F.sum("price").over(region)), F.lit(0.0)),
    })


def mix_cards(daily: DataFrame, prices: DataFrame | None = None) -> DataFrame | None:
    """Commodity mix cards from long prices or else the price columns; None without either."""
    if prices is None:
        if not price_columns(daily):
            return None
        prices = unpivot_prices(daily)
    entry = F.concat("commodity", F.lit(" ₹"), money(F.col("price")))
    mix = ranked_mix(prices).groupBy("region_name").agg(
        F.min_by(F.struct("commodity", "price", "share"), "rank").alias("top"),
        F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry")))).alias("basket"),
    )
    top = F.col("top.commodity")
    return mix.join(region_periods(daily), "region_name").select(
        "region_name",
        F.concat(F.lit("Commodity mix: "), F.when(F.col("top.share") >= DIVERSIFIED_BELOW, top)
                 .otherwise("diversified")).alias("title"),
        F.format_string(MIX_WHAT, "region_name", top, money(F.col("top.price")),
                        figure(F.col("top.share") * 100, "%.0f")).alias("what"),
        F.format_string(MIX_WHY, F.concat_ws(", ", "basket.entry")).alias("why"),
        "period",
        F.lit("Market price columns of the daily region features.").alias("source_method"),
    )


def segment_cards(daily: DataFrame, segments: DataFrame) -> DataFrame:
    """One card per region that has a segment."""
    return segments.join(daily.select("region_name").distinct(), "region_name", "left_semi").select(
        "region_name",
        F.concat(F.lit("Weather-exposure tier: "), "exposure_tier").alias("title"),
        F.format_string(SEGMENT_WHAT, "region_name", "segment", "exposure_tier", "dominant_factor").alias("what"),
        F.col("segment_reason").alias("why"),
        F.lit(SEGMENT_PERIOD).alias("period"),
        F.lit("Rule-based region segments (analytical, not a validated classification).").alias("source_method"),
    )


def model_cards(daily: DataFrame, forecast: DataFrame) -> DataFrame:
    """One card per region with a model estimate."""
    return forecast.join(region_periods(daily), "region_name").select(
        "region_name",
        F.lit(MODEL_TITLE).alias("title"),
        F.format_string(MODEL_WHAT, "region_name", money(F.col("predicted_signal_inr_per_quintal")),
                        money(F.col("actual_signal_inr_per_quintal"))).alias("what"),
        F.lit(MODEL_WHY).alias("why"),
        "period",
        F.lit("Forecast results and model report.").alias("source_method"),
    )


def region_insights(daily: DataFrame, segments: DataFrame | None = None,
                    forecast: DataFrame | None = None, prices: DataFrame | None = None) -> DataFrame:
    """All cards of all regions; an absent input only removes its own card."""
    cards = [weather_cards(daily)]
    mix = mix_cards(daily, prices)
    if mix is not None:
        cards.append(mix)
    if segments is not None:
        cards.append(segment_cards(daily, segments))
    if forecast is not None and "predicted_signal_inr_per_quintal" in forecast.columns:
        cards.append(model_cards(daily, forecast))
    return reduce(DataFrame.unionByName, cards).select(*CARD)
