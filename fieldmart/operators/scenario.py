"""Scenario estimates, sensitivity and risk indicators over a table of scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.numbers import pct_change

COSTS = ["unit_seed_cost", "unit_fertilizer_cost", "unit_labor_cost",
         "unit_transport_cost", "unit_storage_cost", "unit_other_cost"]
INPUTS = ["quantity", "unit_price", *COSTS, "loss_pct"]

# Messages, variations and thresholds of the planner.
QUANTITY_ERROR = "Quantity must be greater than 0."
PRICE_ERROR = "Selling price cannot be negative."
LOSS_ERROR = "Expected loss must be between 0 and below 100 percent."
COST_ERRORS = {
    "unit_seed_cost": "Seed/input cost cannot be negative.",
    "unit_fertilizer_cost": "Fertilizer cost cannot be negative.",
    "unit_labor_cost": "Labor cost cannot be negative.",
    "unit_transport_cost": "Transport cost cannot be negative.",
    "unit_storage_cost": "Storage cost cannot be negative.",
    "unit_other_cost": "Other cost cannot be negative.",
}
VARIATIONS = [
    ("Baseline", 1.0, 1.0, 1.0),
    ("Price +10%", 1.1, 1.0, 1.0),
    ("Price -10%", 0.9, 1.0, 1.0),
    ("Quantity +10%", 1.0, 1.1, 1.0),
    ("Quantity -10%", 1.0, 0.9, 1.0),
    ("Costs +10%", 1.0, 1.0, 1.1),
    ("Costs -10%", 1.0, 1.0, 0.9),
]
BREAK_EVEN_BAND = 10.0
PRICE_TREND_BAND = 5.0
ARRIVAL_TREND_BAND = 10.0
HIGH_TIERS = ["High", "High-Exposure"]
MEDIUM_TIERS = ["Medium", "Moderate", "Moderate-Exposure"]


def input_errors() -> Column:
    """Array of validation messages, empty for a valid scenario."""
    def bad(ok: Column, message: str) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), F.lit(message))

    return F.array_compact(F.array(
        bad(F.col("quantity") > 0, QUANTITY_ERROR),
        bad(F.col("unit_price") >= 0, PRICE_ERROR),
        *[bad(F.col(c) >= 0, COST_ERRORS[c]) for c in COSTS],
        bad((F.col("loss_pct") >= 0) & (F.col("loss_pct") < 100), LOSS_ERROR),
    ))


def with_errors(scenarios: DataFrame) -> DataFrame:
    missing = {c: F.lit(0.0) for c in [*COSTS, "loss_pct"] if c not in scenarios.columns}
    return scenarios.withColumns(missing).withColumn("errors", input_errors())


def _estimate(df: DataFrame, quantity: Column, price: Column, cost_factor: Column) -> DataFrame:
    valid = F.size("errors") == 0
    unit_cost = sum((F.col(c) * cost_factor for c in COSTS[1:]), F.col(COSTS[0]) * cost_factor)
    priced = df.withColumns({
        "sellable_quantity": F.when(valid, quantity * (1.0 - F.col("loss_pct") / 100.0)).otherwise(0.0),
        "total_cost": F.when(valid, quantity * unit_cost).otherwise(0.0),
    })
    priced = priced.withColumn("revenue", F.when(valid, F.col("sellable_quantity") * price).otherwise(0.0))
    margin = F.col("revenue") - F.col("total_cost")
    return priced.withColumns({
        "margin": margin,
        "margin_pct": F.when(F.col("revenue") > 0, margin / F.nullif(F.col("revenue"), F.lit(0.0)) * 100.0),
        "break_even_price": F.when(F.col("sellable_quantity") > 0, F.try_divide("total_cost", "sellable_quantity")),
    })


def estimate(scenarios: DataFrame) -> DataFrame:
    """Sellable quantity, revenue, cost, margin and break-even price per scenario."""
    return _estimate(with_errors(scenarios), F.col("quantity"), F.col("unit_price"), F.lit(1.0))


def sensitivity(scenarios: DataFrame, keys: list[str], variations=VARIATIONS) -> DataFrame:
    """Every valid scenario under each variation; the delta is in percentage points.

    The variations are a literal array exploded per row: no join and no shuffle.
    """
    cases = F.array(*[
        F.struct(F.lit(i).alias("variation_no"), F.lit(label).alias("variation"), F.lit(p).alias("pf"),
                 F.lit(q).alias("qf"), F.lit(c).alias("cf"))
        for i, (label, p, q, c) in enumerate(variations)])
    base = estimate(scenarios).where(F.size("errors") == 0).withColumn("_base", F.col("margin_pct"))
    varied = base.select(*keys, *INPUTS, "errors", "_base", F.inline(cases))
    price = F.col("unit_price") * F.col("pf")
    out = _estimate(varied, F.col("quantity") * F.col("qf"), price, F.col("cf"))
    return out.select(
        *keys, "variation_no", "variation", F.col("sellable_quantity").alias("quantity"),
        price.alias("unit_price"), "revenue", "total_cost", "margin", "margin_pct",
        "break_even_price", (F.col("margin_pct") - F.col("_base")).alias("margin_pct_delta"))


# The published names, severities and sentences of the risks.
RISKS = {
    "above": ("Break-even above market", "caution",
              "Your break-even price (₹%,.0f/quintal) is %.0f%% above the latest market price (₹%,.0f/quintal)."),
    "below": ("Break-even below market", "info",
              "Your break-even price (₹%,.0f/quintal) is %.0f%% below the latest market price (₹%,.0f/quintal)."),
    "falling": ("Declining price trend", "warning", "Recent price trend shows a %.1f%% decline (7-day window)."),
    "rising": ("Rising price trend", "info", "Recent price trend shows a %.1f%% increase (7-day window)."),
    "high": ("High weather exposure", "caution", "This district shows high weather exposure (analytical label from observed weather)."),
    "medium": ("Medium weather exposure", "info", "This district shows medium weather exposure (analytical label from observed weather)."),
    "context": ("Crop production context", "info", "%s"),
    "fewer": ("Declining arrivals", "warning", "Recent arrivals trend shows a %.1f%% decline."),
    "more": ("Increasing arrivals", "info", "Recent arrivals trend shows a %.1f%% increase."),
}


def _risk(name: str, *values: Column) -> Column:
    indicator, severity, sentence = RISKS[name]
    detail = F.format_string(sentence, *values) if values else F.lit(sentence)
    return F.struct(F.lit(indicator).alias("indicator"), F.lit(severity).alias("severity"), detail.alias("detail"))


def risk_indicators() -> Column:
    """Array of risk observations from break_even_price, market_price, price_trend_pct,
    weather_exposure_tier, production_context and arrival_trend_pct."""
    even, market = F.col("break_even_price"), F.col("market_price")
    gap = F.when((even > 0) & (market > 0), pct_change(market, even))
    price, arrival = F.col("price_trend_pct"), F.col("arrival_trend_pct")
    tier, context = F.col("weather_exposure_tier"), F.col("production_context")
    return F.array_compact(F.array(
        F.when(gap < -BREAK_EVEN_BAND, _risk("above", even, F.abs(gap), market)).when(
            gap > BREAK_EVEN_BAND, _risk("below", even, gap, market)),
        F.when(price < -PRICE_TREND_BAND, _risk("falling", price)).when(price > PRICE_TREND_BAND, _risk("rising", price)),
        F.when(tier.isin(HIGH_TIERS), _risk("high")).when(tier.isin(MEDIUM_TIERS), _risk("medium")),
        F.when(F.coalesce(context, F.lit("")) != "", _risk("context", context)),
        F.when(arrival < -ARRIVAL_TREND_BAND, _risk("fewer", arrival)).when(arrival > ARRIVAL_TREND_BAND, _risk("more", arrival)),
    ))


def risks(scenarios: DataFrame, keys: list[str]) -> DataFrame:
    """Long form: one row per scenario and indicator."""
    return scenarios.select(*keys, F.inline(risk_indicators()))


def attach_signals(scenarios: DataFrame, summary: DataFrame, segments: DataFrame,
                   forecasts: DataFrame) -> DataFrame:
    """Latest market line, exposure tier and production context per scenario place and crop.

    Each right side is reduced to one row per key before its left join.
    """
    market = summary.groupBy("state", "district", F.col("commodity").alias("crop")).agg(
        F.max_by(F.struct("latest_modal_price", "modal_price_change_pct_7d", "arrival_change_pct_7d"),
                 F.struct("latest_date", *[c for c in ("apmc", "variety", "price_unit") if c in summary.columns]))
        .alias("_m"))
    tiers = segments.groupBy(F.col("region_name").alias("district")).agg(
        F.min("exposure_tier").alias("weather_exposure_tier"))
    context = forecasts.groupBy("state", "district", "crop").agg(
        F.min_by(F.format_string("Forecast %s: %,.0f tonnes (95%% band: %,.0f–%,.0f)", "forecast_year",
                                 "forecast_production_tonnes", "forecast_lower_tonnes",
                                 "forecast_upper_tonnes"), "season").alias("production_context"))
    joined = (scenarios.join(market, ["state", "district", "crop"], "left")
              .join(tiers, "district", "left")
              .join(context, ["state", "district", "crop"], "left"))
    return joined.select(
        *scenarios.columns,
        F.col("_m.latest_modal_price").alias("market_price"),
        F.col("_m.modal_price_change_pct_7d").alias("price_trend_pct"),
        F.col("_m.arrival_change_pct_7d").alias("arrival_trend_pct"),
        "weather_exposure_tier", "production_context")


def price_change_margin(base: Column, scenario: Column) -> Column:
    """Percent change of the scenario price; null unless both prices are positive."""
    return F.when((base > 0) & (scenario > 0), pct_change(scenario, base))
