"""Scenario queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import market as M
from fieldmart.operators import scenario as Z
from fieldmart.operators import segments as G
from fieldmart.plans.base import define, query
from fieldmart.plans.climate_queries import features
from fieldmart.plans.crop_queries import persistence_forecast, rounded_band
from fieldmart.plans.market_queries import SUMMARY_OUT

define("checked", """
    SELECT *, quantity > 0 AND unit_price >= 0 AND unit_other_cost >= 0 AND loss_pct >= 0 AND loss_pct < 100 AS valid
    FROM scenarios""", "scenarios")
define("estimates_in", """
    SELECT *, CASE WHEN valid THEN sellable * price ELSE 0 END AS revenue,
           CASE WHEN valid THEN quantity * qf * (unit_seed_cost * cf + unit_fertilizer_cost * cf + unit_labor_cost * cf
             + unit_transport_cost * cf + unit_storage_cost * cf + unit_other_cost * cf) ELSE 0 END AS cost
    FROM (SELECT *, unit_price * pf AS price,
                 CASE WHEN valid THEN quantity * qf * (1.0e0 - loss_pct / 100.0e0) ELSE 0 END AS sellable
          FROM checked, (VALUES (0, 'Baseline', 1.0e0, 1.0e0, 1.0e0), (1, 'Price +10%', 1.1e0, 1.0e0, 1.0e0),
                (2, 'Price -10%', 0.9e0, 1.0e0, 1.0e0), (3, 'Quantity +10%', 1.0e0, 1.1e0, 1.0e0),
                (4, 'Quantity -10%', 1.0e0, 0.9e0, 1.0e0), (5, 'Costs +10%', 1.0e0, 1.0e0, 1.1e0),
                (6, 'Costs -10%', 1.0e0, 1.0e0, 0.9e0)) v(variation_no, variation, pf, qf, cf))""", "checked")
define("varied", """
    SELECT *, revenue - cost AS margin, CASE WHEN revenue > 0 THEN (revenue - cost) / revenue * 100 END AS margin_pct,
           CASE WHEN sellable > 0 THEN cost / sellable END AS break_even
    FROM estimates_in""", "estimates_in")
ESTIMATE = ["sellable_quantity", "revenue", "total_cost", "margin", "margin_pct", "break_even_price"]


@query("C1_input_errors", """
    SELECT scenario_id, concat_ws(' | ',
        CASE WHEN NOT quantity > 0 THEN 'Quantity must be greater than 0.' END,
        CASE WHEN unit_other_cost < 0 THEN 'Other cost cannot be negative.' END,
        CASE WHEN loss_pct >= 100 THEN 'Expected loss must be between 0 and below 100 percent.' END) AS errors
    FROM scenarios""", "scenarios")
def c1(t):
    return Z.with_errors(t.scenarios).select("scenario_id", F.concat_ws(" | ", "errors").alias("errors"))


@query("C2_estimate", """
    SELECT scenario_id, sellable AS sellable_quantity, revenue, cost AS total_cost, margin, margin_pct, break_even AS break_even_price
    FROM varied WHERE variation_no = 0""", "varied")
def c2(t):
    return Z.estimate(t.scenarios).select("scenario_id", *ESTIMATE)


@query("C3_sensitivity", """
    SELECT scenario_id, variation_no, variation, sellable AS quantity, price AS unit_price, revenue, cost AS total_cost,
           margin, margin_pct, break_even AS break_even_price,
           margin_pct - max(CASE WHEN variation_no = 0 THEN margin_pct END) OVER (PARTITION BY scenario_id) AS margin_pct_delta
    FROM varied WHERE valid""", "varied")
def c3(t):
    return Z.sensitivity(t.scenarios, ["scenario_id"])


define("crop_lines", f"""
    SELECT state, district, crop, latest_modal_price AS market_price, modal_price_change_pct_7d AS price_trend_pct,
           arrival_change_pct_7d AS arrival_trend_pct
    FROM (SELECT state, district, commodity AS crop, {SUMMARY_OUT}, row_number() OVER (
            PARTITION BY state, district, commodity ORDER BY latest_date DESC, price_unit DESC) AS rn FROM coarse)
    WHERE rn = 1""", "coarse")
define("contexts", """
    SELECT state, district, crop, 'Forecast ' || forecast_year || ': '
           || format('{:,}', cast(round(forecast_production_tonnes) AS bigint)) || ' tonnes (95% band: '
           || format('{:,}', cast(round(forecast_lower_tonnes) AS bigint)) || '–'
           || format('{:,}', cast(round(forecast_upper_tonnes) AS bigint)) || ')' AS production_context
    FROM (SELECT *, row_number() OVER (PARTITION BY state, district, crop ORDER BY season) AS rn FROM forecasts) WHERE rn = 1""",
       "forecasts")
define("signals", """
    SELECT v.scenario_id, v.state, v.district, v.crop, v.break_even AS break_even_price, market_price, price_trend_pct,
           arrival_trend_pct, exposure_tier AS weather_exposure_tier, production_context
    FROM (SELECT * FROM varied WHERE variation_no = 0) v
    LEFT JOIN crop_lines l ON v.state = l.state AND v.district = l.district AND v.crop = l.crop
    LEFT JOIN geo g ON v.district = g.district LEFT JOIN segments s ON g.region_name = s.region_name
    LEFT JOIN contexts c ON v.state = c.state AND v.district = c.district AND c.crop = CASE v.crop
         WHEN 'ECONOMY' THEN 'BUILDING' WHEN 'LARGE' THEN 'FURNITURE' ELSE v.crop END""",
       "varied", "crop_lines", "segments", "contexts", "geo")


def signals(t):
    summary = M.market_summary(t.trades, ["state", "district", "commodity", "price_unit"], ["row_id"], None)
    tiers = G.assign_segments(features(t)).join(t.geo.select("region_name", "district"), "region_name").select(
        F.col("district").alias("region_name"), "exposure_tier")
    crop = F.when(F.col("crop") == "BUILDING", "ECONOMY").when(F.col("crop") == "FURNITURE", "LARGE").otherwise(F.col("crop"))
    forecasts = rounded_band(persistence_forecast(t)).withColumn("crop", crop)
    base = Z.estimate(t.scenarios).select("scenario_id", "state", "district", "crop", "break_even_price")
    return Z.attach_signals(base, summary, tiers, forecasts)


@query("J13_scenario_signals", "SELECT * FROM signals", "signals")
def j13(t):
    return signals(t)


def risk_sql(name: str, when: str, *values: str) -> str:
    """SQL rows of one risk: its name, severity and sentence, where the condition holds."""
    indicator, severity, sentence = Z.RISKS[name]
    parts, rest = [], sentence
    for value in values:  # formats are tried in the sentence's order
        at, mark = min((rest.index(m), m) for m in ("%,.0f", "%.0f", "%.1f", "%s") if m in rest)
        shown = {"%,.0f": f"format('{{:,}}', cast(round({value}) AS bigint))", "%.0f": f"cast(cast(round({value}) AS bigint) AS varchar)",
                 "%.1f": f"printf('%.1f', round({value}, 1))", "%s": value}[mark]
        parts += [f"'{rest[:at]}'", shown]
        rest = rest[at + len(mark):]
    detail = " || ".join([*parts, f"'{rest}'"]).replace("%%", "%")
    return f"SELECT scenario_id, '{indicator}' AS indicator, '{severity}' AS severity, {detail} AS detail FROM gaps WHERE {when}"


define("gaps", """
    SELECT *, CASE WHEN break_even_price > 0 AND market_price > 0 THEN (market_price - break_even_price) / break_even_price * 100 END AS gap
    FROM signals""", "signals")


@query("C4_risk_indicators", " UNION ALL ".join([
    risk_sql("above", "gap < -10", "break_even_price", "abs(gap)", "market_price"),
    risk_sql("below", "gap > 10", "break_even_price", "gap", "market_price"),
    risk_sql("falling", "price_trend_pct < -5", "price_trend_pct"), risk_sql("rising", "price_trend_pct > 5", "price_trend_pct"),
    risk_sql("high", "weather_exposure_tier = 'High-Exposure'"), risk_sql("medium", "weather_exposure_tier = 'Moderate-Exposure'"),
    risk_sql("context", "production_context <> ''", "production_context"),
    risk_sql("fewer", "arrival_trend_pct < -10", "arrival_trend_pct"), risk_sql("more", "arrival_trend_pct > 10", "arrival_trend_pct")]), "gaps")
def c4(t):
    return Z.risks(signals(t), ["scenario_id"])


@query("C5_price_change_margin", """
    SELECT scenario_id, CASE WHEN unit_price > 0 AND unit_seed_cost > 0 THEN (unit_seed_cost - unit_price) / unit_price * 100 END AS margin_pct
    FROM scenarios""", "scenarios")
def c5(t):
    return t.scenarios.select("scenario_id", Z.price_change_margin(
        F.col("unit_price"), F.col("unit_seed_cost")).alias("margin_pct"))
