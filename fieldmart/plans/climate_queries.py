"""Climate, segment and insight queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.functions.labels import strongest_level, tercile_label
from fieldmart.operators import climate as C
from fieldmart.operators import insights as I
from fieldmart.operators import models as ML
from fieldmart.operators import segments as G
from fieldmart.operators.quantiles import attach_quantiles, group_quantiles
from fieldmart.plans.base import define, query
from fieldmart.plans.market_queries import market_daily_features



def daily(t):
    return C.daily_features(t.weather, t.geo)


def features(t):
    """Region features; humidity rounded so that its sum order cannot matter."""
    return C.region_model_features(daily(t)).withColumn("avg_humidity_pct", F.round("avg_humidity_pct", 4))


@query("A2_region_summary", """
    SELECT region_name, state_ut, state_code, district, mandi_apmc, round(avg(temp_avg_c), 2) AS avg_temp_c,
           round(sum(precipitation_mm), 1) AS total_precip_mm, round(avg(humidity_pct), 1) AS avg_humidity_pct
    FROM daily GROUP BY ALL""", "daily")
def a2(t):
    return C.region_summary(daily(t))


@query("T1_ordered_summary", """
    SELECT region_name, state_ut, round(avg(temp_avg_c), 2) AS avg_temp_c, round(sum(precipitation_mm), 1) AS total_precip_mm
    FROM daily GROUP BY ALL ORDER BY state_ut, region_name""", "daily")
def t1(t):
    return C.region_summary(daily(t)).select(
        "region_name", "state_ut", "avg_temp_c", "total_precip_mm").orderBy("state_ut", "region_name")


@query("J1_weather_geography", "SELECT * FROM daily", "daily")
def j1(t):
    return daily(t)


@query("N16_mean_temperature", """
    SELECT region_name, date, (temp_max_c + temp_min_c) / 2 AS temp_avg_c FROM weather""", "weather")
def n16(t):
    return t.weather.select("region_name", "date", C.mean_temperature().alias("temp_avg_c"))


@query("F2_weather_window", """
    SELECT region_name, date, CASE WHEN date > date '2024-01-20' THEN 'forecast' ELSE 'observed' END AS "window"
    FROM weather""", "weather")
def f2(t):
    return C.split_window(t.weather, "2024-01-20").select("region_name", "date", "window")


@query("A3_region_profile", """
    SELECT region_name, avg(temp_avg_c) AS avg_temp_c, sum(precipitation_mm) AS total_precip_mm,
           round(avg(humidity_pct), 4) AS avg_humidity_pct, max(windspeed_max_kmh) AS max_windspeed_kmh,
           min(state_ut) AS state_ut, min(district) AS district
    FROM daily GROUP BY 1""", "daily")
def a3(t):
    return C.region_profile(daily(t)).withColumn("avg_humidity_pct", F.round("avg_humidity_pct", 4))


@query("A9_district_weather", """
    SELECT district, avg(temp_max_c) AS obs_temp_max_c, avg(temp_min_c) AS obs_temp_min_c,
           avg(precipitation_mm) AS obs_precip_mm, round(avg(humidity_pct), 4) AS obs_humidity_pct,
           avg(windspeed_max_kmh) AS windspeed_max_kmh,
           CASE WHEN count(temp_max_c) > 0 THEN 'reported' ELSE 'no_records' END AS weather_status
    FROM region_days WHERE district IS NOT NULL GROUP BY 1""", "region_days")
def a9(t):
    from fieldmart.plans.market_queries import region_days
    return C.district_weather(region_days(t)).withColumn("obs_humidity_pct", F.round("obs_humidity_pct", 4))


@query("A19_headline", """
    SELECT count(*) AS regions, round(avg(avg_temp_c), 6) AS mean_temp_c FROM features""", "features")
def a19(t):
    return C.headline(daily(t)).withColumn("mean_temp_c", F.round("mean_temp_c", 6))


define("market_days", """
    SELECT d.region_name, d.date, temp_avg_c, precipitation_mm, humidity_pct, avg_market_price_inr_per_quintal,
           total_arrivals_quintal
    FROM daily d LEFT JOIN (
        SELECT region_name, date + 9862 AS date, round(avg(floor(modal_price / 8) * 8), 2) AS avg_market_price_inr_per_quintal,
               round(sum(arrival_quantity), 2) AS total_arrivals_quintal
        FROM mapped GROUP BY 1, 2) m ON d.region_name = m.region_name AND d.date = m.date""", "daily", "mapped")


define("market_features", """
    SELECT region_name, avg(temp_avg_c) AS avg_temp_c, sum(precipitation_mm) AS total_precip_mm,
           round(avg(humidity_pct), 4) AS avg_humidity_pct,
           round(avg(avg_market_price_inr_per_quintal), 4) AS market_price_signal_inr_per_quintal,
           coalesce(sum(total_arrivals_quintal), 0) AS total_arrivals_quintal
    FROM market_days GROUP BY 1""", "market_days")


@query("A20_region_model_features", "SELECT * FROM market_features", "market_features")
def a20(t):
    return market_features(t)


def market_features(t):
    return C.region_model_features(market_daily_features(t)).withColumns({
        c: F.round(c, 4) for c in ("avg_humidity_pct", "market_price_signal_inr_per_quintal")})


@query("J8_region_market_join", """
    SELECT f.*, prices, arrivals FROM features f LEFT JOIN (
        SELECT region_name, sum(modal_price) AS prices, sum(arrival_quantity) AS arrivals FROM mapped GROUP BY 1) m
    USING (region_name)""", "features mapped")
def j8(t):
    from fieldmart.operators.region_features import map_region
    by_region = map_region(t.trades, t.geo).groupBy("region_name").agg(
        F.sum("modal_price").alias("prices"), F.sum("arrival_quantity").alias("arrivals"))
    return C.attach_region_market(features(t), by_region)


@query("A17_cohort_quantiles", """
    SELECT round(quantile_cont(total_precip_mm, 0.333e0), 6) AS precip_low,
           round(quantile_cont(total_precip_mm, 0.667e0), 6) AS precip_high, median(total_precip_mm) AS precip_median
    FROM features""", "features")
def a17(t):
    return group_quantiles(features(t), [], "total_precip_mm", {
        "precip_low": G.LOWER, "precip_high": G.UPPER, "precip_median": 0.5}).select(
        F.round("precip_low", 6).alias("precip_low"), F.round("precip_high", 6).alias("precip_high"), "precip_median")


@query("A17_price_quantiles", """
    SELECT district, commodity, round(quantile_cont(modal_price, 0.333e0), 6) AS low, median(modal_price) AS mid,
           round(quantile_cont(modal_price, 0.667e0), 6) AS high
    FROM trades WHERE modal_price IS NOT NULL GROUP BY 1, 2""", "trades")
def a17_prices(t):
    q = group_quantiles(t.trades, ["district", "commodity"], "modal_price", {"low": G.LOWER, "mid": 0.5, "high": G.UPPER})
    return q.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


define("tiers", """
    SELECT *, CASE WHEN rain = 3 OR heat = 3 THEN 'High-Exposure' WHEN rain = 2 OR heat = 2
                   THEN 'Moderate-Exposure' ELSE 'Low-Exposure' END AS exposure_tier,
           CASE WHEN abs(total_precip_mm - p_med) / (CASE WHEN p_med <> 0 THEN p_med ELSE 1.0e0 END)
                  >= abs(avg_temp_c - t_med) / greatest(abs(t_lo), abs(t_hi), 1.0e0)
                THEN 'precipitation' ELSE 'temperature' END AS dominant_factor,
           rain_tier || ' > ' || heat_tier || ' > ' || humidity_label AS segment
    FROM (SELECT *, CASE WHEN total_precip_mm >= p_hi THEN 'High-Rainfall' WHEN total_precip_mm <= p_lo
                         THEN 'Water-Limited' ELSE 'Moderate-Rainfall' END AS rain_tier,
                 CASE WHEN avg_temp_c >= t_hi THEN 'Heat-Stress' WHEN avg_temp_c <= t_lo THEN 'Cool-Regime'
                      ELSE 'Moderate-Heat' END AS heat_tier,
                 CASE WHEN avg_humidity_pct >= h_med THEN 'Humid' ELSE 'Dry-Air' END AS humidity_label,
                 CASE WHEN total_precip_mm >= p_hi THEN 3 WHEN total_precip_mm <= p_lo THEN 1 ELSE 2 END AS rain,
                 CASE WHEN avg_temp_c >= t_hi THEN 3 WHEN avg_temp_c <= t_lo THEN 1 ELSE 2 END AS heat
          FROM features, cohort)""", "features", "cohort")


@query("G1_tiers", "SELECT region_name, rain_tier, heat_tier, humidity_label FROM tiers", "tiers")
def g1(t):
    return G.with_tiers(G.cohort_thresholds(features(t))).select(
        "region_name", "rain_tier", "heat_tier", "humidity_label")


@query("G2_dominant_factor", "SELECT region_name, dominant_factor FROM tiers", "tiers")
def g2(t):
    return G.with_dominant_factor(G.cohort_thresholds(features(t))).select("region_name", "dominant_factor")


@query("G3_exposure_tier", "SELECT region_name, exposure_tier FROM tiers", "tiers")
def g3(t):
    return G.with_exposure_tier(G.with_tiers(G.cohort_thresholds(features(t)))).select("region_name", "exposure_tier")


define("segments", """
    SELECT region_name, segment, region_name || ': ' || cast(round(total_precip_mm) AS bigint) || 'mm total precipitation ('
           || lower(rain_tier) || '; terciles <= ' || cast(round(p_lo) AS bigint) || 'mm / >= ' || cast(round(p_hi) AS bigint)
           || 'mm), ' || round(avg_temp_c, 1) || 'C avg temp (' || lower(heat_tier) || '; terciles <= ' || round(t_lo, 1)
           || 'C / >= ' || round(t_hi, 1) || 'C), ' || cast(round(avg_humidity_pct) AS bigint) || '% humidity ('
           || humidity_label || '). Overall weather-exposure tier: ' || exposure_tier || ' (dominant driver: '
           || dominant_factor || '). This describes observed weather exposure over the window, not a forecast.'
             AS segment_reason, exposure_tier, dominant_factor
    FROM tiers""", "tiers")


@query("G4_segments", "SELECT * FROM segments", "segments")
def g4(t):
    return G.assign_segments(features(t))


define("levels", """
    SELECT region_name, avg_temp_c, total_precip_mm,
           CASE WHEN total_precip_mm < p_lo THEN 'Low' WHEN total_precip_mm > p_hi THEN 'High' ELSE 'Moderate' END AS p_level,
           CASE WHEN avg_temp_c < t_lo THEN 'Low' WHEN avg_temp_c > t_hi THEN 'High' ELSE 'Moderate' END AS t_level
    FROM features, cohort""", "features", "cohort")


def leveled(t):
    f = features(t)
    q = attach_quantiles(f, f, {"p_lo": ("total_precip_mm", G.LOWER), "p_hi": ("total_precip_mm", G.UPPER),
                                "t_lo": ("avg_temp_c", G.LOWER), "t_hi": ("avg_temp_c", G.UPPER)})
    return q.withColumns({"p_level": tercile_label(F.col("total_precip_mm"), F.col("p_lo"), F.col("p_hi")),
                          "t_level": tercile_label(F.col("avg_temp_c"), F.col("t_lo"), F.col("t_hi"))})


@query("G5_tercile_label", "SELECT region_name, p_level, t_level FROM levels", "levels")
def g5(t):
    return leveled(t).select("region_name", "p_level", "t_level")


@query("G6_combined_level", """
    SELECT region_name, CASE WHEN p_level = 'High' OR t_level = 'High' THEN 'High'
           WHEN p_level = 'Low' OR t_level = 'Low' THEN 'Low' ELSE 'Moderate' END AS level FROM levels""", "levels")
def g6(t):
    return leveled(t).select("region_name", strongest_level(F.col("p_level"), F.col("t_level")).alias("level"))


@query("A13_segment_counts", "SELECT segment, count(*) AS count FROM segments GROUP BY 1", "segments")
def a13(t):
    return G.value_counts(G.assign_segments(features(t)), "segment").orderBy(F.col("count").desc(), "segment")


@query("A18_names_per_segment", """
    SELECT segment, cast(row_number() OVER (PARTITION BY segment ORDER BY region_name) AS integer) AS rank, region_name
    FROM segments""", "segments")
def a18(t):
    return G.names_per_segment(G.assign_segments(features(t)))


@query("J12_segment_overview", """
    SELECT region_name, dominant_factor, exposure_tier, p_level || ' precip / ' || t_level || ' temp' AS weather_signal,
           segment FROM segments JOIN levels USING (region_name)""", "segments levels")
def j12(t):
    return G.segment_overview(G.assign_segments(features(t)), C.region_profile(daily(t)))


define("periods", """
    SELECT region_name, CASE WHEN min(date) = max(date) THEN cast(min(date) AS varchar)
           ELSE min(date) || ' → ' || max(date) END AS period FROM weather GROUP BY 1""", "weather")
define("weather_cards", """
    SELECT region_name, 'Weather exposure: ' || overall AS title,
           region_name || ' recorded ' || round(avg_temp_c, 1) || '°C average temperature and '
             || cast(round(total_precip_mm) AS bigint) || ' mm total precipitation over the window.' AS what,
           'Compared with the ' || (SELECT count(*) FROM features) || ' monitored districts (cohort terciles), temperature is '
             || t_level || ' and precipitation is ' || p_level || ', giving an overall ' || overall
             || ' weather-exposure signal. Levels are relative to the observed cohort only.' AS why,
           period, 'Mean temperature and summed precipitation of the daily region features.' AS source_method
    FROM (SELECT *, CASE WHEN p_level = 'High' OR t_level = 'High' THEN 'High'
                         WHEN p_level = 'Low' OR t_level = 'Low' THEN 'Low' ELSE 'Moderate' END AS overall FROM levels)
    JOIN periods USING (region_name)""", "levels", "periods", "features")


@query("I1_weather_cards", "SELECT * FROM weather_cards", "weather_cards")
def i1(t):
    return I.weather_cards(daily(t))


def prices(t):
    """Prices per region, climate day and commodity, in long form."""
    moved = t.trades.withColumn("date", F.date_add("date", 9862)).join(
        t.geo.select("district", "region_name"), "district")
    return moved.select("region_name", "date", F.initcap("commodity").alias("commodity"), F.col("modal_price").alias("price"))


def priced_days(t):
    """Climate days with one price column per commodity that the trades hold."""
    wide = prices(t).groupBy("region_name", "date").pivot("commodity").agg(F.max("price"))
    kinds = wide.columns[2:]
    named = wide.select("region_name", "date", *[F.col(f"`{k}`").alias(f"{k.lower()}_inr_per_quintal") for k in kinds])
    return daily(t).join(named, ["region_name", "date"], "left")


def climate_prices(t):
    """Long prices of the days that have weather, and for every region each commodity once without a price."""
    days = daily(t).select("region_name", "date")
    kinds = prices(t).agg(F.array_sort(F.collect_set("commodity"))).scalar()  # as many as there are commodities
    unpriced = days.select("region_name").distinct().select(
        "region_name", F.lit(None).cast("date").alias("date"), F.explode(kinds).alias("commodity"), F.lit(None).cast("double").alias("price"))
    return prices(t).join(days, ["region_name", "date"], "left_semi").withColumn("price", F.col("price").cast("double")).unionByName(unpriced)


define("prices_long", """
    SELECT w.region_name, w.date, k.commodity, max(m.modal_price) AS price
    FROM weather w CROSS JOIN (SELECT DISTINCT p_type, substr(p_type, 1, 1) || lower(substr(p_type, 2)) AS commodity FROM part) k
    LEFT JOIN mapped m ON m.region_name = w.region_name AND m.date + 9862 = w.date AND m.commodity = k.p_type
    GROUP BY ALL""", "weather", "mapped")


@query("U2_unpivot_prices", "SELECT * FROM prices_long", "prices_long")
def u2(t):
    return I.unpivot_prices(priced_days(t))


define("mix", """
    SELECT *, row_number() OVER (PARTITION BY region_name ORDER BY price DESC NULLS LAST, commodity) AS rank,
           coalesce(price / sum(price) OVER (PARTITION BY region_name), 0) AS share
    FROM (SELECT region_name, commodity, max(price) AS price FROM prices_long GROUP BY 1, 2)""", "prices_long")


@query("T2_ranked_mix", "SELECT region_name, commodity, price, cast(rank AS integer) AS rank, share FROM mix", "mix")
def t2(t):
    return I.ranked_mix(climate_prices(t))


define("mix_cards", """
    SELECT region_name, 'Commodity mix: ' || CASE WHEN share >= 0.40e0 THEN commodity ELSE 'diversified' END AS title,
           'Highest observed price signal in ' || region_name || ' is ' || commodity || ' at ₹'
             || coalesce(format('{:,}', cast(round(price) AS bigint)), 'nan') || '/quintal (' || cast(round(share * 100) AS bigint)
             || '% of the observed basket).' AS what,
           'Observed commodity prices (INR/quintal): ' || basket || '.' AS why, period,
           'Market price columns of the daily region features.' AS source_method
    FROM mix JOIN periods USING (region_name) JOIN (
        SELECT region_name, string_agg(commodity || ' ₹' || coalesce(format('{:,}', cast(round(price) AS bigint)), 'nan'), ', ' ORDER BY rank) AS basket
        FROM mix GROUP BY 1) USING (region_name) WHERE rank = 1""", "mix", "periods")


@query("I2_mix_cards", "SELECT * FROM mix_cards", "mix_cards")
def i2(t):
    return I.mix_cards(daily(t), climate_prices(t))


define("segment_cards", """
    SELECT region_name, 'Weather-exposure tier: ' || exposure_tier AS title,
           region_name || ' is grouped as ' || segment || ' (exposure tier ' || exposure_tier || ', dominant driver '
             || dominant_factor || ').' AS what, segment_reason AS why,
           'Observed weather window (see reason for tercile thresholds).' AS period,
           'Rule-based region segments (analytical, not a validated classification).' AS source_method
    FROM segments""", "segments")


@query("I3_segment_cards", "SELECT * FROM segment_cards", "segment_cards")
def i3(t):
    return I.segment_cards(daily(t), G.assign_segments(features(t)))


def price_estimates(t):
    """Observed region prices against a simple rule in place of a fitted model."""
    rows = market_features(t).withColumn("guess", F.col("total_precip_mm") * 2)
    return ML.actual_vs_predicted(rows, ML.PRICE_TARGET, "guess")


define("estimates", """
    SELECT region_name, signal AS actual_signal_inr_per_quintal, guess AS predicted_signal_inr_per_quintal,
           guess - signal AS difference_inr_per_quintal,
           CASE WHEN signal <> 0 THEN (guess - signal) / signal * 100 END AS prediction_error_pct
    FROM (SELECT region_name, round(avg(avg_market_price_inr_per_quintal), 4) AS signal, sum(precipitation_mm) * 2 AS guess
          FROM market_days GROUP BY 1)""", "market_days")


@query("M14_actual_vs_predicted", "SELECT * FROM estimates", "estimates")
def m14(t):
    return price_estimates(t)


@query("U1_observed_vs_predicted", """
    SELECT region_name, 'Observed' AS series, actual_signal_inr_per_quintal AS signal_inr_per_quintal FROM estimates
    UNION ALL SELECT region_name, 'Model estimate', predicted_signal_inr_per_quintal FROM estimates""", "estimates")
def u1(t):
    from fieldmart.operators.panel import observed_vs_predicted
    return observed_vs_predicted(price_estimates(t))


define("model_cards", """
    SELECT region_name, 'Model signal: prototype (in-sample)' AS title,
           'Prototype model estimates the market-price signal for ' || region_name || ' on weather features at ₹'
             || format('{:,}', cast(round(predicted_signal_inr_per_quintal) AS bigint)) || '/quintal vs the observed ₹'
             || coalesce(format('{:,}', cast(round(actual_signal_inr_per_quintal) AS bigint)), 'nan') || '/quintal.' AS what,
           'Linear-regression prototype; metrics are in-sample and must not be read as out-of-sample accuracy.' AS why,
           period, 'Forecast results and model report.' AS source_method
    FROM estimates JOIN periods USING (region_name)""", "estimates", "periods")


@query("I4_model_cards", "SELECT * FROM model_cards", "model_cards")
def i4(t):
    return I.model_cards(daily(t), price_estimates(t))


@query("I1_I4_all_cards", """
    SELECT * FROM weather_cards UNION ALL SELECT * FROM mix_cards UNION ALL SELECT * FROM segment_cards
    UNION ALL SELECT * FROM model_cards""", "weather_cards mix_cards segment_cards model_cards")
def all_cards(t):
    return I.region_insights(daily(t), G.assign_segments(features(t)), price_estimates(t), climate_prices(t))
