"""Crop panel, forecast and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import crops as K
from fieldmart.operators import market as M
from fieldmart.operators import models as ML
from fieldmart.operators import panel as P
from fieldmart.operators import slices as S
from fieldmart.plans.base import define, query
from fieldmart.plans.climate_queries import market_features
from fieldmart.plans.market_queries import region_days

CELL = ", ".join(P.CELL)

define("crop_years", """
    SELECT state, district, crop, crop_type, season, year_start, year, area, production, "yield", state_code, district_code
    FROM (SELECT *, row_number() OVER (PARTITION BY state, district, crop, season, year_start ORDER BY id) AS rn
          FROM (SELECT * FROM agri UNION ALL SELECT * REPLACE (id + 1 AS id, production + 1 AS production) FROM agri)
          WHERE year_start IS NOT NULL) WHERE rn = 1""", "agri")
define("crop_block", """
    SELECT state, district, crop, crop_type, min(state_code) AS state_code, min(district_code) AS district_code,
           count(*) AS n_year_season_rows, count(DISTINCT year_start) AS years_observed,
           min(year_start) AS first_year, max(year_start) AS last_year,
           max(CASE WHEN rn = 1 THEN year_start END) AS latest_year, max(CASE WHEN rn = 1 THEN season END) AS latest_season,
           max(CASE WHEN rn = 1 THEN area END) AS latest_area_ha,
           max(CASE WHEN rn = 1 THEN production END) AS latest_production_t,
           max(CASE WHEN rn = 1 THEN "yield" END) AS latest_yield_t_per_ha,
           coalesce(sum(area), 0) AS total_area_ha, sum(production) AS total_production_t
    FROM (SELECT *, row_number() OVER (PARTITION BY state, district, crop, crop_type
                                       ORDER BY year_start DESC, season DESC) AS rn FROM agri)
    GROUP BY 1, 2, 3, 4""", "agri")
define("crop_market", """
    SELECT c.*, CASE WHEN b.commodity IS NULL THEN 'no_records' ELSE 'matched' END AS market_status,
           b.commodity AS matched_commodity, coalesce(n_market_records, 0) AS n_market_records,
           coalesce(n_markets, 0) AS n_markets, latest_market_date, latest_modal_price, latest_min_price,
           latest_max_price, avg_modal_price_7d, modal_price_change_pct_7d
    FROM crop_block c LEFT JOIN block b ON lower(c.district) = lower(b.district) AND lower(c.crop) = lower(b.commodity)""",
       "crop_block", "block")
define("district_weather", """
    SELECT district, avg(temp_max_c) AS obs_temp_max_c, avg(temp_min_c) AS obs_temp_min_c,
           avg(precipitation_mm) AS obs_precip_mm, round(avg(humidity_pct), 4) AS obs_humidity_pct,
           CASE WHEN count(temp_max_c) > 0 THEN 'reported' ELSE 'no_records' END AS weather_status
    FROM region_days WHERE district IS NOT NULL GROUP BY 1""", "region_days")


@query("W7_crop_year_panel", "SELECT * FROM crop_years", "crop_years")
def w7(t):
    copies = t.agri.withColumns({"id": F.col("id") + 1, "production": F.col("production") + 1})
    return K.crop_year_panel(t.agri.unionByName(copies))


@query("A10_crop_block", "SELECT * FROM crop_block", "crop_block")
def a10(t):
    return K.crop_block(K.crop_year_panel(t.agri))


@query("J6_crop_market", "SELECT * FROM crop_market", "crop_market")
def j6(t):
    return K.match_market(K.crop_block(K.crop_year_panel(t.written.agri)), M.commodity_block(t.written.trades, "F", tie=["row_id"]))


@query("J7_crop_weather", """
    SELECT state, c.district, crop, crop_type, coalesce(weather_status, 'no_records') AS weather_status,
           obs_temp_max_c, obs_temp_min_c, obs_precip_mm, obs_humidity_pct
    FROM crop_block c LEFT JOIN district_weather w ON lower(c.district) = lower(w.district)""",
       "crop_block district_weather")
def j7(t):
    from fieldmart.operators.climate import district_weather
    crops = K.crop_block(K.crop_year_panel(t.written.agri)).select(*K.SUMMARY_KEY)
    return K.match_weather(crops, district_weather(region_days(t))).withColumn(
        "obs_humidity_pct", F.round("obs_humidity_pct", 4))


@query("A10_J6_J7_crop_summary", """
    SELECT c.*, coalesce(weather_status, 'no_records') AS weather_status, obs_temp_max_c, obs_temp_min_c,
           obs_precip_mm, obs_humidity_pct, cast(NULL AS varchar) AS weather_warning
    FROM crop_market c LEFT JOIN district_weather w ON lower(c.district) = lower(w.district)""",
       "crop_market district_weather")
def crop_summary(t):
    return K.crop_summary(t.written.agri, t.written.trades, region_days(t), "F", ["row_id"]).withColumn(
        "obs_humidity_pct", F.round("obs_humidity_pct", 4))


# -- forecast panel ---------------------------------------------------------------

define("loaded", f"""
    SELECT trim(state) AS state, trim(district) AS district, trim(crop) AS crop, trim(season) AS season, crop_type, year_start, year, state_code,
           district_code, production AS production_t, area AS area_ha, "yield" AS yield_tph FROM panel""", "panel")
define("lagged", f"""
    SELECT *, year_start - min(year_start) OVER (PARTITION BY {CELL}) AS year_offset,
           lag(production_t, 1) OVER c AS lag1_production, lag(production_t, 2) OVER c AS lag2_production,
           lag(area_ha, 1) OVER c AS lag1_area_ha, lag(yield_tph, 1) OVER c AS lag1_yield,
           avg(production_t) OVER (PARTITION BY {CELL} ORDER BY year_start ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
             AS roll3_production
    FROM loaded WINDOW c AS (PARTITION BY {CELL} ORDER BY year_start)""", "loaded")
define("usable", "SELECT * FROM lagged WHERE production_t IS NOT NULL AND lag1_production IS NOT NULL", "lagged")
define("good", f"""
    SELECT * FROM usable SEMI JOIN (SELECT {CELL} FROM usable GROUP BY ALL HAVING count(*) >= 6) USING ({CELL})""", "usable")
define("years", "SELECT year_start, row_number() OVER (ORDER BY year_start DESC) AS back FROM (SELECT DISTINCT year_start FROM good)", "good")
define("labelled", """
    SELECT g.*, CASE WHEN back <= 2 THEN 'test' WHEN back <= 5 THEN 'validate' ELSE 'train' END AS split,
           coalesce(lag1_production, 0) AS baseline
    FROM good g JOIN years USING (year_start)""", "good", "years")


def loaded(t):
    return P.load_panel(t.panel)


def good(t):
    return P.eligible(P.build_features(loaded(t)))


def labelled(t):
    rows = good(t)
    splits = P.temporal_splits(P.observed_years(rows))
    return P.with_split(rows, splits).withColumn("baseline", P.persistence())


@query("M1_load_panel", "SELECT * FROM loaded", "loaded")
def m1(t):
    return loaded(t)


@query("W3_lags", f"""
    SELECT {CELL}, year_start, lag1_production, lag2_production, lag1_area_ha, lag1_yield FROM lagged""", "lagged")
def w3(t):
    return P.with_lags(loaded(t)).select(
        *P.CELL, "year_start", "lag1_production", "lag2_production", "lag1_area_ha", "lag1_yield")


@query("W4_previous_mean", f"SELECT {CELL}, year_start, roll3_production FROM lagged", "lagged")
def w4(t):
    return P.with_lags(loaded(t)).select(*P.CELL, "year_start", "roll3_production")


@query("W5_year_offset", f"SELECT {CELL}, year_start, year_offset FROM lagged", "lagged")
def w5(t):
    return P.with_lags(loaded(t)).select(*P.CELL, "year_start", "year_offset")


FEATURE_COLUMNS = [*P.CELL, "year_start", "production_t", "lag1_production", "roll3_production", "lag1_yield"]


@query("M2_features", f"""
    SELECT {', '.join(FEATURE_COLUMNS)}, round(ln(1 + lag1_area_ha), 9) AS lag1_area_log FROM usable""", "usable")
def m2(t):
    return P.build_features(loaded(t)).select(*FEATURE_COLUMNS, F.round("lag1_area_log", 9).alias("lag1_area_log"))


@query("M3_ordinals", """
    SELECT DISTINCT state, district, cast(dense_rank() OVER (ORDER BY district) - 1 AS double) AS district_ordinal,
           cast(dense_rank() OVER (ORDER BY state) - 1 AS double) AS state_ordinal FROM loaded""", "loaded")
def m3(t):
    rows = loaded(t)
    return P.with_ordinals(rows, rows).select("state", "district", "district_ordinal", "state_ordinal").distinct()


@query("A11_cell_counts", f"SELECT {CELL}, count(*) AS n_year_season_rows FROM usable GROUP BY ALL", "usable")
def a11(t):
    return P.cell_counts(P.build_features(loaded(t)))


@query("J10_eligible_cells", f"SELECT {CELL}, year_start, production_t, lag1_production FROM good", "good")
def j10(t):
    return good(t).select(*P.CELL, "year_start", "production_t", "lag1_production")


@query("M4_prepared_dataset", f"""
    SELECT {', '.join(FEATURE_COLUMNS)}, year_offset FROM good""", "good")
def m4(t):
    return good(t).select(*FEATURE_COLUMNS, "year_offset")


@query("M5_temporal_split", """
    SELECT split, min(year_start) AS first_year, max(year_start) AS last_year, count(*) AS rows
    FROM labelled GROUP BY 1""", "labelled")
def m5(t):
    return labelled(t).groupBy("split").agg(
        F.min("year_start").alias("first_year"), F.max("year_start").alias("last_year"), F.count(F.lit(1)).alias("rows"))


@query("M7_persistence", f"""
    SELECT {CELL}, year_start, production_t, baseline FROM labelled WHERE split <> 'train'""", "labelled")
def m7(t):
    return labelled(t).where(F.col("split") != "train").select(*P.CELL, "year_start", "production_t", "baseline")


def metrics_sql(source: str, predicted: str, by: str) -> str:
    return f"""
        SELECT {by}, round(mae, 2) AS mae_t, round(sqrt(mse), 2) AS rmse_t, round(1 - mse / var, 4) AS r2_vs_observed_mean,
               round(mae / greatest(mean, 1e-9) * 100, 4) AS mae_pct_of_mean, round(ape, 6) AS mape_median_pct,
               mape_on_rows, n_rows
        FROM (SELECT {by}, avg(abs(production_t - {predicted})) AS mae,
                     avg((production_t - {predicted}) * (production_t - {predicted})) AS mse,
                     var_pop(production_t) AS var, avg(production_t) AS mean, count(*) AS n_rows,
                     count(*) FILTER (WHERE production_t >= 1) AS mape_on_rows,
                     median(abs(production_t - {predicted}) / production_t * 100)
                       FILTER (WHERE production_t >= 1 AND {predicted} > 0) AS ape
              FROM {source} GROUP BY {by})"""


@query("M8_metrics", metrics_sql("labelled", "baseline", "split"), "labelled")
def m8(t):
    return P.published(P.grade(labelled(t), "baseline", ["split"])).withColumn(
        "mape_median_pct", F.round("mape_median_pct", 6))


@query("M9_model_selection", """
    SELECT CASE WHEN avg(abs(production_t - roll3_production)) <= avg(abs(production_t - baseline))
           THEN 'gradient_boosting' ELSE 'naive_persistence' END AS chosen,
           round(avg(abs(production_t - roll3_production)), 2) AS model_mae, round(avg(abs(production_t - baseline)), 2) AS naive_mae
    FROM labelled WHERE split = 'validate'""", "labelled")
def m9(t):
    """Selection rule with the three-year mean standing in for the fitted model."""
    rows = labelled(t).where(F.col("split") == "validate")
    model = P.grade(rows, "roll3_production").select(F.col("mae_t").alias("model_mae"))
    naive = P.grade(rows, "baseline").select("mae_t")
    both = model.withColumn("naive_mae", naive.scalar()).first()
    chosen = P.choose_model(both["model_mae"], both["naive_mae"])
    return t.spark.createDataFrame([(chosen, round(both["model_mae"], 2), round(both["naive_mae"], 2))],
                                   "chosen string, model_mae double, naive_mae double")


define("spread", """
    SELECT stddev_pop(ln(1 + production_t) - ln(1 + greatest(baseline, 0))) AS s FROM labelled WHERE split = 'test'""", "labelled")


@query("M10_residual_band", f"""
    SELECT {CELL}, year_start, production_t AS forecast_production_tonnes,
           round(greatest(production_t / (1 + 1.96e0 * s), 0), 2) AS forecast_lower_tonnes,
           round(production_t * (1 + 1.96e0 * s), 2) AS forecast_upper_tonnes
    FROM labelled, spread WHERE split = 'test'""", "labelled spread")
def m10(t):
    test = labelled(t).where(F.col("split") == "test")
    return P.with_band(test, "production_t", P.residual_spread(test, "baseline").scalar()).select(
        *P.CELL, "year_start", "forecast_production_tonnes",
        F.round("forecast_lower_tonnes", 2).alias("forecast_lower_tonnes"),
        F.round("forecast_upper_tonnes", 2).alias("forecast_upper_tonnes"))


@query("J11_anchor_cells", f"""
    SELECT {CELL}, g.year_start, production_t, n_year_season_rows
    FROM good g JOIN (SELECT {CELL}, count(*) AS n_year_season_rows FROM good GROUP BY ALL) n USING ({CELL})
    WHERE g.year_start = (SELECT max(year_start) FROM good)""", "good")
def j11(t):
    rows = good(t)
    return P.anchor_cells(rows, rows.agg(F.max("year_start")).scalar()).select(
        *P.CELL, "year_start", "production_t", "n_year_season_rows")


def persistence_forecast(t):
    """The forecast table under the persistence choice: no fitted model in it."""
    lagged = P.with_lags(loaded(t))
    rows = P.eligible(P.forecastable(lagged))
    years = P.observed_years(rows)
    test = P.with_split(rows, P.temporal_splits(years)).where(F.col("split") == "test")
    spread = P.residual_spread(test.withColumn("baseline", P.persistence()), "baseline").first()[0]
    return ML.forecast_frame(lagged, rows, None, "naive_persistence", spread, years[-1])


define("forecasts", f"""
    SELECT {CELL}, state_code, district_code, crop_type, n_year_season_rows,
           (year_start + 1) || '-' || (year_start + 2) AS forecast_year,
           year_start || '-' || (year_start + 1) AS latest_observed_year, production_t AS observed_last_tonnes,
           production_t AS forecast_production_tonnes,
           round(greatest(production_t / (1 + 1.96e0 * s), 0), 2) AS forecast_lower_tonnes,
           round(production_t * (1 + 1.96e0 * s), 2) AS forecast_upper_tonnes, 'naive_persistence-prototype' AS model_used
    FROM good g JOIN (SELECT {CELL}, count(*) AS n_year_season_rows FROM good GROUP BY ALL) n USING ({CELL}), spread
    WHERE g.year_start = (SELECT max(year_start) FROM good)""", "good", "spread")


def rounded_band(df):
    return df.withColumns({c: F.round(c, 2) for c in ("forecast_lower_tonnes", "forecast_upper_tonnes")})


@query("M11_persistence_forecast", "SELECT * FROM forecasts", "forecasts")
def m11_persistence(t):
    return rounded_band(persistence_forecast(t))


@query("F4_cell_series", f"""
    SELECT {CELL}, cast(year_start AS bigint) AS year, production_t, NULL::double AS lower_t, NULL::double AS upper_t, 'history' AS kind
    FROM loaded WHERE production_t IS NOT NULL
    UNION ALL SELECT {CELL}, cast(substr(forecast_year, 1, 4) AS bigint), forecast_production_tonnes, forecast_lower_tonnes,
           forecast_upper_tonnes, 'forecast' FROM forecasts""", "loaded forecasts")
def f4(t):
    return S.cell_series(t.panel, rounded_band(persistence_forecast(t)))


@query("F4_default_season", """
    SELECT state, district, crop, min(season) AS season FROM panel GROUP BY 1, 2, 3""", "panel")
def f4_season(t):
    return S.default_season(t.panel, ["state", "district", "crop"])


@query("A12_agriculture_audit", """
    SELECT *, CASE WHEN n_years >= 10 THEN 'production (tonnes, next unobserved year)'
                   ELSE 'no valid target -- agriculture history insufficient' END AS target_decision
    FROM (SELECT count(*) AS rows, min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS n_years,
                 count(DISTINCT state) AS n_states, count(DISTINCT district) AS n_districts, count(DISTINCT crop) AS n_crops
          FROM agri)""", "agri")
def a12(t):
    return P.audit_agriculture(t.agri)


@query("A12_source_windows", """
    SELECT 'market' AS source, count(*) AS rows, cast(min(latest_date) AS varchar) AS first_date, cast(max(latest_date) AS varchar) AS last_date,
           count(DISTINCT latest_date) AS n_dates, cast(sum(days_of_history) AS bigint) AS total_record_days FROM lines
    UNION ALL SELECT 'weather', count(*), cast(min(date) AS varchar), cast(max(date) AS varchar), count(DISTINCT date), 0 FROM region_days""",
       "lines region_days")
def a12_windows(t):
    market = P.audit_dates(M.market_summary(t.written.trades, tie=["row_id"], benchmark=None), "latest_date", "days_of_history")
    weather = P.audit_dates(region_days(t), "date")
    return market.select(F.lit("market").alias("source"), "*").unionByName(
        weather.select(F.lit("weather").alias("source"), "*"))


@query("T3_held_out_sample", f"""
    SELECT {CELL}, year_start, production_t AS observed_tonnes, baseline AS predicted_tonnes FROM labelled WHERE split = 'test'""",
       "labelled")
def t3(t):
    return P.held_out_rows(labelled(t).where(F.col("split") == "test"), "baseline")


# -- fitted models: the SQL states what no fit decides ---------------------------------

@query("M6_boosted_trees", f"""
    SELECT {CELL}, year_start, split, production_t, baseline, true AS has_prediction FROM labelled WHERE split <> 'train'""", "labelled")
def m6(t):
    """Held-out rows of the fitted trees; the predictions themselves are checked by tests."""
    table, binning = ML.training_table(ML.prepare(t.panel)[1])
    marked = P.with_split(table, P.temporal_splits(P.observed_years(table)))
    trees = ML.fit_trees(marked.where(F.col("split") == "train"), binning)
    scored = trees.score(marked.where(F.col("split") != "train")).withColumn("baseline", P.persistence())
    fine = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return scored.select(*P.CELL, "year_start", "split", "production_t", "baseline", fine.alias("has_prediction"))


@query("M11_forecast_frame", f"""
    SELECT {CELL}, state_code, district_code, crop_type, n_year_season_rows, forecast_year, latest_observed_year, observed_last_tonnes,
           true AS has_forecast, 1.0e0 AS band_product FROM forecasts""", "forecasts")
def m11(t):
    """Keys, counts and years of the forecast table, and its band: lower times upper is the square of the forecast."""
    found = ML.run_forecast(t.panel).forecast
    p = F.col("forecast_production_tonnes")
    product = F.when(p > 0, F.round(F.col("forecast_lower_tonnes") * F.col("forecast_upper_tonnes") / (p * p), 6)).otherwise(1.0)
    return found.select(
        *P.CELL, "state_code", "district_code", "crop_type", "n_year_season_rows", "forecast_year", "latest_observed_year",
        "observed_last_tonnes", (p.isNotNull() & (p >= 0)).alias("has_forecast"), product.alias("band_product"))


@query("M12_model_report", f"""
    SELECT 'prototype' AS model_status, false AS production_ready, 'production' AS target, 6 AS n_limitations,
           (SELECT count(*) FROM forecasts) AS forecast_cells,
           (SELECT count(*) FROM labelled WHERE split = 'train') AS training_rows,
           (SELECT count(*) FROM labelled WHERE split = 'test') AS held_out_rows,
           (SELECT string_agg(year_start, ',' ORDER BY year_start) FROM years WHERE back > 5) AS train_years,
           (SELECT string_agg(year_start, ',' ORDER BY year_start) FROM years WHERE back BETWEEN 3 AND 5) AS validate_years,
           (SELECT string_agg(year_start, ',' ORDER BY year_start) FROM years WHERE back <= 2) AS test_years,
           (SELECT max(year_start + 1) || '-' || max(year_start + 2) FROM years) AS next_unobserved_year,
           m.mae_t AS naive_mae_t, m.rmse_t AS naive_rmse_t, m.n_rows AS test_rows, a.n_crops AS n_crops, a.last_year AS last_year
    FROM ({metrics_sql("labelled", "baseline", "split")}) m,
         (SELECT count(DISTINCT crop) AS n_crops, max(year) AS last_year FROM panel) a
    WHERE m.split = 'test'""", "labelled forecasts panel")
def m12(t):
    """The report, parsed again; metrics of the fitted model are left to the tests."""
    report = ML.model_report(ML.run_forecast(t.panel), P.audit_agriculture(t.panel))
    parsed = report.select(F.from_json("report", """
        model_status string, production_ready boolean, target struct<variable: string, next_unobserved_year: string>,
        limitations array<string>, forecast_cells long, training_rows long, held_out_rows long,
        splits struct<train: array<int>, validate: array<int>, test: array<int>>,
        metrics struct<naive_baseline_test_mae_t: double, naive_baseline_test_rmse_t: double, test_rows: long>,
        dimensions struct<n_crops: long, last_year: string>""").alias("r"))
    years = [F.array_join(F.col(f"r.splits.{k}").cast("array<string>"), ",").alias(f"{k}_years") for k in ("train", "validate", "test")]
    return parsed.select(
        "r.model_status", "r.production_ready", F.col("r.target.variable").alias("target"), F.size("r.limitations").alias("n_limitations"),
        "r.forecast_cells", "r.training_rows", "r.held_out_rows", *years, "r.target.next_unobserved_year",
        F.col("r.metrics.naive_baseline_test_mae_t").alias("naive_mae_t"), F.col("r.metrics.naive_baseline_test_rmse_t").alias("naive_rmse_t"),
        "r.metrics.test_rows", "r.dimensions.n_crops", "r.dimensions.last_year")


PRICE = "market_price_signal_inr_per_quintal"
define("price_rows", f"""
    SELECT *, ('0x' || substr(md5('42|' || coalesce(region_name, '')), 1, 8))::bigint % 10000 < 2000 AS held_out
    FROM market_features""", "market_features")
define("price_fit", f"""
    SELECT *, y0 - bx * x0 - bz * z0 - bw * w0 AS b0 FROM (
      SELECT *, (py * (zz * ww - zw * zw) - xz * (qy * ww - zw * ry) + xw * (qy * zw - zz * ry)) / det AS bx,
             (xx * (qy * ww - zw * ry) - py * (xz * ww - zw * xw) + xw * (xz * ry - qy * xw)) / det AS bz,
             (xx * (zz * ry - qy * zw) - xz * (xz * ry - qy * xw) + py * (xz * zw - zz * xw)) / det AS bw
      FROM (SELECT *, xx * (zz * ww - zw * zw) - xz * (xz * ww - zw * xw) + xw * (xz * zw - zz * xw) AS det FROM (
        SELECT avg(x) AS x0, avg(z) AS z0, avg(w) AS w0, avg(y) AS y0, var_pop(x) AS xx, var_pop(z) AS zz, var_pop(w) AS ww,
               covar_pop(x, z) AS xz, covar_pop(x, w) AS xw, covar_pop(z, w) AS zw,
               covar_pop(x, y) AS py, covar_pop(z, y) AS qy, covar_pop(w, y) AS ry
        FROM (SELECT avg_temp_c AS x, total_precip_mm AS z, avg_humidity_pct AS w, {PRICE} AS y FROM price_rows
              WHERE NOT held_out AND avg_temp_c IS NOT NULL AND total_precip_mm IS NOT NULL AND avg_humidity_pct IS NOT NULL
                AND {PRICE} IS NOT NULL))))""", "price_rows")


@query("M13_price_model", f"""
    SELECT region_name, round(y, 4) AS actual_signal_inr_per_quintal, round(p, 4) AS predicted_signal_inr_per_quintal,
           round(p - y, 4) AS difference_inr_per_quintal, round(CASE WHEN y <> 0 THEN (p - y) / y * 100 END, 4) AS prediction_error_pct
    FROM (SELECT region_name, {PRICE} AS y, b0 + bx * avg_temp_c + bz * total_precip_mm + bw * avg_humidity_pct AS p
          FROM price_rows, price_fit)""", "price_rows price_fit")
def m13(t):
    rows = market_features(t)
    found = ML.price_forecast(rows, ML.train_price_model(rows))
    return found.select("region_name", *[F.round(c, 4).alias(c) for c in found.columns if c != "region_name"])


@query("M15_forecast_gate", """
    SELECT 'not_generated' AS model_status, 'market_price_signal_inr_per_quintal' AS target_variable,
           'market source not configured' AS reason, count(*) AS regions FROM features""", "features")
def m15(t):
    return ML.gate_status(market_features(t), configured=False)


@query("M16_run_metadata", """
    SELECT 'demand_forecast' AS step, 'skipped_market_gate' AS status, 'ml_status' AS output, 1 AS rows
    UNION ALL SELECT 'weather_exposure_segmentation', 'success', 'region_segments', count(*) FROM features
    UNION ALL SELECT 'market_places', CASE WHEN count(*) > 0 THEN 'stopped_at_gate' ELSE 'success' END, 'silver/geo', 0 FROM market_places
    WHERE NOT (length(state_code) = 2 AND mandi_apmc IS NOT NULL AND latitude BETWEEN 6 AND 37 AND longitude BETWEEN 68 AND 98)""",
       "features market_places")
def m16(t):
    """Three steps that run: one its gate skips, one that succeeds, one that a contract stops."""
    from fieldmart.operators.contracts import GEO
    from fieldmart.operators.segments import assign_segments
    from fieldmart.plans.climate_queries import features
    from fieldmart.session import scratch_path
    from fieldmart.sources.sinks import StepSkipped, run_steps, write_silver

    def price_forecast():
        rows = market_features(t)
        gate = ML.gate_status(rows, configured=False)
        if gate is not None:
            raise StepSkipped("skipped_market_gate", gate)
        return ML.price_forecast(rows, ML.train_price_model(rows))

    path = scratch_path(t.spark, "steps")
    return run_steps(t.spark, [
        ("demand_forecast", "ml_status", price_forecast),
        ("weather_exposure_segmentation", "region_segments", lambda: assign_segments(features(t))),
        ("market_places", "silver/geo", lambda: write_silver(t.market_places, GEO, f"{path}/geo", f"{path}/_rejects"))])
