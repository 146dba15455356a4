import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmart.operators import models as ML
from fieldmart.operators import panel as P
from tests.conftest import day, rows


@pytest.fixture(scope="module")
def crop_year(spark):
    rng = random.Random(7)
    data = []
    for cell in range(12):
        base = rng.uniform(50, 500)
        for i, year in enumerate(range(1997, 2012)):
            data.append((f"S{cell % 3}", f" D{cell} ", "Wheat" if cell % 2 else "Rice", "Kharif", year, f"{year}-{year + 1}",
                         max(base * 1.03 ** i + rng.gauss(0, 5), 1.0), 50.0, 2.0, cell % 3, cell, "Cereals"))
    return spark.createDataFrame(data, "state string, district string, crop string, season string, year_start int, year string, "
                                       "production double, area double, yield double, state_code long, district_code long, crop_type string")


def test_features_use_only_the_past_of_the_cell(crop_year):
    got = rows(P.build_features(P.load_panel(crop_year)), "district", "year_start")
    source = {(r["district"].strip(), r["year_start"]): r["production"] for r in rows(crop_year)}
    assert {r["year_start"] for r in got} == set(range(1998, 2012))
    for r in got:
        d, y = r["district"], r["year_start"]
        assert r["lag1_production"] == source[d, y - 1]
        assert r["roll3_production"] == pytest.approx(np.mean([source[d, p] for p in range(max(1997, y - 3), y)]))
        assert r["year_offset"] == y - 1997 and r["lag1_area_log"] == pytest.approx(math.log1p(50.0))


def test_lags_follow_observed_rows_and_skip_nulls(spark):
    df = spark.createDataFrame([(2000, 1.0), (2003, None), (2004, 5.0), (2005, 7.0)], "year_start int, production double").select(
        *[F.lit("x").alias(c) for c in P.CELL], "year_start", "production", F.lit(1.0).alias("area"), F.lit(1.0).alias("yield"))
    got = {r["year_start"]: r for r in rows(P.with_lags(P.load_panel(df)))}
    assert got[2003]["lag1_production"] == 1.0 and got[2004]["lag1_production"] is None
    assert (got[2005]["lag2_production"], got[2005]["roll3_production"]) == (None, 3.0)
    assert sorted(r["year_start"] for r in rows(P.build_features(P.load_panel(df)))) == [2005]


def test_eligible_cells(crop_year):
    features = P.build_features(P.load_panel(crop_year))
    short = features.where("district <> 'D0' or year_start < 2003")
    assert "D0" not in {r["district"] for r in rows(P.eligible(short))}
    assert P.eligible(features).count() == 12 * 14


def test_temporal_split_sizes():
    s = P.temporal_splits(range(1997, 2023))
    assert [len(s[k]) for k in ("train", "validate", "test")] == [21, 3, 2]
    assert max(s["train"]) < min(s["validate"]) and max(s["validate"]) < min(s["test"])


def test_ordinals_are_dense_and_alphabetical(crop_year):
    panel = P.load_panel(crop_year)
    got = {r["district"]: r["district_ordinal"] for r in rows(P.with_ordinals(panel, panel))}
    assert got == {d: float(i) for i, d in enumerate(sorted(got))}


def test_metrics_equal_numpy(spark):
    y, p = np.array([0.5, 10.0, 20.0, 40.0, 5.0]), np.array([1.0, 12.0, 15.0, 50.0, -1.0])
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "production_t double, pred double")
    (m,) = rows(P.published(P.grade(df, "pred")))
    err = y - p
    assert m["mae_t"] == round(float(np.abs(err).mean()), 2) and m["rmse_t"] == round(float(np.sqrt((err ** 2).mean())), 2)
    assert m["r2_vs_observed_mean"] == round(float(1 - (err ** 2).sum() / ((y - y.mean()) ** 2).sum()), 4)
    assert m["mape_median_pct"] == pytest.approx(25.0) and (m["mape_on_rows"], m["n_rows"]) == (4, 5)


def test_band_and_spread(spark):
    df = spark.createDataFrame([(10.0, 8.0), (20.0, 25.0), (5.0, -3.0)], "production_t double, pred double")
    spread = P.residual_spread(df, "pred").first()[0]
    res = np.log1p([10, 20, 5]) - np.log1p([8, 25, 0])
    assert spread == pytest.approx(float(np.std(res)))
    for r in rows(P.with_band(df, "pred", F.lit(spread))):
        assert 0 <= r["forecast_lower_tonnes"] <= r["forecast_production_tonnes"] <= r["forecast_upper_tonnes"]


def test_model_choice_favours_the_model_on_equality():
    assert P.choose_model(1.0, 1.0) == "gradient_boosting" and P.choose_model(1.1, 1.0) == "naive_persistence"


def test_forecast_run(crop_year):
    run = ML.run_forecast(crop_year, validate=2, test=2, max_iter=3)
    got = rows(run.forecast)
    assert len(got) == 12 and run.anchor == 2011
    for r in got:
        assert 0 <= r["forecast_lower_tonnes"] <= r["forecast_production_tonnes"] <= r["forecast_upper_tonnes"]
        assert (r["forecast_year"], r["n_year_season_rows"]) == ("2012-2013", 14)
    metrics = {(r["split"], r["predictor"]): r["mae_t"] for r in rows(run.metrics)}
    better = metrics["validate", "gradient_boosting"] <= metrics["validate", "naive_persistence"]
    assert run.chosen == ("gradient_boosting" if better else "naive_persistence")
    report = json.loads(ML.model_report(run, P.audit_agriculture(crop_year)).first()[0])
    assert report["held_out_rows"] == run.test.count() > 0
    assert report["forecast_cells"] == 12 and report["audit"]["n_years"] == 15


def test_rolled_features_are_the_anchor_values(crop_year):
    lagged = P.with_lags(P.load_panel(crop_year))
    got = {r["district"]: r for r in rows(P.next_year_features(lagged, 2011))}
    source = {(r["district"].strip(), r["year_start"]): r["production"] for r in rows(crop_year)}
    for d, r in got.items():
        assert r["lag1_production"] == source[d, 2011] and r["year_offset"] == 15
        assert r["roll3_production"] == pytest.approx(np.mean([source[d, y] for y in (2009, 2010, 2011)]))


def test_all_held_out_rows_are_kept(crop_year):
    test = P.build_features(P.load_panel(crop_year))
    assert P.held_out_rows(test, "lag1_production").count() == test.count()


def test_audit(spark, crop_year):
    (a,) = rows(P.audit_agriculture(crop_year))
    assert (a["rows"], a["n_years"], a["n_districts"]) == (180, 15, 12) and a["target_decision"].startswith("production")
    (b,) = rows(P.audit_agriculture(crop_year.where("year_start < 2000")))
    assert b["target_decision"].startswith("no valid target")
    windows = spark.createDataFrame([(day("2026-04-01"), 3), (day("2026-04-05"), 4)], "latest_date date, days_of_history int")
    assert rows(P.audit_dates(windows, "latest_date", "days_of_history")) == [
        {"rows": 2, "first_date": "2026-04-01", "last_date": "2026-04-05", "n_dates": 2, "total_record_days": 7}]


def regions(spark, n, zero=False):
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 50, (n, 3))
    y = x @ np.array([2.0, -1.0, 0.5]) + 300 + rng.normal(0, 1, n)
    if zero:
        y[0] = 0.0
    return spark.createDataFrame([(f"r{i}", *map(float, x[i]), float(y[i])) for i in range(n)],
                                 "region_name string, avg_temp_c double, total_precip_mm double, avg_humidity_pct double, "
                                 "market_price_signal_inr_per_quintal double"), x, y


def test_price_model_equals_least_squares(spark):
    df, x, y = regions(spark, 10)
    fit = ML.train_price_model(df, held_out=False)
    coef = np.linalg.lstsq(np.c_[x, np.ones(len(y))], y, rcond=None)[0]
    assert list(fit.coefficients.values()) == pytest.approx(coef[:3].tolist(), abs=1e-4)
    assert fit.metrics["metrics_are_in_sample"] and "in-sample" in fit.methodology
    assert fit.metrics["small_sample_warning"] and fit.metrics["regions_left_out"] == 0
    large = ML.train_price_model(regions(spark, 40)[0])
    assert not large.metrics["metrics_are_in_sample"] and large.metrics["r2"] > 0.9


def test_price_forecast_error_is_null_at_zero(spark):
    df, _, _ = regions(spark, 10, zero=True)
    fit = ML.train_price_model(df, held_out=False)
    got = {r["region_name"]: r for r in rows(ML.price_forecast(df, fit))}
    assert got["r0"]["prediction_error_pct"] is None and got["r1"]["prediction_error_pct"] is not None


def test_regions_without_a_feature_have_no_estimate(spark):
    df, _, _ = regions(spark, 20)
    gap = df.withColumn("avg_humidity_pct", F.when(F.col("region_name") != "r3", F.col("avg_humidity_pct")))
    fit = ML.train_price_model(gap)
    assert fit.metrics["regions_left_out"] == 1
    got = {r["region_name"]: r["predicted_signal_inr_per_quintal"] for r in rows(ML.price_forecast(gap, fit))}
    assert got["r3"] is None and got["r4"] is not None


def test_gate(spark):
    df, _, _ = regions(spark, 3)
    assert ML.gate_status(df, configured=True) is None
    (status,) = rows(ML.gate_status(df, configured=False))
    assert (status["model_status"], status["regions"]) == ("not_generated", 3)
    assert "target" in ML.gate_status(df.drop(ML.PRICE_TARGET), configured=True).first()["reason"]
