"""The fitted models: bins, the published protocol, least squares, reports."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmart.operators import binned as B
from fieldmart.operators import models as ML
from fieldmart.operators import panel as P
from fieldmart.plans import base
from fieldmart.plans import registered  # noqa: F401  (fills the registry)

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["rice", "wheat", None]), rng.choice([None, float("nan"), rng.gauss(0, 1), 3.0]), float(i % 4), i) for i in range(2000)]
    return spark.createDataFrame(rows, "crop string, a double, b double, id int").repartition(7)


def test_bins_hold_about_equally_many_rows(features):
    binning = B.fit_bins(features, ["a", "b"], ["crop"], bins=16)
    table = B.binned_table(features, binning)
    assert dict(table.dtypes)["a_bin"] == dict(table.dtypes)["crop_index"] == "smallint"
    got = table.toPandas()
    assert len(got) == 2000 and set(got.b_bin) == {1, 2, 3, 4} and set(got.crop_index) == {0, 1, 2}
    missing = got.a.isna()
    assert (got.a_bin[missing] == 0).all() and (got.a_bin[~missing] > 0).all()
    edges = np.array(binning.edges["a"])
    expected = 1 + np.searchsorted(edges, got.a[~missing], side="left")
    assert (got.a_bin[~missing] == expected).all()
    counts = got.a_bin[~missing & (got.a != 3.0)].value_counts()
    assert counts.max() <= 3 * counts.median() and binning.largest <= 17


def test_new_values_fall_into_the_outer_bins_and_labels_into_their_own(spark, features):
    binning = B.fit_bins(features, ["b"], ["crop"], bins=16)
    new = spark.createDataFrame([("maize", -1e9), ("rice", 1e9), (None, None)], "crop string, b double")
    assert [(r.crop_index, r.b_bin) for r in binning.apply(new).orderBy(F.desc_nulls_last("crop")).collect()] == [(0.0, 4.0), (2.0, 1.0), (2.0, 0.0)]


def test_parts_follow_the_rows(features):
    binning = B.fit_bins(features, ["b"])
    assert B.binned_table(features, binning, part_rows=500).rdd.getNumPartitions() >= 4
    one = B.binned_table(features, binning)
    assert one.rdd.getNumPartitions() == 1


def test_both_fits_read_one_table(spark, features, monkeypatch):
    """A fit's input scans the written table: no lags, ranks or bins are computed again."""
    rows = features.select("crop", F.lit("k").alias("season"), *[F.col("b").alias(c) for c in P.NUMERIC], F.col("b").alias(P.TARGET))
    table, binning = ML.training_table(rows)
    plan = B.as_vector(table, binning).select("features", P.TARGET)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Bucketizer" not in plan and "binned-parts" in plan
    fitted = ML.fit_trees(table, binning, 5)
    assert fitted.model.getOrDefault("checkpointInterval") == ML.CHECKPOINT_ROUNDS and fitted.score(table).count() == 2000


def test_trees_find_steps_and_missing_values(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        x = rng.choice([None, rng.uniform(0, 100)])
        y = 500.0 if x is None else (100.0 if x < 40 else 300.0)
        rows.append(("rice", "kharif", x, 1.0, y))
    df = spark.createDataFrame(rows, "crop string, season string, x double, other double, production_t double")
    df = df.select("crop", "season", P.TARGET, *[F.col("x" if i == 3 else "other").alias(c) for i, c in enumerate(P.NUMERIC)])
    table, binning = ML.training_table(df)
    error = ML.fit_trees(table, binning, 60).score(table).selectExpr("abs(prediction - production_t) as e")
    wide = error.where("e > 5").count()  # the step at 40 lies inside one bin of about 4 rows
    assert wide <= 12 and error.agg(F.avg("e")).first()[0] < 3


def test_more_than_256_crops(spark):
    rows = spark.range(600).selectExpr(
        "concat('crop', id % 300) as crop", "'Kharif' as season", "cast(id as double) as production_t",
        *[f"cast(id % 7 as double) as {c}" for c in P.NUMERIC])
    table, binning = ML.training_table(rows)
    trees = ML.fit_trees(table, binning, 1)
    assert trees.model.getOrDefault("maxBins") == 301 and trees.score(rows).count() == 600


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables absent")
def test_published_protocol(spark):
    """3 validation and 2 test years; keeps nothing cached, and every metric has its row. The SQL tests of M6, M11 and M12 run all 300 rounds."""
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    t = base.Tables(spark, FOLDER)
    run = ML.run_forecast(t.panel, max_iter=5)
    assert [len(run.splits[k]) for k in ("validate", "test")] == [3, 2]
    assert {(r.split, r.predictor) for r in run.metrics.collect()} == {(s, p) for s in ("validate", "test") for p in ("gradient_boosting", "naive_persistence")}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    report = json.loads(ML.model_report(run, P.audit_agriculture(t.panel)).first()[0])
    assert report["model_selected_on_validation"] == report["metrics"]["model_selected_on_validation"] == run.chosen
    assert report["metrics"]["test_rows"] == report["held_out_rows"] == run.test.count()
    assert report["forecast_cells"] == run.forecast.count() and report["training_rows"] == run.train_rows > 0
    assert report["metrics"]["beat_naive_on_validation_mae"] == (run.chosen == "gradient_boosting")
    assert report["model_name"].startswith(run.chosen.replace("_", "-")) and len(report["limitations"]) == len(ML.LIMITATIONS)
    assert report["data_period"]["forecast_year"] == report["target"]["next_unobserved_year"] == f"{run.anchor + 1}-{run.anchor + 2}"


def price_rows(spark, n, bound=False):
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 50, (n, 3))
    if bound:
        x[:, 2] = 2 * x[:, 1]
    y = 1e6 + x @ np.array([2.0, -1.0, 0.5])
    return spark.createDataFrame([(f"r{i}", *map(float, x[i]), float(y[i])) for i in range(n)],
                                 "region_name string, avg_temp_c double, total_precip_mm double, avg_humidity_pct double, "
                                 "market_price_signal_inr_per_quintal double"), x, y


def test_normal_equations_keep_their_digits_and_bear_bound_features(spark):
    df, x, y = price_rows(spark, 60)
    intercept, coefficients = ML.least_squares(df, ML.PRICE_FEATURES, ML.PRICE_TARGET)
    assert coefficients == pytest.approx([2.0, -1.0, 0.5], abs=1e-7) and intercept == pytest.approx(1e6, rel=1e-9)
    df, x, y = price_rows(spark, 60, bound=True)
    intercept, coefficients = ML.least_squares(df, ML.PRICE_FEATURES, ML.PRICE_TARGET)
    assert x @ np.array(coefficients) + intercept == pytest.approx(y, rel=1e-9)
    assert ML.least_squares(df.limit(0), ML.PRICE_FEATURES, ML.PRICE_TARGET) is None


def test_price_report_fields(spark):
    df, _, _ = price_rows(spark, 40)
    fit = ML.train_price_model(df)
    report = json.loads(ML.price_report(df, fit).first()[0])
    assert report["row_count"] == report["region_count"] == 40 and report["feature_names"] == ML.PRICE_FEATURES
    assert report["metrics"]["r2"] > 0.99 and report["coefficients"]["avg_temp_c"] == pytest.approx(2.0, abs=1e-4)
    assert report["evaluation_methodology"].startswith("80/20") and not report["small_sample_warning"] and len(report["limitations"]) == 3
    empty = ML.train_price_model(df.limit(0))
    assert empty.intercept is None and ML.price_forecast(df, empty).filter("predicted_signal_inr_per_quintal is not null").count() == 0
    assert json.loads(ML.price_report(df.limit(0), empty).first()[0])["region_count"] == 0
