"""Models: boosted trees for the production forecast, least squares for the price signal."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.numbers import pct_change
from fieldmart.operators import binned as B
from fieldmart.operators import panel as P
from fieldmart.session import materialized, scratch_path

# The published model settings, thresholds and report texts.
MAX_ITER = 300
MAX_DEPTH = 3
MAX_BINS = 256
STEP_SIZE = 0.06
SEED = 42
SMALL_SAMPLE = 15
PRICE_FEATURES = ["avg_temp_c", "total_precip_mm", "avg_humidity_pct"]
PRICE_TARGET = "market_price_signal_inr_per_quintal"
FAMILIES = {"gradient_boosting": "depth-limited boosted regression trees",
            "naive_persistence": "last observed year carried forward, chosen on validation"}
LIMITATIONS = [
    "Prototype, not production-ready, and no signal of profit.",
    "Weather is no feature: the weather window lies after the crop years.",
    "Changes of policy, irrigation, variety or credit are not in the panel.",
    "The band comes from held-out residuals on a log scale and is approximate.",
    f"Cells of fewer than {P.MIN_CELL_ROWS} usable years are left out.",
    "The percent error is a median over rows of at least one tonne.",
]
PRICE_LIMITATIONS = [
    "Prototype: a linear relation between a short weather window and a regional price signal.",
    "One cross-section without a history of years shows no skill over time.",
    "In-sample metrics do not estimate the error on other regions.",
]

#: Rounds between two cuts of a fit's lineage.
CHECKPOINT_ROUNDS = 50


@dataclass(frozen=True)
class Trees:
    """Fitted boosted trees and the bins they were fitted on."""

    binning: B.Binning
    model: GBTRegressionModel

    def score(self, rows: DataFrame) -> DataFrame:
        """Add `prediction`; rows of a training table have their bins already."""
        has_bins = set(self.binning.columns) <= set(rows.columns)
        return self.model.transform(B.as_vector(rows if has_bins else self.binning.apply(rows), self.binning)).drop("features")


def boosted_trees(max_iter: int = MAX_ITER, max_bins: int = MAX_BINS, checkpoint_rounds: int = CHECKPOINT_ROUNDS) -> GBTRegressor:
    """Absolute-error boosted trees on binned features."""
    return GBTRegressor(featuresCol="features", labelCol=P.TARGET, predictionCol="prediction", lossType="absolute",
                        maxDepth=MAX_DEPTH, stepSize=STEP_SIZE, maxIter=max_iter, maxBins=max_bins, seed=SEED,
                        cacheNodeIds=False, checkpointInterval=checkpoint_rounds)


def training_table(rows: DataFrame, part_rows: int = B.PART_ROWS) -> tuple[DataFrame, B.Binning]:
    """The rows with binned features, written once for all fits and their scores."""
    rows = materialized(rows, "forecastable")
    binning = B.fit_bins(rows, P.NUMERIC, P.CATEGORICAL, MAX_BINS)
    return B.binned_table(rows, binning, part_rows), binning


def fit_trees(table: DataFrame, binning: B.Binning, max_iter: int = MAX_ITER) -> Trees:
    """Boosted trees on rows of a training table; the growing lineage is cut in the session's checkpoint folder."""
    context = table.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(table.sparkSession, "trees"))
    learner = boosted_trees(max_iter, max(MAX_BINS, binning.largest))
    return Trees(binning, learner.fit(B.as_vector(table, binning).select("features", P.TARGET)))


@dataclass
class ForecastRun:
    """Result of one forecast: frames stay distributed, only scalars are local."""

    forecast: DataFrame
    metrics: DataFrame
    test: DataFrame
    splits: dict
    chosen: str
    residual_std_log: float
    anchor: int
    train_rows: int


def prepare(crop_year: DataFrame, min_rows: int = P.MIN_CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """(all lagged rows with ordinals, forecastable rows of eligible cells)."""
    panel = P.load_panel(crop_year)
    lagged = P.with_ordinals(P.with_lags(panel), panel)
    return lagged, P.eligible(P.forecastable(lagged), min_rows)


def run_forecast(crop_year: DataFrame, validate: int = P.VALIDATE_YEARS, test: int = P.TEST_YEARS,
                 max_iter: int = MAX_ITER, min_rows: int = P.MIN_CELL_ROWS) -> ForecastRun:
    """Split by time, fit, compare with persistence on validation, refit, forecast one year ahead."""
    lagged, rows = prepare(crop_year, min_rows)
    lagged = materialized(lagged, "lagged")
    table, binning = training_table(P.eligible(P.forecastable(lagged), min_rows))
    years = P.observed_years(table)
    splits = P.temporal_splits(years, validate, test)
    if not splits["train"] or not splits["validate"]:
        raise ValueError("not enough years for a temporal split")
    labelled = P.with_split(table, splits)
    train = labelled.where(F.col("split") == "train")
    fitted = fit_trees(train, binning, max_iter)
    scored = materialized(fitted.score(labelled.where(F.col("split") != "train")).withColumn("baseline", P.persistence()), "scored")
    model_metrics = P.grade(scored, "prediction", ["split"]).withColumn("predictor", F.lit("gradient_boosting"))
    naive_metrics = P.grade(scored, "baseline", ["split"]).withColumn("predictor", F.lit("naive_persistence"))
    raw = materialized(model_metrics.unionByName(naive_metrics), "forecast-metrics")  # 2 rows for each held-out split
    mae = {r["predictor"]: r["mae_t"] for r in
           raw.where(F.col("split") == "validate").select("predictor", "mae_t").collect()}
    chosen = P.choose_model(mae["gradient_boosting"], mae["naive_persistence"])
    column = "prediction" if chosen == "gradient_boosting" else "baseline"
    held_out = scored.where(F.col("split") == "test")
    spread = P.residual_spread(held_out, column).first()["residual_std_log"]
    anchor = years[-1]
    final = fit_trees(table, binning, max_iter) if chosen == "gradient_boosting" else None
    return ForecastRun(
        forecast=materialized(forecast_frame(lagged, table, final, chosen, spread, anchor), "forecasts"),
        metrics=P.published(raw), test=held_out, splits=splits, chosen=chosen,
        residual_std_log=spread, anchor=anchor, train_rows=train.count())


def forecast_frame(lagged: DataFrame, rows: DataFrame, model: Trees | None, chosen: str,
                   spread: float, anchor: int) -> DataFrame:
    """One-year-ahead forecast with band per eligible cell observed in the anchor year."""
    grid = P.next_year_features(lagged, anchor).join(P.cell_counts(rows), P.CELL)
    if chosen == "gradient_boosting":
        grid = model.score(grid.drop(P.TARGET))
    else:
        grid = grid.withColumn("prediction", F.col("observed_last_tonnes"))
    banded = P.with_band(grid, "prediction", F.lit(spread))
    extra = [c for c in ("state_code", "district_code", "crop_type") if c in grid.columns]
    return banded.select(
        *P.CELL, *extra, "n_year_season_rows",
        F.lit(f"{anchor + 1}-{anchor + 2}").alias("forecast_year"),
        F.lit(f"{anchor}-{anchor + 1}").alias("latest_observed_year"),
        "observed_last_tonnes", "forecast_production_tonnes",
        "forecast_lower_tonnes", "forecast_upper_tonnes",
        F.lit(f"{chosen}-prototype").alias("model_used"))


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def model_report(run: ForecastRun, audit: DataFrame) -> DataFrame:
    """The forecast run as one JSON document; the held-out rows are a table of their own (`panel.held_out_rows`)."""
    metrics = run.metrics.agg(F.collect_list(F.struct(*run.metrics.columns)).alias("m"))  # 4 rows

    def of(predictor: str, split: str, column: str) -> Column:
        return F.max(F.when((F.col("predictor") == predictor) & (F.col("split") == split), F.col(column)))

    flat = run.metrics.agg(F.struct(
        *[of("gradient_boosting", "test", c).alias(f"test_{n}") for c, n in (
            ("mae_t", "mae_t"), ("rmse_t", "rmse_t"), ("r2_vs_observed_mean", "r2_vs_observed_mean"),
            ("mape_median_pct", "mape_median_pct"), ("n_rows", "rows"))],
        *[of("naive_persistence", "test", c).alias(f"naive_baseline_test_{c}") for c in ("mae_t", "rmse_t")],
        F.lit(run.chosen).alias("model_selected_on_validation"),
        F.lit(run.chosen == "gradient_boosting").alias("beat_naive_on_validation_mae")).alias("f"))
    splits = F.struct(*[F.array(*[F.lit(y) for y in ys]).alias(k) for k, ys in run.splits.items() if ys])
    spans = " | ".join(f"{k} {ys[0]}..{ys[-1]}" for k, ys in run.splits.items() if ys)
    following = f"{run.anchor + 1}-{run.anchor + 2}"
    return audit.select(F.to_json(F.struct(
        F.lit(f"{run.chosen.replace('_', '-')}-crop-production-prototype").alias("model_name"),
        F.lit(FAMILIES[run.chosen]).alias("model_family"),
        F.lit("prototype").alias("model_status"),
        F.lit(False).alias("production_ready"),
        F.lit(run.chosen).alias("model_selected_on_validation"),
        F.struct(F.lit("production").alias("variable"), F.lit("tonnes").alias("unit"),
                 F.lit(following).alias("next_unobserved_year")).alias("target"),
        F.struct(F.col("first_year").alias("start"), F.col("last_year").alias("end"), F.col("n_years"),
                 F.lit(following).alias("forecast_year")).alias("data_period"),
        F.struct(*audit.columns).alias("dimensions"),
        F.lit(run.train_rows).cast("long").alias("training_rows"),
        run.forecast.agg(F.count(F.lit(1))).scalar().alias("forecast_cells"),
        F.lit(f"years in order, never shuffled; selection on validation only, test scored once: {spans}").alias("validation_method"),
        splits.alias("splits"),
        _texts([*P.CATEGORICAL, *P.NUMERIC]).alias("features"),
        flat.scalar().alias("metrics"),
        metrics.scalar().alias("metrics_by_split"),
        F.lit(round(run.residual_std_log, 4)).alias("residual_std_log_scale"),
        run.test.agg(F.count(F.lit(1))).scalar().alias("held_out_rows"),
        _texts(LIMITATIONS).alias("limitations"),
        F.struct(*audit.columns).alias("audit"),
    )).alias("report"))


@dataclass
class PriceModel:
    """A fitted linear price signal with its evaluation; the coefficients are None where nothing could be fitted."""

    features: list[str]
    intercept: float | None
    coefficients: dict
    metrics: dict
    methodology: str
    rows: int

    def predicted(self) -> Column:
        """The estimate; null where a feature is."""
        if self.intercept is None:
            return F.lit(None).cast("double")
        total = F.lit(self.intercept)
        for f in self.features:
            total = total + F.col(f) * F.lit(self.coefficients[f])
        return F.when(~F.isnan(total), total)


def hash_split(df: DataFrame, keys: Sequence[str], held_out: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add `held_out`: a reproducible share of the rows by a seeded hash of their keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    bucket = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % 10_000
    return df.withColumn("held_out", bucket < int(held_out * 10_000))


def least_squares(rows: DataFrame, features: Sequence[str], target: str) -> tuple[float, list[float]] | None:
    """Intercept and coefficients from one aggregate: means, and the sums of products about them.

    Only numbers of the features' count squared leave the tasks. Sums about the means keep their digits; a
    feature without spread, or bound to others, has the coefficient of the shortest solution. None without rows.
    """
    columns = [*features, target]
    moments = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
               *[F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}_{j}")
                 for i, a in enumerate(columns) for j, b in enumerate(columns) if i <= j]]
    found = rows.agg(*moments).first()
    if not found["n"]:
        return None
    k = len(features)
    gram = np.array([[found[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]).reshape(k, k)
    cross = np.array([found[f"c{i}_{k}"] for i in range(k)])
    size = np.sqrt(np.diag(gram))
    size[size == 0] = 1.0
    coefficients = np.linalg.lstsq(gram / np.outer(size, size), cross / size, rcond=1e-12)[0] / size
    means = [found[f"m{i}"] for i in range(k)]
    return float(found[f"m{k}"] - coefficients @ means), coefficients.tolist()


def train_price_model(regions: DataFrame, features: Sequence[str] = PRICE_FEATURES,
                      target: str = PRICE_TARGET, held_out: bool = True) -> PriceModel:
    """Least squares on the regions that have all features and the target.

    Evaluated on a held-out fifth, or in-sample if the caller says so; the metrics name
    which, count the regions left out, and warn of small samples.
    """
    rows = regions.dropna(subset=[*features, target])
    n, n_all = rows.count(), regions.count()
    if not held_out:
        train = test = rows
        methodology = "in-sample fit (no held-out split)"
    else:
        split = hash_split(rows, ["region_name"])
        train, test = split.where(~F.col("held_out")), split.where(F.col("held_out"))
        methodology = "80/20 train/test split by seeded hash, metrics on held-out test set"
    intercept, coefficients = least_squares(train, features, target) or (None, [None] * len(features))
    model = PriceModel(list(features), intercept, dict(zip(features, coefficients, strict=True)), {}, methodology, n)
    y, p = F.col(target), model.predicted()
    m = test.agg(
        F.avg(F.abs(y - p)).alias("mae"), F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(y).alias("var"),
        F.avg(F.try_divide(F.abs(y - p), F.abs(y))).alias("mape")).first()
    model.metrics.update({
        "mae_inr_per_quintal": _rounded(m["mae"], 2),
        "r2": _rounded(1 - m["mse"] / m["var"], 4) if m["var"] and m["mse"] is not None else None,
        "mape_pct": _rounded(m["mape"] * 100.0, 4) if m["mape"] is not None else None,
        "metrics_are_in_sample": not held_out,
        "small_sample_warning": n < SMALL_SAMPLE,
        "regions_left_out": n_all - n,
    })
    return model


def price_report(regions: DataFrame, model: PriceModel) -> DataFrame:
    """The price model as one JSON document."""
    metrics = F.struct(*[F.lit(v).alias(k) for k, v in model.metrics.items()])
    coefficients = F.struct(*[F.lit(None if v is None else round(v, 6)).cast("double").alias(k) for k, v in model.coefficients.items()])
    return regions.agg(F.count(F.lit(1)).alias("region_count")).select(F.to_json(F.struct(
        F.lit("linear-weather-to-price-signal-prototype").alias("model_name"),
        F.lit("least squares from normal equations").alias("model_family"),
        F.lit("prototype").alias("model_status"),
        F.lit(PRICE_TARGET).alias("target_variable"),
        _texts(model.features).alias("feature_names"),
        F.lit(model.rows).cast("long").alias("row_count"),
        "region_count",
        F.lit(model.methodology).alias("evaluation_methodology"),
        metrics.alias("metrics"), coefficients.alias("coefficients"),
        F.lit(model.metrics["small_sample_warning"]).alias("small_sample_warning"),
        _texts(PRICE_LIMITATIONS).alias("limitations"),
    )).alias("report"))


def _rounded(value, digits: int):
    return None if value is None else round(float(value), digits)


def actual_vs_predicted(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Difference and percent error; the error is null where the actual is 0."""
    out = scored.select("region_name", F.col(actual).alias("actual_signal_inr_per_quintal"),
                        F.col(predicted).alias("predicted_signal_inr_per_quintal"))
    a, p = F.col("actual_signal_inr_per_quintal"), F.col("predicted_signal_inr_per_quintal")
    return out.withColumns({"difference_inr_per_quintal": p - a, "prediction_error_pct": pct_change(p, a)})


def price_forecast(regions: DataFrame, model: PriceModel) -> DataFrame:
    """Estimates for all regions; a region that lacks a feature has a null one."""
    return actual_vs_predicted(regions.withColumn("prediction", model.predicted()), PRICE_TARGET, "prediction")


def gate_status(regions: DataFrame, configured: bool) -> DataFrame | None:
    """One status row when there is no configured source or no target; None when training may run."""
    if configured and PRICE_TARGET in regions.columns:
        return None
    reason = "market source not configured" if not configured else "no market target column"
    return regions.agg(F.count(F.lit(1)).alias("regions")).select(
        F.lit("not_generated").alias("model_status"), F.lit(PRICE_TARGET).alias("target_variable"),
        F.lit(reason).alias("reason"), "regions")
