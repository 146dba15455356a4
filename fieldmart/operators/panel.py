"""Forecast panel: lag features, temporal split, persistence baseline, metrics and band."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.functions.numbers import to_number
from fieldmart.functions.text import strip
from fieldmart.operators.quantiles import group_quantiles
from fieldmart.operators.ranks import with_codes

CELL = ["state", "district", "crop", "season"]
TARGET = "production_t"
CATEGORICAL = ["crop", "season"]
NUMERIC = ["year_offset", "district_ordinal", "state_ordinal", "lag1_production",
           "roll3_production", "lag1_area_log", "lag1_yield"]
# The published protocol (cells, split sizes, band width, sample size).
MIN_CELL_ROWS = 6
VALIDATE_YEARS = 3
TEST_YEARS = 2
BAND_SIGMAS = 1.96
MIN_YEARS_FOR_TARGET = 10


def load_panel(crop_year: DataFrame) -> DataFrame:
    """Trim the cell keys, coerce the measures and name their units."""
    keys = {c: strip(F.col(c).cast("string")) for c in CELL}
    measures = {TARGET: "production", "area_ha": "area", "yield_tph": "yield"}
    kept = [c for c in crop_year.columns if c not in CELL and c not in measures.values()]
    return crop_year.select(
        *[e.alias(c) for c, e in keys.items()], *kept,
        *[to_number(F.col(f"`{old}`")).alias(new) for new, old in measures.items()])


def with_lags(panel: DataFrame) -> DataFrame:
    """Lags by observed row order and year offset per cell.

    A panel cell has one row per year, so its window holds at most the years on record.
    """
    cell = Window.partitionBy(*CELL)
    ordered = cell.orderBy("year_start")
    previous = ordered.rowsBetween(-3, -1)
    return panel.withColumns({
        "year_offset": F.col("year_start") - F.min("year_start").over(cell),
        "lag1_production": F.lag(TARGET, 1).over(ordered),
        "lag2_production": F.lag(TARGET, 2).over(ordered),
        "lag1_area_ha": F.lag("area_ha", 1).over(ordered),
        "lag1_yield": F.lag("yield_tph", 1).over(ordered),
        "roll3_production": F.avg(TARGET).over(previous),
    }).withColumn("lag1_area_log", F.log1p("lag1_area_ha"))


def forecastable(lagged: DataFrame) -> DataFrame:
    """Rows with an observed target and a previous value in the cell."""
    return lagged.where(F.col(TARGET).isNotNull() & F.col("lag1_production").isNotNull())


def build_features(panel: DataFrame) -> DataFrame:
    return forecastable(with_lags(panel))


def cell_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n_year_season_rows"))


def eligible(features: DataFrame, min_rows: int = MIN_CELL_ROWS) -> DataFrame:
    """Rows of cells with enough forecastable rows.

    The cell's window is already partitioned and sorted by the lag step, so the
    count costs no further shuffle.
    """
    return (features.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*CELL)))
            .where(F.col("_n") >= min_rows).drop("_n"))


def with_ordinals(df: DataFrame, reference: DataFrame, columns: Sequence[str] = ("district", "state")) -> DataFrame:
    """Dense alphabetical codes of each column over `reference`, from 0; the labels stay in a table."""
    return with_codes(df, reference, columns)


def observed_years(features: DataFrame, year: str = "year_start") -> list:
    """Distinct years, a calendar-sized list."""
    return sorted(r[0] for r in features.select(year).distinct().collect())


def temporal_splits(years: Sequence, validate: int = VALIDATE_YEARS, test: int = TEST_YEARS) -> dict[str, list]:
    """Every training year precedes every validation year, which precedes every test year."""
    ordered = sorted(years)
    cut = max(len(ordered) - validate - test, 0)
    return {"train": ordered[:cut], "validate": ordered[cut:cut + validate], "test": ordered[cut + validate:]}


def with_split(features: DataFrame, splits: dict[str, list], year: str = "year_start") -> DataFrame:
    label = F.lit(None).cast("string")
    for name, years in splits.items():
        if years:
            label = F.when(F.col(year).isin(list(years)), name).otherwise(label)
    return features.withColumn("split", label)


def persistence() -> Column:
    """Last observed production, null as 0."""
    return F.coalesce(F.col("lag1_production"), F.lit(0.0))


def grade(df: DataFrame, predicted: str, by: Sequence[str] = (), actual: str = TARGET) -> DataFrame:
    """MAE, RMSE, R2, MAE % of the mean and median APE, unrounded.

    R2 is 1 - MSE / population variance, both from one aggregation. The median covers
    rows of at least one tonne with a positive prediction.
    """
    by = list(by)
    y, p = F.col(actual), F.col(predicted)
    rows = df.where(y.isNotNull() & p.isNotNull()).select(*by, y.alias("_y"), p.alias("_p"))
    keyed = rows if by else rows.withColumn("_g", F.lit(0))
    keys = by or ["_g"]
    sums = keyed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.abs(F.col("_y") - F.col("_p"))).alias("mae_t"),
        F.avg((F.col("_y") - F.col("_p")) * (F.col("_y") - F.col("_p"))).alias("_mse"),
        F.avg("_y").alias("_mean"),
        F.var_pop("_y").alias("_var"),
        F.count_if(F.col("_y") >= 1.0).alias("mape_on_rows"),
    )
    ape = keyed.where((F.col("_y") >= 1.0) & (F.col("_p") > 0)).withColumn(
        "_ape", F.abs(F.col("_y") - F.col("_p")) / F.col("_y") * 100.0)
    median = group_quantiles(ape, keys, "_ape", {"mape_median_pct": 0.5})
    return sums.join(median, keys, "left").select(
        *by, "mae_t", F.sqrt("_mse").alias("rmse_t"),
        (1 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2_vs_observed_mean"),
        (F.col("mae_t") / F.greatest(F.col("_mean"), F.lit(1e-9)) * 100.0).alias("mae_pct_of_mean"),
        "mape_median_pct", "mape_on_rows", "n_rows")


def published(metrics: DataFrame) -> DataFrame:
    """Metrics at the published precision."""
    digits = {"mae_t": 2, "rmse_t": 2, "r2_vs_observed_mean": 4, "mae_pct_of_mean": 4}
    return metrics.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c)
                            for c in metrics.columns])


def choose_model(model_mae: float, baseline_mae: float) -> str:
    """Selection on validation MAE only; equality favours the model."""
    return "gradient_boosting" if model_mae <= baseline_mae else "naive_persistence"


def residual_spread(df: DataFrame, predicted: str, actual: str = TARGET) -> DataFrame:
    """Population standard deviation of the log residuals, one row."""
    residual = F.log1p(F.col(actual)) - F.log1p(F.greatest(F.col(predicted), F.lit(0.0)))
    return df.agg(F.stddev_pop(residual).alias("residual_std_log"))


def with_band(df: DataFrame, predicted: str, spread: Column) -> DataFrame:
    """Multiplicative band [pred / (1 + k), pred * (1 + k)], never below zero."""
    k = F.lit(BAND_SIGMAS) * spread
    p = F.greatest(F.col(predicted), F.lit(0.0))
    return df.withColumns({
        "forecast_production_tonnes": p,
        "forecast_lower_tonnes": F.greatest(p / (1.0 + k), F.lit(0.0)),
        "forecast_upper_tonnes": p * (1.0 + k),
    })


def anchor_cells(features: DataFrame, anchor, year: str = "year_start") -> DataFrame:
    """The anchor year's row of each cell with the cell's number of rows."""
    rows = features.where(F.col(year) == anchor)
    return rows.join(cell_counts(features), CELL)


def next_year_features(lagged: DataFrame, anchor: int) -> DataFrame:
    """Roll the anchor year's row one step forward: its own values become the lags.

    Needs the lags of `with_lags`. The previous three values are the anchor's and
    its two lags.
    """
    three = F.array_compact(F.array(TARGET, "lag1_production", "lag2_production"))
    mean = F.aggregate(three, F.lit(0.0), lambda a, x: a + x) / F.size(three)
    return forecastable(lagged).where(F.col("year_start") == anchor).withColumns({
        "observed_last_tonnes": F.col(TARGET),
        "roll3_production": mean,
        "lag1_production": F.col(TARGET),
        "lag1_yield": F.col("yield_tph"),
        "lag1_area_log": F.log1p("area_ha"),
        "year_offset": F.col("year_offset") + 1,
    })


def held_out_rows(test: DataFrame, predicted: str, year: str = "year_start") -> DataFrame:
    """Every held-out observation with its prediction."""
    return test.select(*CELL, year, F.col(TARGET).alias("observed_tonnes"), F.col(predicted).alias("predicted_tonnes"))


def observed_vs_predicted(forecast: DataFrame) -> DataFrame:
    """Long form of the observed and the estimated signal, with display labels."""
    return forecast.select(
        "region_name",
        F.col("actual_signal_inr_per_quintal").alias("Observed"),
        F.col("predicted_signal_inr_per_quintal").alias("Model estimate"),
    ).unpivot("region_name", ["Observed", "Model estimate"], "series", "signal_inr_per_quintal")


def audit_agriculture(agri: DataFrame, year: str = "year") -> DataFrame:
    """Rows, year span and distinct counts, with the decision whether a target exists."""
    return agri.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(year).cast("string").alias("first_year"),
        F.max(year).cast("string").alias("last_year"),
        F.count_distinct(year).alias("n_years"),
        F.count_distinct("state").alias("n_states"),
        F.count_distinct("district").alias("n_districts"),
        F.count_distinct("crop").alias("n_crops"),
    ).withColumn("target_decision", F.when(
        F.col("n_years") >= MIN_YEARS_FOR_TARGET, "production (tonnes, next unobserved year)")
        .otherwise("no valid target -- agriculture history insufficient"))


def audit_dates(df: DataFrame, column: str, history: str | None = None) -> DataFrame:
    """Rows, date span and distinct dates of a source, with its total record days."""
    days = F.coalesce(F.sum(history), F.lit(0)) if history else F.lit(0)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(column).cast("string").alias("first_date"),
        F.max(column).cast("string").alias("last_date"),
        F.count_distinct(column).alias("n_dates"),
        days.cast("long").alias("total_record_days"),
    )


