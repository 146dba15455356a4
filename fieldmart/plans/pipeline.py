"""The whole pipeline: each stage reads tables of the layer before and writes its own.

Layers are written tables, so a lost executor only repeats the running stage and no
stage recomputes another. A stage without its input leaves a status row and goes on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.operators import climate as C
from fieldmart.operators import contracts as V
from fieldmart.operators import crops as K
from fieldmart.operators import market as M
from fieldmart.operators import models as ML
from fieldmart.operators import normalize as Z
from fieldmart.operators import panel as P
from fieldmart.operators import quality as Q
from fieldmart.operators import region_features as R
from fieldmart.operators import segments as G
from fieldmart.operators.dedupe import keep_first, price_contradiction, quarantine
from fieldmart.sources import feeds, reference, sinks
from fieldmart.sources.json_documents import land_documents

CROP_KEY = ["state", "district", "crop", "season", "year"]


@dataclass(frozen=True)
class Layout:
    """Folders of one data root, on storage every executor can reach."""

    root: str

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def catalog(self, name: str) -> str:
        return f"{self.root}/catalog/{name}"

    @property
    def rejects(self) -> str:
        return self.silver("_rejects")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    return feeds.read_optional(spark, path)


def _skip(spark: SparkSession, path: str, dataset: str, reason: str) -> DataFrame:
    marker = sinks.no_data_manifest(spark, dataset, reason)
    marker.write.mode("overwrite").json(path)
    return marker


# -- landing ------------------------------------------------------------------------

def land_trades(spark: SparkSession, csv: str, layout: Layout, stamp: str) -> DataFrame:
    raw = feeds.read_trades_csv(spark, csv)
    return sinks.write_bronze(Z.normalize_trades(raw), layout.bronze("trades"), "trades", stamp, raw, source=csv)


def land_crops(spark: SparkSession, csv: str, registry_json: str, layout: Layout, stamp: str) -> DataFrame:
    raw = feeds.read_crops_csv(spark, csv)
    registry = reference.read_crop_registry(spark, registry_json)
    return sinks.write_bronze(Z.normalize_crops(raw, registry), layout.bronze("crops"), "crops", stamp, raw, source=csv)


def land_weather(spark: SparkSession, json: str, layout: Layout, stamp: str) -> DataFrame:
    land_documents(spark, json, layout.bronze(f"weather_lines/{stamp}"))
    weather = feeds.read_weather(spark, layout.bronze(f"weather_lines/{stamp}"))
    return sinks.write_bronze(weather, layout.bronze("weather"), "weather", stamp, source=json, ingested_at_utc=stamp)


# -- silver -------------------------------------------------------------------------

def _newest(spark: SparkSession, folder: str) -> DataFrame | None:
    return feeds.read_newest(spark, f"{folder}/*_normalized_*")


def build_silver(spark: SparkSession, layout: Layout, regions_json: str,
                 market: DataFrame | None = None) -> dict[str, str]:
    """Dedupe, quarantine and gate every table; returns the status per table."""
    status = {}
    geo = reference.read_regions(spark, regions_json)
    sinks.write_silver(geo, V.GEO, layout.silver("geo"), layout.rejects)
    status["geo"] = "success"

    weather = _newest(spark, layout.bronze("weather"))
    if weather is not None:
        sinks.write_silver(keep_first(weather, ["region_name", "date"]), V.WEATHER, layout.silver("weather"), layout.rejects)
    crops = _newest(spark, layout.bronze("crops"))
    if crops is not None:
        sinks.write_silver(keep_first(crops, CROP_KEY, ["id"]), V.AGRICULTURE, layout.silver("agriculture"), layout.rejects)
    trades = _newest(spark, layout.bronze("trades"))
    if trades is not None:
        kept, rejected = quarantine(keep_first(trades, M.TRADE_DAY_KEY), price_contradiction())
        rejected.write.mode("overwrite").parquet(f"{layout.rejects}/invalid_price_rows")
        sinks.write_silver(V.project(kept, V.TRADES), V.TRADES, layout.silver("trades"), layout.rejects)
    market_status, rows = feeds.optional_market(market)
    if rows is not None:
        sinks.write_silver(rows, V.MARKET_ROWS, layout.silver("market"), layout.rejects)
    for name, table in (("weather", weather), ("agriculture", crops), ("trades", trades)):
        status[name] = "success" if table is not None else "no_data"
        if table is None:
            _skip(spark, layout.silver(f"_status/{name}"), name, "no bronze data")
    if rows is None:
        _skip(spark, layout.silver("_status/market"), "market", market_status)
    return status | {"market": market_status}


# -- gold ---------------------------------------------------------------------------

def build_climate_gold(spark: SparkSession, layout: Layout) -> None:
    """Daily features partitioned by region, and the region summary."""
    geo, market = _read(spark, layout.silver("geo")), _read(spark, layout.silver("market"))
    signal = None
    if market is not None:
        mapped = R.map_region(market, geo)
        signal = M.daily_region_market(mapped, "region_name")
    daily = C.daily_features(_read(spark, layout.silver("weather")), geo, signal)
    sinks.write_table(daily, layout.gold("region_daily_features"), partition_by=["region_name"])
    written = _read(spark, layout.gold("region_daily_features"))
    sinks.write_table(C.region_summary(written).orderBy("state_ut", "region_name"), layout.gold("region_summary"))


def build_integrated_gold(spark: SparkSession, layout: Layout) -> DataFrame:
    """Region features, market summary and crop tables with manifests; returns the lineage."""
    weather, trades, geo, agri = (_read(spark, layout.silver(n)) for n in ("weather", "trades", "geo", "agriculture"))
    entries = []

    def write(name: str, df: DataFrame, inputs: list[str], **facts) -> DataFrame:
        sinks.write_table(df, layout.gold(name))
        table = _read(spark, layout.gold(name))
        m = sinks.manifest(table, name, inputs=[layout.silver(i) for i in inputs], outputs=[layout.gold(name)], **facts)
        m.write.mode("overwrite").json(layout.catalog(f"manifests/{name}"))
        entries.append(spark.read.json(layout.catalog(f"manifests/{name}")))
        return table

    def skip(name: str, reason: str) -> None:
        entries.append(_skip(spark, layout.catalog(f"manifests/{name}"), name, reason))

    features = None
    if weather is None or trades is None:
        skip("region_features", "weather and trades are not both present")
    else:
        features = write("region_features", R.region_features(weather, trades, geo), ["weather", "trades", "geo"],
                         date="date", distinct=["region_name"], matched={
                             "weather_days": F.col("temp_max_c").isNotNull(), "market_days": F.col("n_price_records") > 0})
    if trades is None:
        skip("market_summary", "no trades")
    else:
        summary = write("market_summary", M.market_summary(trades), ["trades"], date="latest_date",
                        distinct=["apmc", "commodity", "state"])
        sinks.write_table(M.state_market_summary(summary), layout.gold("state_market_summary"))
    if agri is None:
        skip("crop_summary", "no crop statistics")
    else:
        write("crop_year", K.crop_year_panel(agri), ["agriculture"], distinct=["crop"])
        none = spark.createDataFrame([], _types(V.TRADES))
        seen = features if features is not None else spark.createDataFrame([], FEATURE_TYPES)
        write("crop_summary", K.crop_summary(agri, trades if trades is not None else none, seen),
              ["agriculture", "trades"], matched={
                  "with_market": F.col("market_status") == "matched", "with_weather": F.col("weather_status") == "reported"})
    rows = sinks.lineage(entries)
    rows.write.mode("overwrite").json(layout.catalog("gold_lineage"))
    return rows


def _types(contract: V.Contract) -> str:
    return ", ".join(f"{c.name} {c.type}" for c in contract.columns)


FEATURE_TYPES = ("district string, temp_max_c double, temp_min_c double, precipitation_mm double, "
                 "humidity_pct double, windspeed_max_kmh double")


# -- models and monitoring ------------------------------------------------------------

def build_forecast(spark: SparkSession, layout: Layout, **settings) -> ML.ForecastRun | None:
    """Production forecast and its report; None without a crop panel."""
    panel = _read(spark, layout.gold("crop_year"))
    if panel is None:
        _skip(spark, layout.catalog("model_report"), "forecasts", "no crop history")
        return None
    run = ML.run_forecast(panel, **settings)
    sinks.write_table(run.forecast, layout.gold("forecasts"))
    ML.model_report(run, P.audit_agriculture(panel)).write.mode("overwrite").text(layout.catalog("model_report"))
    return run


def build_predictions(spark: SparkSession, layout: Layout, market_configured: bool = False) -> DataFrame:
    """The gated price forecast and the segments; returns one row per step with its observed status."""
    features = C.region_model_features(_read(spark, layout.gold("region_daily_features")))

    def forecast() -> DataFrame:
        gate = ML.gate_status(features, market_configured)
        if gate is not None:
            gate.write.mode("overwrite").json(layout.catalog("ml_status"))
            raise sinks.StepSkipped("skipped_market_gate")
        model = ML.train_price_model(features)
        sinks.write_table(ML.price_forecast(features, model), layout.gold("forecast_results"))
        ML.price_report(features, model).write.mode("overwrite").text(layout.catalog("price_model_report"))
        return _read(spark, layout.gold("forecast_results"))

    def segment() -> DataFrame:
        sinks.write_table(G.assign_segments(features), layout.gold("region_segments"))
        return _read(spark, layout.gold("region_segments"))

    configured = market_configured and ML.PRICE_TARGET in features.columns
    steps = sinks.run_steps(spark, [
        ("demand_forecast", layout.gold("forecast_results") if configured else layout.catalog("ml_status"), forecast),
        ("weather_exposure_segmentation", layout.gold("region_segments"), segment)])
    steps.write.mode("overwrite").json(layout.catalog("prediction_run"))
    return steps


#: Gold tables whose manifests monitoring expects.
MANIFESTS = ["region_features", "market_summary", "crop_summary"]


def monitor(spark: SparkSession, layout: Layout, as_of: Column | None = None) -> DataFrame:
    """Freshness, row counts and artifact checks; writes the health report, returns the checks.

    It runs after any subset of the stages: what is not there yet has a row that says so.
    """
    now = as_of if as_of is not None else F.current_timestamp()
    silver = {n: _read(spark, layout.silver(n)) for n in ("weather", "geo", "trades", "agriculture")}
    gold = {n: _read(spark, layout.gold(n)) for n in ("region_features", "crop_summary")}
    weather, geo = silver["weather"], silver["geo"]
    stamps = feeds.read_optional(spark, layout.bronze("weather/meta/*"), "json")
    manifests = feeds.read_optional(spark, layout.catalog("manifests"), "json", recursiveFileLookup=True)
    no_stamps = spark.createDataFrame([], "retrieved_at string")
    no_manifests = spark.createDataFrame([], "dataset string, generated_at string")
    if manifests is not None and "generated_at" not in manifests.columns:
        manifests = manifests.withColumn("generated_at", F.lit(None).cast("string"))
    regions = geo.agg(F.count(F.lit(1))).scalar() if geo is not None else F.lit(1)
    counted = Q.names_of(spark, [*(n for n in ("weather", "geo") if silver[n] is not None), *(t[0] for t in Q.EXPECTED_TABLES[2:])])
    checks = [
        Q.check_freshness(no_stamps if stamps is None else stamps, "retrieved_at", now),
        Q.absent_tables(counted),
        *([Q.check_row_count(weather, "weather", regions * Q.WEATHER_DAYS)] if weather is not None else []),
        *([Q.check_row_count(geo, "geo", 1)] if geo is not None else []),
        Q.artifact_checks(
            silver["trades"], silver["agriculture"], gold["region_features"], gold["crop_summary"], geo,
            (no_manifests if manifests is None else manifests).select("dataset", "generated_at"), now, MANIFESTS),
    ]
    rows = Q.combine(checks)
    observed = Q.observed_figures(spark, {**silver, **gold})
    Q.health_report(rows, now, observed).write.mode("overwrite").text(layout.catalog("health_report"))
    return rows
