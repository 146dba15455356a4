"""Source and sink queries: tables derived from the driver's are written to the shared
scratch folder and read back through the library's readers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.functions.numbers import to_number
from fieldmart.operators import contracts as V
from fieldmart.operators import market as M
from fieldmart.plans.base import define, query
from fieldmart.plans.climate_queries import daily
from fieldmart.plans.market_queries import market_rows
from fieldmart.plans.text_queries import raw_crops, raw_trades
from fieldmart.session import scratch_path
from fieldmart.sources import feeds, reference, sinks


def weather_documents(t):
    """One document per region with parallel arrays: a region has one entry per day."""
    day = F.struct("date", *[c for c in t.weather.columns if c not in ("region_name", "date")])
    docs = t.weather.groupBy("region_name").agg(F.array_sort(F.collect_list(day)).alias("d"))
    series = {name: F.col(f"d.{column}") for column, name in feeds.WEATHER_SERIES.items()}
    return docs.select(
        F.col("region_name").alias("_region_name"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"),
        F.struct(*[c.alias(n) for n, c in series.items()]).alias("daily"))


@query("S1_flatten_weather", "SELECT * REPLACE (cast(date AS timestamp) AS date) FROM weather", "weather")
def s1(t):
    path = scratch_path(t.spark, "weather_raw")
    weather_documents(t).write.json(path)
    return feeds.read_weather(t.spark, path, multiline=False)


@query("S2_newest_batch", "SELECT region_name, date, temp_max_c FROM weather", "weather")
def s2(t):
    path = scratch_path(t.spark, "batches")
    rows = t.weather.select("region_name", "date", "temp_max_c")
    rows.withColumn("temp_max_c", F.col("temp_max_c") + 1).write.parquet(f"{path}/weather_normalized_20240101T000000Z")
    rows.write.parquet(f"{path}/weather_normalized_20240201T000000Z")
    return feeds.newest_batch(feeds.read_ignoring_partitions(t.spark, path))


@query("S3_trades_csv", """
    SELECT CASE WHEN row_id % 10 = 3 THEN 'soon' ELSE cast(date AS varchar) END AS date, state AS state_name,
           commodity AS commodity_name, modal_price, arrival_quantity FROM trades""", "trades")
def s3(t):
    path = scratch_path(t.spark, "trades_csv")
    raw_trades(t).write.option("header", True).csv(path)
    df = feeds.read_trades_csv(t.spark, path)
    return df.select("date", F.trim("state_name").alias("state_name"), "commodity_name",
                     to_number(F.col("modal_price")).alias("modal_price"),
                     to_number(F.col("arrival_quantity")).alias("arrival_quantity"))


@query("S4_crops_csv", """
    SELECT cast(id AS varchar) AS id, district AS district_name, season, cast(area AS decimal(20,1)) || '' AS area,
           coalesce(cast(production AS decimal(20,1)) || '', 'NA') AS production FROM agri""", "agri")
def s4(t):
    path = scratch_path(t.spark, "crops_csv")
    raw_crops(t).write.option("header", True).csv(path)
    return feeds.read_crops_csv(t.spark, path).select(
        "id", F.trim("district_name").alias("district_name"), "season", "area", "production")


@query("S5_region_catalog", """
    SELECT CASE WHEN mandi_apmc IS NULL THEN district ELSE region_name END AS region_name, state_ut AS state, state_ut, state_code, district,
           district_code, coalesce(mandi_apmc, '') AS mandi_apmc, coalesce(mandi_apmc, '') AS mandi,
           coalesce(mandi_apmc, '') AS apmc, latitude, longitude FROM market_places""", "market_places")
def s5(t):
    """Catalog documents, one per supplier, with some fields only under their other names."""
    path = scratch_path(t.spark, "regions")
    r = t.market_places
    one = F.struct(F.when(F.col("mandi_apmc").isNotNull(), F.col("region_name")).alias("region_name"),
                   F.col("state_ut").alias("state"), "state_code", "district", "district_code",
                   F.col("mandi_apmc").alias("mandi"), F.col("mandi_apmc").alias("apmc"), "latitude", "longitude")
    r.select(F.to_json(F.struct(F.array(one).alias("regions"))).alias("value")).write.text(path)
    return reference.read_regions(t.spark, path, one_per_line=True)


@query("S10_partitioned_scan", """
    SELECT state_ut, count(*) AS days, sum(precipitation_mm) AS rain FROM daily GROUP BY 1""", "daily")
def s10(t):
    path = scratch_path(t.spark, "daily")
    sinks.write_table(daily(t), path, partition_by=["region_name"])
    return t.spark.read.parquet(path).groupBy("state_ut").agg(
        F.count(F.lit(1)).alias("days"), F.sum("precipitation_mm").alias("rain"))


@query("S11_region_from_path", "SELECT region_name, date, temp_avg_c FROM daily", "daily")
def s11(t):
    path = scratch_path(t.spark, "by_region")
    sinks.write_table(daily(t), path, partition_by=["region_name"])
    return feeds.region_from_path(feeds.read_ignoring_partitions(t.spark, path)).select("region_name", "date", "temp_avg_c")


@query("S12_optional_market", """
    SELECT 'configured' AS status, commodity, min(variety) AS variety, state AS state_ut, district, apmc AS mandi,
           cast(date AS timestamp) AS date, floor(modal_price / 8) * 8 AS market_price_inr_per_quintal, arrival_quantity AS arrivals_quintal
    FROM trades GROUP BY ALL""", "trades")
def s12(t):
    status, rows = feeds.optional_market(market_rows(t))
    return rows.select(F.lit(status).alias("status"), *feeds.MARKET_COLUMNS)


@query("K1_bronze_write", """
    SELECT 'success' AS status, 'trades' AS dataset, '20240201T000000Z' AS retrieved_at, count(*) AS row_count, 13 AS n_columns FROM trades""", "trades")
def k1(t):
    folder = scratch_path(t.spark, "bronze")
    record = sinks.write_bronze(t.trades, folder, "trades", "20240201T000000Z", dataset="trades")
    return record.select("status", "dataset", "retrieved_at", "row_count", F.size("columns").alias("n_columns"))


@query("K2_silver_write", """
    SELECT region_name, state_ut, state_code, district, mandi_apmc, latitude, longitude FROM market_places
    WHERE length(state_code) = 2 AND mandi_apmc IS NOT NULL AND latitude BETWEEN 6 AND 37 AND longitude BETWEEN 68 AND 98""", "market_places")
def k2(t):
    path = scratch_path(t.spark, "silver")
    try:
        sinks.write_silver(t.market_places, V.GEO, f"{path}/geo", f"{path}/_rejects")
    except V.ContractViolation:  # the table with broken rows isn't written; its clean rows are
        clean = V.clean_rows(V.check_rows(t.market_places, V.GEO))
    sinks.write_silver(clean, V.GEO, f"{path}/geo", f"{path}/_rejects")
    return V.project(t.spark.read.parquet(f"{path}/geo"), V.GEO)


@query("K3_partitioned_gold", "SELECT region_name, date, temp_avg_c, precipitation_mm FROM daily", "daily")
def k3(t):
    path = scratch_path(t.spark, "gold_daily")
    sinks.write_table(daily(t), path, partition_by=["region_name"])
    return t.spark.read.parquet(path).select("region_name", "date", "temp_avg_c", "precipitation_mm")


@query("K4_gold_table", """
    SELECT region_name, date, count(*) AS records, sum(arrival_quantity) AS arrivals FROM mapped GROUP BY 1, 2""", "mapped")
def k4(t):
    from fieldmart.operators.region_features import map_region
    path = scratch_path(t.spark, "gold_market")
    per_day = map_region(t.trades, t.geo).groupBy("region_name", "date").agg(
        F.count(F.lit(1)).alias("records"), F.sum("arrival_quantity").alias("arrivals"))
    sinks.write_table(per_day, path)
    return t.spark.read.parquet(path)


def trade_manifest(t):
    return sinks.manifest(t.trades, "india_mandi", inputs=["bronze"], outputs=["silver"], date="date",
                          distinct=["apmc", "commodity", "state"], matched={"priced": F.col("modal_price").isNotNull()},
                          generated_at="2024-02-01T00:00:00")


@query("K5_manifest", """
    SELECT 'india_mandi' AS dataset, 'success' AS status, count(*) AS rows, cast(min(date) AS varchar) AS first_date, cast(max(date) AS varchar) AS last_date,
           count(DISTINCT apmc) AS n_apmc, count(DISTINCT commodity) AS n_commodity, count(DISTINCT state) AS n_state,
           count(modal_price) AS priced FROM trades""", "trades")
def k5(t):
    return trade_manifest(t).select("dataset", "status", "metrics.*")


@query("K6_lineage", """
    SELECT 'india_mandi' AS dataset, 'success' AS status, 13 AS n_columns, 'silver' AS output FROM (SELECT count(*) FROM trades)
    UNION ALL SELECT 'weather', 'success', 7, NULL FROM (SELECT count(*) FROM weather)""", "trades weather")
def k6(t):
    rows = sinks.lineage([trade_manifest(t), sinks.manifest(t.weather, "weather", date="date")])
    return rows.select("dataset", "status", F.size("schema").alias("n_columns"), F.try_element_at("output", F.lit(1)).alias("output"))


@query("K7_no_data_marker", """
    SELECT 'weather' AS dataset, 'success' AS status, count(*) AS rows FROM weather UNION ALL SELECT 'market', 'no_data', NULL""", "weather")
def k7(t):
    path = scratch_path(t.spark, "present")
    t.weather.write.parquet(f"{path}/weather")
    parts = []
    for name in ("weather", "market"):
        table = feeds.read_optional(t.spark, f"{path}/{name}")
        marker = (sinks.no_data_manifest(t.spark, name, "table absent") if table is None
                  else sinks.manifest(table, name))
        rows = F.col("metrics.rows") if table is not None else F.lit(None).cast("long")
        parts.append(marker.select("dataset", "status", rows.alias("rows")))
    return parts[0].unionByName(parts[1])


define("monitored", "SELECT * FROM geo WHERE state_ut IN ('ASIA', 'EUROPE')", "geo")


@query("K8_monitored_subset", "SELECT * FROM agri WHERE district IN (SELECT district FROM monitored)", "agri monitored")
def k8(t):
    monitored = t.geo.where(F.col("state_ut").isin("ASIA", "EUROPE")).withColumn("district", F.concat(F.lit(" "), "district"))
    return sinks.monitored_subset(t.agri, monitored)


@query("K9_export", """
    SELECT state, commodity, count(*) AS records FROM trades GROUP BY 1, 2""", "trades")
def k9(t):
    path = scratch_path(t.spark, "export")
    per_state = t.trades.groupBy("state", "commodity").agg(F.count(F.lit(1)).alias("records"))
    sinks.export(per_state, path)
    return t.spark.read.parquet(path)
