"""Contract, dedupe, catalog and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import catalog as G
from fieldmart.operators import contracts as V
from fieldmart.operators import crops as K
from fieldmart.operators import dedupe as D
from fieldmart.operators import quality as Q
from fieldmart.session import scratch_path
from fieldmart.plans.base import define, query
from fieldmart.plans.market_queries import market_rows, region_days
from fieldmart.session import materialized

FAILURES = "dataset, \"column\", \"check\", failures"


def failures(source: str, dataset: str, *rules: tuple[str, str, str]) -> str:
    """Failure counts per rule; rules without failures give no row."""
    parts = [f"""SELECT '{dataset}' AS dataset, '{column}' AS "column", '{check}' AS "check", count(*) AS failures
                 FROM {source} WHERE {bad}""" for column, check, bad in rules]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE failures > 0"


def counts(df, contract):
    return V.failure_counts(df, contract)


def trade_rows(t):
    """Trades with the contract's remaining columns and a passthrough column."""
    blank = F.lit("").alias("_")
    return t.trades.select("*", *[blank.alias(c) for c in (
        "state_code", "district_code", "market_center_code", "commodity_id", "grade")])


TRADE_RULES = [
    ("", "min_price must be <= modal_price when both present", "min_price > modal_price"),
    ("", "modal_price must be <= max_price when both present", "modal_price > max_price"),
]


@query("V1_contract_engine", failures(
    "(SELECT *, CASE WHEN row_id % 50 = 1 THEN 'x' END AS bad, CASE WHEN row_id % 50 = 2 THEN NULL ELSE apmc END AS shop FROM trades)",
    "india_mandi", ("arrival_quantity", "coerce_dtype(''double'')", "bad IS NOT NULL"),
    ("apmc", "not_nullable", "shop IS NULL"), *TRADE_RULES), "trades")
def v1(t):
    broken = trade_rows(t).withColumns({
        "arrival_quantity": F.when(F.col("row_id") % 50 == 1, "x").otherwise(F.col("arrival_quantity").cast("string")),
        "apmc": F.when(F.col("row_id") % 50 != 2, F.col("apmc"))})
    return counts(broken, V.TRADES)


@query("V2_weather_contract", failures(
    "weather", "weather", ("humidity_pct", "in_range(0, 100)", "humidity_pct > 100"),
    ("temp_max_c", "in_range(-40, 55)", "temp_max_c > 55"), ("", "temp_max_c must be >= temp_min_c", "temp_max_c < temp_min_c")), "weather")
def v2(t):
    return counts(t.weather, V.WEATHER)


@query("V3_geo_contract", failures(
    "market_places", "geo", ("state_code", "str_length(2, 2)", "length(state_code) <> 2"),
    ("mandi_apmc", "not_nullable", "mandi_apmc IS NULL"), ("latitude", "in_range(6, 37)", "NOT latitude BETWEEN 6 AND 37"),
    ("longitude", "in_range(68, 98)", "NOT longitude BETWEEN 68 AND 98")), "market_places")
def v3(t):
    return counts(t.market_places, V.GEO)


@query("V4_market_rows_contract", failures(
    "trades", "market", ("market_price_inr_per_quintal", "greater_than_or_equal_to(0)", "floor(modal_price / 8) * 8 - 400 < 0"),
    ("market_price_inr_per_quintal", "not_nullable", "modal_price IS NULL"),
    ("arrivals_quintal", "greater_than_or_equal_to(0)", "arrival_quantity < 0")), "trades")
def v4(t):
    lowered = market_rows(t).withColumn("market_price_inr_per_quintal", F.col("market_price_inr_per_quintal") - 400)
    return counts(lowered, V.MARKET_ROWS)


@query("V5_agriculture_contract", failures(
    "agri", "india_agriculture", ("year_start", "greater_than_or_equal_to(1900)", "year_start - 100 < 1900"),
    ("area", "greater_than_or_equal_to(0)", "area - 40 < 0"), ("season", "not_nullable", "season = 'N' AND year_start = 1996"),
    ("", "season must be non-empty when present", "season = 'R' AND year_start = 1996")), "agri")
def v5(t):
    early = F.col("year_start") == 1996
    season = F.when(early & (F.col("season") == "R"), "\t\u00a0").when(~(early & (F.col("season") == "N")), F.col("season"))
    return counts(t.agri.withColumns({"season": season, "area": F.col("area") - 40, "year_start": F.col("year_start") - 100}), V.AGRICULTURE)


@query("V6_trade_contract", failures("trades", "india_mandi", *TRADE_RULES), "trades")
def v6(t):
    return counts(trade_rows(t), V.TRADES)


define("contradicting", "SELECT * FROM trades WHERE coalesce(min_price > modal_price, false) OR coalesce(modal_price > max_price, false)", "trades")


@query("V7_gate_outcome", """
    SELECT 'india_mandi' AS dataset, count(*) AS offending_rows, CASE WHEN count(*) > 0 THEN 'stopped' ELSE 'passed' END AS outcome
    FROM contradicting UNION ALL SELECT 'india_mandi', 0, 'passed'""", "contradicting")
def v7(t):
    """The gate on the failing table, and on its clean rows."""
    folder = scratch_path(t.spark, "rejects")
    clean = V.clean_rows(V.check_rows(trade_rows(t), V.TRADES))
    return V.gate_outcome(trade_rows(t), V.TRADES, f"{folder}/all").unionByName(V.gate_outcome(clean, V.TRADES, f"{folder}/clean"))


@query("V8_quarantine", """
    SELECT * FROM contradicting""", "contradicting")
def v8(t):
    return D.quarantine(t.trades, D.price_contradiction())[1]


@query("V8_kept_rows", """
    SELECT * FROM trades EXCEPT ALL SELECT * FROM contradicting""", "trades contradicting")
def v8_kept(t):
    return D.quarantine(t.trades, D.price_contradiction())[0]


@query("V10_contract_projection", """
    SELECT cast(date AS timestamp) AS date, state, '' AS state_code, district, '' AS district_code, apmc, '' AS market_center_code, commodity,
           '' AS commodity_id, variety, '' AS grade, min_price, modal_price, max_price, price_unit, arrival_quantity, arrival_units
    FROM trades""", "trades")
def v10(t):
    return V.project(trade_rows(t).withColumn("date", F.col("date").cast("timestamp")), V.TRADES)


@query("V11_catalog_problems", """
    SELECT 'duplicate geography record' AS problem, state_code || ' / ' || district AS subject
    FROM (SELECT *, row_number() OVER (PARTITION BY state_code, district) AS rn FROM market_places) WHERE rn > 1
    UNION ALL SELECT 'district_code missing/invalid', region_name FROM market_places WHERE district_code = 'x1'
    UNION ALL SELECT 'state_code not 2 chars', region_name FROM market_places WHERE length(state_code) <> 2
    UNION ALL SELECT 'coordinates outside bounds', region_name FROM market_places
    WHERE NOT (latitude BETWEEN 6 AND 37 AND longitude BETWEEN 68 AND 98)""", "market_places")
def v11(t):
    return G.catalog_problems(t.market_places)


PAIR = {"state": "state_ut", "district": "district"}


@query("V12_known_places", """
    SELECT state, district, crop, season, year_start FROM agri a
    WHERE EXISTS (SELECT 1 FROM market_places m WHERE m.state_ut = a.state AND m.district = a.district)""", "agri market_places")
def v12(t):
    return G.known_places(t.agri, t.market_places, PAIR).select("state", "district", "crop", "season", "year_start")


@query("V12_unknown_places", """
    SELECT region_name, district FROM market_places m
    WHERE NOT EXISTS (SELECT 1 FROM geo g WHERE m.state_ut = g.state_ut AND m.district = g.district)""", "market_places geo")
def v12_unknown(t):
    return G.unknown_pairs(t.market_places, t.geo, {"state_ut": "state_ut", "district": "district"}).select("region_name", "district")


@query("V12_mandi_options", """
    SELECT DISTINCT state_ut, district, mandi_apmc AS mandi FROM market_places WHERE mandi_apmc IS NOT NULL""", "market_places")
def v12_options(t):
    return G.mandi_options(t.market_places)


# -- monitoring -------------------------------------------------------------------

AS_OF = "2024-02-01 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def stamped(t):
    """Ingestion stamps from the event times."""
    return t.events.select(F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("ingested_at_utc"))


@query("Q1_freshness", """
    SELECT 'freshness' AS "check", 'ingestion' AS dataset, CASE WHEN h > 24 THEN 'FAIL' ELSE 'PASS' END AS status,
           'latest ingestion is ' || round(h, 1) || 'h old (max allowed 24 h)' AS detail
    FROM (SELECT date_diff('second', date_trunc('second', max(ts)), timestamp '2024-02-01 00:00:00') / 3600 AS h FROM events)""")
def q1(t):
    return Q.check_freshness(stamped(t), "ingested_at_utc", as_of())


@query("Q2_row_counts", """
    SELECT 'row_count' AS "check", 'weather' AS dataset, CASE WHEN w < 28 * g THEN 'FAIL' ELSE 'PASS' END AS status,
           w || ' rows, expected minimum ' || 28 * g AS detail
    FROM (SELECT (SELECT count(*) FROM weather) AS w, (SELECT count(*) FROM geo) AS g)
    UNION ALL SELECT 'row_count', 'geo', CASE WHEN g < 24 THEN 'FAIL' ELSE 'PASS' END, g || ' rows, expected minimum 24'
    FROM (SELECT count(*) AS g FROM geo)""", "weather geo")
def q2(t):
    regions = t.geo.agg(F.count(F.lit(1))).scalar()
    return Q.combine([Q.check_row_count(t.weather, "weather", regions * Q.WEATHER_DAYS),
                      Q.check_row_count(t.geo, "geo", 24)])


@query("Q3_duplicates", """
    SELECT 'duplicates' AS "check", 'india_mandi' AS dataset, CASE WHEN d > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
           CASE WHEN d > 0 THEN d || ' duplicate trade-day rows' ELSE 'no duplicate trade-day rows' END AS detail
    FROM (SELECT (SELECT count(*) FROM trades) - count(*) AS d
          FROM (SELECT DISTINCT date, state, district, apmc, commodity, variety FROM trades))
    UNION ALL SELECT 'duplicates', 'india_agriculture', 'PASS', 'no duplicate season-aware rows'""", "trades")
def q3(t):
    return Q.combine([
        Q.check_duplicates(t.trades, "india_mandi", ["date", "state", "district", "apmc", "commodity", "variety"], "trade-day rows"),
        Q.check_duplicates(t.agri, "india_agriculture", ["state", "district", "crop", "season", "year"], "season-aware rows")])


@query("Q4_missing_geography", """
    SELECT 'missing_geo' AS "check", 'markets' AS dataset, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
           CASE WHEN n > 0 THEN n || ' rows with empty state/district' ELSE 'no empty state/district' END AS detail
    FROM (SELECT count(*) AS n FROM market_places WHERE mandi_apmc IS NULL)
    UNION ALL SELECT 'missing_geo', 'markets', CASE WHEN u = n THEN 'FAIL' ELSE 'PASS' END,
           u || '/' || n || ' rows without a monitored district'
    FROM (SELECT count(*) AS n, count(*) FILTER (WHERE lower(district) NOT IN (SELECT lower(district) FROM geo)) AS u FROM market_places)""",
       "market_places geo")
def q4(t):
    return Q.combine([Q.check_empty_geography(t.market_places, "markets", ["state_ut", "mandi_apmc"]),
                      Q.check_unknown_places(t.market_places, "markets", t.geo)])


@query("J15_unknown_districts", """
    SELECT region_name, district FROM market_places WHERE lower(district) NOT IN (SELECT lower(district) FROM geo)""", "market_places geo")
def j15(t):
    return Q.unknown_places(t.market_places, t.geo).select("region_name", "district")


@query("Q5_impossible_values", """
    SELECT 'impossible_values' AS "check", 'india_region_features' AS dataset, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
           CASE WHEN n > 0 THEN 'humidity outside [0, 100]' ELSE 'no impossible values' END AS detail
    FROM (SELECT count(*) AS n FROM region_days WHERE humidity_pct > 100)""", "region_days")
def q5(t):
    return Q.check_impossible(region_days(t), "india_region_features", Q.REGION_BOUNDS)


@query("Q6_missing_prices", """
    SELECT 'missing_prices' AS "check", 'india_mandi' AS dataset,
           CASE WHEN n > 0 OR d = 0 THEN 'INFO' ELSE 'PASS' END AS status,
           CASE WHEN n > 0 THEN n || ' rows without modal price' WHEN d = 0 THEN 'no market price days observed' ELSE 'price channel present' END AS detail
    FROM (SELECT (SELECT count(*) FROM trades WHERE modal_price IS NULL) AS n,
                 (SELECT count(*) FROM region_days WHERE n_price_records > 0) AS d)""", "trades region_days")
def q6(t):
    return Q.check_missing_prices(t.written.trades, region_days(t))


@query("Q7_missing_weather", """
    SELECT 'missing_weather' AS "check", 'india_region_features' AS dataset, CASE WHEN n > 0 OR h > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
           CASE WHEN n > 0 OR h > 0 THEN n || ' weather-window rows missing temperature, ' || h || ' missing humidity'
                ELSE 'weather-window rows carry complete temperature/humidity' END AS detail
    FROM (SELECT count(*) FILTER (WHERE temp_max_c IS NULL) AS n, count(*) FILTER (WHERE humidity_pct IS NULL) AS h
          FROM region_days WHERE date IN (SELECT date FROM region_days WHERE temp_max_c IS NOT NULL))""", "region_days")
def q7(t):
    return Q.check_missing_weather(region_days(t))


@query("J14_weather_window", """
    SELECT region_name, date, temp_max_c FROM region_days
    WHERE date IN (SELECT date FROM region_days WHERE temp_max_c IS NOT NULL)""", "region_days")
def j14(t):
    return Q.in_weather_window(region_days(t)).select("region_name", "date", "temp_max_c")


def manifests(t):
    """A manifest per event type with its newest time, one of them unreadable."""
    newest = t.events.groupBy(F.col("event_type").alias("dataset")).agg(F.max("ts").alias("ts"))
    return newest.select("dataset", F.when(F.col("dataset") == "error", "yesterday").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("generated_at"))


@query("Q8_staleness", """
    SELECT 'staleness' AS "check", dataset, CASE WHEN dataset = 'error' THEN 'INFO' WHEN h > 24 THEN 'FAIL' ELSE 'PASS' END AS status,
           CASE WHEN dataset = 'error' THEN 'gold manifest has no parseable generated_at'
                ELSE 'manifest generated ' || round(h, 1) || 'h ago (max allowed 24 h)' END AS detail
    FROM (SELECT event_type AS dataset, date_diff('second', date_trunc('second', max(ts)), timestamp '2024-02-01 00:00:00') / 3600 AS h
          FROM events GROUP BY 1)""")
def q8(t):
    return Q.check_staleness(manifests(t), as_of())


def all_checks(t):
    """The checks read written tables, as monitoring does: each is computed once."""
    trades, agri = t.written.trades, materialized(t.written.agri, "agri")
    features = materialized(region_days(t), "region_features")
    crops = materialized(K.crop_summary(agri, trades, features, "F", ["row_id"]), "crop_summary")
    return Q.artifact_checks(trades, agri, features, crops, t.geo, manifests(t), as_of(), ["market_summary"])


def counted(check: str, dataset: str, n: str, found: str, none: str, source: str) -> str:
    """SQL of a check that fails where its count is above zero."""
    return f"""
        SELECT '{check}' AS "check", '{dataset}' AS dataset, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
               CASE WHEN n > 0 THEN n || ' {found}' ELSE '{none}' END AS detail FROM (SELECT {n} AS n FROM {source})"""


def repeated(dataset: str, key: str, what: str, source: str) -> str:
    return counted("duplicates", dataset, f"count(*) - count(DISTINCT ({key}))", f"duplicate {what}", f"no duplicate {what}", source)


def bounded(dataset: str, bounds: dict[str, str], source: str) -> str:
    names = ", ".join(f"CASE WHEN count(*) FILTER (WHERE {rule}) > 0 THEN '{name}' END" for name, rule in bounds.items())
    return f"""
        SELECT 'impossible_values', '{dataset}', CASE WHEN d <> '' THEN 'FAIL' ELSE 'PASS' END, CASE WHEN d <> '' THEN d ELSE 'no impossible values' END
        FROM (SELECT concat_ws('; ', {names}) AS d FROM {source})"""


EMPTY = "count(*) FILTER (WHERE coalesce(trim(state), '') = '' OR coalesce(trim(district), '') = '')"
define("report_crops", """
    SELECT c.*, obs_temp_max_c, obs_temp_min_c FROM crop_market c LEFT JOIN district_weather w ON lower(c.district) = lower(w.district)""",
       "crop_market", "district_weather")
define("report_rows", " UNION ALL ".join([
    repeated("india_mandi", "date, state, district, apmc, commodity, variety", "trade-day rows", "trades"),
    repeated("india_agriculture", "state, district, crop, season, year", "season-aware rows", "agri"),
    repeated("india_region_features", "region_name, date", "(region_name, date) rows", "region_days"),
    repeated("india_crop_summary", "state, district, crop", "(state, district, crop) rows", "report_crops"),
    *[counted("missing_geo", d, EMPTY, "rows with empty state/district", "no empty state/district", source)
      for d, source in (("india_region_features", "region_days"), ("india_crop_summary", "report_crops"))],
    """SELECT 'missing_geo', 'india_crop_summary', CASE WHEN u = n THEN 'FAIL' ELSE 'PASS' END, u || '/' || n || ' rows without a monitored district'
       FROM (SELECT count(*) AS n, count(*) FILTER (WHERE lower(district) NOT IN (SELECT lower(district) FROM geo)) AS u FROM report_crops)""",
    bounded("india_region_features", Q.REGION_BOUNDS, "region_days"), bounded("india_crop_summary", Q.CROP_BOUNDS, "report_crops"),
    """SELECT 'missing_prices', 'india_mandi', CASE WHEN n > 0 OR d = 0 THEN 'INFO' ELSE 'PASS' END,
              CASE WHEN n > 0 THEN n || ' rows without modal price' WHEN d = 0 THEN 'no market price days observed' ELSE 'price channel present' END
       FROM (SELECT (SELECT count(*) FROM trades WHERE modal_price IS NULL) AS n,
                    (SELECT count(*) FROM region_days WHERE n_price_records > 0) AS d)""",
    """SELECT 'missing_weather', 'india_region_features', CASE WHEN t > 0 OR h > 0 THEN 'FAIL' ELSE 'PASS' END,
              CASE WHEN t > 0 OR h > 0 THEN t || ' weather-window rows missing temperature, ' || h || ' missing humidity'
                   ELSE 'weather-window rows carry complete temperature/humidity' END
       FROM (SELECT count(*) FILTER (WHERE temp_max_c IS NULL) AS t, count(*) FILTER (WHERE humidity_pct IS NULL) AS h
             FROM region_days WHERE date IN (SELECT date FROM region_days WHERE temp_max_c IS NOT NULL))""",
    """SELECT 'staleness', dataset, CASE WHEN h IS NULL THEN 'INFO' WHEN h > 24 THEN 'FAIL' ELSE 'PASS' END,
              CASE WHEN dataset = 'market_summary' THEN 'gold manifest absent' WHEN h IS NULL THEN 'gold manifest has no parseable generated_at'
                   ELSE 'manifest generated ' || round(h, 1) || 'h ago (max allowed 24 h)' END
       FROM (SELECT event_type AS dataset, CASE WHEN event_type <> 'error' THEN
                    date_diff('second', date_trunc('second', max(ts)), timestamp '2024-02-01 00:00:00') / 3600 END AS h
             FROM events GROUP BY 1 UNION ALL SELECT 'market_summary', NULL)"""]), *"trades agri region_days report_crops geo".split())


@query("X1_check_union", "SELECT * FROM report_rows", "report_rows")
def x1(t):
    return all_checks(t)


@query("Q9_health_report", """
    SELECT '2024-02-01 00:00:00' AS checked_at, CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
           count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'INFO') AS informational,
           count(*) FILTER (WHERE status = 'FAIL') AS issues,
           string_agg(detail, ' | ' ORDER BY "check", dataset, detail) FILTER (WHERE status = 'FAIL') AS issue_details,
           (SELECT count(*) FROM trades) AS trades_rows, (SELECT count(*) FROM trades WHERE modal_price IS NULL) AS trades_without_price
    FROM report_rows""", "report_rows")
def q9(t):
    """The health report, parsed again."""
    report = Q.health_report(all_checks(t), as_of(), Q.observed_figures(t.spark, {"trades": t.written.trades}))
    entry = "array<struct<check: string, dataset: string, status: string, detail: string>>"
    parsed = report.select(F.from_json("report", f"""checked_at string, status string, issues {entry}, checks {entry},
        observed struct<trades_rows: long, trades_without_price: long>""").alias("r"))

    def number(status):
        return F.size(F.filter("r.checks", lambda c: c["status"] == status)).cast("long")

    return parsed.select("r.checked_at", "r.status", number("PASS").alias("passed"), number("INFO").alias("informational"),
                         F.size("r.issues").cast("long").alias("issues"), F.array_join("r.issues.detail", " | ").alias("issue_details"),
                         "r.observed.trades_rows", "r.observed.trades_without_price")
