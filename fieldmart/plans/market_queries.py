"""Market queries: summaries, windows, benchmarks, slices and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import climate as C
from fieldmart.operators import market as M
from fieldmart.operators import region_features as R
from fieldmart.operators import slices as S
from fieldmart.operators.dedupe import keep_first
from fieldmart.plans.base import define, query

COARSE = ["state", "district", "commodity", "price_unit"]


def summary_sql(keys: str, source: str = "trades") -> str:
    """Market summary per key: latest record, window averages and changes."""
    return f"""
        SELECT *, CASE WHEN wd >= 2 AND avg_modal_price_7d <> 0
                       THEN (latest_modal_price - avg_modal_price_7d) / avg_modal_price_7d * 100 END
                    AS modal_price_change_pct_7d,
               CASE WHEN wd >= 2 AND avg_arrival_quantity_7d <> 0
                    THEN (latest_arrival_quantity - avg_arrival_quantity_7d) / avg_arrival_quantity_7d * 100 END
                    AS arrival_change_pct_7d
        FROM (SELECT {keys}, max(date) AS latest_date, count(DISTINCT date) AS days_of_history,
                     max(CASE WHEN rn = 1 THEN min_price END) AS latest_min_price,
                     max(CASE WHEN rn = 1 THEN modal_price END) AS latest_modal_price,
                     max(CASE WHEN rn = 1 THEN max_price END) AS latest_max_price,
                     max(CASE WHEN rn = 1 THEN arrival_quantity END) AS latest_arrival_quantity,
                     max(CASE WHEN rn = 1 THEN arrival_units END) AS arrival_units,
                     count(DISTINCT CASE WHEN recent THEN date END) AS wd,
                     avg(CASE WHEN recent THEN modal_price END) AS avg_modal_price_7d,
                     avg(CASE WHEN recent THEN arrival_quantity END) AS avg_arrival_quantity_7d
              FROM (SELECT *, date_diff('day', date, max(date) OVER (PARTITION BY {keys})) <= 6 AS recent,
                           row_number() OVER (PARTITION BY {keys} ORDER BY date DESC, row_id,
                             min_price NULLS FIRST, modal_price NULLS FIRST, max_price NULLS FIRST,
                             arrival_quantity, arrival_units) AS rn
                    FROM {source})
              GROUP BY {keys})"""


SUMMARY_OUT = ("latest_date, days_of_history, latest_min_price, latest_modal_price, latest_max_price, "
               "latest_arrival_quantity, avg_modal_price_7d, avg_arrival_quantity_7d, "
               "modal_price_change_pct_7d, arrival_change_pct_7d, arrival_units")
FULL = ", ".join(M.SUMMARY_KEY)
define("lines", summary_sql(FULL), "trades")
define("coarse", summary_sql(", ".join(COARSE)), "trades")
define("bench", """
    SELECT state, price_unit, latest_modal_price AS state_latest_modal_price
    FROM (SELECT *, row_number() OVER (PARTITION BY state, price_unit ORDER BY latest_date DESC,
                 district DESC, apmc DESC, commodity DESC, variety DESC) AS rn FROM lines) WHERE rn = 1""", "lines")
define("mapped", """
    SELECT t.*, coalesce(g.region_name, lower(t.district)) AS region_name
    FROM trades t LEFT JOIN geo g ON lower(t.district) = lower(g.district)""", "trades", "geo")
define("priced", """
    SELECT region_name, date, median(modal_price) AS median_modal_price_rq, count(modal_price) AS n_price_records,
           count(DISTINCT apmc) AS n_price_markets, count(DISTINCT commodity) AS n_price_commodities
    FROM mapped WHERE price_unit = 'F' GROUP BY 1, 2""", "mapped")
define("arrived", """
    SELECT region_name, date, coalesce(sum(arrival_quantity), 0) AS total_arrival_tonnes,
           count(arrival_quantity) AS n_arrival_records, count(DISTINCT apmc) AS n_arrival_markets
    FROM mapped WHERE arrival_units = 'A' GROUP BY 1, 2""", "mapped")


def lines(t):
    return M.market_summary(t.trades, tie=["row_id"])


@query("A6_market_summary", f"""
    SELECT {FULL}, {SUMMARY_OUT}, state_latest_modal_price,
           CASE WHEN state_latest_modal_price <> 0 THEN (latest_modal_price - state_latest_modal_price)
             / state_latest_modal_price * 100 END AS modal_pct_vs_state_latest
    FROM lines LEFT JOIN bench USING (state, price_unit)""", "lines bench")
def a6(t):
    return lines(t)


@query("W1_trailing_week", f"SELECT {', '.join(COARSE)}, {SUMMARY_OUT} FROM coarse", "coarse")
def w1(t):
    return M.market_summary(t.trades, COARSE, ["row_id"], None)


@query("W2_latest_record", """
    SELECT apmc, commodity, date AS latest_date, modal_price, min_price, max_price
    FROM (SELECT *, row_number() OVER (PARTITION BY apmc, commodity ORDER BY date DESC, row_id,
            min_price NULLS FIRST, modal_price NULLS FIRST, max_price NULLS FIRST, arrival_quantity,
            arrival_units) AS rn FROM trades) WHERE rn = 1""", "trades")
def w2(t):
    return M.market_summary(t.trades, ["apmc", "commodity"], ["row_id"], None).select(
        "apmc", "commodity", "latest_date", F.col("latest_modal_price").alias("modal_price"),
        F.col("latest_min_price").alias("min_price"), F.col("latest_max_price").alias("max_price"))


@query("W6_state_latest", "SELECT * FROM bench", "bench")
def w6(t):
    return M.latest_benchmark(M.market_summary(t.trades, tie=["row_id"], benchmark=None),
                              M.SUMMARY_KEY, ["state", "price_unit"])


@query("J9_benchmark_change", f"""
    SELECT {FULL}, latest_modal_price, state_latest_modal_price,
           CASE WHEN state_latest_modal_price <> 0 THEN (latest_modal_price - state_latest_modal_price)
             / state_latest_modal_price * 100 END AS modal_pct_vs_state_latest
    FROM lines LEFT JOIN bench USING (state, price_unit)""", "lines bench")
def j9(t):
    return lines(t).select(*M.SUMMARY_KEY, "latest_modal_price", "state_latest_modal_price",
                           "modal_pct_vs_state_latest")


@query("A7_state_market_summary", """
    SELECT state, price_unit,
           max(CASE WHEN rn = 1 THEN latest_modal_price END) AS latest_modal_price,
           count(DISTINCT apmc) AS markets, count(DISTINCT commodity) AS commodities
    FROM (SELECT *, row_number() OVER (PARTITION BY state, price_unit ORDER BY latest_modal_price IS NULL,
            district, apmc, commodity, variety) AS rn FROM lines) GROUP BY 1, 2""", "lines")
def a7(t):
    return M.state_market_summary(M.market_summary(t.trades, tie=["row_id"], benchmark=None))


define("block", """
    SELECT *, CASE WHEN wd >= 2 AND avg_modal_price_7d <> 0
                   THEN (latest_modal_price - avg_modal_price_7d) / avg_modal_price_7d * 100 END
                AS modal_price_change_pct_7d
    FROM (SELECT district, commodity, count(modal_price) AS n_market_records, count(DISTINCT apmc) AS n_markets,
                 max(date) AS latest_market_date,
                 max(CASE WHEN rn = 1 THEN modal_price END) AS latest_modal_price,
                 max(CASE WHEN rn = 1 THEN min_price END) AS latest_min_price,
                 max(CASE WHEN rn = 1 THEN max_price END) AS latest_max_price,
                 count(DISTINCT CASE WHEN recent THEN date END) AS wd,
                 avg(CASE WHEN recent THEN modal_price END) AS avg_modal_price_7d
          FROM (SELECT *, date_diff('day', date, max(date) OVER (PARTITION BY district, commodity)) <= 6 AS recent,
                       row_number() OVER (PARTITION BY district, commodity ORDER BY date DESC, apmc, row_id,
                         min_price NULLS FIRST, modal_price NULLS FIRST, max_price NULLS FIRST) AS rn
                FROM trades WHERE price_unit = 'F')
          GROUP BY 1, 2)""", "trades")


@query("A8_commodity_block", "SELECT * EXCLUDE (wd) FROM block", "block")
def a8(t):
    return M.commodity_block(t.written.trades, "F", tie=["row_id"])


@query("A1_daily_market", """
    SELECT district AS region_name, date, round(avg(modal_price), 2) AS avg_market_price_inr_per_quintal,
           round(sum(arrival_quantity), 2) AS total_arrivals_quintal
    FROM (SELECT district, date, floor(modal_price / 8) * 8 AS modal_price, arrival_quantity FROM trades)
    GROUP BY 1, 2""", "trades")
def a1(t):
    return M.daily_region_market(market_rows(t))


def market_rows(t):
    return t.trades.select(
        "commodity", "variety", F.col("state").alias("state_ut"), "district", F.col("apmc").alias("mandi"), "date",
        (F.floor(F.col("modal_price") / 8) * 8).cast("double").alias("market_price_inr_per_quintal"),
        F.col("arrival_quantity").alias("arrivals_quintal"))


@query("A4_price_block", "SELECT * FROM priced", "priced")
def a4(t):
    return R.price_block(R.map_region(t.trades, t.geo), "F")


@query("A5_arrival_block", "SELECT * FROM arrived", "arrived")
def a5(t):
    return R.arrival_block(R.map_region(t.trades, t.geo), "A")


define("region_days", """
    SELECT region_name, coalesce(w.state, g.state_ut) AS state, coalesce(w.state_code, g.state_code) AS state_code,
           coalesce(w.district, g.district) AS district, date, temp_max_c, temp_min_c, temp_avg_c,
           precipitation_mm, humidity_pct, windspeed_max_kmh, median_modal_price_rq, n_price_records,
           n_price_markets, n_price_commodities, total_arrival_tonnes, n_arrival_records, n_arrival_markets
    FROM (SELECT region_name, date, temp_max_c, temp_min_c, temp_avg_c, precipitation_mm, humidity_pct,
                 windspeed_max_kmh, state_ut AS state, state_code, district FROM daily) w
    FULL JOIN priced USING (region_name, date) FULL JOIN arrived USING (region_name, date)
    LEFT JOIN geo g USING (region_name)""", "daily", "priced", "arrived", "geo")


def region_days(t):
    return R.region_features(t.weather, t.written.trades, t.geo, "F", "A")


@query("J3_region_features", "SELECT * FROM region_days", "region_days")
def j3(t):
    return region_days(t)


@query("J4_recovered_location", """
    SELECT region_name, date, state, state_code, district FROM region_days WHERE temp_max_c IS NULL""", "region_days")
def j4(t):
    return region_days(t).where(F.col("temp_max_c").isNull()).select(
        "region_name", "date", "state", "state_code", "district")


@query("J5_district_to_region", """
    SELECT coalesce(g.region_name, lower(t.district)) AS region_name, t.district, count(*) AS records,
           sum(arrival_quantity) AS arrivals
    FROM trades t LEFT JOIN geo_known g ON lower(t.district) = lower(g.district) GROUP BY 1, 2""",
       "trades geo_known")
def j5(t):
    known = t.geo.where(F.col("state_ut") != "EUROPE")
    return R.map_region(t.trades, known).groupBy("region_name", "district").agg(
        F.count(F.lit(1)).alias("records"), F.sum("arrival_quantity").alias("arrivals"))


define("geo_known", "SELECT * FROM geo WHERE state_ut <> 'EUROPE'", "geo")


@query("F1_canonical_unit", """
    SELECT apmc, commodity, date, modal_price, arrival_quantity, row_id FROM trades
    WHERE price_unit = 'F' AND arrival_units = 'A'""", "trades")
def f1(t):
    return M.in_unit(M.in_unit(t.trades, "F", "price_unit"), "A", "arrival_units").select(
        "apmc", "commodity", "date", "modal_price", "arrival_quantity", "row_id")


@query("F3_location_cascade", """
    SELECT DISTINCT state, district, apmc, commodity FROM trades""", "trades")
def f3(t):
    return S.cascade_options(t.trades, ["state", "district", "apmc", "commodity"])


@query("F3_catalog_options", """
    SELECT DISTINCT state_ut, district, mandi_apmc FROM geo
    WHERE region_name IN (SELECT region_name FROM weather)""", "geo weather")
def f3_catalog(t):
    return S.location_options(t.geo, t.weather)


@query("F5_market_signal", f"""
    SELECT {', '.join(COARSE)}, modal_price_change_pct_7d,
           CASE WHEN modal_price_change_pct_7d > 2 THEN 'rising' WHEN modal_price_change_pct_7d < -2
                THEN 'falling' ELSE 'stable' END AS signal FROM coarse""", "coarse")
def f5(t):
    return M.with_signal(M.market_summary(t.trades, COARSE, ["row_id"], None)).select(
        *COARSE, "modal_price_change_pct_7d", "signal")


@query("A14_daily_trend", """
    SELECT district, commodity, date, avg(modal_price) AS modal_price,
           coalesce(sum(arrival_quantity), 0) AS arrival_quantity FROM trades GROUP BY ALL""", "trades")
def a14(t):
    return M.daily_trend(t.trades, ["district", "commodity", "date"])


define("unit_counts", """
    SELECT apmc, commodity, price_unit, count(*) AS records, row_number() OVER (
        PARTITION BY apmc, commodity ORDER BY count(*) DESC, price_unit) AS rn
    FROM trades GROUP BY 1, 2, 3""", "trades")


@query("A15_dominant_unit", """
    SELECT apmc, commodity, price_unit, records FROM unit_counts WHERE rn = 1""", "unit_counts")
def a15(t):
    return M.dominant_unit(t.trades, ["apmc", "commodity"])


@query("A16_price_span", """
    SELECT t.apmc, t.commodity, max(date) AS latest_date,
           max(CASE WHEN date = last THEN modal_price END) AS latest_modal_price, min(min_price) AS min_price,
           max(modal_price) AS modal_price, max(max_price) AS max_price, count(*) AS records
    FROM (SELECT t.*, max(t.date) OVER (PARTITION BY t.apmc, t.commodity) AS last FROM trades t
          JOIN unit_counts u ON t.apmc = u.apmc AND t.commodity = u.commodity AND t.price_unit = u.price_unit
            AND u.rn = 1) t GROUP BY 1, 2""", "trades unit_counts")
def a16(t):
    slices = ["apmc", "commodity"]
    return M.price_span(M.in_dominant_unit(t.trades, slices), slices)


@query("S8_historical_slice", """
    SELECT apmc, commodity, date, modal_price, row_id FROM trades
    WHERE state = 'ASIA' AND commodity = 'ECONOMY' AND date BETWEEN date '1996-01-01' AND date '1998-12-31'""",
       "trades")
def s8(t):
    return S.historical(t.trades, {"state": "ASIA", "commodity": "ECONOMY", "district": None},
                        "1996-01-01", "1998-12-31").select(
        "apmc", "commodity", "date", "modal_price", "row_id")


@query("S9_latest_slice", """
    SELECT apmc, commodity, date, modal_price, row_id FROM trades
    WHERE state = 'ASIA' AND date = (SELECT max(date) FROM trades WHERE state = 'ASIA')""", "trades")
def s9(t):
    return S.latest_available(t.trades, {"state": "ASIA"}).select(
        "apmc", "commodity", "date", "modal_price", "row_id")


@query("S9_latest_metadata", """
    SELECT max(date) AS latest_date, count(*) FILTER (WHERE date = last) AS total_available
    FROM (SELECT date, max(date) OVER () AS last FROM trades)""", "trades")
def s9_meta(t):
    return S.latest_metadata(t.trades)


@query("J2_climate_with_market", """
    SELECT d.region_name, d.date, temp_avg_c, avg_market_price_inr_per_quintal, total_arrivals_quintal
    FROM daily d LEFT JOIN (
        SELECT region_name, date + 9862 AS date, round(avg(floor(modal_price / 8) * 8), 2) AS avg_market_price_inr_per_quintal,
               round(sum(arrival_quantity), 2) AS total_arrivals_quintal
        FROM mapped GROUP BY 1, 2) m ON d.region_name = m.region_name AND d.date = m.date""", "daily mapped")
def j2(t):
    return market_daily_features(t).select(
        "region_name", "date", "temp_avg_c", "avg_market_price_inr_per_quintal", "total_arrivals_quintal")


def market_daily_features(t):
    """Climate days with market days moved into the weather year, so the two overlap."""
    moved = R.map_region(market_rows(t).withColumn("date", F.date_add("date", 9862)), t.geo)
    return C.daily_features(t.weather, t.geo, M.daily_region_market(moved, "region_name"))


@query("V9_trade_day_dedupe", """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY date, state, district, apmc, commodity, variety ORDER BY row_id, price_unit, arrival_units,
        min_price NULLS FIRST, modal_price NULLS FIRST, max_price NULLS FIRST, arrival_quantity) AS rn FROM trades)
    WHERE rn = 1""", "trades")
def v9(t):
    return keep_first(t.trades, M.TRADE_DAY_KEY, ["row_id"])
