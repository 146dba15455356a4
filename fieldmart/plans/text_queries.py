"""Scalar expressions and normalizers over texts derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.functions import numbers as N
from fieldmart.functions import text as T
from fieldmart.operators import bulletins as B
from fieldmart.operators import normalize as Z
from fieldmart.plans.base import define, query
from fieldmart.sources.feeds import envelope_records
from fieldmart.sources.reference import crop_registry

# -- numbers, dates and names ------------------------------------------------------

NUMBER_TEXTS = """
    SELECT p_partkey, p_size, CASE p_size % 8 WHEN 0 THEN cast(p_size AS varchar) WHEN 1 THEN ' ' || p_size || '.5 '
           WHEN 2 THEN p_size || 'd' WHEN 3 THEN '' WHEN 4 THEN '1e' || (p_size % 3) WHEN 5 THEN '-' || p_size
           WHEN 6 THEN 'n/a' END AS raw FROM part"""


def number_texts(t):
    size, text = F.col("p_size"), F.col("p_size").cast("string")
    case = size % 8
    raw = (F.when(case == 0, text).when(case == 1, F.concat(F.lit(" "), text, F.lit(".5 ")))
           .when(case == 2, F.concat(text, F.lit("d"))).when(case == 3, "")
           .when(case == 4, F.concat(F.lit("1e"), (size % 3).cast("string")))
           .when(case == 5, F.concat(F.lit("-"), text)).when(case == 6, "n/a"))
    return t.part.select("p_partkey", "p_size", raw.alias("raw"))


@query("N3_to_number", f"""
    SELECT p_partkey, CASE WHEN p_size % 8 IN (2, 3, 6) THEN NULL ELSE cast(trim(raw) AS double) END AS number
    FROM ({NUMBER_TEXTS})""")
def n3(t):
    return number_texts(t).select("p_partkey", N.to_number(F.col("raw")).alias("number"))


@query("N4_to_day", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE cast(o_orderdate AS date) END AS day FROM orders""")
def n4(t):
    raw = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("on "), F.col("o_orderdate").cast("string"))).otherwise(
        F.col("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", N.to_day(raw).alias("day"))


@query("N5_crop_year_start", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE cast(year(o_orderdate) AS integer) END AS year_start FROM orders""")
def n5(t):
    year = F.year("o_orderdate")
    raw = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("FY "), year.cast("string"))).when(
        F.col("o_orderstatus") == "F", F.concat_ws("-", F.concat(F.lit("  "), year), year + 1)).otherwise(year.cast("string"))
    return t.orders.select("o_orderkey", N.crop_year_start(raw).alias("year_start"))


def registry(t):
    """Every part type except PROMO as a crop: name, canonical name and category."""
    kinds = t.part.where(F.col("p_type") != "PROMO").select("p_type").distinct()
    return kinds.select(F.col("p_type").alias("name"), F.initcap("p_type").alias("canonical"),
                        F.substring("p_type", 1, 1).alias("category"))


define("registry", """
    SELECT DISTINCT p_type AS name, substr(p_type, 1, 1) || lower(substr(p_type, 2)) AS canonical,
           substr(p_type, 1, 1) AS category FROM part WHERE p_type <> 'PROMO'""")


@query("S6_crop_registry", """
    SELECT name AS key, canonical, category FROM registry UNION SELECT canonical, canonical, category FROM registry""", "registry")
def s6(t):
    return crop_registry(registry(t))


@query("N6_canonical_crop", """
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'PROMO' || CASE p_size % 2 WHEN 1 THEN ' x' ELSE '' END
             WHEN p_size % 2 = 1 THEN p_type || ' x' ELSE substr(p_type, 1, 1) || lower(substr(p_type, 2)) END AS crop,
           CASE WHEN p_type = 'PROMO' OR p_size % 2 = 1 THEN '' ELSE substr(p_type, 1, 1) END AS category
    FROM part""")
def n6(t):
    name = F.when(F.col("p_size") % 2 == 1, F.concat(F.lit(" "), "p_type", F.lit("  x"))).otherwise(
        F.concat("p_type", F.lit(" ")))
    return Z.canonical_crops(t.part.select("p_partkey", name.alias("crop_name")), crop_registry(registry(t))).drop("crop_name")


@query("N7_match_key", """
    SELECT p_partkey, lower(p_name) AS key FROM part""")
def n7(t):
    raw = F.concat(F.lit("  "), F.replace(F.upper("p_name"), F.lit(" "), F.lit(" \t ")), F.lit("\n"))
    return t.part.select("p_partkey", T.match_key(raw).alias("key"))


@query("N8_location_key", """
    SELECT p_partkey, upper(replace(p_name, ' ', '')) AS key FROM part""")
def n8(t):
    return t.part.select("p_partkey", T.location_key(F.col("p_name")).alias("key"))


@query("N9_bulletin_number", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN -value
           WHEN event_type = 'click' THEN value * 0 + 1234.5e0 ELSE value END AS number FROM events""")
def n9(t):
    value = F.col("value").cast("decimal(20,2)").cast("string")
    kind = F.col("event_type")
    raw = (F.when(kind == "error", " N/A ").when(kind == "view", F.concat(F.lit("-"), value, F.lit("%")))
           .when(kind == "click", "1,234.5").otherwise(F.concat(F.lit(" "), value, F.lit(" "))))
    return t.events.select("event_id", N.bulletin_number(raw).alias("number"))


@query("N10_one_line", r"""
    SELECT doc_id, regexp_replace(regexp_replace(text, '[\r\n]+', ' ', 'g'),
           '^[\t\n\v\f\r \x{85}\p{Z}]+|[\t\n\v\f\r \x{85}\p{Z}]+$', '', 'g') AS text FROM documents""")
def n10(t):
    return t.documents.select("doc_id", T.one_line(F.col("text")).alias("text"))


WHOLE = "cast(cast(round(cast(o_totalprice AS decimal(18,2)), 0) AS bigint) AS varchar)"


@query("N17_indian_number", f"""
    SELECT o_orderkey, '₹' || CASE WHEN length(w) <= 3 THEN w WHEN length(w) <= 5 THEN left(w, -3) || ',' || right(w, 3)
           ELSE left(w, -5) || ',' || right(left(w, -3), 2) || ',' || right(w, 3) END || ' / quintal' AS label
    FROM (SELECT o_orderkey, {WHOLE} AS w FROM orders)""")
def n17(t):
    return t.orders.select("o_orderkey", T.rupees_per_quintal(F.col("o_totalprice")).alias("label"))


@query("N18_compact_rupees", f"""
    SELECT o_orderkey, CASE WHEN v >= 1e7 THEN '₹' || cast(v / 1e7 AS decimal(18,1)) || ' crore'
           WHEN v >= 1e5 THEN '₹' || cast(v / 1e5 AS decimal(18,1)) || ' lakh'
           ELSE '₹' || CASE WHEN length(w) <= 3 THEN w ELSE left(w, -3) || ',' || right(w, 3) END END AS label
    FROM (SELECT o_orderkey, o_totalprice AS v, {WHOLE} AS w
          FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 64 ELSE o_totalprice END AS o_totalprice FROM orders))""")
def n18(t):
    value = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") * 64).otherwise(F.col("o_totalprice"))
    return t.orders.select("o_orderkey", T.rupees_compact(value).alias("label"))


@query("N19_hierarchy_label", """
    SELECT region_name, region_name || ' (' || state_ut || ')' || coalesce(' -- APMC ' || mandi_apmc, '') AS label,
           district || ' (' || state_ut || ')' AS place FROM market_places""", "market_places")
def n19(t):
    return t.market_places.select(
        "region_name", T.hierarchy_label(F.col("region_name"), F.col("state_ut"), F.col("mandi_apmc")).alias("label"),
        T.place_label(F.col("district"), F.col("state_ut")).alias("place"))


@query("N20_period_label", """
    SELECT o_custkey, CASE WHEN min(cast(o_orderdate AS date)) = max(cast(o_orderdate AS date)) THEN cast(min(cast(o_orderdate AS date)) AS varchar)
           ELSE min(cast(o_orderdate AS date)) || ' → ' || max(cast(o_orderdate AS date)) END AS period
    FROM orders GROUP BY 1""")
def n20(t):
    return t.orders.groupBy("o_custkey").agg(T.period_label(F.min("o_orderdate"), F.max("o_orderdate")).alias("period"))


# -- normalizers ------------------------------------------------------------------

def raw_trades(t):
    """Trades as the source delivers them: texts, padding, gaps and bad dates."""
    bad = F.col("row_id") % 10 == 3
    text = {c: F.col(c).cast("decimal(20,1)").cast("string") for c in ("min_price", "modal_price", "max_price", "arrival_quantity")}
    return t.trades.select(
        F.when(bad, "soon").otherwise(F.col("date").cast("string")).alias("date"),
        F.concat(F.lit(" "), "state", F.lit(" ")).alias("state_name"),
        F.col("district").alias("district_name"), F.concat("apmc", F.lit("\t")).alias("market_center_name"),
        F.col("commodity").alias("commodity_name"), F.col("row_id").alias("commodity_id"),
        F.when(F.col("variety") != "Brand#3", F.col("variety")).alias("variety"),
        F.when(F.col("row_id") % 10 == 4, "NR").otherwise(text["min_price"]).alias("min_price"),
        text["modal_price"].alias("modal_price"), text["max_price"].alias("max_price"),
        F.col("price_unit"), text["arrival_quantity"].alias("arrival_quantity"))


define("normal_trades", """
    SELECT cast(date AS timestamp) AS date, state, '' AS state_code, district, '' AS district_code, apmc, '' AS market_center_code,
           commodity, cast(row_id AS varchar) AS commodity_id, CASE WHEN variety <> 'Brand#3' THEN variety ELSE '' END AS variety,
           '' AS grade, CASE WHEN row_id % 10 <> 4 THEN min_price END AS min_price, modal_price, max_price, price_unit,
           arrival_quantity, '' AS arrival_units
    FROM trades WHERE row_id % 10 <> 3""", "trades")


@query("N1_normalize_trades", "SELECT * FROM normal_trades", "normal_trades")
def n1(t):
    return Z.normalize_trades(raw_trades(t))


def raw_crops(t):
    return t.agri.select(
        "id", F.concat(F.lit(" "), "year").alias("year"), F.col("state").alias("state_name"),
        F.col("state_code").cast("double").cast("string").alias("state_code"),
        F.concat("district", F.lit(" ")).alias("district_name"), F.col("district_code").cast("string").alias("district_code"),
        F.concat_ws("  ", F.split(F.upper("crop"), " ")).alias("crop_name"), "season",
        F.col("area").cast("decimal(20,1)").cast("string").alias("area"),
        F.coalesce(F.col("production").cast("decimal(20,1)").cast("string"), F.lit("NA")).alias("production"))


define("normal_crops", """
    SELECT id, year, year_start, state, state_code, district, district_code,
           coalesce(canonical, upper(crop)) AS crop, coalesce(category, '') AS crop_type, season, area, production, NULL::double AS "yield"
    FROM agri LEFT JOIN registry ON upper(crop) = name""", "agri", "registry")


@query("N2_normalize_crops", "SELECT * FROM normal_crops", "normal_crops")
def n2(t):
    return Z.normalize_crops(raw_crops(t), crop_registry(registry(t)))


# -- weather bulletins ------------------------------------------------------------

@query("S7_envelopes", """
    WITH e AS (SELECT event_id, event_type, regexp_extract(props, '[0-9]+') AS k FROM events)
    SELECT event_id, k, NULL AS malformed FROM e WHERE event_type IN ('view', 'click', 'purchase')
    UNION ALL SELECT event_id, k, NULL FROM e WHERE event_type = 'purchase'
    UNION ALL SELECT event_id, NULL, 'not a JSON list or object of records' FROM e WHERE event_type = 'error'""")
def s7(t):
    kind, one = F.col("event_type"), F.col("props")
    text = (F.when(kind == "view", one).when(kind == "click", F.concat(F.lit("["), one, F.lit("]")))
            .when(kind == "purchase", F.concat(F.lit('{"data": ['), one, F.lit(","), one, F.lit("]}")))
            .when(kind == "error", F.lit("[1]")).otherwise("{}"))
    return envelope_records(t.events.select("event_id", text.alias("value"))).select(
        "event_id", F.try_element_at("record", F.lit("k")).alias("k"), "malformed")


def record(**fields):
    """A map of field name to text."""
    parts = []
    for name, value in fields.items():
        parts += [F.lit(name), value]
    return F.create_map(*parts).alias("record")


def as_text(column):
    return F.col(column).cast("decimal(20,2)").cast("string")


@query("N11_current_weather", """
    SELECT cast(event_id AS varchar) AS station_id, CASE WHEN event_type = 'view' THEN cast(event_id AS varchar) ELSE 'Station ' || user_id END AS station,
           '2024-01-01' AS date, '' AS time_utc, CASE WHEN event_type <> 'error' THEN value END AS temp_c, 74.0e0 AS humidity_pct,
           NULL::double AS rainfall_24h_mm, NULL::double AS wind_speed_kmh, '' AS wind_direction_code, value AS mslp_hpa,
           '' AS weather_code, 'a b' AS nebulosity, NULL AS malformed
    FROM events WHERE event_type <> 'signup'
    UNION ALL SELECT '', '', '2024-01-01', '', value, 74, NULL, NULL, '', value, '', 'a b', 'record missing required ''Station'' field'
    FROM events WHERE event_type = 'signup'""")
def n11(t):
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    named = F.when(kind == "view", "").when(kind != "signup", F.concat(F.lit("Station "), F.col("user_id").cast("string")))
    common = dict(Temperature=F.when(kind != "error", as_text("value")).otherwise("N/A"), Humidity=F.lit("74%"), MSLP=as_text("value"),
                  Date=F.lit(" 2024-01-01\n"), Nebulosity=F.lit("a\r\nb"))
    fields = record(**{"Station Id": F.when(kind != "signup", key), "Station": named, **common})
    return B.current_weather(t.events.select(fields))


FORECAST_DAYS = """
    UNION ALL SELECT region_name, region_name, cast(date + {n} AS varchar), {d}, temp_max_c + {n}, temp_min_c, 'day {d}', NULL, NULL, NULL, NULL
    FROM weather WHERE precipitation_mm >= 500"""


@query("N12_city_forecast", """
    SELECT region_name AS station_code, region_name AS station_name, cast(date AS varchar) AS date, 1 AS forecast_day, temp_max_c, temp_min_c,
           'today' AS forecast_text, floor(humidity_pct) AS rh_0830_pct, NULL::double AS rh_1730_pct, precipitation_mm AS rainfall_24h_mm, NULL AS malformed
    FROM weather WHERE precipitation_mm >= 500""" + "".join(FORECAST_DAYS.format(d=d, n=d - 1) for d in range(2, 8)) + """
    UNION ALL SELECT region_name, region_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'unparseable issue date'
    FROM weather WHERE precipitation_mm < 500""", "weather")
def n12(t):
    day = F.col("date").cast("string")
    issued = F.when(F.col("precipitation_mm") >= 500, day).otherwise(F.date_format("date", "dd/MM/yyyy"))
    fields = {"Station_Code": F.col("region_name"), "Station_Name": F.col("region_name"), "Date": issued,
              "Today_Max_temp": as_text("temp_max_c"), "Today_Min_temp": as_text("temp_min_c"), "Todays_Forecast": F.lit("today"),
              "Relative_Humidity_at_0830": F.floor("humidity_pct").cast("string"), "Past_24_hrs_Rainfall": as_text("precipitation_mm")}
    for d in range(2, 8):
        fields |= {f"Day_{d}_Max_Temp": (F.col("temp_max_c") + (d - 1)).cast("string"),
                   f"Day_{d}_Min_temp": as_text("temp_min_c"), f"Day_{d}_Forecast": F.lit(f"day {d}")}
    return B.city_forecast(t.weather.select(record(**fields)))


def rain_records(t):
    fields = {"OBJ_ID": F.lit("7"), "District": F.upper("region_name"), "Date": F.col("date").cast("string")}
    for i, period in enumerate(B.RAIN_PERIODS):
        fields |= {f"{period} Actual": (F.col("precipitation_mm") + i).cast("string"), f"{period} Normal": F.lit("--"),
                   f"{period} Departure Per": F.lit(f"-{10 + i}%"), f"{period} Category": F.lit("N")}
    return t.weather.select(record(**fields))


@query("N13_district_rainfall", """
    SELECT '7' AS obj_id, upper(region_name) AS district, cast(date AS varchar) AS date, """ + ", ".join(
    f"precipitation_mm + {i} AS {p.lower()}_actual_mm, NULL::double AS {p.lower()}_normal_mm, "
    f"-{10 + i}.0e0 AS {p.lower()}_departure_pct, 'N' AS {p.lower()}_category" for i, p in enumerate(B.RAIN_PERIODS)) + """,
           NULL AS malformed FROM weather""", "weather")
def n13(t):
    return B.district_rainfall(rain_records(t))


@query("N14_district_warning", """
    SELECT region_name AS district, cast(date AS varchar) AS date, '4|' || cast(temp_max_c AS bigint) || '|x' AS codes,
           '4|' || cast(temp_max_c AS bigint) || '|-' AS numbers, '' AS second_codes, 'Yellow' AS color FROM weather""", "weather")
def n14(t):
    raw = F.concat(F.lit("4, "), F.col("temp_max_c").cast("bigint").cast("string"), F.lit(",,x "))
    rows = B.district_warning(t.weather.select(record(
        District=F.col("region_name"), Date=F.col("date").cast("string"), Day_1=raw, Day1_Color=F.lit("Yellow"))))
    joined = F.concat_ws("|", F.transform("day_1_code_numbers", lambda n: F.coalesce(n.cast("string"), F.lit("-"))))
    return rows.select("district", "date", F.concat_ws("|", "day_1_codes").alias("codes"), joined.alias("numbers"),
                       F.concat_ws("|", "day_2_codes").alias("second_codes"), F.col("day_1_color").alias("color"))


@query("N15_location_filter", """
    SELECT upper(region_name) AS district, cast(date AS varchar) AS date, precipitation_mm AS daily_actual_mm
    FROM weather WHERE region_name = 'NATION_7'""", "weather")
def n15(t):
    rows = B.split_malformed(B.district_rainfall(rain_records(t)))[0]
    return B.at_location(rows, " nation_7 ").select("district", "date", "daily_actual_mm")


@query("N15_available_places", """
    SELECT DISTINCT upper(region_name) AS district FROM weather""", "weather")
def n15_available(t):
    return B.available_places(B.district_rainfall(rain_records(t)))
