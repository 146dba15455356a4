import json

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import bulletins as B
from fieldmart.operators import normalize as Z
from fieldmart.sources import feeds, reference, sinks
from tests.conftest import rows

RAW_TRADE = {
    "date": "2025-11-03", "state_name": " Odisha ", "state_code": "33", "district_name": "Cuttack",
    "district_code": "611", "market_center_name": "Cuttack Apmc\t", "market_center_code": "7310",
    "category": "Wholesale Market", "commodity_name": "Onion", "commodity_id": "123", "variety": "Local", "grade": "FAQ",
    "arrival_quantity": "84.5", "arrival_units": "Metric Tonnes", "min_price": "930", "modal_price": "1010",
    "max_price": "1185", "price_unit": "Rs./Quintal"}


def table(spark, *records):
    names = list(records[0])
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ", ".join(f"`{n}` string" for n in names))


def write(path, name, value):
    target = path / name
    target.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")
    return str(target)


def test_normalize_trades(spark):
    bad_date = RAW_TRADE | {"date": "soon"}
    gaps = RAW_TRADE | {"modal_price": "NR", "variety": None}
    got = rows(Z.normalize_trades(table(spark, RAW_TRADE, bad_date, gaps)), "variety")
    assert len(got) == 2 and list(got[0]) == Z.TRADE_COLUMNS
    assert (got[0]["variety"], got[0]["modal_price"]) == ("", None)
    assert (got[1]["state"], got[1]["apmc"], got[1]["min_price"]) == ("Odisha", "Cuttack Apmc", 930.0)


def test_normalize_trades_without_optional_columns(spark):
    few = {k: v for k, v in RAW_TRADE.items() if k in feeds.TRADE_REQUIRED}
    (r,) = rows(Z.normalize_trades(table(spark, few)))
    assert (r["arrival_quantity"], r["arrival_units"], r["grade"]) == (None, "", "")


RAW_CROP = {"id": "0", "year": "2004-2005", "state_name": "Kerala", "state_code": "32", "district_name": "Wayanad ",
            "district_code": "563", "crop_name": "Ginger/Adrak", "crop_type": "Spices", "season": "Kharif", "area": "8150",
            "production": "1304", "yield": "0.16"}


def registry(spark):
    crops = spark.createDataFrame([("Ginger/Adrak", "Ginger/Adrak", "Spices"), ("Jute (bast)", "Jute", "Fibre")],
                                  "name string, canonical string, category string")
    return reference.crop_registry(crops)


def test_normalize_crops(spark):
    raw = table(spark, RAW_CROP, RAW_CROP | {"id": "1", "production": None, "yield": "NA", "state_name": None})
    first, second = rows(Z.normalize_crops(raw, registry(spark)), "id")
    assert (first["year_start"], first["state_code"], first["district"], first["yield"]) == (2004, 32, "Wayanad", 0.16)
    assert second["production"] is None and second["yield"] is None and second["state"] is None


def test_crop_registry_lookup(spark):
    names = [("Jute  (bast)",), ("Jute",), ("Adrak",), (" Ginger/Adrak",), ("jute",)]
    got = rows(Z.canonical_crops(spark.createDataFrame(names, "crop_name string"), registry(spark)), "crop_name")
    assert {r["crop_name"]: (r["crop"], r["category"]) for r in got} == {
        "Jute  (bast)": ("Jute", "Fibre"), "Jute": ("Jute", "Fibre"), "Adrak": ("Adrak", ""),
        " Ginger/Adrak": ("Ginger/Adrak", "Spices"), "jute": ("jute", "")}


def test_source_crop_type_overrides_the_registry(spark):
    raw = table(spark, RAW_CROP | {"crop_name": "Jute", "crop_type": "Other"})
    assert rows(Z.normalize_crops(raw, registry(spark)))[0]["crop_type"] == "Other"
    assert rows(Z.normalize_crops(raw.drop("crop_type"), registry(spark)))[0]["crop_type"] == "Fibre"


# -- envelopes and bulletins ---------------------------------------------------------

def test_envelopes(spark):
    texts = ['[{"a": 1}, {"a": null}]', '{"data": [{"a": "x"}]}', '{"a": "y", "b": 2.5}', "{}", "[]", "[1]", "oops"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = rows(feeds.envelope_records(df), "i")
    assert [(r["i"], r["record"]) for r in got if not r["malformed"]] == [
        (0, {"a": "1"}), (0, {"a": None}), (1, {"a": "x"}), (2, {"a": "y", "b": "2.5"})]
    assert sorted({r["i"] for r in got if r["malformed"]}) == [5, 6]


def records(spark, *maps):
    return spark.createDataFrame([(m,) for m in maps], "record map<string,string>")


CURRENT = {"Station Id": "43003", "Station": "Colaba", "Date of Observation": "2026-09-18", "Time of Observation": "03",
           "M.S.L.P": "1008.7", "Temperature": "28.1", "Humidity": "81", "Last 24 hrs Rainfall": "NIL", "Nebulosity": "4\r\n"}


def test_current_weather(spark):
    alias = {"station_id": "7", "Station": "", "Date": "2026-09-18", "Rainfall": "1.5", "MSLP": "1000"}
    rows_ = rows(B.current_weather(records(spark, CURRENT, alias, {"Temperature": "1"})), "station_id")
    broken, first, second = rows_
    assert (first["temp_c"], first["humidity_pct"], first["mslp_hpa"], first["rainfall_24h_mm"]) == (28.1, 81.0, 1008.7, None)
    assert (second["station"], second["rainfall_24h_mm"], second["mslp_hpa"], second["date"]) == ("7", 1.5, 1000.0, "2026-09-18")
    assert "Station" in broken["malformed"]
    with pytest.raises(B.MalformedRecords):
        B.require_wellformed(B.current_weather(records(spark, {"Temperature": "1"})))


FORECAST = {"Date": "2026-09-18", "Station_Code": "43003", "Station_Name": "Colaba", "Today_Max_temp": "30.2",
            "Today_Min_temp": "22.4", "Relative_Humidity_at_0830": "68", "Day_2_Max_Temp": "31.8", "Day_2_Min_temp": "22",
            "Day_7_Forecast": "Light\nrain"}


def test_seven_day_forecast(spark):
    got = rows(B.city_forecast(records(spark, FORECAST)), "forecast_day")
    assert [r["date"] for r in got] == [f"2026-09-{d}" for d in range(18, 25)]
    assert (got[0]["temp_max_c"], got[0]["temp_min_c"], got[0]["rh_0830_pct"]) == (30.2, 22.4, 68.0)
    assert (got[1]["temp_max_c"], got[1]["rh_0830_pct"], got[6]["forecast_text"]) == (31.8, None, "Light rain")
    bad = rows(B.city_forecast(records(spark, FORECAST | {"Date": "18/09/2026"})))
    assert len(bad) == 1 and bad[0]["malformed"] == "unparseable issue date" and bad[0]["date"] is None


def test_rainfall_and_location_filter(spark):
    rain = {"OBJ_ID": "1", "District": "NASHIK", "Date": "2026-09-18", "Daily Actual": "12.5", "Daily Normal": "-",
            "Daily Departure Per": "52%", "Daily Category": "E"}
    df = B.split_malformed(B.district_rainfall(records(spark, rain, rain | {"District": "PUNE"})))[0]
    (r,) = rows(B.require_location(df, "nashik"))
    assert (r["daily_actual_mm"], r["daily_normal_mm"], r["daily_departure_pct"], r["weekly_actual_mm"]) == (12.5, None, 52.0, None)
    with pytest.raises(LookupError, match="NASHIK, PUNE"):
        B.require_location(df, "Goa")


def test_warning_codes(spark):
    (r,) = rows(B.district_warning(records(spark, {"District": "A", "Day_1": "4,17", "Day_2": "4, x,,", "Day1_Color": "Red"})))
    assert (r["day_1_codes"], r["day_1_code_numbers"], r["day_1_color"]) == (["4", "17"], [4, 17], "Red")
    assert (r["day_2_codes"], r["day_2_code_numbers"], r["day_3_codes"]) == (["4", "x"], [4, None], [])


# -- files ---------------------------------------------------------------------------

def weather_doc(region, times, tmax):
    n = len(times)
    return {"_region_name": region, "latitude": 1.0, "longitude": 2.0, "daily": {
        "time": times, "temperature_2m_max": tmax, "temperature_2m_min": [1.0] * n, "precipitation_sum": [0.0] * n,
        "relative_humidity_2m_mean": [50.0] * n, "windspeed_10m_max": [3.0] * n}}


def test_weather_json(spark, tmp_path):
    docs = [weather_doc("A", ["2026-08-01", "2026-08-02", "2026-08-02"], [30.0, 31.0, 31.0]),
            weather_doc("B", ["2026-08-01", "2026-08-02"], [20.0])]
    got = rows(feeds.read_weather(spark, write(tmp_path, "w.json", docs)), "region_name", "date")
    assert [(r["region_name"], str(r["date"])[:10], r["temp_max_c"]) for r in got] == [
        ("A", "2026-08-01", 30.0), ("A", "2026-08-02", 31.0), ("B", "2026-08-01", 20.0), ("B", "2026-08-02", None)]


def test_csv_checks(spark, tmp_path):
    full = ",".join(feeds.CROP_REQUIRED) + "\n2020-2021,KA,X,Onion,Kharif,10\n"
    assert feeds.read_crops_csv(spark, write(tmp_path, "a.csv", full)).first()["area"] == "10"
    with pytest.raises(feeds.InvalidSource, match="season"):
        feeds.read_crops_csv(spark, write(tmp_path, "b.csv", full.replace("season", "saison")))
    with pytest.raises(feeds.InvalidSource, match="no rows"):
        feeds.read_crops_csv(spark, write(tmp_path, "c.csv", ",".join(feeds.CROP_REQUIRED) + "\n"))
    with pytest.raises(feeds.InvalidSource, match="no rows"):
        feeds.read_trades_csv(spark, write(tmp_path, "d.csv", ""))


def test_newest_batch_reads_only_its_files(spark, tmp_path):
    for stamp, value in (("20260101T000000Z", 1), ("20260301T000000Z", 3), ("20260201T000000Z", 2)):
        spark.range(1).select(F.lit(value).alias("v")).write.parquet(f"{tmp_path}/x_normalized_{stamp}")
    batch = feeds.newest_batch(feeds.read_ignoring_partitions(spark, str(tmp_path)))
    assert [r["v"] for r in rows(batch)] == [3]
    assert len(batch.select(F.input_file_name()).distinct().collect()) == 1
    assert feeds.read_newest(spark, f"{tmp_path}/absent") is None


def test_region_catalog_fallbacks(spark, tmp_path):
    regions = [{"district": "Nashik", "state": "Maharashtra", "state_code": "MH", "district_code": 487, "mandi": "Nashik", "latitude": 20, "longitude": 73.8},
               {"region_name": "Kanpur", "district": "Kanpur Nagar", "state_ut": "UP", "state_code": "UP", "mandi_apmc": "Kanpur", "latitude": 28.1, "longitude": 80.3}]
    for doc in ({"regions": regions}, regions):
        kanpur, nashik = rows(reference.read_regions(spark, write(tmp_path, "r.json", doc)), "region_name")
        assert (nashik["region_name"], nashik["state_ut"], nashik["mandi_apmc"], nashik["district_code"]) == ("Nashik", "Maharashtra", "Nashik", "487")
        assert (kanpur["state"], kanpur["mandi"], kanpur["district"]) == ("UP", "Kanpur", "Kanpur Nagar")


def test_crop_and_commodity_catalogs(spark, tmp_path):
    crops = {"crops": [{"name": "Jute (bast)", "canonical": "Jute", "category": "Fibre"}]}
    assert [r["key"] for r in rows(reference.read_crop_registry(spark, write(tmp_path, "c.json", crops)), "key")] == ["Jute", "Jute (bast)"]
    goods = {"commodities": [{"name": "Wheat", "category": "Cereals"}]}
    assert rows(reference.read_commodities(spark, write(tmp_path, "m.json", goods))) == [{"name": "Wheat", "category": "Cereals"}]
    sources = {"sources": [{"name": "Weather", "status": "live"}]}
    assert rows(reference.read_datasets(spark, write(tmp_path, "d.json", sources)))[0]["status"] == "live"


def test_optional_market(spark):
    assert feeds.optional_market(None) == ("not_configured", None)
    with pytest.raises(feeds.InvalidSource, match="arrivals_quintal"):
        feeds.optional_market(spark.createDataFrame([("a",)], "commodity string"))
    row = ("Wheat", "b", "S", "D", "M", "2026-05-01", 10.0, 5.0)
    schema = ", ".join(f"{c} {'double' if 'quintal' in c else 'string'}" for c in feeds.MARKET_COLUMNS)
    status, df = feeds.optional_market(spark.createDataFrame([row, ("Wheat", "a") + row[2:]], schema))
    assert status == "configured" and [r["variety"] for r in rows(df)] == ["a"]


def test_partition_value_from_path(spark, weather, tmp_path):
    odd = weather.withColumn("region_name", F.concat("region_name", F.lit(" a+b 50%")))
    sinks.write_table(odd, f"{tmp_path}/t", partition_by=["region_name"])
    back = feeds.region_from_path(feeds.read_ignoring_partitions(spark, f"{tmp_path}/t"))
    assert {r["region_name"] for r in rows(back)} == {"Bengaluru a+b 50%", "Karnal a+b 50%"}


def test_bronze_record_and_manifest(spark, trades, tmp_path):
    (record,) = rows(sinks.write_bronze(trades, str(tmp_path), "trades", "20260501T000000Z", raw=trades, source="market"))
    assert (record["row_count"], record["source"], len(record["columns"])) == (4, "market", len(trades.columns))
    (m,) = rows(sinks.manifest(trades, "trades", date="date", distinct=["apmc"], matched={"onions": F.col("commodity") == "Onion"}))
    assert m["metrics"] == {"rows": 4, "first_date": "2026-04-01", "last_date": "2026-04-02", "n_apmc": 2, "onions": 3}
    none = sinks.no_data_manifest(spark, "crops", "absent", ["agri"])
    assert [r["status"] for r in rows(sinks.lineage([sinks.manifest(trades, "trades"), none]), "dataset")] == ["no_data", "success"]
    assert json.loads(sinks.as_json(none).first()[0])["missing"] == ["agri"]


def test_monitored_subset_and_export(spark, agri, geo, tmp_path):
    spaced = geo.where("district = 'Karnal'").withColumn("district", F.lit(" Karnal "))
    subset = sinks.monitored_subset(agri, spaced)
    assert [r["crop"] for r in rows(subset)] == ["Wheat"]
    sinks.export(agri, f"{tmp_path}/report")
    assert spark.read.parquet(f"{tmp_path}/report").count() == agri.count()
