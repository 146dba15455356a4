import datetime
import json

import pytest
from pyspark.sql import functions as F

from fieldmart.operators.contracts import ContractViolation
from fieldmart.plans import pipeline as L
from fieldmart.session import scratch_path
from tests.conftest import rows
from tests.test_ingest import weather_doc

REGIONS = {"regions": [
    {"region_name": "Bengaluru", "state": "Karnataka", "state_code": "KA", "district": "Bengaluru Urban", "district_code": "525",
     "mandi": "Yeshwanthpur", "latitude": 12.97, "longitude": 77.59},
    {"region_name": "Karnal", "state": "Haryana", "state_code": "HR", "district": "Karnal", "district_code": "67",
     "mandi": "Karnal", "latitude": 29.69, "longitude": 76.98}]}


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    trades = ["date,state_name,district_name,market_center_name,commodity_name,variety,min_price,modal_price,max_price,price_unit,arrival_quantity,arrival_units"]
    for d in range(1, 9):
        trades.append(f"2026-08-{d:02d},Karnataka,Bengaluru Urban,Yeshwanthpur,Onion,Local,1000,{1100 + d},1300,Rs./Quintal,20,Metric Tonnes")
    trades += [trades[1], "2026-08-09,Karnataka,Bengaluru Urban,Yeshwanthpur,Onion,Local,9000,8200,9500,Rs./Quintal,20,Metric Tonnes",
               "soon,Karnataka,Bengaluru Urban,Yeshwanthpur,Onion,Local,1,2,3,Rs./Quintal,20,Metric Tonnes"]
    crops = ["id,year,state_name,state_code,district_name,district_code,crop_name,season,area,production,yield"]
    n = 0
    for y in range(2000, 2015):
        for district, state, code in (("Bengaluru Urban", "Karnataka", 29), ("Karnal", "Haryana", 6)):
            for crop in ("Onion", "Wheat"):
                crops.append(f"{n},{y}-{y + 1},{state},{code},{district},{code},{crop},Kharif,{10 + y % 3},{100 + 5 * (y - 2000) + n % 7},10")
                n += 1
    days = [(datetime.date(2026, 8, 1) + datetime.timedelta(days=i)).isoformat() for i in range(30)]
    weather = [weather_doc("Bengaluru", days, [30.0] * 30), weather_doc("Karnal", days, [35.0] * 30)]
    for name, text in (("trades.csv", "\n".join(trades)), ("crops.csv", "\n".join(crops)), ("weather.json", json.dumps(weather)),
                       ("regions.json", json.dumps(REGIONS)),
                       ("registry.json", json.dumps({"crops": [{"name": c, "canonical": c, "category": "Food"} for c in ("Onion", "Wheat")]}))):
        (root / name).write_text(text + "\n", encoding="utf-8")
    return root


def test_all_stages(spark, landed, tmp_path):
    layout, stamp = L.Layout(str(tmp_path)), "20260831T000000Z"
    (record,) = rows(L.land_trades(spark, f"{landed}/trades.csv", layout, stamp))
    assert record["row_count"] == 10
    L.land_crops(spark, f"{landed}/crops.csv", f"{landed}/registry.json", layout, stamp)
    L.land_weather(spark, f"{landed}/weather.json", layout, stamp)
    assert L.build_silver(spark, layout, f"{landed}/regions.json") == {
        "geo": "success", "weather": "success", "agriculture": "success", "trades": "success", "market": "not_configured"}
    assert spark.read.parquet(layout.silver("trades")).count() == 8
    assert spark.read.parquet(f"{layout.rejects}/invalid_price_rows").count() == 1

    L.build_climate_gold(spark, layout)
    assert spark.read.parquet(layout.gold("region_summary")).count() == 2
    lineage = {r["dataset"]: r["status"] for r in rows(L.build_integrated_gold(spark, layout))}
    assert set(lineage.values()) == {"success"} and set(lineage) == {"region_features", "market_summary", "crop_year", "crop_summary"}
    (onion,) = rows(spark.read.parquet(layout.gold("market_summary")))
    assert (onion["latest_modal_price"], onion["days_of_history"], onion["avg_modal_price_7d"]) == (1108.0, 8, 1105.0)
    crops = {(r["district"], r["crop"]): r["market_status"] for r in rows(spark.read.parquet(layout.gold("crop_summary")))}
    assert crops["Bengaluru Urban", "Onion"] == "matched" and crops["Karnal", "Wheat"] == "no_records"

    L.build_forecast(spark, layout, max_iter=2)
    assert spark.read.parquet(layout.gold("forecasts")).count() == 4
    steps = {r["step"]: (r["status"], r["rows"]) for r in rows(L.build_predictions(spark, layout))}
    assert steps == {"demand_forecast": ("skipped_market_gate", 0), "weather_exposure_segmentation": ("success", 2)}

    fresh = F.to_timestamp(F.lit("2026-08-31 06:00:00"))
    checks = rows(L.monitor(spark, layout, fresh))
    assert [c for c in checks if c["status"] == "FAIL"] == []
    report = json.loads(spark.read.text(layout.catalog("health_report")).first()[0])
    assert report["status"] == "PASS" and report["observed"]["geo_rows"] == 2 and report["observed"]["trades_without_price"] == 0
    assert {c["dataset"] for c in checks if c["check"] == "row_count"} == {"weather", "geo"}


def test_absent_inputs_leave_markers(spark, landed, tmp_path):
    layout = L.Layout(str(tmp_path))
    assert L.build_silver(spark, layout, f"{landed}/regions.json") == {
        "geo": "success", "weather": "no_data", "agriculture": "no_data", "trades": "no_data", "market": "not_configured"}
    assert {r["status"] for r in rows(L.build_integrated_gold(spark, layout))} == {"no_data"}
    assert L.build_forecast(spark, layout) is None
    status = {(r["check"], r["dataset"]): r["status"] for r in rows(L.monitor(spark, layout, F.to_timestamp(F.lit("2026-08-31 06:00:00"))))}
    assert status["row_count", "weather"] == status["freshness", "ingestion"] == "FAIL" and status["row_count", "geo"] == "PASS"
    assert {status["duplicates", d] for d in ("india_mandi", "india_agriculture", "india_region_features", "india_crop_summary")} == {"INFO"}


def test_monitoring_before_any_stage(spark, tmp_path):
    layout = L.Layout(str(tmp_path))
    found = rows(L.monitor(spark, layout))
    assert {(r["check"], r["dataset"], r["status"]) for r in found} == {
        ("freshness", "ingestion", "FAIL"), ("row_count", "weather", "FAIL"), ("row_count", "geo", "FAIL"),
        *(("duplicates", d, "INFO") for d in ("india_mandi", "india_agriculture", "india_region_features", "india_crop_summary")),
        *(("staleness", m, "INFO") for m in L.MANIFESTS)}
    assert json.loads(spark.read.text(layout.catalog("health_report")).first()[0])["status"] == "FAIL"


def test_a_broken_table_stops_at_its_gate(spark, landed, tmp_path):
    layout = L.Layout(str(tmp_path))
    broken = json.loads(json.dumps(REGIONS))
    broken["regions"][0]["latitude"] = 80
    (tmp_path / "regions.json").write_text(json.dumps(broken))
    with pytest.raises(ContractViolation):
        L.build_silver(spark, layout, f"{tmp_path}/regions.json")


def test_scratch_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if base:
        assert path.startswith(base)
