import json

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import crops as K
from fieldmart.operators import quality as Q
from fieldmart.operators import region_features as R
from fieldmart.operators.dedupe import keep_first
from fieldmart.operators.market import TRADE_DAY_KEY
from tests.conftest import rows

NOW = "2026-09-20 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


@pytest.fixture(scope="module")
def clean(spark, weather, trades, geo, agri):
    deduped = keep_first(trades, TRADE_DAY_KEY, ["seq"])
    features = R.region_features(weather, deduped, geo).where("district <> 'Bengaluru Urban' or temp_max_c is not null or date < '2026-08-01'")
    summary = K.crop_summary(agri, deduped, features, tie=["seq"])
    manifests = spark.createDataFrame([("india_region_features", "2026-09-19T12:00:00"), ("india_crop_summary", "2026-09-19T13:00:00")],
                                      "dataset string, generated_at string")
    return {"trades": deduped, "agri": agri, "region_features": features, "crop_summary": summary, "geo": geo, "manifests": manifests}


def statuses(tables):
    return {(r["check"], r["dataset"]): r["status"] for r in rows(Q.artifact_checks(**tables, as_of=now()))}


def test_clean_tables_have_no_failure(clean):
    assert "FAIL" not in statuses(clean).values()
    (total,) = rows(Q.overall(Q.artifact_checks(**clean, as_of=now())))
    assert (total["status"], total["failed"]) == ("PASS", 0)


def test_planted_defects_fail(clean):
    rf = clean["region_features"]
    hot = rf.where("temp_max_c is not null").limit(1).withColumn("temp_max_c", F.lit(99.9))
    old = clean["manifests"].withColumn("generated_at", F.lit("2026-09-17T22:00:00"))
    broken = clean | {"trades": clean["trades"].union(clean["trades"].limit(1)), "region_features": rf.union(hot), "manifests": old}
    got = statuses(broken)
    assert {k for k, v in got.items() if v == "FAIL"} == {
        ("duplicates", "india_mandi"), ("duplicates", "india_region_features"), ("impossible_values", "india_region_features"),
        ("staleness", "india_region_features"), ("staleness", "india_crop_summary")}
    report = json.loads(Q.health_report(Q.artifact_checks(**broken, as_of=now()), now()).first()[0])
    assert report["status"] == "FAIL" and len(report["issues"]) == 5 and len(report["checks"]) == len(rows(Q.artifact_checks(**broken, as_of=now())))


def test_freshness(spark):
    stamps = spark.createDataFrame([("20260918T000000Z",), ("20260919T060000Z",), ("broken",)], "s string")
    (r,) = rows(Q.check_freshness(stamps, "s", now()))
    assert (r["status"], r["detail"]) == ("PASS", "latest ingestion is 18.0h old (max allowed 24 h)")
    assert Q.check_freshness(stamps.limit(1), "s", now()).first()["status"] == "FAIL"
    assert Q.check_freshness(stamps.limit(0), "s", now()).first()["status"] == "FAIL"


def test_row_counts_and_missing_tables(spark, geo):
    assert Q.check_row_count(geo, "geo", 2).first()["status"] == "PASS"
    assert Q.check_row_count(geo, "geo", 3).first()["status"] == "FAIL"
    present = Q.names_of(spark, ["weather", "geo", "india_mandi", "india_agriculture", "india_region_features"])
    assert rows(Q.absent_tables(present)) == [
        {"check": "duplicates", "dataset": "india_crop_summary", "status": "INFO", "detail": "gold table absent"}]


def test_unknown_places_fail_only_when_all_are_unknown(agri, geo):
    half = geo.where("district = 'Karnal'")
    (r,) = rows(Q.check_unknown_places(agri, "crops", half))
    assert (r["status"], r["detail"]) == ("PASS", "3/4 rows without a monitored district")
    assert Q.check_unknown_places(agri, "crops", geo.limit(0)).first()["status"] == "FAIL"
    assert Q.unknown_places(agri, half).count() == 3


def test_empty_geography_counts_rows_once(spark):
    df = spark.createDataFrame([("", None), (" ", "x"), ("a", "b")], "state string, district string")
    (r,) = rows(Q.check_empty_geography(df, "t"))
    assert (r["status"], r["detail"]) == ("FAIL", "2 rows with empty state/district")


def test_missing_weather_only_inside_the_window(spark):
    df = spark.createDataFrame([("a", "d1", 1.0, 2.0), ("b", "d1", None, 2.0), ("a", "d2", None, None)],
                               "region_name string, date string, temp_max_c double, humidity_pct double")
    (r,) = rows(Q.check_missing_weather(df))
    assert (r["status"], r["detail"]) == ("FAIL", "1 weather-window rows missing temperature, 0 missing humidity")
    assert Q.in_weather_window(df).count() == 2
    assert Q.check_missing_weather(df.where("date = 'd2'")).first()["status"] == "INFO"


def test_missing_prices_are_informational(trades):
    assert Q.check_missing_prices(trades, None).first()["status"] == "INFO"
    gap = trades.withColumn("modal_price", F.lit(None).cast("double"))
    assert Q.check_missing_prices(gap, None).first()["detail"] == "4 rows without modal price"


def test_unreadable_manifest_is_informational(spark):
    df = spark.createDataFrame([("a", "yesterday"), ("b", None)], "dataset string, generated_at string")
    assert {r["status"] for r in rows(Q.check_staleness(df, now()))} == {"INFO"}
