import re

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import climate as C
from fieldmart.operators import insights as I
from fieldmart.operators import segments as G
from tests.conftest import day, rows


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame([("RainyWest", 24.0, 200.0, 90.0), ("DryEast", 25.0, 30.0, 45.0)],
                                 "region_name string, avg_temp_c double, total_precip_mm double, avg_humidity_pct double")


def test_segments(features):
    dry, rainy = rows(G.assign_segments(features), "region_name")
    assert rainy["segment"] == "High-Rainfall > Cool-Regime > Humid" and rainy["exposure_tier"] == "High-Exposure"
    assert dry["segment"].startswith("Water-Limited > Heat-Stress") and dry["exposure_tier"] == "High-Exposure"
    assert {rainy["dominant_factor"], dry["dominant_factor"]} == {"precipitation"}
    assert rainy["segment_reason"].startswith("RainyWest: 200mm total precipitation (high-rainfall; terciles <= 87mm / >= 143mm), 24.0C")
    assert "90% humidity (Humid)" in rainy["segment_reason"]


def test_every_region_gets_a_segment_even_with_equal_values(spark):
    same = spark.createDataFrame([(f"r{i}", 20.0, 0.0, 50.0) for i in range(4)],
                                 "region_name string, avg_temp_c double, total_precip_mm double, avg_humidity_pct double")
    got = rows(G.assign_segments(same))
    assert len(got) == 4 and {r["segment"] for r in got} == {"High-Rainfall > Heat-Stress > Humid"}


def test_overview_and_names(features):
    segments = G.assign_segments(features)
    overview = {r["region_name"]: r["weather_signal"] for r in rows(G.segment_overview(segments, features))}
    assert overview == {"RainyWest": "High precip / Low temp", "DryEast": "Low precip / High temp"}
    assert {(r["rank"], r["region_name"]) for r in rows(G.names_per_segment(segments))} == {(1, "RainyWest"), (1, "DryEast")}
    assert rows(G.value_counts(segments, "exposure_tier")) == [{"exposure_tier": "High-Exposure", "count": 2}]


@pytest.fixture(scope="module")
def daily(spark):
    data = []
    for name, temp, rain, wheat, onion, tomato in (("Alpha", 30.0, 5.0, 2400.0, 1500.0, 1200.0),
                                                   ("Beta", 20.0, 50.0, 1000.0, 1000.0, 1000.0),
                                                   ("Gamma", 25.0, 20.0, 0.0, 0.0, 0.0)):
        for d in ("2026-08-01", "2026-08-02"):
            data.append((name, day(d), temp, rain, 60.0, wheat, onion, tomato))
    return spark.createDataFrame(data, "region_name string, date date, temp_avg_c double, precipitation_mm double, humidity_pct double, "
                                       "Wheat_inr_per_quintal double, Onion_inr_per_quintal double, Tomato_inr_per_quintal double")


def test_weather_cards(daily):
    alpha = rows(I.weather_cards(daily), "region_name")[0]
    assert alpha["title"] == "Weather exposure: High"
    assert alpha["what"] == "Alpha recorded 30.0°C average temperature and 10 mm total precipitation over the window."
    assert "Compared with the 3 monitored districts" in alpha["why"] and alpha["period"] == "2026-08-01 → 2026-08-02"


def test_commodity_mix(daily):
    alpha, beta, gamma = rows(I.mix_cards(daily), "region_name")
    assert alpha["title"] == "Commodity mix: Wheat" and "Wheat at ₹2,400/quintal (47% of the observed basket)" in alpha["what"]
    assert alpha["why"] == "Observed commodity prices (INR/quintal): Wheat ₹2,400, Onion ₹1,500, Tomato ₹1,200."
    assert beta["title"] == "Commodity mix: diversified" and "(0% of the observed basket)" in gamma["what"]
    top = [r for r in rows(I.ranked_mix(I.unpivot_prices(daily))) if r["region_name"] == "Alpha" and r["rank"] == 1]
    assert top[0]["share"] == pytest.approx(2400 / 5100)


def test_cards_appear_only_with_their_input(spark, daily):
    plain = daily.drop(*I.price_columns(daily))
    assert I.mix_cards(plain) is None
    assert I.region_insights(plain).count() == 3
    segments = spark.createDataFrame([("Alpha", "A > B > C", "because", "High-Exposure", "temperature"), ("Elsewhere", "x", "y", "z", "w")],
                                     "region_name string, segment string, segment_reason string, exposure_tier string, dominant_factor string")
    forecast = spark.createDataFrame([("Beta", 1000.0, 1234.0)], "region_name string, actual_signal_inr_per_quintal double, predicted_signal_inr_per_quintal double")
    cards = rows(I.region_insights(daily, segments, forecast), "region_name", "title")
    assert len(cards) == 3 + 3 + 1 + 1
    assert [c["what"] for c in cards if c["title"].startswith("Weather-exposure tier")] == [
        "Alpha is grouped as A > B > C (exposure tier High-Exposure, dominant driver temperature)."]
    assert any("₹1,234/quintal vs the observed ₹1,000/quintal" in c["what"] for c in cards)


def test_profile_and_headline(daily):
    wind = daily.withColumns({"windspeed_max_kmh": F.lit(9.0), "state_ut": F.lit("S"),
                              "district": F.when(F.col("date") > "2026-08-01", "D")})
    alpha = rows(C.region_profile(wind), "region_name")[0]
    assert (alpha["total_precip_mm"], alpha["max_windspeed_kmh"], alpha["district"]) == (10.0, 9.0, "D")
    assert rows(C.headline(daily)) == [{"regions": 3, "mean_temp_c": 25.0}]


def test_no_unbounded_cross_join_in_the_plan(features):
    plan = G.assign_segments(features)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
