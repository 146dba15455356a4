import pytest
from pyspark.sql import functions as F

from fieldmart.operators import scenario as Z
from tests.conftest import day, rows


def scenario(spark, **values):
    base = {"id": 1, "quantity": 1000.0, "unit_price": 100.0, **{c: 0.0 for c in Z.COSTS}, "loss_pct": 0.0} | values
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} {'int' if k == 'id' else 'double'}" for k in base))


def test_estimate(spark):
    df = scenario(spark, unit_seed_cost=30.0, unit_transport_cost=20.0, unit_storage_cost=10.0, loss_pct=5.0)
    (r,) = rows(Z.estimate(df))
    assert (r["sellable_quantity"], r["revenue"], r["total_cost"], r["margin"]) == (950.0, 95000.0, 60000.0, 35000.0)
    assert r["margin_pct"] == pytest.approx(36.842105, abs=1e-6) and r["break_even_price"] == pytest.approx(60000 / 950)


def test_zero_price_has_no_margin_percent(spark):
    (r,) = rows(Z.estimate(scenario(spark, quantity=100.0, unit_price=0.0, unit_seed_cost=5.0)))
    assert (r["margin_pct"], r["margin"]) == (None, -500.0)


@pytest.mark.parametrize("change, message", [
    ({"quantity": 0.0}, Z.QUANTITY_ERROR), ({"quantity": None}, Z.QUANTITY_ERROR), ({"unit_price": -1.0}, Z.PRICE_ERROR),
    ({"loss_pct": 100.0}, Z.LOSS_ERROR), ({"loss_pct": -1.0}, Z.LOSS_ERROR),
    *[({c: -1.0}, Z.COST_ERRORS[c]) for c in Z.COSTS]])
def test_invalid_inputs(spark, change, message):
    df = scenario(spark, **change)
    (r,) = rows(Z.estimate(df))
    assert r["errors"] == [message]
    assert (r["sellable_quantity"], r["revenue"], r["total_cost"], r["margin"]) == (0.0, 0.0, 0.0, 0.0)
    assert r["margin_pct"] is None and r["break_even_price"] is None
    assert Z.sensitivity(df, ["id"]).count() == 0


def test_sensitivity(spark):
    got = rows(Z.sensitivity(scenario(spark, unit_seed_cost=50.0), ["id"]), "variation_no")
    assert [r["variation"] for r in got] == [v[0] for v in Z.VARIATIONS]
    by = {r["variation"]: r for r in got}
    assert by["Baseline"]["margin_pct_delta"] == 0.0 and by["Price +10%"]["unit_price"] == pytest.approx(110.0)
    assert by["Price +10%"]["margin_pct_delta"] > 0 > by["Costs +10%"]["margin_pct_delta"]
    assert by["Quantity +10%"]["quantity"] == pytest.approx(1100.0)
    assert by["Quantity +10%"]["margin_pct_delta"] == pytest.approx(0.0)


def indicators(spark, **values):
    base = {"id": 1, "break_even_price": None, "market_price": None, "price_trend_pct": None, "weather_exposure_tier": None,
            "production_context": None, "arrival_trend_pct": None} | values
    kinds = {"id": "int", "weather_exposure_tier": "string", "production_context": "string"}
    df = spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} {kinds.get(k, 'double')}" for k in base))
    return [(r["indicator"], r["severity"], r["detail"]) for r in rows(Z.risks(df, ["id"]))]


@pytest.mark.parametrize("values, expected", [
    ({"break_even_price": 2000.0, "market_price": 1500.0}, [("Break-even above market", "caution")]),
    ({"break_even_price": 2000.0, "market_price": 2500.0}, [("Break-even below market", "info")]),
    ({"break_even_price": 2000.0, "market_price": 1950.0}, []),
    ({"break_even_price": 0.0, "market_price": 1950.0}, []),
    ({"price_trend_pct": -10.0}, [("Declining price trend", "warning")]), ({"price_trend_pct": 10.0}, [("Rising price trend", "info")]),
    ({"price_trend_pct": 2.0}, []),
    ({"arrival_trend_pct": -15.0}, [("Declining arrivals", "warning")]), ({"arrival_trend_pct": 15.0}, [("Increasing arrivals", "info")]),
    ({"weather_exposure_tier": "High"}, [("High weather exposure", "caution")]),
    ({"weather_exposure_tier": "High-Exposure"}, [("High weather exposure", "caution")]),
    ({"weather_exposure_tier": "Moderate-Exposure"}, [("Medium weather exposure", "info")]),
    ({"weather_exposure_tier": "Low-Exposure"}, []),
    ({"production_context": "x"}, [("Crop production context", "info")]), ({"production_context": ""}, []), ({}, []),
])
def test_risk_indicators(spark, values, expected):
    assert [(i, s) for i, s, _ in indicators(spark, **values)] == expected


def test_risk_sentence(spark):
    ((_, _, detail),) = indicators(spark, break_even_price=2000.0, market_price=1500.0)
    assert detail == "Your break-even price (₹2,000/quintal) is 25% above the latest market price (₹1,500/quintal)."


def test_signals_join_one_row_per_scenario(spark):
    scenarios = spark.createDataFrame([(1, "S", "D", "Onion"), (2, "S", "D", "Rice")], "id int, state string, district string, crop string")
    summary = spark.createDataFrame([("S", "D", "Onion", "A", day("2026-05-01"), 10.0, 1.0, 2.0), ("S", "D", "Onion", "B", day("2026-05-02"), 20.0, 3.0, 4.0)],
                                    "state string, district string, commodity string, apmc string, latest_date date, latest_modal_price double, "
                                    "modal_price_change_pct_7d double, arrival_change_pct_7d double")
    segments = spark.createDataFrame([("D", "High-Exposure")], "region_name string, exposure_tier string")
    forecasts = spark.createDataFrame([("S", "D", "Onion", "Kharif", "2023-2024", 1234.0, 1000.0, 2000.0)],
                                      "state string, district string, crop string, season string, forecast_year string, "
                                      "forecast_production_tonnes double, forecast_lower_tonnes double, forecast_upper_tonnes double")
    onion, rice = rows(Z.attach_signals(scenarios, summary, segments, forecasts), "id")
    assert (onion["market_price"], onion["price_trend_pct"], onion["weather_exposure_tier"]) == (20.0, 3.0, "High-Exposure")
    assert onion["production_context"] == "Forecast 2023-2024: 1,234 tonnes (95% band: 1,000–2,000)"
    assert rice["market_price"] is None and rice["weather_exposure_tier"] == "High-Exposure"


def test_price_change_margin(spark):
    df = spark.createDataFrame([(100.0, 120.0), (0.0, 5.0), (5.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(Z.price_change_margin(F.col("a"), F.col("b"))).collect()] == [20.0, None, None]
