import os

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import climate as C
from fieldmart.operators import crops as K
from fieldmart.operators import market as M
from fieldmart.operators import region_features as R
from fieldmart.plans import base
from fieldmart.plans import registered  # noqa: F401  (fills the registry)
from tests.conftest import day, rows


def test_region_features_outer_join(weather, trades, geo):
    df = R.region_features(weather, trades, geo)
    assert df.columns == R.COLUMNS
    got = {(r["region_name"], r["date"]): r for r in rows(df)}
    assert {k[0] for k in got} == {"Bengaluru", "Karnal"}
    assert sorted(k[1] for k in got if k[0] == "Bengaluru") == [day("2026-04-01"), day("2026-08-01"), day("2026-08-02")]
    april = got["Bengaluru", day("2026-04-01")]
    assert (april["median_modal_price_rq"], april["n_price_records"], april["n_price_markets"]) == (1200.0, 3, 2)
    assert (april["total_arrival_tonnes"], april["n_arrival_records"]) == (560.0, 3)
    assert april["temp_max_c"] is None and (april["state"], april["state_code"]) == ("Karnataka", "KA")
    august = got["Bengaluru", day("2026-08-01")]
    assert august["median_modal_price_rq"] is None and august["temp_max_c"] == 30.1


def test_unknown_district_keeps_folded_text(trades, geo):
    odd = trades.withColumn("district", F.lit("MYSURU"))
    assert {r["region_name"] for r in rows(R.map_region(odd, geo))} == {"mysuru"}


def test_region_summary(weather, geo):
    bengaluru, karnal = rows(C.region_summary(C.daily_features(weather, geo)), "region_name")
    assert (bengaluru["avg_temp_c"], bengaluru["total_precip_mm"], bengaluru["avg_humidity_pct"]) == (25.4, 2.5, 76.0)
    assert karnal["state_ut"] == "Haryana"


def test_daily_features_keep_the_grain_with_market(spark, weather, geo):
    market = spark.createDataFrame([("Bengaluru", day("2026-08-01"), 10.0, 5.0), ("Bengaluru", day("2026-08-01"), 20.0, 5.0)],
                                   "district string, date date, market_price_inr_per_quintal double, arrivals_quintal double")
    out = C.daily_features(weather, geo.union(geo), M.daily_region_market(market))
    assert out.count() == 3
    assert {r["avg_market_price_inr_per_quintal"] for r in rows(out)} == {15.0, None}
    profile = {r["region_name"]: r for r in rows(C.region_model_features(out))}
    assert profile["Karnal"]["total_arrivals_quintal"] == 0.0
    assert profile["Karnal"]["market_price_signal_inr_per_quintal"] is None


def test_crop_year_panel_dedupes(agri):
    again = agri.where("id = 1").withColumn("id", F.lit(9).cast("long"))
    panel = K.crop_year_panel(agri.unionByName(again))
    assert panel.where("state = 'Karnataka'").count() == 3


def test_crop_block(agri):
    got = {r["crop"]: r for r in rows(K.crop_block(K.crop_year_panel(agri)))}
    onion = got["Onion"]
    assert (onion["years_observed"], onion["latest_year"], onion["latest_area_ha"]) == (2, 2021, 120.0)
    assert (onion["latest_production_t"], onion["latest_yield_t_per_ha"]) == (2400.0, 20.0)
    assert (onion["total_area_ha"], onion["n_year_season_rows"]) == (220.0, 2)
    assert got["Wheat"]["total_production_t"] is None and got["Wheat"]["total_area_ha"] == 300.0


def test_null_crop_type_drops_the_row(agri):
    assert K.crop_block(agri.withColumn("crop_type", F.lit(None).cast("string"))).count() == 0


def test_crop_summary_blocks(agri, trades, weather, geo):
    features = R.region_features(weather, trades, geo)
    got = {r["crop"]: r for r in rows(K.crop_summary(agri, trades, features, tie=["seq"]))}
    onion, carrot, wheat = got["Onion"], got["Carrot"], got["Wheat"]
    assert (onion["market_status"], onion["n_market_records"], onion["n_markets"]) == ("matched", 2, 1)
    assert (carrot["market_status"], carrot["n_market_records"], carrot["latest_modal_price"]) == ("no_records", 0, None)
    assert onion["obs_temp_max_c"] == pytest.approx(30.55) and wheat["obs_temp_max_c"] == pytest.approx(34.0)
    assert {r["weather_warning"] for r in got.values()} == {None}


def test_equal_districts_of_two_states_can_stay_apart(spark):
    crops = spark.createDataFrame([("A", "X", "Onion", "V"), ("B", "X", "Onion", "V")], "state string, district string, crop string, crop_type string")
    fields = {f: "double" for f in K.MARKET_FIELDS} | {"n_market_records": "long", "n_markets": "long", "latest_market_date": "date"}
    block = spark.createDataFrame([("A", "X", "ONION", *[None] * len(fields))],
                                  "state string, district string, commodity string, " + ", ".join(f"{c} {t}" for c, t in fields.items()))
    assert [r["market_status"] for r in rows(K.match_market(crops, block), "state")] == ["matched", "matched"]
    assert [r["market_status"] for r in rows(K.match_market(crops, block, include_state=True), "state")] == ["matched", "no_records"]


def test_crop_summary_can_keep_states_apart(spark, agri, trades, geo, weather):
    twin = agri.withColumns({"state": F.lit("Goa"), "id": F.col("id") + 100})
    both = agri.unionByName(twin)
    sold = trades.unionByName(trades.where("commodity = 'Onion'").withColumns({"state": F.lit("Goa"), "modal_price": F.lit(77.0)}))
    features = R.region_features(weather, trades, geo)
    apart = {r["state"]: r for r in rows(K.crop_summary(both, sold, features, include_state=True)) if r["crop"] == "Onion"}
    assert apart["Goa"]["latest_modal_price"] == 77.0 and apart["Karnataka"]["latest_modal_price"] != 77.0
    joint = [r for r in rows(K.crop_summary(both, sold, features)) if r["crop"] == "Onion"]
    assert len({r["latest_modal_price"] for r in joint}) == 1


def test_market_block_equals_its_parts(spark, tmp_path):
    """Counts, distinct counts, medians and arrivals of mixed units, nulls and ties."""
    import random
    rng = random.Random(8)
    pick = lambda *xs: rng.choice(xs)
    data = [(pick("r1", "r2", None), day(f"2026-04-0{rng.randint(1, 3)}"), pick("m1", "m2", None), pick("c1", "c2", None),
             pick(None, 5.0, 7.0, 9.5), pick("Rs./Quintal", "Rs./Unit", None), pick(None, 1.0, 2.5), pick("Metric Tonnes", "Bundle", None))
            for _ in range(400)]
    trades = spark.createDataFrame(data, "region_name string, date date, apmc string, commodity string, modal_price double, "
                                         "price_unit string, arrival_quantity double, arrival_units string")
    trades.write.parquet(f"{tmp_path}/trades")
    stored = spark.read.parquet(f"{tmp_path}/trades")
    block = R.market_block(stored)
    parts = R.price_block(stored).join(R.arrival_block(stored), R.KEY, "full")
    assert rows(block.select(*sorted(block.columns)), *R.KEY) == rows(parts.select(*sorted(block.columns)), *R.KEY)
    only_bundles = R.market_block(stored.where("price_unit = 'Rs./Unit' and arrival_units = 'Bundle'"))
    assert only_bundles.count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables absent")
@pytest.mark.parametrize("name", ["J3_region_features", "A8_commodity_block"])
def test_trades_are_scanned_once(spark, name):
    df = base.QUERIES[name](spark, "/root/testdata/sf0.001")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len([line for line in final.split("\n") if "FileScan parquet" in line and "l_" in line.split("FileScan parquet")[1][:60]]) == 1
