import pytest
from pyspark.sql import functions as F

from fieldmart.operators import market as M
from fieldmart.operators import slices as S
from fieldmart.operators.dedupe import keep_first, price_contradiction, quarantine
from tests.conftest import TRADE_SCHEMA, day, rows, trade


def series(spark, *points):
    return spark.createDataFrame(
        [trade(d, "Coimbatore Apmc", "Onion", p, p, p, seq=i) for i, (d, p) in enumerate(points)], TRADE_SCHEMA)


def test_trailing_week_of_three_days(spark):
    df = series(spark, ("2026-05-10", 1000.0), ("2026-05-12", 1100.0), ("2026-05-14", 1200.0))
    (r,) = rows(M.market_summary(df, tie=["seq"]))
    assert (r["latest_modal_price"], r["days_of_history"], r["avg_modal_price_7d"]) == (1200.0, 3, 1100.0)
    assert r["modal_price_change_pct_7d"] == pytest.approx(100 / 1100 * 100)
    assert (r["state_latest_modal_price"], r["modal_pct_vs_state_latest"]) == (1200.0, 0.0)


def test_single_day_has_no_change(spark):
    (r,) = rows(M.market_summary(series(spark, ("2026-05-14", 1200.0)), tie=["seq"]))
    assert r["modal_price_change_pct_7d"] is None and r["arrival_change_pct_7d"] is None
    assert r["avg_modal_price_7d"] == 1200.0


def test_window_is_anchored_at_the_own_latest_day(spark):
    df = series(spark, ("2026-05-01", 500.0), ("2026-05-08", 1000.0), ("2026-05-14", 2000.0))
    (r,) = rows(M.market_summary(df, tie=["seq"]))
    assert (r["avg_modal_price_7d"], r["days_of_history"]) == (1500.0, 3)


def test_null_latest_price_stays_null(spark):
    df = series(spark, ("2026-05-13", 1000.0), ("2026-05-14", None))
    (r,) = rows(M.market_summary(df, tie=["seq"]))
    assert r["latest_modal_price"] is None and r["modal_price_change_pct_7d"] is None
    assert r["avg_modal_price_7d"] == 1000.0


def test_first_record_of_the_latest_day_counts(trades):
    onion = [r for r in rows(M.market_summary(trades, tie=["seq"])) if r["commodity"] == "Onion" and r["price_unit"] == "Rs./Quintal"]
    assert onion[0]["latest_modal_price"] == 1200.0 and onion[0]["modal_price_change_pct_7d"] is None


def test_benchmark_and_state_summary(spark):
    df = spark.createDataFrame([
        trade("2026-05-14", "A", "Onion", 1.0, 100.0, 1.0), trade("2026-05-15", "B", "Onion", 1.0, 200.0, 1.0),
        trade("2026-05-15", "A", "Potato", 1.0, None, 1.0)], TRADE_SCHEMA)
    summary = M.market_summary(df)
    assert {r["state_latest_modal_price"] for r in rows(summary)} == {200.0}
    assert [r["modal_pct_vs_state_latest"] for r in rows(summary, "apmc", "commodity")] == [-50.0, None, 0.0]
    (state,) = rows(M.state_market_summary(summary))
    assert (state["latest_modal_price"], state["markets"], state["commodities"]) == (100.0, 2, 2)


def test_commodity_block_takes_first_market_by_name(trades):
    onion, tomato = rows(M.commodity_block(trades, tie=["seq"]), "commodity")
    assert (onion["n_market_records"], onion["n_markets"], onion["latest_modal_price"]) == (2, 1, 1200.0)
    assert tomato["latest_modal_price"] == 1000.0


def test_dedupe_keeps_first_and_all_keys(spark):
    base = trade("2026-05-14", "A", "Onion", 1.0, 2.0, 3.0, seq=1)
    df = spark.createDataFrame([base, base, trade("2026-05-14", "A", "Onion", 9.0, 9.0, 9.0, seq=0)], TRADE_SCHEMA)
    kept = rows(keep_first(df, M.TRADE_DAY_KEY, ["seq"]))
    assert len(kept) == 1 and kept[0]["seq"] == 0


def test_many_copies_of_one_key_are_cut_before_the_shuffle(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    out = keep_first(df, ["k"], ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert out.count() == df.select("k").distinct().count()


def test_quarantine_loses_no_row(spark):
    df = spark.createDataFrame([
        trade("2026-05-14", "A", "Onion", 1100.0, 1200.0, 1400.0), trade("2026-05-13", "A", "Onion", 9000.0, 8200.0, 9500.0),
        trade("2026-05-12", "A", "Onion", 1.0, 9000.0, 8200.0), trade("2026-05-11", "A", "Onion", None, 5.0, None)], TRADE_SCHEMA)
    kept, rejected = quarantine(df, price_contradiction())
    assert (kept.count(), rejected.count()) == (2, 2)


def test_dominant_unit_and_span(trades):
    onion = trades.where("commodity = 'Onion'")
    (unit,) = rows(M.dominant_unit(onion, ["commodity"]))
    assert (unit["price_unit"], unit["records"]) == ("Rs./Quintal", 2)
    (span,) = rows(M.price_span(M.in_dominant_unit(onion, ["commodity"]), ["commodity"]))
    assert (span["min_price"], span["modal_price"], span["max_price"], span["records"]) == (1100.0, 1230.0, 1450.0, 2)


def test_history_and_latest_slices(trades):
    assert S.historical(trades, {"commodity": "Onion", "state": None}, "2026-04-01", "2026-04-01").count() == 2
    assert S.historical(trades).count() == trades.count()
    latest = rows(S.latest_available(trades, {"state": "Karnataka"}))
    assert [r["date"] for r in latest] == [day("2026-04-02")]
    (meta,) = rows(S.latest_metadata(trades, {"commodity": "Onion"}))
    assert (meta["latest_date"], meta["total_available"]) == (day("2026-04-02"), 1)


def test_unparseable_dates_drop_only_under_a_range(spark):
    df = spark.createDataFrame([("2026-05-14", 1), ("soon", 2)], "date string, i int")
    assert S.historical(df).count() == 2
    assert [r["i"] for r in rows(S.historical(df, start="2026-01-01"))] == [1]
