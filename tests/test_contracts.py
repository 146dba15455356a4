import pytest
from pyspark.sql import functions as F

from fieldmart.operators import catalog as G
from fieldmart.operators import contracts as V
from tests.conftest import rows


def checks(df, contract):
    return sorted((r["column"], r["check"]) for r in rows(V.failure_report(V.check_rows(df, contract), contract)))


def test_weather_contract(weather):
    assert checks(weather, V.WEATHER) == []
    cold = weather.withColumn("temp_max_c", F.lit(15.0)).withColumn("temp_min_c", F.lit(25.0))
    assert {c for _, c in checks(cold, V.WEATHER)} == {"temp_max_c must be >= temp_min_c"}
    wet = weather.limit(1).withColumn("humidity_pct", F.lit(130.0))
    assert checks(wet, V.WEATHER) == [("humidity_pct", "in_range(0, 100)")]


def test_all_failures_of_a_row_are_reported_at_once(weather):
    bad = weather.limit(1).withColumns({
        "temp_max_c": F.lit("warm"), "precipitation_mm": F.lit(-1.0), "region_name": F.lit(None).cast("string")})
    assert checks(bad, V.WEATHER) == [
        ("precipitation_mm", "greater_than_or_equal_to(0)"), ("region_name", "not_nullable"),
        ("temp_max_c", "coerce_dtype('double')")]
    (r,) = [r for r in rows(V.failure_report(V.check_rows(bad, V.WEATHER), V.WEATHER)) if r["column"] == "temp_max_c"]
    assert (r["dataset"], r["failure_case"]) == ("weather", "warm")


def test_extra_columns_pass_and_text_is_coerced(weather):
    text = weather.withColumn("humidity_pct", F.col("humidity_pct").cast("string")).withColumn("note", F.lit("x"))
    clean, report = V.validate(text, V.WEATHER)
    assert report.count() == 0 and dict(clean.dtypes)["humidity_pct"] == "double" and "note" in clean.columns


def test_missing_contract_column_is_an_error(weather):
    with pytest.raises(V.ContractViolation, match="humidity_pct"):
        V.check_rows(weather.drop("humidity_pct"), V.WEATHER)


def test_geo_contract(geo):
    assert checks(geo, V.GEO) == []
    far = geo.withColumns({"latitude": F.lit(50.0), "state_code": F.lit("KAR")})
    assert {c for _, c in checks(far, V.GEO)} == {"in_range(6, 37)", "str_length(2, 2)"}


def test_agriculture_contract(agri):
    assert checks(agri, V.AGRICULTURE) == []
    blank = agri.limit(1).withColumns({"season": F.lit("  "), "year_start": F.lit(1850)})
    assert checks(blank, V.AGRICULTURE) == [
        ("", "season must be non-empty when present"), ("year_start", "greater_than_or_equal_to(1900)")]
    none = agri.limit(1).withColumns({c: F.lit(None).cast("double") for c in ("area", "production", "yield")})
    assert ("area", "not_nullable") in checks(none, V.AGRICULTURE)


def test_trade_contract_tolerates_missing_prices(trades):
    assert checks(trades, V.TRADES) == []
    assert checks(trades.withColumn("modal_price", F.lit(None).cast("double")), V.TRADES) == []
    bad = trades.limit(1).withColumns({"min_price": F.lit(9000.0), "commodity": F.lit(" ")})
    assert {c for _, c in checks(bad, V.TRADES)} == {
        "commodity must be a non-empty string", "min_price must be <= modal_price when both present"}


def test_failure_counts_equal_the_report(trades):
    bad = trades.withColumns({"min_price": F.lit(9000.0), "apmc": F.lit(None).cast("string")})
    counted = {(r["column"], r["check"]): r["failures"] for r in rows(V.failure_counts(bad, V.TRADES))}
    listed = V.failure_report(V.check_rows(bad, V.TRADES), V.TRADES).groupBy("column", "check").count()
    assert counted == {(r["column"], r["check"]): r["count"] for r in rows(listed)}


def test_gate_stops_the_table_and_writes_rejects(spark, weather, tmp_path):
    assert V.gate(weather, V.WEATHER, str(tmp_path)).count() == 3
    bad = weather.withColumn("humidity_pct", F.when(F.col("region_name") == "Karnal", 130.0).otherwise(F.col("humidity_pct")))
    with pytest.raises(V.ContractViolation):
        V.gate(bad, V.WEATHER, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/weather_rejects").count() == 1
    assert spark.read.parquet(f"{tmp_path}/weather_rows").select("region_name").first()[0] == "Karnal"
    (outcome,) = rows(V.gate_outcome(bad, V.WEATHER, f"{tmp_path}/again"))
    assert (outcome["offending_rows"], outcome["outcome"]) == (1, "stopped")


@pytest.mark.parametrize(("column", "contract"), [("season", V.AGRICULTURE), ("apmc", V.TRADES), ("commodity", V.TRADES)])
def test_blank_text_is_rejected(agri, trades, column, contract):
    source = agri if contract is V.AGRICULTURE else trades
    for blank in ("\t", "\u00a0 ", "\u3000"):
        (found,) = rows(V.failure_counts(source.withColumn(column, F.lit(blank)), contract))
        assert found["failures"] == source.count()


def test_projection_drops_passthrough_columns(trades):
    assert V.project(trades, V.TRADES).columns == V.TRADES.column_names


def test_clean_catalog_has_no_problems(geo):
    assert G.catalog_problems(geo).count() == 0


@pytest.mark.parametrize("change, problem", [
    ({"district_code": "x1"}, "district_code missing/invalid"),
    ({"state_code": "KAR"}, "state_code not 2 chars"),
    ({"latitude": 50.0}, "coordinates outside bounds"),
    ({"state_ut": "Texas"}, "foreign state in catalog"),
])
def test_catalog_problems(geo, change, problem):
    broken = geo.where("region_name = 'Karnal'").withColumns({c: F.lit(v) for c, v in change.items()})
    assert [r["problem"] for r in rows(G.catalog_problems(broken))] == [problem]


def test_catalog_duplicates(geo):
    twice = geo.unionByName(geo.where("region_name = 'Karnal'"))
    assert [r["problem"] for r in rows(G.catalog_problems(twice), "problem")] == [
        "duplicate district_code", "duplicate geography record", "duplicate region_name values"]


def test_membership(geo, agri):
    pair = {"district": "district", "state": "state_ut"}
    assert G.known_places(agri, geo, pair).count() == 4
    assert G.unknown_pairs(agri.withColumn("state", F.lit("Goa")), geo, pair).count() == 4
    assert G.known_places(geo, geo, {"state_code": "state_code", "district_code": "district_code"}).count() == 2


def test_a_silver_table_is_written_once_and_only_published_when_clean(spark, weather, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from fieldmart.sources import sinks
    written, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: written.append(path) or real(self, path, *a, **k))
    path, rejects = f"{tmp_path}/silver/weather", f"{tmp_path}/rejects"
    first = sinks.write_silver(weather, V.WEATHER, path, rejects)
    assert len(written) == 1 and first.count() == spark.read.parquet(path).count() == 3
    assert set(first.columns) == set(V.check_rows(weather, V.WEATHER).columns) - {"_violations"}
    bad = weather.withColumn("humidity_pct", F.lit(130.0))
    with pytest.raises(V.ContractViolation):
        sinks.write_silver(bad, V.WEATHER, path, rejects)
    assert spark.read.parquet(path).where("humidity_pct > 100").count() == 0 and spark.read.parquet(f"{rejects}/weather_rows").count() == 3
    assert sinks.write_silver(weather.limit(1), V.WEATHER, path, rejects).count() == 1
    assert sinks.write_silver(weather.limit(0), V.WEATHER, path, rejects).count() == 0


def test_steps_record_what_happened(spark, weather):
    from fieldmart.sources import sinks

    def skipped():
        raise sinks.StepSkipped("skipped_gate", weather.limit(1))

    def stopped():
        raise V.ContractViolation("no")

    got = {r["step"]: (r["status"], r["rows"]) for r in rows(sinks.run_steps(spark, [
        ("a", "x", lambda: weather), ("b", "y", skipped), ("c", "z", stopped), ("d", "w", lambda: weather.limit(2))]))}
    assert got == {"a": ("success", 3), "b": ("skipped_gate", 1), "c": ("stopped_at_gate", 0), "d": ("success", 2)}
    with pytest.raises(ZeroDivisionError):
        sinks.run_steps(spark, [("e", "v", lambda: 1 / 0)])
