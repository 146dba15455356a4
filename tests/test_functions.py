from pyspark.sql import functions as F

from fieldmart.functions import labels as L
from fieldmart.functions import numbers as N
from fieldmart.functions import text as T


def values(spark, texts, make, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def test_strip_removes_every_unicode_space(spark):
    texts = ["a", " a ", "\ta\n", " a b ", "", None, "é ", "\x1fa"]
    expected = ["a", "a", "a", "a b", "", None, "é", "a"]
    assert values(spark, texts, T.strip) == expected
    assert values(spark, texts, T.trim_spaces) == expected


def test_match_and_location_keys(spark):
    assert values(spark, ["  Green \t Chilli ", None], T.match_key) == ["green chilli", ""]
    assert values(spark, ["Kanpur Nagar", None], T.location_key) == ["KANPURNAGAR", ""]


def test_one_line(spark):
    assert values(spark, [" Light\r\n rain \n", None], T.one_line) == ["Light  rain", ""]


def test_numbers_are_null_when_no_number(spark):
    texts = ["12", " 1.5 ", "1d", "0x1p3", "Infinity", "NaN", "", "-3e2", "abc", None, "1 2", "."]
    assert values(spark, texts, N.to_number) == [12.0, 1.5, None, None, None, None, None, -300.0, None, None, None, None]
    assert values(spark, ["28", "28.0", "28.5", "x", None], N.to_whole) == [28, 28, None, None, None]


def test_bulletin_numbers(spark):
    texts = ["52%", "-100%", " 0.00 ", "N/A", "-", "--", "nil", "1,234.5", "52 %", "", None, "calm"]
    assert values(spark, texts, N.bulletin_number) == [52.0, -100.0, 0.0, None, None, None, None, 1234.5, 52.0, None, None, None]


def test_crop_year_start(spark):
    texts = ["1997-1998", " 2020 ", "97-98", "FY 2020", None, "20201-2"]
    assert values(spark, texts, N.crop_year_start) == [1997, 2020, None, None, None, 20201]


def test_days(spark):
    assert [str(d) for d in values(spark, ["2026-05-14", "14/05/2026", "soon", None], N.to_day)] == [
        "2026-05-14", "None", "None", "None"]


def test_percent_change(spark):
    df = spark.createDataFrame([(110.0, 100.0), (1.0, 0.0), (None, 5.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(N.pct_change(F.col("a"), F.col("b"))).collect()]
    assert got == [10.0, None, None, None]


def test_indian_currency_text(spark):
    assert values(spark, [1234567.0, 100000.0, 999.0, -1234567.5, 0.0, 1000.0, 123456789.0], T.indian_number, "double") == [
        "12,34,567", "1,00,000", "999", "-12,34,568", "0", "1,000", "12,34,56,789"]
    assert values(spark, [1234567.0], T.rupees, "double") == ["₹12,34,567"]
    assert values(spark, [2500.0], T.rupees_per_quintal, "double") == ["₹2,500 / quintal"]
    assert values(spark, [12500000.0, 250000.0, 950.0, -250000.0], T.rupees_compact, "double") == [
        "₹1.3 crore", "₹2.5 lakh", "₹950", "₹-2.5 lakh"]
    assert values(spark, [1234.565, -0.4], lambda c: T.indian_number(c, 2), "double") == ["1,234.57", "-0.40"]


def test_hierarchy_label(spark):
    df = spark.createDataFrame([("Nashik", "Maharashtra", "Nashik"), ("Nashik", "", None)], "r string, s string, m string")
    got = [r[0] for r in df.select(T.hierarchy_label(F.col("r"), F.col("s"), F.col("m"))).collect()]
    assert got == ["Nashik (Maharashtra) -- APMC Nashik", "Nashik"]


def test_period_label(spark):
    df = spark.createDataFrame([("2026-08-01", "2026-08-01"), ("2026-08-01", "2026-08-03")], "a string, b string")
    got = [r[0] for r in df.select(T.period_label(F.col("a"), F.col("b"))).collect()]
    assert got == ["2026-08-01", "2026-08-01 → 2026-08-03"]


def test_signal_and_tercile_labels(spark):
    assert values(spark, [2.1, 2.0, -2.0, -2.1, None], L.market_signal, "double") == [
        "rising", "stable", "stable", "falling", "stable"]
    tercile = lambda c: L.tercile_label(c, F.lit(2.0), F.lit(5.0))
    assert values(spark, [1.0, 2.0, 3.5, 5.0, 6.0], tercile, "double") == ["Low", "Moderate", "Moderate", "Moderate", "High"]
    empty = lambda c: L.tercile_label(c, F.lit(None).cast("double"), F.lit(None).cast("double"))
    assert values(spark, [1.0], empty, "double") == ["n/a"]
    df = spark.createDataFrame([("Low", "High"), ("Low", "Moderate"), ("Moderate", "Moderate")], "a string, b string")
    assert [r[0] for r in df.select(L.strongest_level(F.col("a"), F.col("b"))).collect()] == ["High", "Low", "Moderate"]


def test_weather_window(spark):
    assert values(spark, ["2026-09-17", "2026-09-18", "2026-09-19"],
                  lambda c: L.weather_window(c.cast("date"), "2026-09-18")) == ["observed", "observed", "forecast"]
    assert values(spark, ["2026-09-19"], lambda c: L.weather_window(c.cast("date"), None)) == ["observed"]
