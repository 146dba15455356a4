import datetime

import pytest

from fieldmart.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[*]", 8, spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}", spark__driver__memory="6g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as dictionaries, sorted when columns are given."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: tuple(str(r[c]) for c in order)) if order else out


def day(text):
    return datetime.date.fromisoformat(text)


TRADE_SCHEMA = ("date date, state string, state_code string, district string, district_code string, apmc string, "
                "market_center_code string, commodity string, commodity_id string, variety string, grade string, "
                "min_price double, modal_price double, max_price double, price_unit string, arrival_quantity double, "
                "arrival_units string, seq int")


def trade(when, apmc, commodity, low, modal, high, unit="Rs./Quintal", arrival=100.0, arrival_unit="Metric Tonnes",
          seq=0, state="Karnataka", district="Bengaluru Urban"):
    return (day(when), state, "29", district, "525", apmc, "1", commodity, "1", "Local", "FAQ",
            low, modal, high, unit, arrival, arrival_unit, seq)


@pytest.fixture(scope="session")
def trades(spark):
    return spark.createDataFrame([
        trade("2026-04-01", "Yeshwanthpur", "Onion", 1100.0, 1200.0, 1400.0, arrival=200.0, seq=0),
        trade("2026-04-01", "Shivajinagar", "Tomato", 900.0, 1000.0, 1200.0, arrival=150.0, seq=1),
        trade("2026-04-02", "Yeshwanthpur", "Onion", 1050.0, 1180.0, 1350.0, "Rs./Unit", 40.0, "Bundle", seq=2),
        trade("2026-04-01", "Yeshwanthpur", "Onion", 1120.0, 1230.0, 1450.0, arrival=210.0, seq=3),
    ], TRADE_SCHEMA)


@pytest.fixture(scope="session")
def geo(spark):
    return spark.createDataFrame([
        ("Bengaluru", "Karnataka", "KA", "Bengaluru Urban", "525", "Yeshwanthpur", 12.97, 77.59),
        ("Karnal", "Haryana", "HR", "Karnal", "67", "Karnal", 29.69, 76.98),
    ], "region_name string, state_ut string, state_code string, district string, district_code string, "
       "mandi_apmc string, latitude double, longitude double")


@pytest.fixture(scope="session")
def weather(spark):
    return spark.createDataFrame([
        ("Bengaluru", day("2026-08-01"), 30.1, 20.0, 0.5, 74.0, 12.0),
        ("Bengaluru", day("2026-08-02"), 31.0, 20.5, 2.0, 78.0, 14.0),
        ("Karnal", day("2026-08-01"), 34.0, 24.0, 0.0, 60.0, 9.0),
    ], "region_name string, date date, temp_max_c double, temp_min_c double, precipitation_mm double, "
       "humidity_pct double, windspeed_max_kmh double")


@pytest.fixture(scope="session")
def agri(spark):
    return spark.createDataFrame([
        (1, "2020-2021", 2020, "Karnataka", 29, "Bengaluru Urban", 525, "Onion", "Vegetables", "Kharif", 100.0, 2000.0, 20.0),
        (2, "2021-2022", 2021, "Karnataka", 29, "Bengaluru Urban", 525, "Onion", "Vegetables", "Kharif", 120.0, 2400.0, 20.0),
        (3, "2020-2021", 2020, "Karnataka", 29, "Bengaluru Urban", 525, "Carrot", "Vegetables", "Rabi", 50.0, 1000.0, 20.0),
        (4, "2021-2022", 2021, "Haryana", 6, "Karnal", 67, "Wheat", "Cereals", "Rabi", 300.0, None, None),
    ], "id long, year string, year_start int, state string, state_code long, district string, district_code long, "
       "crop string, crop_type string, season string, area double, production double, yield double")
