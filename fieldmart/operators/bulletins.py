"""Weather bulletins: string-typed records to typed rows.

Input frames have one `record` column, a map of field name to text. A record that
lacks a required field is kept apart with a `malformed` reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.numbers import bulletin_number
from fieldmart.functions.text import first_filled, location_key, one_line

# Field names of the bulletin records.
DAYS_AHEAD = 7
WARNING_DAYS = 5
RAIN_PERIODS = ["Daily", "Weekly", "Cumulative", "Monthly"]
RAIN_FIELDS = {"actual_mm": "Actual", "normal_mm": "Normal", "departure_pct": "Departure Per"}


class MalformedRecords(Exception):
    """A feed holds records without their required fields."""


def _field(*names: str) -> Column:
    return first_filled(*[F.try_element_at("record", F.lit(n)) for n in names])


def _text(*names: str) -> Column:
    return one_line(_field(*names))


def _number(*names: str) -> Column:
    return bulletin_number(_field(*names))


def current_weather(records: DataFrame) -> DataFrame:
    """Station observations with their field-name variants."""
    station = _field("Station", "Station Id", "station_id")
    return records.select(
        _text("Station Id", "station_id").alias("station_id"),
        one_line(station).alias("station"),
        _text("Date of Observation", "Date").alias("date"),
        _text("Time of Observation", "Time").alias("time_utc"),
        _number("Temperature", "temperature").alias("temp_c"),
        _number("Humidity", "humidity").alias("humidity_pct"),
        _number("Last 24 hrs Rainfall", "Rainfall").alias("rainfall_24h_mm"),
        _number("Wind Speed").alias("wind_speed_kmh"),
        _text("Wind Direction").alias("wind_direction_code"),
        _number("M.S.L.P", "MSLP", "mslp").alias("mslp_hpa"),
        _text("Weather Code").alias("weather_code"),
        _text("Nebulosity").alias("nebulosity"),
        F.when(station.isNull(), "record missing required 'Station' field").alias("malformed"),
    )


ONLY_TODAY = {"rh_0830_pct": "Relative_Humidity_at_0830", "rh_1730_pct": "Relative_Humidity_at_1730",
              "rainfall_24h_mm": "Past_24_hrs_Rainfall"}


def _day_fields(day: int) -> Column:
    """The raw texts of one day ahead; they are parsed after the days became rows."""
    high, low, text = (("Today_Max_temp", "Today_Min_temp", "Todays_Forecast") if day == 1 else
                       (f"Day_{day}_Max_Temp", f"Day_{day}_Min_temp", f"Day_{day}_Forecast"))
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(day).alias("forecast_day"),
        _field(high).alias("temp_max_c"), _field(low).alias("temp_min_c"), _field(text).alias("forecast_text"),
        *[(_field(name) if day == 1 else none).alias(c) for c, name in ONLY_TODAY.items()])


def city_forecast(records: DataFrame) -> DataFrame:
    """One record to one row per day ahead, dated from the issue date.

    A malformed record gives a single row without a day.
    """
    base = records.select(
        _text("Station_Code").alias("station_code"), _field("Station_Name", "Station").alias("_name"),
        _text("Date").alias("_date"),
        F.inline(F.array(*[_day_fields(d) for d in range(1, DAYS_AHEAD + 1)])))
    issued = F.when(F.col("_date").rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.col("_date").try_cast("date"))
    reason = (F.when(F.col("_name").isNull(), "record missing required 'Station_Name' field")
              .when(issued.isNull(), "unparseable issue date"))
    days = base.withColumns({"_issued": issued, "malformed": reason}).where(
        F.col("malformed").isNull() | (F.col("forecast_day") == 1))
    good = F.col("malformed").isNull()
    return days.select(
        "station_code", one_line(F.col("_name")).alias("station_name"),
        F.when(good, F.date_add("_issued", F.col("forecast_day") - 1).cast("string")).alias("date"),
        F.when(good, F.col("forecast_day")).alias("forecast_day"),
        *[F.when(good, bulletin_number(F.col(c))).alias(c) for c in ("temp_max_c", "temp_min_c")],
        F.when(good, one_line(F.col("forecast_text"))).alias("forecast_text"),
        *[F.when(good, bulletin_number(F.col(c))).alias(c) for c in ONLY_TODAY],
        "malformed")


def _district_head() -> list[Column]:
    return [_text("OBJ_ID", "Obj_id", "obj_id").alias("obj_id"),
            one_line(_field("District")).alias("district"), _text("Date").alias("date")]


def _no_district() -> Column:
    return F.when(_field("District").isNull(), "record missing required 'District' field").alias("malformed")


def district_rainfall(records: DataFrame) -> DataFrame:
    """Actual, normal, departure and category for each reporting period."""
    columns = []
    for period in RAIN_PERIODS:
        columns += [_number(f"{period} {name}").alias(f"{period.lower()}_{suffix}")
                    for suffix, name in RAIN_FIELDS.items()]
        columns.append(_text(f"{period} Category").alias(f"{period.lower()}_category"))
    return records.select(*_district_head(), *columns, _no_district())


def district_warning(records: DataFrame) -> DataFrame:
    """Warning codes per day as texts and, where numeric, as integers."""
    columns = []
    for day in range(1, WARNING_DAYS + 1):
        tokens = F.transform(F.split(F.coalesce(_field(f"Day_{day}"), F.lit("")), ","), one_line)
        codes = F.filter(tokens, lambda t: t != "")
        columns += [codes.alias(f"day_{day}_codes"),
                    F.transform(codes, lambda t: t.try_cast("int")).alias(f"day_{day}_code_numbers"),
                    _text(f"Day{day}_Color").alias(f"day_{day}_color")]
    return records.select(*_district_head(), _text("UTC").alias("time_utc"), *columns, _no_district())


NORMALIZERS = {"current": current_weather, "forecast": city_forecast,
               "rainfall": district_rainfall, "warning": district_warning}


def split_malformed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed rows with their reason)."""
    return rows.where(F.col("malformed").isNull()).drop("malformed"), rows.where(F.col("malformed").isNotNull())


def require_wellformed(rows: DataFrame) -> DataFrame:
    """The rows, or an error naming the malformed reasons; they are a fixed set of texts."""
    good, bad = split_malformed(rows)
    reasons = sorted(r[0] for r in bad.select("malformed").distinct().collect())
    if reasons:
        raise MalformedRecords("; ".join(reasons))
    return good


def at_location(rows: DataFrame, place: str, column: str = "district") -> DataFrame:
    """Rows of one place, compared without case and whitespace."""
    return rows.where(location_key(F.col(column)) == location_key(F.lit(place)))


def available_places(rows: DataFrame, column: str = "district") -> DataFrame:
    """All place names."""
    return rows.select(column).distinct()


def require_location(rows: DataFrame, place: str, column: str = "district") -> DataFrame:
    found = at_location(rows, place, column)
    if found.isEmpty():
        # the message shows a first few names; `available_places` has them all
        names = [r[0] for r in available_places(rows, column).orderBy(column).take(25) if r[0]]
        raise LookupError(f"{column} '{place}' not found. Available: {', '.join(names)}")
    return found
