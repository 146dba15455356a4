"""Landed files: nested weather JSON, CSV imports, record envelopes and newest batches."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldmart.operators.dedupe import keep_first
from fieldmart.sources.json_documents import documents

# Feed schemas and required columns of the source files.
WEATHER_SCHEMA = (
    "_region_name string, latitude double, longitude double, "
    "daily struct<time: array<string>, temperature_2m_max: array<double>, "
    "temperature_2m_min: array<double>, precipitation_sum: array<double>, "
    "relative_humidity_2m_mean: array<double>, windspeed_10m_max: array<double>>"
)
WEATHER_SERIES = {
    "date": "time",
    "temp_max_c": "temperature_2m_max",
    "temp_min_c": "temperature_2m_min",
    "precipitation_mm": "precipitation_sum",
    "humidity_pct": "relative_humidity_2m_mean",
    "windspeed_max_kmh": "windspeed_10m_max",
}
TRADE_REQUIRED = ["date", "state_name", "district_name", "market_center_name",
                  "commodity_name", "min_price", "modal_price", "max_price"]
CROP_REQUIRED = ["year", "state_name", "district_name", "crop_name", "season", "area"]
MARKET_COLUMNS = ["commodity", "variety", "state_ut", "district", "mandi", "date",
                  "market_price_inr_per_quintal", "arrivals_quintal"]
BATCH_STAMP = r"(\d{8}T\d{6}Z)"


class InvalidSource(Exception):
    """A landed file is missing, empty or lacks required columns."""


def flatten_weather(docs: DataFrame) -> DataFrame:
    """One row per region and day from documents with parallel daily arrays.

    Arrays of unequal length are padded with nulls, which the weather contract rejects.
    """
    series = F.arrays_zip(*[F.col(f"daily.{name}") for name in WEATHER_SERIES.values()])
    rows = docs.select(F.col("_region_name").alias("region_name"), F.inline(series))
    named = rows.toDF("region_name", *WEATHER_SERIES)
    dated = named.withColumn("date", F.col("date").try_cast("timestamp"))
    return keep_first(dated, ["region_name", "date"])


def read_weather(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Daily weather from JSON: one document per line, or with `multiline` arrays and documents of any layout.

    Either way a file is read by as many tasks as its size asks for.
    """
    if not multiline:
        return flatten_weather(spark.read.schema(WEATHER_SCHEMA).json(path))
    found = documents(spark, path).filter("document is not null")
    return flatten_weather(found.select(F.from_json("document", WEATHER_SCHEMA).alias("d")).select("d.*"))


def newest_stamp(files: DataFrame, stamp: str = BATCH_STAMP) -> str | None:
    """The newest batch stamp in the file listing Spark already holds; no job is run."""
    found = (re.search(stamp, name) for name in files.inputFiles())
    return max((m.group(1) for m in found if m), default=None)


def newest_batch(files: DataFrame, stamp: str = BATCH_STAMP) -> DataFrame | None:
    """Rows of the newest timestamp-named batch; None when there is no batch.

    The stamp is put into the plan as a literal on the file path, so Spark skips
    the files of older batches.
    """
    newest = newest_stamp(files, stamp)
    if newest is None:
        return None
    return files.where(F.col("_metadata.file_path").contains(newest))


def read_newest(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """Newest batch under a folder; None when the folder is missing or empty."""
    table = read_optional(spark, path, fmt)
    return None if table is None else newest_batch(table)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame | None:
    """The table at a path, or None when nothing is there."""
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_csv(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """A CSV with header, all columns as text, after checking columns and rows.

    Types are set later by the normalizers, so nothing is inferred from the data.
    """
    header = spark.read.text(path).limit(1)
    if header.isEmpty():
        raise InvalidSource(f"no rows in {path}")
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise InvalidSource(f"{path}: missing required columns {missing} (have {sorted(df.columns)})")
    if df.isEmpty():
        raise InvalidSource(f"no rows in {path}")
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_trades_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TRADE_REQUIRED)


def read_crops_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CROP_REQUIRED)


def envelope_records(texts: DataFrame, column: str = "value") -> DataFrame:
    """Records of JSON texts that are a list, {"data": [...]} or a single object.

    Gives one `record` map per element. A text that is none of the three, or a list
    with elements that are no objects, gives one row with a `malformed` reason; an
    empty list or object gives no row.
    """
    text = F.col(column)
    as_list = F.from_json(text, "array<map<string,string>>")
    wrapped = F.from_json(text, "struct<data: array<map<string,string>>>")["data"]
    single = F.from_json(text, "map<string,string>")
    body = F.ltrim(text)
    shape = (F.when(body.startswith("["), as_list)
             .otherwise(F.coalesce(wrapped, F.when(F.size(single) > 0, F.array(single)))))
    records = F.transform(shape, lambda r: F.struct(
        r.alias("record"), F.when(r.isNull(), "record is not a JSON object").alias("malformed")))
    empty = body.startswith("{") & (F.size(single) == 0)
    broken = F.array(F.struct(F.lit(None).cast("map<string,string>").alias("record"),
                              F.lit("not a JSON list or object of records").alias("malformed")))
    rows = F.when(records.isNull() & ~F.coalesce(empty, F.lit(False)), broken).otherwise(records)
    return texts.select(*[c for c in texts.columns if c != column], F.inline(rows))


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Records of the files at a path, one file read by many tasks.

    Members of a list or of an envelope are records; an object that stands alone is read as `envelope_records` does.
    """
    found = documents(spark, path)
    member = F.col("element") & F.col("document").isNotNull()
    records = found.filter(member).select(
        F.from_json("document", "map<string,string>").alias("record"), F.lit(None).cast("string").alias("malformed"))
    broken = found.filter("document is null").select(F.lit(None).cast("map<string,string>").alias("record"), "malformed")
    alone = envelope_records(found.filter(~member & F.col("document").isNotNull()).select(F.col("document").alias("value")))
    return records.unionByName(broken).unionByName(alone)


def optional_market(market: DataFrame | None) -> tuple[str, DataFrame | None]:
    """(status, rows): not_configured without a frame, an error when columns are missing."""
    if market is None:
        return "not_configured", None
    missing = [c for c in MARKET_COLUMNS if c not in market.columns]
    if missing:
        raise InvalidSource(f"market source is missing columns: {missing}")
    key = [c for c in MARKET_COLUMNS if c != "variety"]
    dated = market.withColumn("date", F.col("date").try_cast("timestamp"))
    return "configured", keep_first(dated, key)


def status_row(spark: SparkSession, status: str, reason: str, layer: str) -> DataFrame:
    """Marker for a step that was skipped because its input is absent."""
    schema = StructType([StructField(c, StringType()) for c in ("status", "reason", "layer")])
    return spark.createDataFrame([(status, reason, layer)], schema)


def _decoded(text: Column) -> Column:
    """Percent-decoding that leaves a plain '+' alone."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def region_from_path(df: DataFrame, column: str = "region_name") -> DataFrame:
    """Recover a partition value from the file path when the files do not carry it.

    The path is a URI over an already escaped folder name, so it is decoded twice.
    """
    value = F.regexp_extract(F.col("_metadata.file_path"), f"{column}=([^/]*)", 1)
    return df.select("*", _decoded(_decoded(value)).alias(column))


def read_ignoring_partitions(spark: SparkSession, path: str) -> DataFrame:
    """All part files below a folder, without partition discovery."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)
