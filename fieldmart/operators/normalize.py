"""Raw market and crop statistics to their canonical columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.numbers import crop_year_start, parsed_number, to_day, whole_number
from fieldmart.functions.text import finish_trim, squeeze

# Source column -> canonical column.
TRADE_TEXT = {
    "state": "state_name", "state_code": "state_code", "district": "district_name",
    "district_code": "district_code", "apmc": "market_center_name",
    "market_center_code": "market_center_code", "commodity": "commodity_name",
    "commodity_id": "commodity_id", "variety": "variety", "grade": "grade",
}
TRADE_NUMBERS = ["min_price", "modal_price", "max_price", "arrival_quantity"]
TRADE_COLUMNS = [
    "date", "state", "state_code", "district", "district_code",
    "apmc", "market_center_code", "commodity", "commodity_id",
    "variety", "grade", "min_price", "modal_price", "max_price",
    "price_unit", "arrival_quantity", "arrival_units",
]
CROP_COLUMNS = [
    "id", "year", "year_start", "state", "state_code", "district",
    "district_code", "crop", "crop_type", "season", "area", "production", "yield",
]


def _trimmed(df: DataFrame, texts: dict[str, Column], kept: dict[str, Column] | None = None) -> DataFrame:
    """Trimmed texts under their new names, next to `kept` expressions.

    Two projections instead of one: Spark compiles each into its own small method,
    and a single large one would be too big for the JVM to optimize.
    """
    rest = kept or {}
    first = df.select(*[F.trim(e).alias(c) for c, e in texts.items()], *[e.alias(c) for c, e in rest.items()])
    return first.select(*[finish_trim(F.col(f"`{c}`")).alias(c) for c in texts], *[F.col(f"`{c}`") for c in rest])


def normalize_trades(raw: DataFrame) -> DataFrame:
    """Renamed and typed: absent texts are '', absent numbers null, bad dates drop out."""
    present = dict(raw.dtypes)

    def text(source: str) -> Column:
        return F.coalesce(F.col(source).cast("string"), F.lit("")) if source in present else F.lit("")

    typed = {c: F.col(c).cast("double") for c in TRADE_NUMBERS if present.get(c, "string") != "string"}
    texts = {c: text(s) for c, s in TRADE_TEXT.items()} | {c: text(c) for c in ("price_unit", "arrival_units")}
    texts |= {c: text(c) for c in TRADE_NUMBERS if c not in typed}
    dated = _trimmed(raw, texts, {"date": to_day(F.col("date")).cast("timestamp"), **typed}).where(
        F.col("date").isNotNull())
    return dated.select(*[
        parsed_number(F.col(c)).alias(c) if c in TRADE_NUMBERS and c not in typed else F.col(c)
        for c in TRADE_COLUMNS])


def canonical_crops(df: DataFrame, registry: DataFrame, name: str = "crop_name") -> DataFrame:
    """Add `crop` and `category`: exact match on the whitespace-collapsed name.

    Unknown names are kept as they are with an empty category.
    """
    keyed = df.withColumn("_name", squeeze(F.col(name)))
    entries = registry.select(F.col("key").alias("_name"), F.col("canonical").alias("_canonical"),
                              F.col("category").alias("_category"))
    return keyed.join(entries, "_name", "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.coalesce("_canonical", "_name").alias("crop"), F.coalesce("_category", F.lit("")).alias("category"))


def normalize_crops(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """Canonical crop statistics; a source crop_type overrides the registry category.

    Missing keys stay null for the contract to reject. Without a source id the row
    gets the hash of its values, the same in every run.
    """
    df = canonical_crops(raw, registry)
    texts = {"year": "year", "state": "state_name", "district": "district_name", "season": "season"}
    numbers = [c for c in ("state_code", "district_code", "area", "production", "yield") if c in raw.columns]
    columns = {c: F.col(s).cast("string") for c, s in texts.items()}
    columns |= {f"_{c}": F.col(f"`{c}`").cast("string") for c in numbers}
    columns["crop_type"] = (F.coalesce(F.col("crop_type").cast("string"), F.lit("")) if "crop_type" in raw.columns
                            else F.col("category"))
    ids = F.col("id").try_cast("long") if "id" in raw.columns else F.xxhash64(*[F.col(f"`{c}`") for c in sorted(raw.columns)])
    trimmed = _trimmed(df, columns, {"id": ids, "crop": F.col("crop")})

    def number(name: str) -> Column:
        return parsed_number(F.col(f"_{name}")) if name in numbers else F.lit(None).cast("double")

    return trimmed.select(
        "id", "year", crop_year_start(F.col("year")).alias("year_start"),
        "state", whole_number(number("state_code")).alias("state_code"),
        "district", whole_number(number("district_code")).alias("district_code"),
        "crop", "crop_type", "season",
        *[number(c).alias(c) for c in ("area", "production", "yield")])
