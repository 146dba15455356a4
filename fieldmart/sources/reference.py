"""Reference dimensions from catalog JSON: regions, crops, commodities and datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of the catalog documents.
REGION_FIELDS = ["region_name", "district", "state", "state_ut", "state_code", "district_code",
                 "mandi", "apmc", "mandi_apmc", "latitude", "longitude"]
CROP_SCHEMA = "crops array<struct<name: string, canonical: string, category: string>>"
DATASET_FIELDS = ["name", "period", "last_updated", "transformation", "model", "kind", "status", "url", "units"]


def _filled(*names: str) -> Column:
    return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names], F.lit(""))


def geography(regions: DataFrame) -> DataFrame:
    """Region records with their field-name fallbacks resolved."""
    r = regions.select(*[F.col(c) if c in regions.columns else F.lit(None).cast("string").alias(c)
                         for c in REGION_FIELDS])
    mandi, apmc = _filled("mandi", "mandi_apmc"), _filled("apmc", "mandi_apmc")
    return r.select(
        _filled("region_name", "district").alias("region_name"),
        _filled("state", "state_ut").alias("state"),
        _filled("state_ut", "state").alias("state_ut"),
        "state_code", "district", F.col("district_code").cast("string").alias("district_code"),
        F.coalesce(F.nullif(mandi, F.lit("")), apmc).alias("mandi_apmc"),
        mandi.alias("mandi"), apmc.alias("apmc"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"))


def read_regions(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """The region lists of catalog documents, or bare lists of regions; one document per file or line."""
    fields = ", ".join(f"{c}: {'double' if c in ('latitude', 'longitude') else 'string'}" for c in REGION_FIELDS)
    text = spark.read.option("wholetext", not one_per_line).text(path)
    wrapped = F.from_json("value", f"struct<regions: array<struct<{fields}>>>")["regions"]
    bare = F.from_json("value", f"array<struct<{fields}>>")
    is_list = F.ltrim("value").startswith("[")
    return geography(text.select(F.inline(F.when(is_list, bare).otherwise(wrapped))))


def crop_registry(crops: DataFrame) -> DataFrame:
    """Lookup table keyed by name and by canonical name; the canonical entry wins."""
    entry = F.struct("canonical", "category")
    keyed = crops.select(F.col("name").alias("key"), F.lit(0).alias("rank"), entry.alias("e")).unionByName(
        crops.select(F.col("canonical").alias("key"), F.lit(1).alias("rank"), entry.alias("e")))
    return keyed.groupBy("key").agg(F.max_by("e", F.struct("rank", "e")).alias("e")).select("key", "e.canonical", "e.category")


def read_crop_registry(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.schema(CROP_SCHEMA).option("multiLine", True).json(path)
    return crop_registry(docs.select(F.inline("crops")))


def read_commodities(spark: SparkSession, path: str, fields: str = "name: string, category: string") -> DataFrame:
    """Commodity metadata from a list or a {"commodities": [...]} document."""
    text = spark.read.option("wholetext", True).text(path)
    wrapped = F.from_json("value", f"struct<commodities: array<struct<{fields}>>>")["commodities"]
    bare = F.from_json("value", f"array<struct<{fields}>>")
    return text.select(F.inline(F.when(F.ltrim("value").startswith("["), bare).otherwise(wrapped)))


def read_datasets(spark: SparkSession, path: str) -> DataFrame:
    """Provenance of the datasets."""
    fields = ", ".join(f"{c}: string" for c in DATASET_FIELDS)
    docs = spark.read.schema(f"sources array<struct<{fields}>>").option("multiLine", True).json(path)
    return docs.select(F.inline("sources"))
