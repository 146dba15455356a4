"""Region by day features: weather outer-joined with the market's price and arrival blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.operators.climate import mean_temperature, one_per_region
from fieldmart.operators.dedupe import keep_first
from fieldmart.operators.market import ARRIVAL_UNIT, PRICE_UNIT, in_unit
from fieldmart.operators.quantiles import group_quantiles

COLUMNS = [
    "region_name", "state", "state_code", "district", "date",
    "temp_max_c", "temp_min_c", "temp_avg_c", "precipitation_mm",
    "humidity_pct", "windspeed_max_kmh",
    "median_modal_price_rq", "n_price_records", "n_price_markets",
    "n_price_commodities", "total_arrival_tonnes", "n_arrival_records",
    "n_arrival_markets",
]
KEY = ["region_name", "date"]


def map_region(trades: DataFrame, geo: DataFrame, order: tuple[str, ...] = ("region_name",)) -> DataFrame:
    """Add `region_name` by case-folded district; unknown districts keep the folded text.

    One geography record per district is used, the first by `order`.
    """
    places = keep_first(
        geo.select(F.lower("district").alias("_fold"), "region_name", "state_ut", "state_code"),
        ["_fold"], order)
    folded = trades.withColumn("_fold", F.lower("district"))
    return (folded.join(places.select("_fold", F.col("region_name").alias("_region")), "_fold", "left")
            .withColumn("region_name", F.coalesce("_region", "_fold")).drop("_fold", "_region"))


def price_block(mapped: DataFrame, price_unit: str | None = PRICE_UNIT) -> DataFrame:
    """Per region and day: exact median price, priced records, markets and commodities.

    Counts and medians both start from one table of distinct (market, commodity, price)
    entries with their number of records, so the trades are scanned and shuffled once.
    """
    entries = (
        in_unit(mapped, price_unit, "price_unit")
        .where(F.col("region_name").isNotNull() & F.col("date").isNotNull())
        .groupBy(*KEY, "apmc", "commodity", "modal_price")
        .agg(F.count("modal_price").alias("priced"))
    )
    counts = entries.groupBy(*KEY).agg(
        F.sum("priced").alias("n_price_records"),
        F.count_distinct("apmc").alias("n_price_markets"),
        F.count_distinct("commodity").alias("n_price_commodities"),
    )
    medians = group_quantiles(entries, KEY, "modal_price", {"median_modal_price_rq": 0.5}, weight="priced")
    return counts.join(medians, KEY, "left")


def arrival_block(mapped: DataFrame, arrival_unit: str | None = ARRIVAL_UNIT) -> DataFrame:
    """Per region and day: summed arrivals, records and markets."""
    rows = in_unit(mapped, arrival_unit, "arrival_units").where(
        F.col("region_name").isNotNull() & F.col("date").isNotNull())
    return rows.groupBy(*KEY).agg(
        F.coalesce(F.sum("arrival_quantity"), F.lit(0.0)).alias("total_arrival_tonnes"),
        F.count("arrival_quantity").alias("n_arrival_records"),
        F.count_distinct("apmc").alias("n_arrival_markets"),
    )


def market_block(mapped: DataFrame, price_unit: str | None = PRICE_UNIT, arrival_unit: str | None = ARRIVAL_UNIT) -> DataFrame:
    """Price and arrival figures per region and day.

    Three scans that read few columns and combine before their shuffle: per market, per commodity and per price.
    No table of (market, commodity, price) entries is made, which would be about as long as the trades. The
    columns equal those of `price_block` and `arrival_block`; a block without a record in its unit is null.
    """
    priced = F.lit(True) if price_unit is None else F.coalesce(F.col("price_unit") == price_unit, F.lit(False))
    arrived = F.lit(True) if arrival_unit is None else F.coalesce(F.col("arrival_units") == arrival_unit, F.lit(False))
    has_price, quantity = F.col("modal_price").isNotNull(), F.col("arrival_quantity")
    rows = mapped.where(F.col("region_name").isNotNull() & F.col("date").isNotNull())
    figures = ["_rows", "_priced", "_arrivals", "_measured", "_tonnes"]
    # sums per market first: then a distinct count is a count of its rows, and nothing is expanded
    by_market = rows.where(priced | arrived).groupBy(*KEY, "apmc").agg(
        F.count_if(priced).alias("_rows"), F.count_if(priced & has_price).alias("_priced"),
        F.count_if(arrived).alias("_arrivals"), F.count_if(arrived & quantity.isNotNull()).alias("_measured"),
        F.coalesce(F.sum(F.when(arrived, quantity)), F.lit(0.0)).alias("_tonnes"))
    markets = by_market.groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in figures],
        F.count(F.when(F.col("_rows") > 0, F.col("apmc"))).alias("_price_markets"),
        F.count(F.when(F.col("_arrivals") > 0, F.col("apmc"))).alias("_arrival_markets"))
    in_price = rows.where(priced)
    commodities = in_price.groupBy(*KEY).agg(F.count_distinct("commodity").alias("_commodities"))
    medians = group_quantiles(in_price.withColumn("_priced", has_price.cast("long")), KEY, "modal_price",
                              {"median_modal_price_rq": 0.5}, weight="_priced", written=True)
    sold, brought = F.col("_rows") > 0, F.col("_arrivals") > 0
    return markets.join(commodities, KEY, "left").join(medians, KEY, "left").select(
        *KEY, F.when(sold, F.col("_priced")).alias("n_price_records"), F.when(sold, F.col("_price_markets")).alias("n_price_markets"),
        F.when(sold, F.coalesce("_commodities", F.lit(0))).alias("n_price_commodities"), "median_modal_price_rq",
        F.when(brought, F.col("_tonnes")).alias("total_arrival_tonnes"), F.when(brought, F.col("_measured")).alias("n_arrival_records"),
        F.when(brought, F.col("_arrival_markets")).alias("n_arrival_markets"))


def recover_location(joined: DataFrame, geo: DataFrame) -> DataFrame:
    """Fill state, code and district of rows without weather from the geography."""
    known = one_per_region(geo, ["state_ut", "state_code", "district"]).select(
        "region_name", F.col("state_ut").alias("_state"), F.col("state_code").alias("_code"),
        F.col("district").alias("_district"))
    return (joined.join(known, "region_name", "left")
            .withColumn("state", F.coalesce("state", "_state"))
            .withColumn("state_code", F.coalesce("state_code", "_code"))
            .withColumn("district", F.coalesce("district", "_district"))
            .drop("_state", "_code", "_district"))


def outer_blocks(weather: DataFrame, prices: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Full outer join on region and day; a side without a record stays null."""
    return weather.join(prices, KEY, "full").join(arrivals, KEY, "full")


def region_features(weather: DataFrame, trades: DataFrame, geo: DataFrame,
                    price_unit: str | None = PRICE_UNIT,
                    arrival_unit: str | None = ARRIVAL_UNIT) -> DataFrame:
    places = one_per_region(geo, ["state_ut", "state_code", "district"]).withColumnRenamed("state_ut", "state")
    days = (weather.withColumn("date", F.col("date").cast("date"))
            .withColumn("temp_avg_c", mean_temperature())
            .join(places, "region_name", "left"))
    mapped = map_region(trades.withColumn("date", F.col("date").cast("date")), geo)
    joined = days.join(market_block(mapped, price_unit, arrival_unit), KEY, "full")
    return recover_location(joined, geo).select(*COLUMNS)
