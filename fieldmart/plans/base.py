"""Query registry and the stand-in views over the driver's tables.

The driver's tables hold no crops or markets. Each stand-in shapes them like one of
the library's input tables; measures are whole numbers, so sums are exact in any
order. `CTES` states the same views in SQL for the cross-check.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.session import materialized

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

#: What trades and agri read of the joined line items.
SOLD_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                "l_linestatus", "l_shipdate", "s_name", "state", "district", "r_regionkey", "n_nationkey",
                "p_type", "p_brand", "p_size"]


def whole(value: Column) -> Column:
    return F.floor(value).cast("double")


class Tables:
    """Base tables and stand-ins of one data folder, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        raise AttributeError(name)

    @cached_property
    def places(self) -> DataFrame:
        """Nation with its region: the district and state of the stand-ins."""
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", "r_regionkey", F.col("r_name").alias("state"),
            F.replace("n_name", F.lit("NATION_"), F.lit("District ")).alias("district"))

    @cached_property
    def geo(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.places.select(
            F.col("n_name").alias("region_name"), F.col("state").alias("state_ut"),
            F.upper(F.substring("state", 1, 2)).alias("state_code"), "district",
            (key + 500).cast("string").alias("district_code"),
            F.concat(F.lit("Mandi "), key.cast("string")).alias("mandi_apmc"),
            (key + 8.0).alias("latitude"), (key + 70.0).alias("longitude"))

    @cached_property
    def weather(self) -> DataFrame:
        v = whole(F.col("value"))
        per_day = self.events.groupBy(
            (F.col("user_id") % 25).alias("k"), F.col("ts").cast("date").alias("date")
        ).agg(F.max(v).alias("hi"), F.min(v).alias("lo"), F.sum(v).alias("rain"), F.avg(v).alias("mean"))
        return per_day.join(self.nation, F.col("k") == F.col("n_nationkey")).select(
            F.col("n_name").alias("region_name"), "date",
            (whole(F.col("hi") / 20) + 20).alias("temp_max_c"), whole(F.col("lo") / 20).alias("temp_min_c"),
            F.col("rain").alias("precipitation_mm"), (F.col("mean") * 1.5).alias("humidity_pct"),
            (F.col("hi") - F.col("lo")).alias("windspeed_max_kmh"))

    @cached_property
    def _sold(self) -> DataFrame:
        """Line items with their market place and commodity; the join that may shuffle comes first, on narrow rows."""
        return (self.lineitem
                .join(self.part, F.col("l_partkey") == F.col("p_partkey"))
                .join(self.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
                .join(self.places, F.col("s_nationkey") == F.col("n_nationkey")))

    @cached_property
    def written(self) -> Tables:
        """The same tables with the joined line items as a written table, for queries that read them several times."""
        out = Tables(self.spark, self.folder)
        out._sold = materialized(self._sold.select(*SOLD_COLUMNS), "sold")
        out.written = out
        return out

    @cached_property
    def trades(self) -> DataFrame:
        price = whole(F.col("l_extendedprice") / F.col("l_quantity"))
        untold = (F.col("l_discount") == 0.0) & (F.col("l_tax") == 0.08)
        return self._sold.select(
            F.col("l_shipdate").cast("date").alias("date"), "state", "district",
            F.col("s_name").alias("apmc"), F.col("p_type").alias("commodity"), F.col("p_brand").alias("variety"),
            F.col("l_linestatus").alias("price_unit"), F.col("l_returnflag").alias("arrival_units"),
            whole(price * (1 - F.col("l_discount"))).alias("min_price"),
            F.when(~untold, price).alias("modal_price"),
            whole(price * (1 + F.col("l_tax") - 0.02)).alias("max_price"),
            F.col("l_quantity").alias("arrival_quantity"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"))

    @cached_property
    def agri(self) -> DataFrame:
        name = F.initcap("p_type")
        crop = F.when(F.col("p_size") > 40, F.concat(F.lit("Rare "), name)).otherwise(name)
        per_year = self._sold.groupBy(
            "state", F.col("r_regionkey").cast("long").alias("state_code"), "district",
            F.col("n_nationkey").cast("long").alias("district_code"), crop.alias("crop"),
            F.substring("p_type", 1, 1).alias("crop_type"), F.col("l_returnflag").alias("season"),
            F.year("l_shipdate").alias("year_start"),
        ).agg(
            F.min(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
            F.sum("l_quantity").alias("area"), F.sum(whole(F.col("l_extendedprice"))).alias("made"))
        untold = (F.col("season") == "A") & (F.col("year_start") == 1995)
        return per_year.select(
            "id", F.concat_ws("-", "year_start", F.col("year_start") + 1).alias("year"), "year_start",
            "state", "state_code", "district", "district_code", "crop", "crop_type", "season", "area",
            F.when(~untold, F.col("made")).alias("production"), (F.col("made") / F.col("area")).alias("yield"))

    @cached_property
    def panel(self) -> DataFrame:
        ordered = (self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
                   .join(self.places, F.col("c_nationkey") == F.col("n_nationkey")))
        return ordered.groupBy(
            "state", "district", F.col("c_mktsegment").alias("crop"), F.col("o_orderpriority").alias("season"),
            F.year("o_orderdate").alias("year_start"), F.col("r_regionkey").cast("long").alias("state_code"),
            F.col("n_nationkey").cast("long").alias("district_code"),
        ).agg(
            F.sum(whole(F.col("o_totalprice"))).alias("production"), F.count(F.lit(1)).cast("double").alias("area"),
        ).select(
            "state", "district", "crop", F.substring("crop", 1, 1).alias("crop_type"), "season", "year_start",
            F.concat_ws("-", "year_start", F.col("year_start") + 1).alias("year"), "area", "production",
            (F.col("production") / F.col("area")).alias("yield"), "state_code", "district_code")

    @cached_property
    def scenarios(self) -> DataFrame:
        price, size = F.col("p_retailprice"), F.col("p_size")
        placed = self.part.withColumn("k", F.col("p_partkey") % 25).join(
            self.places, F.col("k") == F.col("n_nationkey"))
        return placed.select(
            F.col("p_partkey").alias("scenario_id"), "state", "district", F.col("p_type").alias("crop"),
            size.cast("double").alias("quantity"), price.alias("unit_price"),
            whole(price * 0.25).alias("unit_seed_cost"), whole(price * 0.125).alias("unit_fertilizer_cost"),
            whole(price * 0.25).alias("unit_labor_cost"), F.lit(20.0).alias("unit_transport_cost"),
            F.lit(10.0).alias("unit_storage_cost"),
            F.when(F.col("p_brand") == "Brand#7", -1.0).otherwise(0.0).alias("unit_other_cost"),
            F.when(size == 50, 100.0).otherwise((size % 12).cast("double")).alias("loss_pct"))

    @cached_property
    def market_places(self) -> DataFrame:
        """A geography row per supplier, with planted defects."""
        key = F.col("s_suppkey")
        return self.supplier.join(self.places, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_name").alias("region_name"), F.col("state").alias("state_ut"),
            F.when(key % 7 == 0, F.col("state")).otherwise(F.upper(F.substring("state", 1, 2))).alias("state_code"),
            F.when(key % 11 == 0, F.concat(F.lit("Market "), F.col("s_name"))).otherwise(F.col("district")).alias("district"),
            F.when(key % 13 == 0, "x1").otherwise((key + 500).cast("string")).alias("district_code"),
            F.when(key % 17 != 0, F.col("s_name")).alias("mandi_apmc"),
            ((key % 40) + 1.0).alias("latitude"), ((key % 35) + 65.0).alias("longitude"))


# The same views in SQL, without the keyword AS in front of the table name.
CTES = {
    "places": """
        SELECT n_nationkey, n_name, r_regionkey, r_name AS state,
               replace(n_name, 'NATION_', 'District ') AS district
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "geo": """
        SELECT n_name AS region_name, state AS state_ut, upper(substr(state, 1, 2)) AS state_code, district,
               cast(n_nationkey + 500 AS varchar) AS district_code, 'Mandi ' || n_nationkey AS mandi_apmc,
               n_nationkey + 8.0e0 AS latitude, n_nationkey + 70.0e0 AS longitude
        FROM places""",
    "weather": """
        SELECT n_name AS region_name, d AS date, floor(hi / 20) + 20 AS temp_max_c, floor(lo / 20) AS temp_min_c,
               rain AS precipitation_mm, mean * 1.5e0 AS humidity_pct, hi - lo AS windspeed_max_kmh
        FROM (SELECT user_id % 25 AS k, cast(ts AS date) AS d, max(floor(value)) AS hi, min(floor(value)) AS lo,
                     sum(floor(value)) AS rain, avg(floor(value)) AS mean
              FROM events GROUP BY 1, 2) JOIN nation ON k = n_nationkey""",
    "sold": """
        SELECT * FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN places ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "trades": """
        SELECT cast(l_shipdate AS date) AS date, state, district, s_name AS apmc, p_type AS commodity,
               p_brand AS variety, l_linestatus AS price_unit, l_returnflag AS arrival_units,
               floor(floor(l_extendedprice / l_quantity) * (1 - l_discount)) AS min_price,
               CASE WHEN NOT (l_discount = 0.0e0 AND l_tax = 0.08e0)
                    THEN floor(l_extendedprice / l_quantity) END AS modal_price,
               floor(floor(l_extendedprice / l_quantity) * (1 + l_tax - 0.02e0)) AS max_price,
               l_quantity AS arrival_quantity, l_orderkey * 8 + l_linenumber AS row_id
        FROM sold""",
    "agri": """
        SELECT id, year_start || '-' || (year_start + 1) AS year, year_start, state, state_code, district,
               district_code, crop, crop_type, season, area,
               CASE WHEN NOT (season = 'A' AND year_start = 1995) THEN made END AS production,
               made / area AS yield
        FROM (SELECT state, cast(r_regionkey AS bigint) AS state_code, district,
                     cast(n_nationkey AS bigint) AS district_code,
                     CASE WHEN p_size > 40 THEN 'Rare ' ELSE '' END
                       || substr(p_type, 1, 1) || lower(substr(p_type, 2)) AS crop,
                     substr(p_type, 1, 1) AS crop_type, l_returnflag AS season,
                     cast(year(l_shipdate) AS integer) AS year_start,
                     min(l_orderkey * 8 + l_linenumber) AS id, sum(l_quantity) AS area,
                     sum(floor(l_extendedprice)) AS made
              FROM sold GROUP BY ALL)""",
    "panel": """
        SELECT state, district, crop, substr(crop, 1, 1) AS crop_type, season, year_start,
               year_start || '-' || (year_start + 1) AS year, area, production, production / area AS yield,
               state_code, district_code
        FROM (SELECT state, district, c_mktsegment AS crop, o_orderpriority AS season,
                     cast(year(o_orderdate) AS integer) AS year_start, cast(r_regionkey AS bigint) AS state_code,
                     cast(n_nationkey AS bigint) AS district_code, sum(floor(o_totalprice)) AS production,
                     cast(count(*) AS double) AS area
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey
              GROUP BY ALL)""",
    "scenarios": """
        SELECT p_partkey AS scenario_id, state, district, p_type AS crop, cast(p_size AS double) AS quantity,
               p_retailprice AS unit_price, floor(p_retailprice * 0.25e0) AS unit_seed_cost,
               floor(p_retailprice * 0.125e0) AS unit_fertilizer_cost,
               floor(p_retailprice * 0.25e0) AS unit_labor_cost, 20.0e0 AS unit_transport_cost,
               10.0e0 AS unit_storage_cost,
               CASE WHEN p_brand = 'Brand#7' THEN -1.0e0 ELSE 0.0e0 END AS unit_other_cost,
               CASE WHEN p_size = 50 THEN 100.0e0 ELSE cast(p_size % 12 AS double) END AS loss_pct
        FROM part JOIN places ON p_partkey % 25 = n_nationkey""",
    "market_places": """
        SELECT s_name AS region_name, state AS state_ut,
               CASE WHEN s_suppkey % 7 = 0 THEN state ELSE upper(substr(state, 1, 2)) END AS state_code,
               CASE WHEN s_suppkey % 11 = 0 THEN 'Market ' || s_name ELSE district END AS district,
               CASE WHEN s_suppkey % 13 = 0 THEN 'x1' ELSE cast(s_suppkey + 500 AS varchar) END AS district_code,
               CASE WHEN s_suppkey % 17 <> 0 THEN s_name END AS mandi_apmc,
               (s_suppkey % 40) + 1.0e0 AS latitude, (s_suppkey % 35) + 65.0e0 AS longitude
        FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "daily": """
        SELECT w.*, (temp_max_c + temp_min_c) / 2 AS temp_avg_c, state_ut, state_code, district, mandi_apmc,
               latitude, longitude
        FROM weather w LEFT JOIN geo USING (region_name)""",
    "features": """
        SELECT region_name, avg(temp_avg_c) AS avg_temp_c, sum(precipitation_mm) AS total_precip_mm,
               round(avg(humidity_pct), 4) AS avg_humidity_pct
        FROM daily GROUP BY 1""",
    "cohort": """
        SELECT quantile_cont(total_precip_mm, 0.333e0) AS p_lo, quantile_cont(total_precip_mm, 0.667e0) AS p_hi,
               median(total_precip_mm) AS p_med, quantile_cont(avg_temp_c, 0.333e0) AS t_lo,
               quantile_cont(avg_temp_c, 0.667e0) AS t_hi, median(avg_temp_c) AS t_med,
               median(avg_humidity_pct) AS h_med
        FROM features""",
}
NEEDS = {
    "geo": ["places"], "sold": ["places"], "trades": ["sold"], "agri": ["sold"], "panel": ["places"],
    "scenarios": ["places"], "market_places": ["places"], "daily": ["weather", "geo"], "features": ["daily"],
    "cohort": ["features"],
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, tuple[str, str]] = {}


def define(name: str, sql: str, *needs: str) -> None:
    """Add a named view for the SQL side only."""
    CTES[name] = sql
    NEEDS[name] = list(needs)


def with_views(sql: str, views: str) -> str:
    """Prefix a statement with the views it uses, dependencies first."""
    ordered: list[str] = []

    def add(view: str) -> None:
        for need in NEEDS.get(view, []):
            add(need)
        if view not in ordered:
            ordered.append(view)

    for view in views.split():
        add(view)
    head = ",\n".join(f"{v} AS ({CTES[v]})" for v in ordered)
    return f"WITH {head}\n{sql}" if ordered else sql


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query on `Tables` and, if given, its SQL over the base tables."""
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = (sql, views)
        return build
    return register


def oracle_sql() -> dict[str, str]:
    """Complete statements, with their views in front."""
    return {name: with_views(sql, views) for name, (sql, views) in ORACLES.items()}
