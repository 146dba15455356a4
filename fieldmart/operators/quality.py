"""Quality checks as rows (check, dataset, status, detail) and the health report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.operators.contracts import blank

PASS, INFO, FAIL = "PASS", "INFO", "FAIL"
REPORT = ["check", "dataset", "status", "detail"]

# Limits of the published checks.
MAX_AGE_HOURS = 24
STAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
WEATHER_DAYS = 28
REGION_BOUNDS = {
    "temperature out of [-60, 60] C": "temp_max_c > 60 or temp_max_c < -60",
    "humidity outside [0, 100]": "humidity_pct < 0 or humidity_pct > 100",
    "negative median modal price": "median_modal_price_rq < 0",
    "negative total arrival": "total_arrival_tonnes < 0",
}
CROP_BOUNDS = {f"{c} < 0": f"{c} < 0" for c in (
    "latest_area_ha", "latest_production_t", "latest_yield_t_per_ha",
    "latest_modal_price", "obs_temp_max_c", "obs_temp_min_c")}


#: The tables that monitoring expects, and what their absence means: dataset, check, status, detail.
EXPECTED_TABLES = [
    ("weather", "row_count", FAIL, "silver table missing"),
    ("geo", "row_count", FAIL, "silver table missing"),
    ("india_mandi", "duplicates", INFO, "silver table absent (no market data yet)"),
    ("india_agriculture", "duplicates", INFO, "silver table absent"),
    ("india_region_features", "duplicates", INFO, "gold table absent"),
    ("india_crop_summary", "duplicates", INFO, "gold table absent"),
]
NO_MANIFEST = "gold manifest absent"


@dataclass(frozen=True)
class Rule:
    """One check of a table: the row conditions it counts and its report entry.

    The entry may use each count by its name, and `rows` and `duplicates`.
    """

    counts: Mapping[str, Column]
    entry: Column


def _entry(check: str, dataset: str, status: Column, detail: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(dataset).alias("dataset"),
                    status.alias("status"), detail.alias("detail"))


def _row(check: str, dataset: str, status: Column, detail: Column) -> list[Column]:
    return [F.lit(check).alias("check"), F.lit(dataset).alias("dataset"),
            status.alias("status"), detail.alias("detail")]


def _counted(n: str, found: str, none: str) -> Column:
    return F.when(F.col(n) > 0, F.concat(F.col(n).cast("string"), F.lit(f" {found}"))).otherwise(none)


def _failed_if(bad: Column) -> Column:
    return F.when(bad, FAIL).otherwise(PASS)


def facts(df: DataFrame, key: Sequence[str] | None, counts: Mapping[str, Column]) -> DataFrame:
    """One row: rows, repeated keys and the rows meeting each condition, in one pass.

    With a key the counts are first combined per key, so the pass that finds
    duplicates also gives all other counts.
    """
    first = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()]]
    if not key:
        return df.agg(*first, F.lit(0).cast("long").alias("duplicates"))
    per_key = df.groupBy(*key).agg(*first)
    none = F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum("rows"), none).alias("rows"),
        F.coalesce(F.sum(F.col("rows") - 1), none).alias("duplicates"),
        *[F.coalesce(F.sum(n), none).alias(n) for n in counts])


def run_rules(df: DataFrame, key: Sequence[str] | None, rules: Sequence[Rule]) -> DataFrame:
    """All rules of one table from one pass, one report row each."""
    counts = {n: c for rule in rules for n, c in rule.counts.items()}
    return facts(df, key, counts).select(F.inline(F.array(*[rule.entry for rule in rules])))


def duplicates_rule(dataset: str, what: str = "rows") -> Rule:
    return Rule({}, _entry("duplicates", dataset, _failed_if(F.col("duplicates") > 0),
                           _counted("duplicates", f"duplicate {what}", f"no duplicate {what}")))


def empty_geography_rule(dataset: str, columns: Sequence[str] = ("state", "district")) -> Rule:
    empty = reduce(Column.__or__, [blank(c) for c in columns])
    return Rule({"empty_geo": empty}, _entry(
        "missing_geo", dataset, _failed_if(F.col("empty_geo") > 0),
        _counted("empty_geo", "rows with empty state/district", "no empty state/district")))


def unknown_places_rule(dataset: str, unknown: Column) -> Rule:
    """Fails only when every row lies outside the monitored districts."""
    detail = F.concat(F.col("unknown_geo").cast("string"), F.lit("/"), F.col("rows").cast("string"),
                      F.lit(" rows without a monitored district"))
    return Rule({"unknown_geo": unknown}, _entry(
        "missing_geo", dataset, _failed_if(F.col("unknown_geo") == F.col("rows")), detail))


def impossible_rule(dataset: str, bounds: Mapping[str, str], columns: Sequence[str]) -> Rule:
    """Rows outside each bound; bounds on absent columns are left out."""
    present = [(n, r) for n, r in bounds.items() if r.split()[0] in columns]
    counts = {f"bound_{i}": F.expr(r) for i, (_, r) in enumerate(present)}
    names = F.concat_ws("; ", *[F.when(F.col(f"bound_{i}") > 0, n) for i, (n, _) in enumerate(present)])
    return Rule(counts, _entry("impossible_values", dataset, _failed_if(names != ""),
                               F.when(names != "", names).otherwise("no impossible values")))


def missing_prices_rule(dataset: str, price_days: Column) -> Rule:
    """Records without a price are informational; so is a table without price days."""
    n, silent = F.col("no_price"), price_days.isNull() | (price_days == 0)
    detail = (F.when(n > 0, F.concat(n.cast("string"), F.lit(" rows without modal price")))
              .when(price_days == 0, "no market price days observed").otherwise("price channel present"))
    return Rule({"no_price": F.col("modal_price").isNull()}, _entry(
        "missing_prices", dataset, F.when((n > 0) | silent, INFO).otherwise(PASS), detail))


def names_of(spark: SparkSession, found: Sequence[str]) -> DataFrame:
    """A catalog listing as a table: one row per dataset that is there."""
    return spark.createDataFrame([(n,) for n in found], "dataset string")


def absent_tables(present: DataFrame, expected: Sequence[tuple[str, str, str, str]] = EXPECTED_TABLES) -> DataFrame:
    """A report row for each expected dataset that the listing `present` (dataset) lacks."""
    wanted = present.sparkSession.createDataFrame(list(expected), "dataset string, check string, status string, detail string")
    return wanted.join(present.select("dataset"), "dataset", "left_anti").select(*REPORT)


def check_freshness(stamps: DataFrame, column: str, as_of: Column, max_age_hours: int = MAX_AGE_HOURS) -> DataFrame:
    """Age of the newest ingestion stamp; no stamp at all fails."""
    newest = stamps.agg(F.max(F.try_to_timestamp(F.col(column), F.lit(STAMP_FORMAT))).alias("_at"))
    aged = newest.withColumn("age_hours", (F.unix_timestamp(as_of) - F.unix_timestamp("_at")) / 3600)
    stale = F.col("age_hours").isNull() | (F.col("age_hours") > max_age_hours)
    detail = F.when(F.col("age_hours").isNull(), "no ingestion metadata found").otherwise(
        F.format_string("latest ingestion is %.1fh old (max allowed %d h)", "age_hours", F.lit(max_age_hours)))
    return aged.select(*_row("freshness", "ingestion", _failed_if(stale), detail))


def check_row_count(df: DataFrame, dataset: str, minimum: Column | int) -> DataFrame:
    low = minimum if isinstance(minimum, Column) else F.lit(minimum)
    counted = df.agg(F.count(F.lit(1)).alias("n")).withColumn("low", low)
    detail = F.concat(F.col("n").cast("string"), F.lit(" rows, expected minimum "), F.col("low").cast("string"))
    return counted.select(*_row("row_count", dataset, _failed_if(F.col("n") < F.col("low")), detail))


def check_duplicates(df: DataFrame, dataset: str, key: Sequence[str], what: str = "rows") -> DataFrame:
    return run_rules(df, key, [duplicates_rule(dataset, what)])


def check_empty_geography(df: DataFrame, dataset: str, columns: Sequence[str] = ("state", "district")) -> DataFrame:
    return run_rules(df, None, [empty_geography_rule(dataset, columns)])


def known_districts(geo: DataFrame) -> DataFrame:
    return geo.where(F.col("district").isNotNull()).select(F.lower("district").alias("_d")).distinct()


def unknown_places(df: DataFrame, geo: DataFrame, column: str = "district") -> DataFrame:
    """Rows whose district is not monitored, by case-folded name."""
    return df.withColumn("_d", F.lower(column)).join(known_districts(geo), "_d", "left_anti").drop("_d")


def mark_unknown_places(df: DataFrame, geo: DataFrame, column: str = "district") -> DataFrame:
    """Add `_unknown` instead of dropping the known rows."""
    known = known_districts(geo).withColumn("_known", F.lit(True))
    return (df.withColumn("_d", F.lower(column)).join(known, "_d", "left")
            .withColumn("_unknown", F.col("_known").isNull()).drop("_d", "_known"))


def check_unknown_places(df: DataFrame, dataset: str, geo: DataFrame) -> DataFrame:
    return run_rules(mark_unknown_places(df, geo), None, [unknown_places_rule(dataset, F.col("_unknown"))])


def check_impossible(df: DataFrame, dataset: str, bounds: Mapping[str, str]) -> DataFrame:
    return run_rules(df, None, [impossible_rule(dataset, bounds, df.columns)])


def price_day_count(region_features: DataFrame) -> DataFrame:
    return region_features.agg(F.count_if(F.coalesce("n_price_records", F.lit(0)) > 0))


def check_missing_prices(trades: DataFrame, region_features: DataFrame | None, dataset: str = "india_mandi") -> DataFrame:
    days = price_day_count(region_features).scalar() if region_features is not None else F.lit(None).cast("long")
    return run_rules(trades, None, [missing_prices_rule(dataset, days)])


def in_weather_window(region_features: DataFrame) -> DataFrame:
    """Rows on days for which any region reported a temperature."""
    days = region_features.where(F.col("temp_max_c").isNotNull()).select("date").distinct()
    return region_features.join(days, "date", "left_semi")


def check_missing_weather(region_features: DataFrame, dataset: str = "india_region_features") -> DataFrame:
    """Gaps on days with any temperature: counted per day first, so no join is needed."""
    per_day = region_features.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("temp_max_c").isNull()).alias("t"),
        F.count_if(F.col("humidity_pct").isNull()).alias("h"))
    n = per_day.where(F.col("t") < F.col("n")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "t", "h")])
    bad = (F.col("t") > 0) | (F.col("h") > 0)
    status = F.when(F.col("n") == 0, INFO).when(bad, FAIL).otherwise(PASS)
    detail = (F.when(F.col("n") == 0, "no weather window rows present")
              .when(bad, F.concat(F.col("t").cast("string"), F.lit(" weather-window rows missing temperature, "),
                                  F.col("h").cast("string"), F.lit(" missing humidity")))
              .otherwise("weather-window rows carry complete temperature/humidity"))
    return n.select(*_row("missing_weather", dataset, status, detail))


def check_staleness(manifests: DataFrame, as_of: Column, max_age_hours: int = MAX_AGE_HOURS,
                    expected: DataFrame | None = None) -> DataFrame:
    """One row per manifest (dataset, generated_at); an unparseable stamp is informational.

    With `expected` (dataset) a dataset without a manifest has a row too.
    """
    kept = manifests.select("dataset", "generated_at", F.lit(True).alias("_there"))
    if expected is not None:
        kept = expected.select("dataset").distinct().join(kept, "dataset", "full")
    age = (F.unix_timestamp(as_of) - F.unix_timestamp(F.col("generated_at").try_cast("timestamp"))) / 3600
    aged = kept.withColumn("age", age)
    status = F.when(F.col("age").isNull(), INFO).when(F.col("age") > max_age_hours, FAIL).otherwise(PASS)
    detail = F.when(F.col("_there").isNull(), NO_MANIFEST).when(
        F.col("age").isNull(), "gold manifest has no parseable generated_at").otherwise(
        F.format_string("manifest generated %.1fh ago (max allowed %d h)", "age", F.lit(max_age_hours)))
    return aged.select(F.lit("staleness").alias("check"), "dataset", status.alias("status"), detail.alias("detail"))


def combine(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [c.select(*REPORT) for c in checks])


def overall(checks: DataFrame) -> DataFrame:
    """FAIL when any check failed, with the number of checks per status."""
    return checks.agg(
        F.when(F.bool_or(F.col("status") == FAIL), FAIL).otherwise(PASS).alias("status"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == INFO).alias("informational"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
    )


def health_report(checks: DataFrame, as_of: Column, observed: DataFrame | None = None) -> DataFrame:
    """One JSON document; the checks are a fixed list, a few rows per table. `observed` is one row of figures."""
    entries = checks.agg(
        F.when(F.bool_or(F.col("status") == FAIL), FAIL).otherwise(PASS).alias("status"),
        F.array_sort(F.collect_list(F.struct(*REPORT))).alias("checks"))
    issues = F.filter("checks", lambda c: c["status"] == FAIL)
    figures = [] if observed is None else [observed.select(F.struct(*observed.columns)).scalar().alias("observed")]
    return entries.select(F.to_json(F.struct(
        as_of.cast("string").alias("checked_at"), "status", issues.alias("issues"), "checks", *figures)).alias("report"))


def observed_figures(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row: the rows of each table that is there, and the records and days with and without a price."""
    one = spark.range(1)
    columns = [t.agg(F.count(F.lit(1))).scalar().alias(f"{n}_rows") for n, t in tables.items() if t is not None]
    trades, features = tables.get("trades"), tables.get("region_features")
    if trades is not None:
        columns.append(trades.agg(F.count_if(F.col("modal_price").isNull())).scalar().alias("trades_without_price"))
    if features is not None:
        columns.append(price_day_count(features).scalar().alias("price_days"))
    return one.select(*columns) if columns else one.select(F.lit(0).alias("tables"))


def artifact_checks(trades: DataFrame | None, agri: DataFrame | None, region_features: DataFrame | None,
                    crop_summary: DataFrame | None, geo: DataFrame | None, manifests: DataFrame, as_of: Column,
                    expected_manifests: Sequence[str] = ()) -> DataFrame:
    """All checks over the silver and gold tables, one pass per table and key.

    A table that is None has one row from the list of expected tables; without `geo` districts aren't compared.
    """
    spark = manifests.sparkSession
    rf, cs = "india_region_features", "india_crop_summary"
    tables = {"india_mandi": trades, "india_agriculture": agri, rf: region_features, cs: crop_summary}
    present = names_of(spark, [*(n for n, t in tables.items() if t is not None), "weather", "geo"])
    found = [absent_tables(present), check_staleness(
        manifests, as_of, expected=names_of(spark, expected_manifests) if expected_manifests else None)]
    if trades is not None:
        days = price_day_count(region_features).scalar() if region_features is not None else F.lit(None).cast("long")
        found.append(run_rules(trades, ["date", "state", "district", "apmc", "commodity", "variety"], [
            duplicates_rule("india_mandi", "trade-day rows"), missing_prices_rule("india_mandi", days)]))
    if agri is not None:
        found.append(run_rules(agri, ["state", "district", "crop", "season", "year"], [
            duplicates_rule("india_agriculture", "season-aware rows")]))
    if region_features is not None:
        found += [run_rules(region_features, ["region_name", "date"], [
            duplicates_rule(rf, "(region_name, date) rows"),
            empty_geography_rule(rf),
            impossible_rule(rf, REGION_BOUNDS, region_features.columns)]), check_missing_weather(region_features)]
    if crop_summary is not None:
        marked = crop_summary if geo is None else mark_unknown_places(crop_summary, geo)
        found.append(run_rules(marked, ["state", "district", "crop"], [
            duplicates_rule(cs, "(state, district, crop) rows"),
            empty_geography_rule(cs),
            *([] if geo is None else [unknown_places_rule(cs, F.col("_unknown"))]),
            impossible_rule(cs, CROP_BOUNDS, crop_summary.columns)]))
    return combine(found)
