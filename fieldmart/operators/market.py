"""Market price and arrival aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.functions.labels import market_signal
from fieldmart.functions.numbers import mean_of, pct_change
from fieldmart.operators.dedupe import keep_first
from fieldmart.session import materialized

# Units in which prices and arrivals may be compared across markets.
PRICE_UNIT = "Rs./Quintal"
ARRIVAL_UNIT = "Metric Tonnes"

TRADE_DAY_KEY = ["date", "state", "district", "apmc", "commodity", "variety"]
SUMMARY_KEY = ["state", "district", "apmc", "commodity", "variety", "price_unit"]
WINDOW_DAYS = 7


def in_unit(df: DataFrame, unit: str | None, column: str) -> DataFrame:
    """Rows of one unit; `None` keeps all."""
    return df if unit is None else df.where(F.col(column) == unit)


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def _by_day(trades: DataFrame, keys: Sequence[str], tie: Sequence[str], fields: Sequence[str],
            measures: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """One row per key and day (and `within`), combined before the shuffle.

    `_first` is the day's first record by `tie`, then by all its fields: the least of the
    structs of both, so a record is held once. A struct keeps a null price null instead of
    taking the next record's. The hash `_k` of the keys leads the grouping so that sorting
    compares one long instead of the texts.
    """
    order = F.struct(*[c for c in tie if c not in keys], F.struct(*fields).alias("_record"))
    return (
        _with_keys(trades, [*keys, "date"])
        .withColumn("date", F.col("date").cast("date"))
        .withColumn("_k", F.xxhash64(*keys))
        .groupBy("_k", "date", *keys, *within)
        .agg(F.min(order)["_record"].alias("_first"),
             *[F.count(m).alias(f"_n_{m}") for m in measures],
             *[F.sum(m).alias(f"_s_{m}") for m in measures])
    )


def _recent(column: str) -> Column:
    """The day's value when the day is in the key's own trailing window."""
    return F.when(F.datediff("_last", "date") <= WINDOW_DAYS - 1, F.col(column))


def _window_metrics(by_day: DataFrame, keys: Sequence[str], measures: Sequence[str],
                    extra: Sequence[Column] = ()) -> DataFrame:
    """Latest record and trailing-window averages per key.

    The window anchors at each key's own latest day. Its input has one row per key
    and day, so a key never holds more rows than there are days.
    """
    anchored = by_day.withColumn("_last", F.max("date").over(Window.partitionBy("_k", *keys)))
    return anchored.groupBy("_k", *keys).agg(
        F.max("date").alias("_latest_date"),
        F.count("date").alias("_days"),
        F.count(_recent("date")).alias("_window_days"),
        F.max_by("_first", "date").alias("_latest"),
        *[F.sum(_recent(f"_n_{m}")).alias(f"_wn_{m}") for m in measures],
        *[F.sum(_recent(f"_s_{m}")).alias(f"_ws_{m}") for m in measures],
        *extra,
    )


def _windowed_change(latest: Column, average: Column) -> Column:
    """A change needs at least two days in the window."""
    return F.when(F.col("_window_days") >= 2, pct_change(latest, average))


def market_summary(trades: DataFrame, keys: Sequence[str] = SUMMARY_KEY,
                   tie: Sequence[str] = (), benchmark: Sequence[str] | None = ("state", "price_unit")) -> DataFrame:
    """Latest prices, trailing 7-day averages and changes per market line.

    With `benchmark` each line is compared with the group's most recent line.
    """
    fields = ["min_price", "modal_price", "max_price", "arrival_quantity", "arrival_units"]
    measures = ["modal_price", "arrival_quantity"]
    by_day = _by_day(trades, keys, tie, fields, measures)
    w = _window_metrics(by_day, keys, measures)
    avg_price = mean_of(F.col("_ws_modal_price"), F.col("_wn_modal_price"))
    avg_arrival = mean_of(F.col("_ws_arrival_quantity"), F.col("_wn_arrival_quantity"))
    out = w.select(
        *keys,
        F.col("_latest_date").alias("latest_date"),
        F.col("_days").alias("days_of_history"),
        F.col("_latest.min_price").alias("latest_min_price"),
        F.col("_latest.modal_price").alias("latest_modal_price"),
        F.col("_latest.max_price").alias("latest_max_price"),
        F.col("_latest.arrival_quantity").alias("latest_arrival_quantity"),
        avg_price.alias("avg_modal_price_7d"),
        avg_arrival.alias("avg_arrival_quantity_7d"),
        _windowed_change(F.col("_latest.modal_price"), avg_price).alias("modal_price_change_pct_7d"),
        _windowed_change(F.col("_latest.arrival_quantity"), avg_arrival).alias("arrival_change_pct_7d"),
        F.coalesce(F.col("_latest.arrival_units"), F.lit("")).alias("arrival_units"),
    )
    return attach_benchmark(out, keys, list(benchmark)) if benchmark else out


def latest_benchmark(summary: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Per group, the price of the most recent line; the greatest key wins a tie."""
    order = F.struct("latest_date", *[k for k in keys if k not in group])
    return summary.groupBy(*group).agg(
        F.max_by(F.struct("latest_modal_price"), order).alias("_b")
    ).select(*group, F.col("_b.latest_modal_price").alias("state_latest_modal_price"))


def attach_benchmark(summary: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Each line with its group's benchmark; the lines are written first, since both sides of the join read them."""
    summary = materialized(summary, "market_lines")
    joined = summary.join(latest_benchmark(summary, keys, group), list(group), "left")
    return joined.withColumn("modal_pct_vs_state_latest", pct_change(
        F.col("latest_modal_price"), F.col("state_latest_modal_price")))


def state_market_summary(summary: DataFrame, keys: Sequence[str] = SUMMARY_KEY,
                         group: Sequence[str] = ("state", "price_unit")) -> DataFrame:
    """First non-null latest price in key order, number of markets and commodities."""
    order = F.struct(*[k for k in keys if k not in group])
    priced = F.col("latest_modal_price").isNotNull()
    return summary.groupBy(*group).agg(
        F.min_by("latest_modal_price", F.when(priced, order)).alias("latest_modal_price"),
        F.count_distinct("apmc").alias("markets"),
        F.count_distinct("commodity").alias("commodities"),
    )


def commodity_block(trades: DataFrame, price_unit: str | None = PRICE_UNIT,
                    keys: Sequence[str] = ("district", "commodity"), tie: Sequence[str] = ()) -> DataFrame:
    """Market aggregates per district and commodity within one price unit.

    The latest record is the one of the alphabetically first market. Markets are folded
    into days before the window, so no task holds days times markets. They are counted in a
    scan of their own that combines them before its shuffle and needs no sort.
    """
    rows = in_unit(trades, price_unit, "price_unit")
    fields = ["min_price", "modal_price", "max_price"]
    by_market = _by_day(rows, keys, tie, fields, ["modal_price"], within=["apmc"])
    by_day = by_market.groupBy("_k", "date", *keys).agg(
        F.min_by("_first", F.struct("apmc")).alias("_first"),
        F.sum("_n_modal_price").alias("_n_modal_price"), F.sum("_s_modal_price").alias("_s_modal_price"))
    metrics = _window_metrics(by_day, keys, ["modal_price"], [F.sum("_n_modal_price").alias("n_market_records")])
    markets = _with_keys(rows, [*keys, "date"]).groupBy(*keys).agg(F.count_distinct("apmc").alias("n_markets"))
    w = metrics.join(markets, list(keys))
    avg_price = mean_of(F.col("_ws_modal_price"), F.col("_wn_modal_price"))
    return w.select(
        *keys,
        "n_market_records",
        "n_markets",
        F.col("_latest_date").alias("latest_market_date"),
        F.col("_latest.modal_price").alias("latest_modal_price"),
        F.col("_latest.min_price").alias("latest_min_price"),
        F.col("_latest.max_price").alias("latest_max_price"),
        avg_price.alias("avg_modal_price_7d"),
        _windowed_change(F.col("_latest.modal_price"), avg_price).alias("modal_price_change_pct_7d"),
    )


def daily_region_market(market: DataFrame, region: str = "district") -> DataFrame:
    """Mean price and summed arrivals per region and day, 2 decimals."""
    return market.groupBy(F.col(region).alias("region_name"), "date").agg(
        F.round(F.avg("market_price_inr_per_quintal"), 2).alias("avg_market_price_inr_per_quintal"),
        F.round(F.sum("arrivals_quintal"), 2).alias("total_arrivals_quintal"),
    )


def daily_trend(trades: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """Mean modal price and total arrivals per day; no arrivals count as zero."""
    return trades.groupBy(*by).agg(
        F.avg("modal_price").alias("modal_price"),
        F.coalesce(F.sum("arrival_quantity"), F.lit(0.0)).alias("arrival_quantity"),
    )


def dominant_unit(trades: DataFrame, by: Sequence[str], unit: str = "price_unit") -> DataFrame:
    """The most frequent unit per slice; the smallest name wins a tie."""
    counts = _with_keys(trades, [*by, unit]).groupBy(*by, unit).agg(F.count(F.lit(1)).alias("records"))
    return keep_first(counts, by, [F.col("records").desc(), F.col(unit)])


def in_dominant_unit(trades: DataFrame, by: Sequence[str], unit: str = "price_unit") -> DataFrame:
    """Rows in each slice's dominant unit; slices without any unit keep all rows."""
    best = dominant_unit(trades, by, unit).select(*by, F.col(unit).alias("_unit"))
    return (trades.join(best, list(by), "left")
            .where(F.col("_unit").isNull() | (F.col("_unit") == F.col(unit))).drop("_unit"))


def price_span(trades: DataFrame, by: Sequence[str]) -> DataFrame:
    """Highest modal of the latest day and the min / modal / max span per slice."""
    per_day = trades.groupBy(*by, "date").agg(
        F.max("modal_price").alias("_day_modal"), F.min("min_price").alias("_lo"),
        F.max("max_price").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    return per_day.groupBy(*by).agg(
        F.max("date").alias("latest_date"),
        F.max_by(F.struct("_day_modal"), "date").alias("_latest"),
        F.min("_lo").alias("min_price"),
        F.max("_day_modal").alias("modal_price"),
        F.max("_hi").alias("max_price"),
        F.sum("_n").alias("records"),
    ).select(*by, "latest_date", F.col("_latest._day_modal").alias("latest_modal_price"),
             "min_price", "modal_price", "max_price", "records")


def with_signal(summary: DataFrame) -> DataFrame:
    return summary.withColumn("signal", market_signal(F.col("modal_price_change_pct_7d")))
