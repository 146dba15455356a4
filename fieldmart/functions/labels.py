"""Rule labels: signals, terciles and combined levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def market_signal(change_pct: Column, band: float = 2.0) -> Column:
    """rising above +band percent, falling below -band percent, else stable."""
    return (F.when(change_pct > band, "rising").when(change_pct < -band, "falling")
            .otherwise("stable"))


def tercile_label(value: Column, low: Column, high: Column) -> Column:
    """Strictly below the lower tercile is Low, strictly above the upper one High."""
    return (F.when(low.isNull() | high.isNull(), "n/a").when(value < low, "Low")
            .when(value > high, "High").otherwise("Moderate"))


def strongest_level(*levels: Column) -> Column:
    """High if any is High, else Low if any is Low, else Moderate."""
    seen = F.array(*levels)
    return (F.when(F.array_contains(seen, "High"), "High")
            .when(F.array_contains(seen, "Low"), "Low").otherwise("Moderate"))


def weather_window(day: Column, ingested_on) -> Column:
    """observed up to the ingestion day, forecast after it; all observed when unknown."""
    if ingested_on is None:
        return F.lit("observed")
    cut = ingested_on if isinstance(ingested_on, Column) else F.lit(ingested_on)
    return F.when(day > cut.try_cast("date"), "forecast").otherwise("observed")
