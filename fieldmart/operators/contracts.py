"""Declared data contracts, checked lazily for all rules in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fieldmart.functions.text import SPACES, strip
from fieldmart.session import scratch_path

#: The characters that count as blank, as a SQL literal.
SPACE_TEXT = "'" + "".join(f"\\u{ord(c):04x}" for c in SPACES) + "'"


class ContractViolation(Exception):
    """A table failed its gate; the message names the reject location."""


@dataclass(frozen=True)
class Col:
    """A contract column: type, nullability and bounds (null always meets bounds)."""

    name: str
    type: str
    nullable: bool = False
    low: float | None = None
    high: float | None = None
    length: int | None = None


@dataclass(frozen=True)
class Check:
    """A row rule: SQL condition that must not be false."""

    name: str
    condition: str


@dataclass(frozen=True)
class Contract:
    name: str
    columns: Sequence[Col]
    checks: Sequence[Check] = field(default_factory=tuple)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


# The published contracts (types, nullability, bounds and rules).
WEATHER = Contract("weather", [
    Col("region_name", "string"),
    Col("date", "timestamp"),
    Col("temp_max_c", "double", low=-40, high=55),
    Col("temp_min_c", "double", low=-50, high=45),
    Col("precipitation_mm", "double", low=0),
    Col("humidity_pct", "double", low=0, high=100),
    Col("windspeed_max_kmh", "double", low=0),
], [Check("temp_max_c must be >= temp_min_c", "temp_max_c >= temp_min_c")])

GEO = Contract("geo", [
    Col("region_name", "string"),
    Col("state_ut", "string"),
    Col("state_code", "string", length=2),
    Col("district", "string"),
    Col("mandi_apmc", "string"),
    Col("latitude", "double", low=6, high=37),
    Col("longitude", "double", low=68, high=98),
])

MARKET_ROWS = Contract("market", [
    Col("commodity", "string"),
    Col("variety", "string", nullable=True),
    Col("state_ut", "string"),
    Col("district", "string"),
    Col("mandi", "string"),
    Col("date", "timestamp"),
    Col("market_price_inr_per_quintal", "double", low=0),
    Col("arrivals_quintal", "double", low=0),
])

AGRICULTURE = Contract("india_agriculture", [
    Col("id", "long"),
    Col("year", "string"),
    Col("year_start", "int", nullable=True, low=1900),
    Col("state", "string"),
    Col("state_code", "long", nullable=True, low=0),
    Col("district", "string"),
    Col("district_code", "long", nullable=True, low=0),
    Col("crop", "string"),
    Col("crop_type", "string", nullable=True),
    Col("season", "string"),
    Col("area", "double", low=0),
    Col("production", "double", nullable=True, low=0),
    Col("yield", "double", nullable=True, low=0),
], [
    Check("a row must carry area, production, or yield",
          "production is not null or `yield` is not null or area is not null"),
    Check("season must be non-empty when present", f"trim(BOTH {SPACE_TEXT} FROM season) <> ''"),
])

TRADES = Contract("india_mandi", [
    Col("date", "timestamp"),
    Col("state", "string"),
    Col("state_code", "string", nullable=True),
    Col("district", "string"),
    Col("district_code", "string", nullable=True),
    Col("apmc", "string"),
    Col("market_center_code", "string", nullable=True),
    Col("commodity", "string"),
    Col("commodity_id", "string", nullable=True),
    Col("variety", "string"),
    Col("grade", "string", nullable=True),
    Col("min_price", "double", nullable=True, low=0),
    Col("modal_price", "double", nullable=True, low=0),
    Col("max_price", "double", nullable=True, low=0),
    Col("price_unit", "string", nullable=True),
    Col("arrival_quantity", "double", nullable=True, low=0),
    Col("arrival_units", "string", nullable=True),
], [
    Check("commodity must be a non-empty string", f"trim(BOTH {SPACE_TEXT} FROM commodity) <> ''"),
    Check("apmc must be a non-empty string", f"trim(BOTH {SPACE_TEXT} FROM apmc) <> ''"),
    Check("min_price must be <= modal_price when both present", "min_price <= modal_price"),
    Check("modal_price must be <= max_price when both present", "modal_price <= max_price"),
])


def _failure(column: str, check: str, case: Column) -> Column:
    return F.struct(F.lit(column).alias("column"), F.lit(check).alias("check"),
                    case.cast("string").alias("failure_case"))


def _number(bound: float) -> str:
    return f"{bound:g}"


def _bound_check(c: Col) -> tuple[str, Column] | None:
    value = F.col(c.name)
    if c.length is not None:
        return f"str_length({c.length}, {c.length})", F.length(value) == c.length
    if c.low is not None and c.high is not None:
        return f"in_range({_number(c.low)}, {_number(c.high)})", value.between(c.low, c.high)
    if c.low is not None:
        return f"greater_than_or_equal_to({_number(c.low)})", value >= c.low
    return None


def _typed_rules(df: DataFrame, contract: Contract) -> tuple[DataFrame, list[tuple[str, str, Column, Column]]]:
    """The coerced table and its rules: column, check, broken condition, failure case.

    A raw value that the type cannot hold is kept as text in a `_raw_` column.
    """
    missing = [n for n in contract.column_names if n not in df.columns]
    if missing:
        raise ContractViolation(f"{contract.name}: missing columns {missing}")
    present = dict(df.dtypes)
    cast = [c for c in contract.columns if present[c.name] != c.type.replace("long", "bigint")]
    typed = df.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in contract.column_names],
        *[F.col(f"`{c.name}`").try_cast(c.type).alias(c.name) if c in cast else F.col(f"`{c.name}`")
          for c in contract.columns],
        *[F.when(F.col(f"`{c.name}`").try_cast(c.type).isNull(), F.col(f"`{c.name}`").cast("string"))
          .alias(f"_raw_{c.name}") for c in cast])
    rules: list[tuple[str, str, Column, Column]] = []
    for c in contract.columns:
        value, coerced = F.col(f"`{c.name}`"), F.lit(False)
        if c in cast:
            raw = F.col(f"_raw_{c.name}")
            coerced = raw.isNotNull()
            rules.append((c.name, f"coerce_dtype('{c.type}')", coerced, raw))
        if not c.nullable:
            rules.append((c.name, "not_nullable", value.isNull() & ~coerced, F.lit(None)))
        bound = _bound_check(c)
        if bound:
            rules.append((c.name, bound[0], ~bound[1], value))
    rules += [("", check.name, ~F.expr(check.condition), F.lit("false")) for check in contract.checks]
    return typed, rules


def check_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Coerce the contract columns and add `_violations`, one entry per broken rule.

    Columns outside the contract are kept. A missing contract column is an error.
    """
    typed, rules = _typed_rules(df, contract)
    found = F.array(*[F.when(bad, _failure(column, check, case)) for column, check, bad, case in rules])
    helpers = [c for c in typed.columns if c.startswith("_raw_") and c not in df.columns]
    return typed.withColumn("_violations", F.array_compact(found)).drop(*helpers)


def clean_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("_violations") == 0).drop("_violations")


def offending_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("_violations") > 0)


def failure_report(checked: DataFrame, contract: Contract) -> DataFrame:
    """Long form: dataset, column, check, failure_case."""
    return checked.select(F.lit(contract.name).alias("dataset"), F.inline("_violations"))


def failure_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """Failures per column and rule: one pass of counters, no row is shuffled."""
    typed, rules = _typed_rules(df, contract)
    counted = typed.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad, _) in enumerate(rules)])
    entries = F.array(*[
        F.struct(F.lit(contract.name).alias("dataset"), F.lit(column).alias("column"),
                 F.lit(check).alias("check"), F.col(f"r{i}").alias("failures"))
        for i, (column, check, _, _) in enumerate(rules)])
    return counted.select(F.inline(entries)).where(F.col("failures") > 0)


def validate(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(clean rows, report of all failures)."""
    checked = check_rows(df, contract)
    return clean_rows(checked), failure_report(checked, contract)


def gate(df: DataFrame, contract: Contract, rejects: str) -> DataFrame:
    """The clean table, or write failures and offending rows and raise.

    The checked table is computed and written once, and its failures are counted while it
    is written; what follows reads what was written.
    """
    seen, path = Observation(), scratch_path(df.sparkSession, f"gate-{contract.name}")
    bad = F.count_if(F.size("_violations") > 0).alias("bad")
    check_rows(df, contract).observe(seen, bad).write.parquet(path)
    checked = df.sparkSession.read.parquet(path)
    if not seen.get["bad"]:
        return checked.drop("_violations")
    failure_report(checked, contract).write.mode("overwrite").json(f"{rejects}/{contract.name}_rejects")
    offending_rows(checked).write.mode("overwrite").parquet(f"{rejects}/{contract.name}_rows")
    raise ContractViolation(f"data quality gate failed for {contract.name}, see {rejects}")


def project(df: DataFrame, contract: Contract) -> DataFrame:
    """Only the contract columns, in contract order."""
    return df.select(*[F.col(f"`{n}`") for n in contract.column_names])


def blank(column: str) -> Column:
    return F.coalesce(strip(F.col(column).cast("string")), F.lit("")) == ""


def gate_outcome(df: DataFrame, contract: Contract, rejects: str) -> DataFrame:
    """What the gate does, as one row: dataset, offending_rows, outcome."""
    spark = df.sparkSession
    try:
        gate(df, contract, rejects)
        bad = spark.range(1).select(F.lit(0).cast("long").alias("offending_rows"))
    except ContractViolation:
        bad = spark.read.parquet(f"{rejects}/{contract.name}_rows").agg(F.count("*").alias("offending_rows"))
    return bad.select(F.lit(contract.name).alias("dataset"), "offending_rows",
                      F.when(F.col("offending_rows") > 0, "stopped").otherwise("passed").alias("outcome"))
