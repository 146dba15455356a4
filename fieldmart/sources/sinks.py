"""Layer writes, manifests, lineage and exports."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldmart.functions.text import strip
from fieldmart.operators.contracts import Contract, ContractViolation, check_rows, gate

FORMAT = "parquet"


def write_table(df: DataFrame, path: str, fmt: str = FORMAT, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table, optionally partitioned.

    For a partitioned table the rebalance hint brings rows of one value together and
    lets adaptive execution split a value that is too large for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path)


def write_bronze(df: DataFrame, folder: str, name: str, stamp: str, raw: DataFrame | None = None,
                 **provenance: str | None) -> DataFrame:
    """Raw copy, normalized batch and provenance record; returns the record.

    The row count is observed while writing, not by a second job.
    """
    if raw is not None:
        raw.write.mode("overwrite").json(f"{folder}/raw/{name}_raw_{stamp}")
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("row_count"))
     .write.mode("overwrite").parquet(f"{folder}/{name}_normalized_{stamp}"))
    record = df.sparkSession.range(1).select(
        F.lit("success").alias("status"),
        *[F.lit(v).cast("string").alias(k) for k, v in provenance.items()],
        F.lit(stamp).alias("retrieved_at"),
        F.lit(seen.get["row_count"]).cast("long").alias("row_count"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"))
    record.write.mode("overwrite").json(f"{folder}/meta/{name}_{stamp}")
    return record


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a written folder in the place of a table: one rename in the file system that holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path
    files = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(folder(path), True)
    files.mkdirs(folder(path).getParent())
    if not files.rename(folder(staged), folder(path)):
        raise OSError(f"could not move {staged} to {path}")


def write_silver(df: DataFrame, contract: Contract, path: str, rejects: str) -> DataFrame:
    """Write, audit, publish: the table is written once, next to its place, and moved there if no row failed.

    Failures are counted while it is written. A failing table is not published: the gate then writes its failures and
    offending rows and raises; what was staged is left out of the way of readers.
    """
    spark, seen = df.sparkSession, Observation()
    staged = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex}"
    checked = check_rows(df, contract)
    passed = F.size("_violations") == 0
    flagged = checked.withColumn("passed", passed).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(~passed).alias("bad")).drop("_violations")
    flagged.write.partitionBy("passed").parquet(staged)
    if seen.get["bad"]:
        gate(df, contract, rejects)
    if seen.get["rows"]:
        publish(spark, f"{staged}/passed=true", path)
    else:
        checked.drop("_violations").limit(0).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def manifest(df: DataFrame, dataset: str, status: str = "success", inputs: Sequence[str] = (),
             outputs: Sequence[str] = (), date: str | None = None, distinct: Sequence[str] = (),
             matched: dict[str, Column] | None = None, generated_at: str | None = None) -> DataFrame:
    """One row: schema, period, row, distinct and matched counts from one aggregation."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if date:
        aggs += [F.min(date).cast("date").cast("string").alias("first_date"),
                 F.max(date).cast("date").cast("string").alias("last_date")]
    aggs += [F.count_distinct(c).alias(f"n_{c}") for c in distinct]
    aggs += [F.count_if(c).alias(n) for n, c in (matched or {}).items()]
    stamp = F.lit(generated_at) if generated_at else F.current_timestamp().cast("string")

    def texts(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return df.agg(*aggs).select(
        F.lit(dataset).alias("dataset"), F.lit(status).alias("status"),
        texts(inputs).alias("input"), texts(outputs).alias("output"), texts(df.columns).alias("schema"),
        stamp.alias("generated_at"), F.struct("*").alias("metrics"))


def no_data_manifest(spark: SparkSession, dataset: str, reason: str, missing: Sequence[str] = ()) -> DataFrame:
    return spark.range(1).select(
        F.lit(dataset).alias("dataset"), F.lit("no_data").alias("status"), F.lit(reason).alias("reason"),
        F.array(*[F.lit(m) for m in missing]).cast("array<string>").alias("missing"),
        F.current_timestamp().cast("string").alias("generated_at"))


def as_json(df: DataFrame, name: str = "document") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(name))


LINEAGE = ["dataset", "status", "input", "output", "schema", "generated_at"]


def lineage(manifests: Sequence[DataFrame]) -> DataFrame:
    """One row per output table; fields a manifest lacks are null."""
    rows = [m.select(*[c for c in LINEAGE if c in m.columns]) for m in manifests]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def monitored_subset(df: DataFrame, geo: DataFrame, column: str = "district") -> DataFrame:
    """Rows of monitored districts, by trimmed equality."""
    known = geo.select(strip(F.col("district")).alias("_d")).distinct()
    return df.withColumn("_d", strip(F.col(column))).join(known, "_d", "left_semi").drop("_d")


def export(df: DataFrame, path: str, fmt: str = FORMAT) -> None:
    """A report table as a folder of part files, each written by its own task."""
    df.write.format(fmt).mode("overwrite").save(path)


def run_metadata(steps: Sequence[tuple[str, str, str, DataFrame | None]]) -> DataFrame:
    """One row per (step, status, output, rows frame) with its row count."""
    def row(step: str, status: str, output: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(step).alias("step"), F.lit(status).alias("status"), F.lit(output).alias("output"), "rows")

    return reduce(DataFrame.unionByName, [row(*s) for s in steps])


class StepSkipped(Exception):
    """A step that may not run; it leaves the status and, if any, the rows that say why."""

    def __init__(self, status: str, rows: DataFrame | None = None):
        super().__init__(status)
        self.status, self.rows = status, rows


def run_steps(spark: SparkSession, steps: Sequence[tuple[str, str, Callable[[], DataFrame]]]) -> DataFrame:
    """Run (step, output, build) one after another and record what happened to each: step, status, output, rows.

    A build returns its rows, or raises `StepSkipped`, or stops at a contract's gate; the next steps run all the same.
    Any other error is a fault and is raised.
    """
    found = []
    for step, output, build in steps:
        try:
            status, rows = "success", build()
        except StepSkipped as skipped:
            status, rows = skipped.status, skipped.rows
        except ContractViolation:
            status, rows = "stopped_at_gate", None
        found.append((step, status, output, rows if rows is not None else spark.range(0)))
    return run_metadata(found)
