"""Session settings and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "fieldmart", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC days.

    On a cluster `master` and `shuffle_partitions` stay unset: the submit command
    decides them, and adaptive execution coalesces or splits shuffle partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for a table that later steps read.

    It lies under the shared folder of `spark.checkpoint.dir`. Where that is unset, it lies
    under the warehouse folder, which every executor of a session shares as well; so the
    rule is the same for every master, and nothing goes to a machine's own temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/fieldmart/{label}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the scratch folder, for results that several steps read."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
