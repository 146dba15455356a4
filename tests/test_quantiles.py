import math
import random
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldmart.operators.quantiles import attach_quantiles, group_quantiles, ordered_image

PROBS = {"lo": 0.333, "mid": 0.5, "hi": 0.667, "first": 0.0, "last": 1.0}
number = st.floats(-1e9, 1e9, allow_nan=False).map(lambda v: round(v, 3)) | st.sampled_from([0.0, 1.0, 1.0, -1.0, 1e-9])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), number), min_size=1, max_size=40))
def test_equals_numpy_for_any_values(spark, data):
    df = spark.createDataFrame(data, "k string, v double")
    for split_values in (100_000, 0):  # 0 splits every bucket
        for r in group_quantiles(df, ["k"], "v", PROBS, split_values=split_values).collect():
            values = [v for k, v in data if k == r["k"]]
            for name, p in PROBS.items():
                assert r[name] == pytest.approx(float(np.quantile(values, p)), rel=1e-9, abs=1e-9)


def test_one_hot_group_and_one_hot_value(spark):
    """A group with most rows, most of them one value, is counted rather than gathered."""
    df = spark.range(60000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") % 977).cast("double") / 7).alias("v"))
    got = {r["k"]: r["m"] for r in group_quantiles(df, ["k"], "v", {"m": 0.5}).collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert got == pytest.approx(want)


def test_nulls_are_ignored_and_empty_groups_absent(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None), ("b", 4.0)], "k string, v double")
    assert [tuple(r) for r in group_quantiles(df, ["k"], "v", {"m": 0.5}).collect()] == [("b", 2.5)]
    assert group_quantiles(df.where("k = 'a'"), [], "v", {"m": 0.5}).collect() == []


def test_attached_to_every_row_without_a_join(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 7)], "i int, v double")
    out = attach_quantiles(df, df, {"lo": ("v", 0.333), "hi": ("v", 0.667)})
    assert {(round(r["lo"], 3), round(r["hi"], 3)) for r in out.collect()} == {(2.665, 4.335)}
    none = attach_quantiles(df, df.where("false"), {"lo": ("v", 0.333)})
    assert {r["lo"] for r in none.collect()} == {None}


def test_image_keeps_the_order_of_all_doubles(spark):
    rng = random.Random(9)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, -math.inf, 1.0, 2.0, 0.5]
    values += [2.0**e for e in range(-1074, 1024)] + [math.nextafter(2.0**e, w) for e in range(-1070, 1020, 3) for w in (0, math.inf)]
    values += [-v for v in values] + [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(4000)]
    values = [v for v in values if not math.isnan(v)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_image(F.col("v")).alias("i")).collect()
    for r in got:
        bits = struct.unpack("q", struct.pack("d", abs(r["v"])))[0]
        assert r["i"] == (-bits if r["v"] < 0 else bits)


def narrow(spark, n):
    """Distinct values of one group within a hundredth of a percent, in a few buckets of the image."""
    return spark.range(n).select(F.lit("hot").alias("k"), (1000 + F.col("id") * (0.1 / n)).alias("v")).repartition(8)


def test_values_within_a_hundredth_of_a_percent(spark):
    df = narrow(spark, 120_000)
    got = group_quantiles(df, ["k"], "v", PROBS, split_values=5_000).first()
    values = np.array([r["v"] for r in df.select("v").toLocalIterator()])
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_no_task_orders_a_crowded_bucket(spark):
    """Of 120,000 values in one bucket the last window sees one part of it."""
    df = narrow(spark, 120_000)
    image = ordered_image(F.col("v"))
    per_bucket = df.groupBy(F.shiftright(image, 40)).count().agg(F.max("count")).first()[0]
    per_part = df.groupBy(F.shiftright(image, 20)).count().agg(F.max("count")).first()[0]
    assert per_bucket > 100_000 / 4 and per_part < 100
