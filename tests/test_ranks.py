"""Row numbers over a table and over groups, against plain Python, and their plans."""

import random

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import panel as P
from fieldmart.operators import ranks
from fieldmart.operators import segments as G
from tests.conftest import rows


@pytest.fixture(scope="module")
def crowded(spark):
    """Nearly all rows in one group, null keys, ties and nulls in the order."""
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.9 else rng.choice(["a", "b", None]), rng.choice([None, *range(400)]), i) for i in range(5000)]
    return spark.createDataFrame(data, "g string, v int, i long").repartition(16)


def test_places_of_a_table(crowded):
    got = sorted(ranks.with_place(crowded, [F.col("v").asc_nulls_first()]).collect(), key=lambda r: r.place)
    assert [r.place for r in got] == list(range(5000)) and len({r.i for r in got}) == 5000
    values = [-1 if r.v is None else r.v for r in got]
    assert values == sorted(values)


def test_places_in_groups(crowded):
    got = ranks.with_group_place(crowded, ["g"], ["v", "i"], "at", size="n").collect()
    expected = {}
    for g in ("hot", "a", "b", None):
        own = sorted((r for r in got if r.g == g), key=lambda r: (r.v is not None, r.v, r.i))
        expected |= {r.i: (k, len(own)) for k, r in enumerate(own)}
    assert {r.i: (r["at"], r.n) for r in got} == expected and len(got) == 5000


def test_equal_rows_are_dealt_out(spark):
    same = spark.range(20_000).select(F.lit("x").alias("g"))
    placed = ranks.with_place(same, ["g"])
    assert placed.agg(F.min("place"), F.max("place"), F.count_distinct("place")).first() == (0, 19_999, 20_000)


def test_empty_table(crowded):
    assert ranks.with_group_place(crowded.limit(0), ["g"], ["v"], "at").count() == 0
    assert ranks.with_place(crowded.limit(0), ["v"]).count() == 0


def test_codes_keep_nulls_and_strangers_apart(spark):
    known = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "d string")
    asked = spark.createDataFrame([("a",), ("c",), ("zz",), (None,)], "d string")
    got = {r.d: r.d_ordinal for r in ranks.with_codes(asked, known, ["d"]).collect()}
    assert got == {"a": 0.0, "c": 2.0, "zz": 3.0, None: 3.0}


def windows_without_keys(df):
    """Inputs of windows that have no partition; each must be the table of one row per task."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    return [lines[i + 1:i + 4] for i, line in enumerate(lines) if "Window [" in line]


def test_no_window_over_rows(crowded):
    segments = crowded.select(F.col("g").alias("segment"), F.col("i").cast("string").alias("region_name"))
    for df in (G.names_per_segment(segments), P.with_ordinals(crowded.select(F.col("g").alias("district")), crowded.select(F.col("g").alias("district")), ["district"])):
        for below in windows_without_keys(df):
            assert any("Aggregate [" in line and "_task" in line or "Aggregate [shiftright" in line for line in below), below


def test_one_segment_of_all_rows(spark):
    names = [f"region {i:05d}" for i in random.Random(2).sample(range(3000), 3000)]
    segments = spark.createDataFrame([("only", n) for n in names], "segment string, region_name string").repartition(12)
    got = {r["region_name"]: r["rank"] for r in rows(G.names_per_segment(segments))}
    assert got == {n: i + 1 for i, n in enumerate(sorted(names))}
