"""Queries that read the joined line items several times join them once, with the same results."""

import datetime

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import market as M
from fieldmart.operators import region_features as R
from fieldmart.plans import registered  # noqa: F401  (fills the registry)
from fieldmart.plans.base import QUERIES, Tables
from tests.conftest import rows

DAY = datetime.datetime(1998, 3, 1)
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "NATION_0", 0), (1, "NATION_1", 1)]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int",
                 [(k, f"S{k}", k % 2) for k in range(4)] + [(3, "S3 again", 0), (None, "none", 1)]),
    "part": ("p_partkey long, p_brand string, p_type string, p_size int",
             [(k, f"Brand#{k}", "LARGE" if k % 2 else "SMALL", 10 * k) for k in range(6)] + [(5, "Brand#9", "SMALL", 1)]),
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                 [(i, i % 7 if i % 11 else None, i % 5, i % 3, 1.0 + i % 4, 900.0 + 37 * (i % 13), 0.01 * (i % 3), 0.04 * (i % 3),
                   "ARN"[i % 3], "FO"[i % 2], DAY + datetime.timedelta(days=i % 9)) for i in range(200)] * 2),
    "events": ("event_id long, ts timestamp, user_id long, event_type string, value double",
               [(i, datetime.datetime(2024, 1, 1 + i % 20, i % 24), i % 40, ("view", "error")[i % 2], float(i % 90)) for i in range(200)]),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    for name, (schema, data) in TABLES.items():
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def scans(df, table):
    return df._jdf.queryExecution().optimizedPlan().toString().count(table)


@pytest.mark.parametrize("name", ["Q9_health_report", "A12_source_windows", "X1_check_union", "A10_J6_J7_crop_summary",
                                  "J9_benchmark_change", "Q6_missing_prices"])
def test_the_join_of_line_items_is_in_no_plan(spark, folder, name):
    """Each plan reads what was written once; before, it held two to seven such joins."""
    plan = QUERIES[name](spark, folder)
    assert scans(plan, "l_partkey") == 0
    assert plan.count() > 0


def test_written_tables_equal_the_joined_ones(spark, folder):
    plain = Tables(spark, folder)
    for name in ("trades", "agri"):
        written = getattr(plain.written, name)
        assert written.schema == getattr(plain, name).schema
        assert written.exceptAll(getattr(plain, name)).count() == getattr(plain, name).exceptAll(written).count() == 0


def test_a_days_first_record_is_held_once(spark, trades):
    """The record lies inside its order; a second copy would be sorted and shuffled with it."""
    plan = M.market_summary(trades, tie=["seq"], benchmark=None)._jdf.queryExecution().optimizedPlan().toString()
    assert "AS _first" in plan
    assert "min_by" not in plan


def test_market_block_equals_its_two_blocks(spark, folder):
    t = Tables(spark, folder)
    mapped = R.map_region(t.trades, t.geo)
    mapped = mapped.unionByName(mapped.limit(1).withColumns({
        "modal_price": F.lit(None).cast("double"), "commodity": F.lit(None).cast("string"), "apmc": F.lit(None).cast("string"),
        "price_unit": F.lit("F"), "arrival_units": F.lit(None).cast("string"), "date": F.lit(datetime.date(1990, 1, 1))}))
    whole = R.market_block(mapped, "F", "A")
    apart = R.price_block(mapped, "F").join(R.arrival_block(mapped, "A"), R.KEY, "full").select(*whole.columns)
    assert rows(whole, *R.KEY) == rows(apart, *R.KEY)


def test_markets_are_counted_without_a_second_pass_over_days(spark, folder):
    """The count of markets has its own narrow scan; before, days and records were built twice."""
    plan = M.commodity_block(Tables(spark, folder).trades, "F", tie=["row_id"])._jdf.queryExecution().optimizedPlan().toString()
    records = [line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Aggregate [_k") and "apmc" in line and "min_price" in line]
    assert len(records) == 1
