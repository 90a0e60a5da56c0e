"""Queries against their SQL on tables where one user, customer and order hold a third of all rows."""

import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from farelake.plans.fixtures import TABLES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
HOT = {"events": ("user_id", 8), "orders": ("o_custkey", 7), "lineitem": ("l_orderkey", 1)}
QUERIES = [
    "upsert_latest", "fold_attempts", "final_state", "seed_missing", "coverage_gap", "progress_steps", "echo_median",
    "evict_blacklist", "prefilter_until", "source_yield", "rate_burst", "rate_trace", "snapshot_decision", "weighted_pick",
    "cheapest_snapshot", "price_trend", "price_anomaly", "route_comparison", "booking_window", "airline_comparison",
    "top_outbound", "round_trip_pairs", "expand_outcome", "silver_write", "stream_upsert", "stream_endpoint_state",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        if name not in HOT:
            shutil.copyfile(f"{SF}/{name}.parquet", folder / f"{name}.parquet")
            continue
        key, value = HOT[name]
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        if name == "orders":
            value_of = F.when(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0, value).otherwise(F.col(key))
        else:
            value_of = F.when(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0, value).otherwise(F.col(key))
        pdf = df.withColumn(key, value_of.cast("bigint")).toPandas()
        pdf.to_parquet(folder / f"{name}.parquet", index=False, coerce_timestamps="us")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_tables(spark, skewed, name):
    assert compare(entry.queries()[name](spark, skewed), connect(skewed), entry.oracle_sql()[name]) is None
