"""The skew-proof helpers against plain Python, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from farelake.functions.common import floor_div
from farelake.operators import scaling


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(9)}", i, rng.randrange(40)) for i in range(3000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, pos long, v int").repartition(6)


@pytest.mark.parametrize("block", [1, 7, 100, 10**9])
def test_running_total(hot, block):
    rows, df = hot
    got = scaling.running_total(df, ["k"], floor_div("pos", block), ["pos"], F.col("v"), "t")
    want, sums = {}, {}
    for k, pos, v in sorted(rows, key=lambda r: r[1]):
        sums[k] = sums.get(k, 0) + v
        want[pos] = sums[k]
    assert {r["pos"]: r["t"] for r in got.collect()} == want


def test_running_total_without_keys_and_negative_positions(spark):
    df = spark.createDataFrame([(i, 1) for i in range(-20, 20)], "pos long, v int")
    got = scaling.running_total(df, [], floor_div("pos", 3), ["pos"], F.col("v"), "t")
    assert {r["pos"]: r["t"] for r in got.collect()} == {i: i + 21 for i in range(-20, 20)}


@pytest.mark.parametrize("n", [0, 1, 3, 1200])
def test_top_n(hot, n):
    rows, df = hot
    got = scaling.top_n(df, ["k"], ["pos"], n, salts=4)
    want = set()
    for key in {r[0] for r in rows}:
        want |= set(sorted(r[1] for r in rows if r[0] == key)[:n])
    assert {r["pos"] for r in got.collect()} == want


def test_top_n_is_trimmed_before_the_shuffle(hot):
    _, df = hot
    plan = scaling.top_n(df, ["k"], ["pos"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 3, Partial" in plan


def test_latest_takes_the_whole_last_row(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, seq int, v string")
    assert rows(scaling.latest(df, ["k"], ["seq"])) == [("a", 2, None), ("b", 1, "y")]


@pytest.mark.parametrize("most", [3, 10**6])
def test_order_statistics(hot, most):
    rows, df = hot
    got = scaling.order_statistics(df, ["k"], "v", {"low": F.lit(1), "mid": floor_div("_n", 2) + 1}, most)
    for r in got.collect():
        values = sorted(v for k, _, v in rows if k == r["k"])
        assert (r["_n"], r["low"], r["mid"]) == (len(values), values[0], values[len(values) // 2])


def test_percentiles_interpolate(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 10.0), ("a", 11.0), ("b", 5.0)], "k string, v double")
    got = {r["k"]: (r["q1"], r["q2"]) for r in scaling.percentiles(df, ["k"], "v", {"q1": 0.25, "q2": 0.5}).collect()}
    assert got == {"a": (1.75, 6.0), "b": (5.0, 5.0)}


@pytest.mark.parametrize("scale", ["0..1", "mixed"])
def test_values_of_one_hot_key_stay_spread(spark, scale, monkeypatch):
    """Whatever the values look like, a window sees ranges or few values, and the ranks are exact."""
    monkeypatch.setattr(scaling, "RANGES", 64)
    rng = random.Random(5)
    make = {
        "0..1": rng.random,
        "mixed": lambda: rng.choice([0.0, 1e-9 * rng.randrange(500), 1e12 + rng.random(), 10 ** rng.uniform(-200, 200), float("inf"), float("-inf")]),
    }[scale]
    values = [("hot", make()) for _ in range(4000)] + [("none", None), (None, 7.5), ("hot", None)]
    df = spark.createDataFrame(values, "k string, v double").repartition(5)
    ranks = {"first": F.lit(1), "third": floor_div("_n", 3) + 1, "last": F.col("_n"), "beyond": F.col("_n") + 1}
    totals = {"rows": F.sum("_cnt"), "least": F.min("_v")}
    got = {r["k"]: r for r in scaling.order_statistics(df, ["k"], "v", ranks, most=50, totals=totals).collect()}
    hot = sorted(v for k, v in values if k == "hot" and v is not None)
    assert [got["hot"][c] for c in ("_n", "first", "third", "last", "beyond", "rows", "least")] == [4000, hot[0], hot[1333], hot[-1], None, 4001, hot[0]]
    assert [got[None][c] for c in ("_n", "first", "last")] == [1, 7.5, 7.5]
    assert (got["none"]["_n"], got["none"]["first"], got["none"]["rows"]) == (0, None, 1)


def test_statistics_scan_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("id % 3 AS k", "cast(id AS double) AS v").mapInArrow(count, "k long, v double")
    got = scaling.percentiles(df, ["k"], "v", {"q": 0.5}, {"n": F.sum("_cnt")}, most=20)
    assert {r["k"]: r["q"] for r in got.collect()} == {0: 499.5, 1: 499.0, 2: 500.0} and seen.value == 1000
