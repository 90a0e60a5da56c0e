"""Price questions on a small table, worked out in plain Python."""

import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from farelake.operators import gold

SCHEMA = "seq long, route string, dep_date string, return_date string, flight_type string, snapshot_date date, " \
         "price double, primary_airline_name string"
D0 = date(2024, 1, 1)


def offer(seq, price, day=0, airline="A", route="SIN|KUL", dep="2024-03-01"):
    return (seq, route, dep, "", "ONE_WAY", D0 + timedelta(days=day), price, airline)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    return [
        offer(i, rng.randrange(100, 900) / 4, rng.randrange(20), rng.choice("ABC"), rng.choice(["SIN|KUL"] * 4 + ["SIN|BKK"]))
        for i in range(300)
    ]


@pytest.fixture(scope="module")
def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def daily(data):
    """Lowest price per route and day, in day order."""
    best = {}
    for r in data:
        best[(r[1], r[5])] = min(best.get((r[1], r[5]), 1e9), r[6])
    out = {}
    for (route, _), price in sorted(best.items()):
        out.setdefault(route, []).append(price)
    return out


def series(df, column):
    out = {}
    for r in df.orderBy("route", "snapshot_date").collect():
        out.setdefault(r.route, []).append(r[column])
    return out


def test_facts(spark, rows):
    df = spark.createDataFrame(
        [offer(1, 5.0, 3), offer(1, 5.0, 3), offer(2, 0.0), offer(3, None), offer(4, 9.0, dep="2024-13-01"), offer(5, 5.0, 3)], SCHEMA
    )
    got = gold.offer_facts(df).select("seq", "lead_days", "dep_month", "dep_weekday")
    assert rows(got) == [(1, 57, 3, 4), (5, 57, 3, 4)]
    assert rows(gold.quarantined_offers(df).select("seq")) == [(2,), (3,), (4,)]


def test_cheapest_takes_the_earlier_arrival(spark):
    df = spark.createDataFrame([offer(3, 5.0, airline="X"), offer(2, 5.0, airline="Y"), offer(1, 6.0)], SCHEMA)
    r = gold.cheapest_snapshot(df).collect()[0]
    assert (r.price, r.airline, r.n_offers) == (5.0, "Y", 3)


def test_trend_and_features(table, data):
    snaps = gold.cheapest_snapshot(table)
    want = daily(data)
    trend = gold.price_trend(snaps)
    assert series(trend, "change") == {r: [None] + [b - a for a, b in zip(p, p[1:])] for r, p in want.items()}
    for route, means in series(trend, "mean_3").items():
        assert means == pytest.approx([statistics.mean(want[route][max(0, i - 2) : i + 1]) for i in range(len(means))])
    features = gold.forecast_features(snaps)
    assert series(features, "lag_2") == {r: [None, None] + p[:-2] for r, p in want.items()}
    assert series(features, "label") == {r: p[1:] + [None] for r, p in want.items()}


def test_anomaly(table, data):
    got = gold.price_anomaly(gold.cheapest_snapshot(table))
    for route, prices in daily(data).items():
        for i, z in enumerate(series(got, "z")[route]):
            past = prices[max(0, i - 7) : i]
            sd = statistics.pstdev(past) if past else 0
            assert z == (pytest.approx((prices[i] - statistics.mean(past)) / sd) if sd > 0 else None)
    flat = table.withColumn("price", F.lit(80.1))
    assert gold.price_anomaly(gold.cheapest_snapshot(flat)).filter("z is not null or anomaly").count() == 0


def test_routes(table, data):
    got = {r.route: r for r in gold.route_comparison(table).collect()}
    prices = {route: [r[6] for r in data if r[1] == route] for route in got}
    for route, r in got.items():
        assert (r.n_offers, r.min_price) == (len(prices[route]), min(prices[route]))
        assert (r.mean_price, r.median_price) == pytest.approx((statistics.mean(prices[route]), statistics.median(prices[route])))
    order = sorted(got, key=lambda k: got[k].mean_price)
    assert [got[k]["rank"] for k in order] == [1, 2]
    total = gold.route_rollup(table).filter("route is null").collect()[0]
    assert total.n_offers == len(data)


def test_airlines_count_itineraries(table, data):
    got = {(r.route, r.primary_airline_name): r for r in gold.airline_comparison(table).collect()}
    assert sum(r.n_offers for r in got.values()) == len(data)
    assert all(r.n_itineraries == 1 for r in got.values())


def test_booking_window(spark):
    rows = [offer(1, 10.0, dep="2024-01-31"), offer(2, 20.0, dep="2024-02-01"), offer(3, 30.0, dep="2024-04-01"), offer(4, 40.0, dep="2024-04-02")]
    got = {r.bucket: r for r in gold.booking_window(gold.offer_facts(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert {b: r.mean_price for b, r in got.items()} == {"0-30": 10.0, "31-60": 20.0, "91+": 35.0}
    assert got["91+"].price_index == 35.0 / 25.0


def test_stale(table, data):
    for r in gold.stale_age(table, "2024-02-01").collect():
        last = max(x[5] for x in data if x[1] == r.route)
        assert r.age_days == (date(2024, 2, 1) - last).days


def test_a_missing_price_never_wins(spark):
    key = ("SIN|KUL", "2026-08-01", "", "ONE_WAY")
    schema = "route string, dep_date string, return_date string, flight_type string, snapshot_date string, seq long, price double, primary_airline_name string"
    rows = [(*key, "2026-07-01", 1, None, "N"), (*key, "2026-07-01", 2, 100.0, "A"), (*key, "2026-07-01", 3, 90.0, "B"), (*key, "2026-07-02", 4, None, "N")]
    df = spark.createDataFrame(rows, schema).withColumn("snapshot_date", F.to_date("snapshot_date"))
    got = {str(r.snapshot_date): (r.price, r.airline, r.n_offers) for r in gold.cheapest_snapshot(df).collect()}
    assert got == {"2026-07-01": (90.0, "B", 3), "2026-07-02": (None, None, 1)}


def test_offers_of_one_search_and_null_routes_stay(spark):
    key = ("SIN|KUL", "2026-08-01", "", "ONE_WAY", "2026-07-01", 1)
    schema = "route string, dep_date string, return_date string, flight_type string, snapshot_date string, seq long, price double, offer_pos int"
    rows = [(*key, 100.0, 0), (*key, 90.0, 1), (*key, 90.0, 1), (None, *key[1:], 70.0, 0)]
    df = spark.createDataFrame(rows, schema).withColumn("snapshot_date", F.to_date("snapshot_date"))
    assert gold.offer_facts(df).count() == 3
    got = {r.route: (r.n_offers, r.median_price) for r in gold.route_comparison(df).collect()}
    assert got == {"SIN|KUL": (3, 90.0), None: (1, 70.0)}


def test_lead_buckets(spark):
    df = spark.createDataFrame([(d,) for d in (-1, 0, 30, 31, 90, 91, None)], "d int")
    got = [r.b for r in df.select(gold.lead_bucket("d").alias("b")).collect()]
    assert got == ["past", "0-30", "0-30", "31-60", "61-90", "91+", "unknown"]


def test_currencies_stay_apart(spark):
    rows = [(*offer(i, p), c) for i, (p, c) in enumerate([(100.0, "SGD"), (90.0, "VND"), (None, "SGD"), (300.0, "SGD"), (80.0, None)])]
    df = spark.createDataFrame(rows, SCHEMA + ", currency string")
    assert {(r.currency, r.price, r.n_offers) for r in gold.cheapest_snapshot(df).collect()} == {("SGD", 80.0, 4), ("VND", 90.0, 1)}
    assert {(r.currency, r.mean_price, r["rank"]) for r in gold.route_comparison(df).collect()} == {("SGD", 160.0, 1), ("VND", 90.0, 1)}
    assert {(r.currency, r.n_offers, r.mean_price) for r in gold.airline_comparison(df).collect()} == {("SGD", 4, 160.0), ("VND", 1, 90.0)}
    assert gold.route_rollup(df).count() == 6
    raw = df.withColumns({"lead_days": F.lit(5), "dep_month": F.lit(3), "dep_weekday": F.lit(1)})
    assert {(r.currency, r.mean_price, r.price_index) for r in gold.booking_window(raw).collect()} == {("SGD", 160.0, 1.0), ("VND", 90.0, 1.0)}
    assert {(r.currency, r.n_offers) for r in gold.seasonal(raw).collect()} == {("SGD", 4), ("VND", 1)}
    # No price at all: no mean, not a division by zero.
    none = df.filter("price IS NULL")
    assert [r.mean_price for f in (gold.airline_comparison, gold.route_comparison) for r in f(none).collect()] == [None, None]


def test_sketches_merge_over_any_days(spark):
    n = 20000
    df = spark.range(n).select(
        F.col("id").alias("seq"), F.lit("SIN|KUL").alias("route"), (F.col("id") % (n // 2)).cast("string").alias("dep_date"), F.lit("").alias("return_date"),
        F.lit("ONE_WAY").alias("flight_type"), F.date_add(F.lit(D0), (F.col("id") % 20).cast("int")).alias("snapshot_date"),
        F.lit(10.0).alias("price"), F.lit("A").alias("primary_airline_name"),
    )
    sketches = gold.airline_sketches(df)
    assert sketches.count() == 20
    for last, exact in (("2024-01-01", n // 40), ("2024-01-10", n // 4), ("2024-01-20", n // 2)):
        r = gold.airlines_between(sketches, "2024-01-01", last).collect()[0]
        assert abs(r.about - exact) <= 4 * r.error * exact and r.error < 0.02


def test_refresh_computes_changed_routes_only(spark, tmp_path):
    from farelake.plans import refresh
    from farelake.sources import silver, statetable

    out, lake = str(tmp_path / "gold"), str(tmp_path / "silver")
    flights = "array<struct<price:double,currency:string,primary_airline_name:string>>"
    schema = f"route string, dep_date string, return_date string, flight_type string, flights {flights}, searched_at string"
    search = lambda route, price, at="2024-01-02 10:00:00": (route, "2024-03-01", "", "ONE_WAY", [(price, "SGD", "A"), (None, "SGD", "B"), (0.0, "SGD", "C"), (7.0, "VND", "D")], at)
    silver.write_silver(spark.createDataFrame([search(f"R{i}", 100.0 + i) for i in range(4)], schema), lake)
    assert refresh.refresh(spark, lake, out).routes == [f"R{i}" for i in range(4)]
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "gold").rglob("*.parquet")}
    assert refresh.refresh(spark, lake, out) == refresh.Refreshed(1, [], [])
    silver.write_silver(spark.createDataFrame([search("R2", 50.0), search("R2", 60.0, "2024-01-03 10:00:00")], schema), lake)
    base = statetable.current_commit(spark, f"{out}/manifest")
    assert refresh.refresh(spark, lake, out).routes == ["R2"]
    fresh = [p for p in (tmp_path / "gold").rglob("*.parquet") if p.name not in before and "manifest" not in str(p)]
    assert fresh and all(p.parent.name == "route=R2" for p in fresh)
    got = {(r.route, str(r.snapshot_date), r.currency): (r.price, r.version) for r in refresh.read_gold(spark, out, "snapshots").collect()}
    assert got[("R2", "2024-01-02", "SGD")] == (50.0, 2) and got[("R2", "2024-01-03", "SGD")] == (60.0, 2) and got[("R1", "2024-01-02", "SGD")] == (101.0, 1)
    assert got[("R1", "2024-01-02", "VND")] == (7.0, 1) and len(got) == 10
    # Of two refreshes from one manifest the second fails.
    with pytest.raises(statetable.StateConflict):
        statetable.write_state(spark.createDataFrame([], refresh.MANIFEST), f"{out}/manifest", buckets=1, base=base, place=("route",))
    # A route that left silver leaves gold; folders without a route are removed.
    from farelake.sources import storage
    storage.remove(spark, f"{lake}/route=R0")
    assert refresh.refresh(spark, lake, out).gone == ["R0"]
    assert {r.route for r in refresh.read_gold(spark, out, "facts").collect()} == {"R1", "R2", "R3"}
    assert refresh.read_gold(spark, out, "facts", ["R9"]) is None
    silver.write_silver(spark.createDataFrame([search("R1", 1.0), search("R3", 1.0)], schema), lake)
    refresh.refresh(spark, lake, out)
    kept = {tuple(r) for r in refresh.read_gold(spark, out, "snapshots").collect()}
    assert len(refresh.drop_unused(spark, out)) == 3 and {tuple(r) for r in refresh.read_gold(spark, out, "snapshots").collect()} == kept
