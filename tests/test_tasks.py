from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import tasks

D = date.fromisoformat


def run(spark, start, end, today):
    return spark.createDataFrame([(D(start), D(end), D(today))], "start_date date, effective_end date, as_of date")


def test_routes(spark, rows):
    assert tasks.one_way_routes(tasks.catalog(spark)).count() == 30
    assert tasks.round_trip_routes(tasks.catalog(spark)).count() == 15
    one = spark.createDataFrame([("KUL",)], "dest string")
    assert rows(tasks.one_way_routes(one)) == [("KUL", "SIN"), ("SIN", "KUL")]


@pytest.mark.parametrize("start,end,today,first,n", [
    ("2026-08-10", "2026-08-16", "2026-08-14", "2026-08-14", 3),
    ("2026-08-10", "2026-08-12", "2026-08-14", None, 0),
    ("2026-08-16", "2026-08-10", "2026-08-01", None, 0),
    ("2026-08-14", "2026-08-14", "2026-08-14", "2026-08-14", 1),
])
def test_dates_between(spark, start, end, today, first, n):
    got = tasks.explode_dates(run(spark, start, end, today), "start_date", "effective_end", "as_of").collect()
    assert [r.dep for r in got] == [D(first) + timedelta(days=i) for i in range(n)]


def test_grid_of_one_route_and_date(spark, rows):
    grid = tasks.build_tasks(run(spark, "2026-08-01", "2026-08-01", "2026-08-01"), destinations=["KUL"])
    assert rows(grid.filter("route = 'SIN|KUL'").select("return_date", "flight_type")) == [
        ("", "ONE_WAY"), ("2026-08-08", "ROUND_TRIP"), ("2026-08-15", "ROUND_TRIP"), ("2026-08-22", "ROUND_TRIP")
    ]


def test_full_grid_size_and_unique_keys(spark):
    grid = tasks.build_tasks(run(spark, "2026-08-18", "2027-05-15", "2026-08-18"))
    assert grid.count() == 20325 == tasks.TASKS_PER_DATE * 271
    assert grid.select(*S.PK).distinct().count() == 20325
    assert grid.filter("flight_type = 'ROUND_TRIP' and origin <> 'SIN'").isEmpty()


def test_window_is_capped(spark):
    runs = spark.createDataFrame(
        [(D("2026-08-20"), 270, D("2026-08-18")), (D("2026-08-01"), 5, D("2026-08-18"))],
        "start_date date, max_days int, as_of date",
    )
    got = tasks.search_window(runs, "start_date", "max_days", "as_of").collect()
    assert [(r.ahead_days, r.effective_end) for r in got] == [(272, D("2027-05-17")), (0, D("2026-08-06"))]
    capped = runs.select(tasks.capped_end(F.lit("2026-12-01").cast("date"), "as_of", F.lit(-1)).alias("e")).collect()
    assert capped[0].e == D("2026-08-17")


def test_supported_routes(spark, rows):
    cand = spark.createDataFrame([("a", "SIN", "KUL"), ("a", "KUL", "SIN"), ("b", "SIN", "BKK")], "provider string, origin string, dest string")
    who = spark.createDataFrame([("a", False), ("b", True)], "provider string, covers_all boolean")
    cover = spark.createDataFrame([("a", "SIN", "KUL")], "provider string, origin string, dest string")
    assert rows(tasks.supported_routes(cand, who, cover)) == [("a", "SIN", "KUL"), ("b", "SIN", "BKK")]


STATE = "route string, dep_date string, return_date string, flight_type string, error_type string, retries int, success int"


def failed(spark):
    return spark.createDataFrame([
        ("SIN|KUL", "2026-08-13", "", "ONE_WAY", "timeout", 3, 0), ("SIN|KUL", "2026-08-14", "", "ONE_WAY", "timeout", 3, 0),
        ("SIN|XXX", "2026-08-14", "", "ONE_WAY", "429", 6, 0), ("SIN|BKK", "2026-08-15", "", "ONE_WAY", "other", 3, 0),
        ("SIN|BKK", "2026-08-16", "", "ONE_WAY", None, 1, 1),
    ], STATE)


def test_retries_take_the_last_provider_and_todays_departures(spark, rows):
    cover = spark.createDataFrame([("SIN|KUL", "a", 0), ("SIN|KUL", "b", 1)], "route string, provider string, provider_pos int")
    who = tasks.provider_map(cover)
    assert rows(tasks.retry_tasks(failed(spark), who, "2026-08-14").select("route", "dep_date", "provider")) == [
        ("SIN|KUL", "2026-08-14", "b")
    ]
    assert [r.route for r in tasks.uncovered_failures(failed(spark), who, "2026-08-14", None).collect()] == ["SIN|XXX"]


def test_retry_budget_by_round(spark):
    got = tasks.retry_budget(failed(spark)).groupBy("round").count().collect()
    assert {r["round"]: r["count"] for r in got} == {1: 2, 2: 3, 3: 3}


@pytest.mark.parametrize("day,window,suffix,n", [
    ("2026-08-18", 270, "full", 20325), ("2026-08-19", 30, "w30", 2325), ("2026-08-20", 60, "w60", 4575),
    ("2026-08-21", 90, "w90", 6825), ("2026-08-17", 90, "w90", 6825), ("2026-08-22", 270, "full", 20325),
])
def test_cycle(spark, day, window, suffix, n):
    r = tasks.cycle_calendar(spark.createDataFrame([(D(day),)], "day date")).collect()[0]
    assert (r.window_days, r.suffix, r.expected_tasks) == (window, suffix, n)


def test_coverage_gap(spark, rows):
    grid = tasks.build_tasks(run(spark, "2026-08-01", "2026-08-01", "2026-08-01"), destinations=["KUL"])
    log = grid.filter("flight_type = 'ONE_WAY'").unionByName(grid.filter("flight_type = 'ONE_WAY'"))
    got = tasks.coverage_gap(grid, log, ["as_of"]).drop("as_of", "dep_date")
    assert rows(got) == [("KUL|SIN", 1, 1, 0), ("SIN|KUL", 4, 1, 3)]


def test_segments(spark, rows):
    t = spark.createDataFrame([("SIN", "KUL", "2026-08-01", ""), ("SIN", "BKK", "2026-08-01", "2026-08-08")],
                              "origin string, destination string, dep_date string, return_date string")
    got = tasks.task_segments(t).select("destination", "seg_no", "seg_from", "seg_to", "seg_date")
    assert rows(got) == [
        ("BKK", 0, "SIN", "BKK", "2026-08-01"), ("BKK", 1, "BKK", "SIN", "2026-08-08"), ("KUL", 0, "SIN", "KUL", "2026-08-01")
    ]


@pytest.mark.parametrize("dep,ret,error", [
    ("2026-12-01", "", None), ("2026-12-01", None, None), ("2026-99-99", "", "data"), ("nope", "", "data"),
    ("2026-01-01", "", "data"), ("2026-08-14", "", None), ("2026-12-01", "2026-13-01", "data"), ("2026-12-01", "2026-12-08", None),
])
def test_dates_are_checked(spark, dep, ret, error):
    df = spark.createDataFrame([(dep, ret)], "d string, r string")
    assert df.select(tasks.date_error("d", "r", F.lit("2026-08-14")).alias("e")).collect()[0].e == error


def test_airports(spark):
    codes = spark.createDataFrame([("OKA",), ("NAH",), ("YIC",), ("???",)], "code string")
    known = spark.createDataFrame([("NAH",), ("SIN",)], "code string")
    got = {r.code: r.airport for r in tasks.airport_alias(codes, "code", known).collect()}
    assert got == {"OKA": "NAH", "NAH": "NAH", "YIC": "YIC", "???": None}
