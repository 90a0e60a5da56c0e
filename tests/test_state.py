import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import state as st

ROW = "route string, dep_date string, return_date string, flight_type string, origin string, destination string, " \
      "flights string, error_type string, retries int, success int, searched_at string"


def row(dep="2026-08-01", ret="", flights=None, error=None, retries=1, success=0, route="SIN|KUL", kind="ONE_WAY"):
    o, d = route.split("|")
    return (route, dep, ret, kind, o, d, flights, error, retries, success, "2026-01-01T00:00:00Z")


def state(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def test_upsert_replaces_the_whole_row(spark):
    old = state(spark, row(flights='[{"price":1}]', success=1))
    new = state(spark, row(error="timeout", retries=3)).withColumn("seq", F.lit(1))
    got = st.upsert_latest(new, old).collect()
    assert len(got) == 1
    assert (got[0].flights, got[0].error_type, got[0].retries, got[0].success) == (None, "timeout", 3, 0)


def test_upsert_orders_by_arrival_not_time(spark):
    batch = state(spark, row(error="429"), row(flights="[]", success=1)).withColumn(
        "seq", F.when(F.col("success") == 1, 1).otherwise(2)
    )
    assert st.upsert_latest(batch).collect()[0].error_type == "429"


def test_upsert_keeps_keys_apart_and_is_idempotent(spark, rows):
    batch = state(
        spark, row(success=1), row(ret="2026-08-08", kind="ROUND_TRIP", success=1), row(dep="2026-08-02", success=1)
    ).withColumn("seq", F.monotonically_increasing_id())
    once = st.upsert_latest(batch)
    assert once.count() == 3
    assert rows(st.upsert_latest(batch, once)) == rows(once)


def test_normalise_and_quarantine(spark):
    df = spark.createDataFrame(
        [(None, [], True, None), ("", [(120.0,)], True, None), ("", None, False, None), ("", [], False, "data")],
        "return_date string, flights array<struct<price:double>>, success boolean, error_type string",
    )
    got = st.normalise_outcome(df).collect()
    assert [(r.return_date, r.flights, r.success, r.violation) for r in got] == [
        ("", None, 1, False), ("", '[{"price":120.0}]', 1, False), ("", None, 0, True), ("", None, 0, False)
    ]
    assert st.accepted(st.normalise_outcome(df)).count() == 3
    assert st.quarantined(st.normalise_outcome(df)).count() == 1
    with pytest.raises(PySparkException, match="needs a reason in error_type"):
        st.accepted(st.normalise_outcome(df), strict=True).collect()


def test_seeds_ignore_known_keys_and_repeats(spark):
    have = state(spark, row(flights="[1]", success=1))
    seeds = state(spark, row(), row(dep="2026-08-02"), row(dep="2026-08-02")).select(*S.SEED_COLUMNS)
    got = {r.dep_date: r for r in st.seed_missing(have, seeds).collect()}
    assert set(got) == {"2026-08-01", "2026-08-02"}
    assert got["2026-08-01"].success == 1
    fresh = got["2026-08-02"]
    assert (fresh.retries, fresh.success, fresh.error_type, fresh.flights) == (0, 0, None, None)
    assert st.seed_missing(st.seed_missing(have, seeds), seeds).count() == 2


def test_purge_only_drops_untouched_seeds(spark):
    table = state(
        spark, row(), row(dep="2", error="429"), row(dep="3", success=1), row(dep="4", success=None)
    )
    assert {r.dep_date for r in st.purge_seeds(table).collect()} == {"2", "3", "4"}
    assert st.count_purged(table).collect()[0].purged == 1


@pytest.mark.parametrize("budget,n", [(3, 1), (6, 2), (9, 3), (None, 4)])
def test_retry_budgets(spark, budget, n):
    table = state(spark, *[row(dep=f"2026-08-0{i}", error="timeout", retries=3 * i) for i in (1, 2, 3, 4)])
    assert st.failed_retryable(table, budget).count() == n


def test_other_is_not_retried_and_since_is_inclusive(spark):
    table = state(
        spark, row(error="other", retries=3), row(dep="2026-08-02", error="429", retries=3),
        row(dep="2026-08-03", error="no_proxy", retries=3), row(dep="2026-08-04", success=1),
    )
    assert {r.dep_date for r in st.failed_retryable(table, since="2026-08-03").collect()} == {"2026-08-03"}
    assert {r.dep_date for r in st.failed_retryable(table).collect()} == {"2026-08-02", "2026-08-03"}


def test_counts(spark, rows):
    table = state(spark, row(error="429"), row(error="timeout"), row(error="429"), row(success=1), row(success=None), row())
    assert rows(st.count_status(table)) == [(1, 4)]
    assert rows(st.count_success(table)) == [(1,)]
    assert rows(st.count_failed(table)) == [(4,)]
    assert rows(st.count_by_error(table)) == [("429", 2), ("timeout", 1), (None, 1)]
    assert rows(st.row_count(table)) == [(6,)]
    assert rows(st.count_status(state(spark).limit(0))) == [(0, 0)]


def test_successful_rows_in_order(spark):
    table = state(
        spark, row(dep="2026-08-02", success=1), row(dep="2026-08-01", flights='[{"price":5}]', success=1), row(error="429")
    )
    assert [(r.dep_date, r.flights) for r in st.successful_raw(table).collect()] == [
        ("2026-08-01", '[{"price":5}]'), ("2026-08-02", "[]")
    ]
    parsed = st.successful_parsed(table).collect()
    assert parsed[0].flights[0].price == 5.0 and parsed[1].flights == []


def test_broken_offers_fail_or_read_as_null(spark):
    table = state(spark, row(flights="{broken", success=1))
    with pytest.raises(Exception, match="(?i)malformed"):
        st.successful_parsed(table).collect()
    assert st.successful_parsed(table, strict=False).collect()[0].flights is None


def test_check_state(spark):
    with pytest.raises(st.StateError, match="missing"):
        st.check_state(None)
    with pytest.raises(st.StateError, match="error_type, retries"):
        st.check_state(state(spark, row()).drop("retries", "error_type"))
    with pytest.raises(st.StateError, match="empty"):
        st.check_state(state(spark, row()).limit(0))
    assert st.check_state(state(spark, row()).drop("searched_at")).count() == 1


def test_migrate_drops_old_tables_whole(spark):
    old = state(spark, row()).drop("return_date")
    assert st.migrate_state(old).count() == 0
    assert st.migrate_state(old).columns == list(S.STATE_COLUMNS)
    assert st.migrate_state(state(spark, row())).count() == 1
