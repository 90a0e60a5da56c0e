"""Queries over the outcome table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import state as st
from farelake.plans.fixtures import fx
from farelake.plans.registry import query

AS_OF = "2024-01-15"
PK = ", ".join(S.PK)
COLUMNS = f"{PK}, origin, destination, flights, error_type, retries, success, searched_at"
LATEST = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {PK} ORDER BY seq DESC) AS rn
 FROM fx_attempts) y WHERE rn = 1)"""
FAILED = "success = 0 AND error_type IN ('429', 'timeout', 'connection', 'no_proxy', 'data')"


#: A field of the offer in place ``offer_pos`` of the stored text.
FIELD = "json_extract_string(flights, '$[' || offer_pos || '].{}')"


def all_offers(rows: str) -> str:
    """SQL for a row per offer of ``rows`` with ``n_offers`` and ``offer_pos``; a search without offers keeps one."""
    size = "json_array_length(coalesce(flights, '[]'))"
    return f"""(SELECT g.*, {size}::INT AS n_offers, unnest(CASE WHEN {size} = 0 THEN [NULL] ELSE range({size}::BIGINT) END)::INT AS offer_pos FROM {rows} g)"""


def stored(spark, sf) -> DataFrame:
    """The state after all attempts of the log."""
    return st.upsert_latest(fx(spark, sf, "fx_attempts"))


@query("upsert_latest", f"SELECT seq, {COLUMNS} FROM {LATEST} z")
def upsert_latest(spark, sf):
    """The first half of the log makes a state, which the second half then updates."""
    log = fx(spark, sf, "fx_attempts")
    first = F.col("searched_at") < F.lit(AS_OF).cast("timestamp_ntz")
    state = st.upsert_latest(log.filter(first))
    return st.upsert_latest(log.filter(~first), state).select("seq", *S.STATE_COLUMNS)


@query("normalise_outcome", f"""
SELECT seq, {PK}, flights, error_type, cast(success AS int) AS success, violation FROM (
 SELECT seq, route, dep_date, coalesce(return_date, '') AS return_date, flight_type,
  CASE WHEN flights = '[]' THEN NULL ELSE flights END AS flights, error_type, success,
  (NOT success AND error_type IS NULL) AS violation FROM fx_outcomes) x""")
def normalise_outcome(spark, sf):
    return st.normalise_outcome(fx(spark, sf, "fx_outcomes")).select(
        "seq", *S.PK, "flights", "error_type", "success", "violation"
    )


SEEDS = f"SELECT DISTINCT {PK}, origin, destination FROM fx_attempts"


@query("seed_missing", f"""
SELECT {COLUMNS} FROM {LATEST} z WHERE success = 1
UNION ALL
SELECT {PK}, origin, destination, NULL, NULL, 0, 0, NULL FROM ({SEEDS}) s
WHERE NOT EXISTS (SELECT 1 FROM {LATEST} l WHERE l.success = 1 AND l.route = s.route AND l.dep_date = s.dep_date
 AND l.return_date = s.return_date AND l.flight_type = s.flight_type)""")
def seed_missing(spark, sf):
    """The successful keys are the state; every key of the log is to be seeded."""
    log = fx(spark, sf, "fx_attempts")
    return st.seed_missing(stored(spark, sf).filter("success = 1").drop("seq"), log).select(*S.STATE_COLUMNS)


@query("purge_seeds", f"""
SELECT {COLUMNS} FROM fx_state WHERE NOT (coalesce(success, 1) = 0 AND error_type IS NULL)""")
def purge_seeds(spark, sf):
    return st.purge_seeds(fx(spark, sf, "fx_state"))


@query("purge_seeds_count", """
SELECT count(*) AS purged FROM fx_state WHERE success = 0 AND error_type IS NULL""")
def purge_seeds_count(spark, sf):
    return st.count_purged(fx(spark, sf, "fx_state"))


@query("failed_retryable", f"SELECT {PK} FROM fx_state WHERE {FAILED} AND dep_date >= '{AS_OF}' AND retries <= 6")
def failed_retryable(spark, sf):
    return st.failed_retryable(fx(spark, sf, "fx_state"), max_retries=6, since=AS_OF)


@query("failed_retryable_all", f"SELECT {PK} FROM fx_state WHERE {FAILED}")
def failed_retryable_all(spark, sf):
    return st.failed_retryable(fx(spark, sf, "fx_state"), max_retries=None)


STATUS = """SELECT coalesce(sum(CASE WHEN success = 1 THEN 1 ELSE 0 END), 0)::BIGINT AS n_success,
 coalesce(sum(CASE WHEN success = 0 THEN 1 ELSE 0 END), 0)::BIGINT AS n_failed FROM fx_state"""


@query("count_status", STATUS)
def count_status(spark, sf):
    return st.count_status(fx(spark, sf, "fx_state"))


@query("count_success", f"SELECT n_success FROM ({STATUS}) x")
def count_success(spark, sf):
    return st.count_success(fx(spark, sf, "fx_state"))


@query("count_failed", f"SELECT n_failed FROM ({STATUS}) x")
def count_failed(spark, sf):
    return st.count_failed(fx(spark, sf, "fx_state"))


@query("count_by_error", "SELECT error_type, count(*) AS n FROM fx_state WHERE success = 0 GROUP BY error_type")
def count_by_error(spark, sf):
    return st.count_by_error(fx(spark, sf, "fx_state"))


@query("row_count", "SELECT count(*) AS n FROM fx_state")
def row_count(spark, sf):
    return st.row_count(fx(spark, sf, "fx_state"))


@query("successful_raw", f"""
SELECT {PK}, origin, destination, coalesce(flights, '[]') AS flights, searched_at
FROM fx_state WHERE success = 1""")
def successful_raw(spark, sf):
    return st.successful_raw(fx(spark, sf, "fx_state"))


@query("successful_parsed", f"""
SELECT {PK}, n_offers, offer_pos, {FIELD.format("price")}::DOUBLE AS price, {FIELD.format("primary_airline_name")} AS airline
FROM {all_offers("(SELECT * FROM fx_state WHERE success = 1)")} x""")
def successful_parsed(spark, sf):
    return st.successful_parsed(fx(spark, sf, "fx_state")).select(
        *S.PK, F.size("flights").alias("n_offers"), F.posexplode_outer("flights").alias("offer_pos", "offer")
    ).select(*S.PK, "n_offers", "offer_pos", "offer.price", F.col("offer.primary_airline_name").alias("airline"))


@query("check_state", "SELECT count(*) AS n FROM fx_state")
def check_state(spark, sf):
    return st.row_count(st.check_state(fx(spark, sf, "fx_state")))


@query("migrate_state", "SELECT count(*) AS n, count(return_date) AS n_keyed FROM fx_state")
def migrate_state(spark, sf):
    """A current table stays whole; one from before return dates adds nothing."""
    state = fx(spark, sf, "fx_state").withColumn("searched_at", F.col("searched_at").cast("string"))
    old = st.migrate_state(state.drop("return_date"))
    both = st.migrate_state(state).unionByName(old)
    return both.agg(F.count(F.lit(1)).alias("n"), F.count("return_date").alias("n_keyed"))
