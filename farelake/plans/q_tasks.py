"""Queries over the task grid and retries."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions.common import bundle_name, cycle_suffix, route_key
from farelake.operators import tasks
from farelake.plans.fixtures import fx, sql
from farelake.plans.q_state import AS_OF, FAILED, PK
from farelake.plans.registry import query

DESTS = "SELECT DISTINCT destination AS dest FROM fx_attempts WHERE origin = 'SIN'"
CATALOG = ", ".join(f"('{d}')" for d in S.DESTINATIONS)
ONE_WAY = "SELECT 'SIN' AS origin, dest FROM d UNION ALL SELECT dest, 'SIN' FROM d"
GRID = f"""SELECT as_of, o || '|' || d AS route, cast(dep AS varchar) AS dep_date,
 coalesce(cast(dep + cast(k AS int) AS varchar), '') AS return_date,
 CASE WHEN k IS NULL THEN 'ONE_WAY' ELSE 'ROUND_TRIP' END AS flight_type, o AS origin, d AS destination
FROM (SELECT as_of, cast(unnest(generate_series(start_date, effective_end, INTERVAL 1 DAY)) AS date) AS dep FROM fx_runs) r,
 (SELECT 'SIN' AS o, c AS d, NULL AS k FROM (VALUES {CATALOG}) v(c) UNION ALL
  SELECT c, 'SIN', NULL FROM (VALUES {CATALOG}) v(c) UNION ALL
  SELECT 'SIN', c, k FROM (VALUES {CATALOG}) v(c), (VALUES (7), (14), (21)) w(k)) s"""


def _dests(spark, sf):
    return sql(spark, sf, DESTS)


@query("one_way_routes", f"SELECT * FROM (WITH d AS ({DESTS}) {ONE_WAY}) x")
def one_way_routes(spark, sf):
    return tasks.one_way_routes(_dests(spark, sf))


@query("round_trip_routes", f"SELECT 'SIN' AS origin, dest FROM ({DESTS}) d")
def round_trip_routes(spark, sf):
    return tasks.round_trip_routes(_dests(spark, sf))


CANDIDATES = "SELECT DISTINCT concat('p', cast(seq % 4 AS string)) AS provider, origin, destination AS dest FROM fx_attempts"


@query("supported_routes", f"""
SELECT c.* FROM ({CANDIDATES}) c WHERE provider = 'p0' OR EXISTS (SELECT 1 FROM fx_coverage v
 WHERE v.provider = c.provider AND v.origin = c.origin AND v.dest = c.dest)""")
def supported_routes(spark, sf):
    candidates = sql(spark, sf, CANDIDATES)
    providers = candidates.select("provider").distinct().withColumn("covers_all", F.col("provider") == "p0")
    return tasks.supported_routes(candidates, providers, fx(spark, sf, "fx_coverage"))


@query("dates_between", """
SELECT run_id, cast(unnest(generate_series(greatest(start_date, as_of), end_date, INTERVAL 1 DAY)) AS date) AS dep
FROM fx_windows WHERE end_date >= greatest(start_date, as_of)""")
def dates_between(spark, sf):
    return tasks.explode_dates(fx(spark, sf, "fx_windows"), "start_date", "end_date", "as_of").select("run_id", "dep")


@query("search_window", """
SELECT run_id, e AS end_date, greatest(e - as_of, 0)::INT AS ahead_days,
 least(e, as_of + greatest(e - as_of, 0)::INT) AS effective_end
FROM (SELECT run_id, as_of, start_date + max_days AS e FROM fx_windows) x""")
def search_window(spark, sf):
    runs = fx(spark, sf, "fx_windows").drop("end_date")
    return tasks.search_window(runs, "start_date", "max_days", "as_of").select(
        "run_id", "end_date", "ahead_days", "effective_end"
    )


@query("round_trip_offsets", """
SELECT run_id, start_date AS dep, start_date + k AS return_day FROM fx_windows, (VALUES (7), (14), (21)) w(k)""")
def round_trip_offsets(spark, sf):
    dates = fx(spark, sf, "fx_windows").select("run_id", F.col("start_date").alias("dep"))
    return tasks.round_trip_offsets(dates)


@query("build_tasks", GRID)
def build_tasks(spark, sf):
    return tasks.build_tasks(fx(spark, sf, "fx_runs")).drop("start_date", "effective_end")


@query("route_key", "SELECT seq, origin || '|' || destination AS route FROM fx_attempts")
def key_of_route(spark, sf):
    return fx(spark, sf, "fx_attempts").select("seq", route_key("origin", "destination").alias("route"))


MAP = "SELECT route, arg_max(provider, provider_pos) AS provider FROM fx_coverage GROUP BY route"


@query("provider_map", MAP)
def provider_map(spark, sf):
    return tasks.provider_map(fx(spark, sf, "fx_coverage"))


@query("retry_tasks", f"""
SELECT {PK}, provider FROM fx_state JOIN ({MAP}) m USING (route)
WHERE {FAILED} AND retries <= 9 AND dep_date >= '{AS_OF}'""")
def retry_tasks(spark, sf):
    return tasks.retry_tasks(fx(spark, sf, "fx_state"), provider_map(spark, sf), AS_OF, max_retries=9)


@query("uncovered_failures", f"""
SELECT {PK} FROM fx_state WHERE {FAILED} AND retries <= 9 AND dep_date >= '{AS_OF}'
 AND route NOT IN (SELECT route FROM fx_coverage)""")
def uncovered_failures(spark, sf):
    return tasks.uncovered_failures(fx(spark, sf, "fx_state"), provider_map(spark, sf), AS_OF, max_retries=9)


@query("retry_budget", f"""
SELECT r::INT AS round, {PK} FROM fx_state, (VALUES (1), (2), (3)) w(r)
WHERE {FAILED} AND retries <= 3 * r AND dep_date >= '{AS_OF}'""")
def retry_budget(spark, sf):
    return tasks.retry_budget(fx(spark, sf, "fx_state"), since=AS_OF)


CYCLE = "(((d - DATE '2026-08-18') % 4) + 4) % 4"


@query("cycle_calendar", f"""
SELECT d AS day, n, w::INT AS window_days, s AS suffix, (75 * (w + 1))::INT AS expected_tasks FROM (
 SELECT d, n, CASE {CYCLE} WHEN 0 THEN 270 WHEN 1 THEN 30 WHEN 2 THEN 60 ELSE 90 END AS w,
  CASE {CYCLE} WHEN 0 THEN 'full' WHEN 1 THEN 'w30' WHEN 2 THEN 'w60' ELSE 'w90' END AS s
 FROM (SELECT cast(o_orderdate AS date) AS d, count(*) AS n FROM orders GROUP BY 1) x) y""")
def cycle_calendar(spark, sf):
    days = sql(spark, sf, "SELECT cast(o_orderdate AS date) AS day, count(*) AS n FROM orders GROUP BY 1")
    return tasks.cycle_calendar(days)


@query("coverage_gap", f"""
SELECT g.as_of, g.route, g.dep_date, count(*) AS expected, count(s.route) AS searched, count(*) - count(s.route) AS missing
FROM ({GRID}) g LEFT JOIN (SELECT DISTINCT cast(searched_at AS date) AS as_of, {PK} FROM fx_attempts) s
 ON g.as_of = s.as_of AND g.route = s.route AND g.dep_date = s.dep_date AND g.return_date = s.return_date
 AND g.flight_type = s.flight_type
GROUP BY g.as_of, g.route, g.dep_date""")
def coverage_gap(spark, sf):
    searched = fx(spark, sf, "fx_attempts").withColumn("as_of", F.col("searched_at").cast("date"))
    return tasks.coverage_gap(build_tasks(spark, sf), searched, ["as_of"])


@query("task_segments", """
SELECT seq, seg_no::INT AS seg_no, seg_from, seg_to, seg_date, 1 AS adults, 'ECONOMY' AS seat, 'ANY' AS max_stops,
 'CHEAPEST' AS sort_by FROM (
 SELECT seq, 0 AS seg_no, origin AS seg_from, destination AS seg_to, dep_date AS seg_date FROM fx_attempts
 UNION ALL SELECT seq, 1, destination, origin, return_date FROM fx_attempts WHERE return_date <> '') x""")
def task_segments(spark, sf):
    rows = fx(spark, sf, "fx_attempts").select("seq", "origin", "destination", "dep_date", "return_date")
    return tasks.task_segments(rows).drop("origin", "destination", "dep_date", "return_date")


@query("valid_dates", """
SELECT task_id, dep_date, return_date, CASE WHEN coalesce(try_cast(dep_date AS date) < DATE '1996-01-01', true)
 OR (return_date <> '' AND coalesce(try_cast(return_date AS date) < DATE '1996-01-01', true)) THEN 'data' END AS error_type
FROM fx_dates""")
def valid_dates(spark, sf):
    rows = fx(spark, sf, "fx_dates")
    return rows.withColumn("error_type", tasks.date_error("dep_date", "return_date", F.lit("1996-01-01")))


@query("airport_alias", """
SELECT event_id, code, CASE code WHEN 'OKA' THEN 'NAH' WHEN 'XXX' THEN NULL ELSE code END AS airport FROM fx_codes""")
def airport_alias(spark, sf):
    codes = fx(spark, sf, "fx_codes")
    airports = codes.filter(~F.col("code").isin("OKA", "YIC", "XXX")).select("code").distinct()
    return tasks.airport_alias(codes, "code", airports)


@query("bundle_name", f"""
SELECT event_id, 'search_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' ||
 CASE {CYCLE} WHEN 0 THEN 'full' WHEN 1 THEN 'w30' WHEN 2 THEN 'w60' ELSE 'w90' END AS bundle
FROM (SELECT event_id, ts, cast(ts AS date) AS d FROM events) x""")
def name_of_bundle(spark, sf):
    events = sql(spark, sf, "SELECT event_id, ts FROM events")
    return events.select("event_id", bundle_name("ts", cycle_suffix(F.col("ts").cast("date"))).alias("bundle"))


