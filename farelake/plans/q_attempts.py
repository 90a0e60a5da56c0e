"""Queries over attempts: classification and folding."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import outcomes
from farelake.functions.common import floor_div, format_duration
from farelake.operators import attempts as at
from farelake.operators import state as st
from farelake.operators.scaling import running_total
from farelake.plans.fixtures import fx, sql
from farelake.plans.q_state import PK
from farelake.plans.registry import query

MARKER = "(" + " OR ".join(f"contains(lower(body), '{m}')" for m in S.BLOCK_MARKERS) + ")"
HTTP = f"""CASE WHEN status = 429 THEN '429' WHEN status >= 500 THEN 'connection' WHEN status = 403 THEN '429'
 WHEN status = 200 AND {MARKER} THEN '429' WHEN status >= 400 THEN 'data' ELSE 'ok' END"""
TRANSPORT = """CASE WHEN exception IS NULL THEN NULL WHEN exception = 'Timeout' THEN 'timeout'
 WHEN exception IN ('ProxyError', 'ConnectionError') THEN 'connection' ELSE 'other' END"""


def page_rows(body: str, slot: int) -> str:
    """Raw rows of one page as a list of JSON values."""
    return f"""CASE WHEN json_type({body}, '$[{slot}][0]') = 'ARRAY' THEN json_extract({body}, '$[{slot}][0][*]') ELSE [] END"""


def _blank(body: str, path: str) -> str:
    """Nothing there, JSON null or an empty list."""
    kind = f"json_type({body}, '{path}')"
    return f"coalesce({kind} = 'NULL' OR ({kind} = 'ARRAY' AND json_array_length({body}, '{path}') = 0), true)"


def page_kind(body: str) -> str:
    """none, malformed or ok, for texts whose pages are lists or null."""
    bad = " OR ".join(
        f"(NOT {_blank(body, f'$[{s}]')} AND (json_type({body}, '$[{s}]') <> 'ARRAY' OR"
        f" (NOT {_blank(body, f'$[{s}][0]')} AND json_type({body}, '$[{s}][0]') <> 'ARRAY')))" for s in (2, 3)
    )
    return f"""CASE WHEN NOT json_valid({body}) THEN 'none' WHEN json_type({body}) <> 'ARRAY' OR json_array_length({body}) < 4
 THEN 'malformed' WHEN {bad} THEN 'malformed' ELSE 'ok' END"""


DECODED = "list_filter(raw, lambda x: json_type(x, '$.price') IN ('UBIGINT', 'BIGINT', 'DOUBLE'))"


def payloads(view: str, body: str, extra: str = "") -> str:
    """Subquery with kind, raw and the rows that decode."""
    return f"""(SELECT *, {DECODED} AS decoded FROM (SELECT *,
 CASE WHEN kind = 'ok' THEN list_concat({page_rows('doc', 2)}, {page_rows('doc', 3)}) ELSE [] END AS raw
 FROM (SELECT *, {page_kind(body)} AS kind, CASE WHEN json_valid({body}) THEN {body} ELSE '[]' END AS doc FROM {view}) p1) p2)"""


PAYLOAD = """CASE WHEN kind = 'none' AND length(body) < 1024 THEN 'stub' WHEN kind <> 'ok' THEN 'data'
 WHEN len(decoded) = 0 THEN 'data' ELSE 'ok' END"""
CLASSED = f"""(SELECT *, {HTTP} AS http_class, {TRANSPORT} AS transport_class, {PAYLOAD} AS payload_class
 FROM {payloads('fx_exchanges', 'body')} c1)"""
OUTCOME = f"""(SELECT *, CASE WHEN verdict = 'stub' THEN 'data' ELSE verdict END AS error_type,
 coalesce(verdict = 'stub', false) AS stubbed, (verdict IS NULL)::INT AS success FROM (SELECT *,
 CASE WHEN NOT has_endpoint THEN 'no_proxy' WHEN exception IS NOT NULL THEN transport_class
  WHEN http_class <> 'ok' THEN http_class WHEN payload_class <> 'ok' THEN payload_class END AS verdict FROM {CLASSED} o1) o2)"""


@query("http_class", f"SELECT response_id, status, {HTTP} AS http_class FROM fx_responses")
def http_class(spark, sf):
    rows = fx(spark, sf, "fx_responses")
    return rows.select("response_id", "status", outcomes.http_class("status", "body").alias("http_class"))


@query("block_marker", f"SELECT response_id, {MARKER} AS blocked FROM fx_responses")
def block_marker(spark, sf):
    return fx(spark, sf, "fx_responses").select("response_id", outcomes.block_marker("body").alias("blocked"))


@query("transport_class", f"SELECT response_id, exception, {TRANSPORT} AS transport_class FROM fx_exchanges")
def transport_class(spark, sf):
    rows = fx(spark, sf, "fx_exchanges")
    return rows.select("response_id", "exception", outcomes.transport_class("exception").alias("transport_class"))


@query("payload_class", f"SELECT response_id, kind AS page_kind, len(decoded)::INT AS n_offers, payload_class FROM {CLASSED} x")
def payload_class(spark, sf):
    return at.classify_exchanges(fx(spark, sf, "fx_exchanges")).select(
        "response_id", "page_kind", "n_offers", "payload_class"
    )


@query("payload_class_pages", """
SELECT response_id, CASE WHEN length(body) < 1024 THEN 'stub' ELSE 'data' END AS payload_class FROM fx_responses""")
def payload_class_pages(spark, sf):
    """Whole web pages are no payload; their length decides."""
    rows = fx(spark, sf, "fx_responses")
    kind = F.when(F.try_parse_json("body").isNull(), "none").otherwise("malformed")
    return rows.select("response_id", outcomes.payload_class(kind, F.lit(0), "body").alias("payload_class"))


@query("attempt_outcome", f"SELECT response_id, error_type, stubbed, success FROM {OUTCOME} x")
def attempt_outcome(spark, sf):
    return at.classify_exchanges(fx(spark, sf, "fx_exchanges"), only_open=True).select(
        "response_id", "error_type", "stubbed", "success"
    )


@query("endpoint_blame", f"""
SELECT CASE WHEN error_type IS NULL THEN 'ok' WHEN error_type IN ('timeout', 'connection') THEN 'failure'
 WHEN error_type = '429' THEN 'rate_limited' WHEN stubbed THEN 'stub' ELSE 'none' END AS event, count(*) AS n
FROM {OUTCOME} x GROUP BY 1""")
def endpoint_blame(spark, sf):
    classed = at.classify_exchanges(fx(spark, sf, "fx_exchanges"), only_open=True)
    event = outcomes.endpoint_event("error_type", "stubbed").alias("event")
    return classed.groupBy(event).agg(F.count(F.lit(1)).alias("n"))


def attempt_log(spark, sf):
    """The rows of ``fx_attempt_log``, with each key's attempts numbered by block counts."""
    log = fx(spark, sf, "fx_attempts").select("seq", *S.PK, "success", "error_type", "flights", "searched_at")
    numbered = running_total(log, S.PK, floor_div("seq", 65536), ["seq"], F.lit(1), "_n")
    n = F.col("_n") - 1
    return (
        numbered.withColumn("round", floor_div(n, S.ATTEMPTS_PER_ROUND).cast("int"))
        .withColumn("attempt", F.pmod(n, F.lit(S.ATTEMPTS_PER_ROUND)).cast("int"))
        .drop("_n")
    )


FOLD = f"""(SELECT {PK}, round, arg_min(flights, attempt) FILTER (WHERE success = 1) AS flights,
 CASE WHEN max(success) = 0 THEN arg_max(error_type, attempt) END AS error_type,
 CASE WHEN max(success) = 1 THEN min(attempt) FILTER (WHERE success = 1) + 1 ELSE 3 * (round + 1) END::INT AS retries,
 max(success)::INT AS success, arg_min(searched_at, attempt) AS searched_at
FROM fx_attempt_log GROUP BY {PK}, round)"""


@query("fold_attempts", f"SELECT * FROM {FOLD} x")
def fold_attempts(spark, sf):
    return at.fold_attempts(attempt_log(spark, sf))


@query("final_state", f"""
SELECT {PK}, flights, error_type, retries, success, searched_at FROM (SELECT *,
 row_number() OVER (PARTITION BY {PK} ORDER BY round DESC) AS rn FROM {FOLD} x) y WHERE rn = 1""")
def final_state(spark, sf):
    return at.final_state(attempt_log(spark, sf))


@query("unexpected_failure", """
SELECT seq, route, dep_date, coalesce(return_date, '') AS return_date, flight_type, NULL::VARCHAR AS flights,
 'other' AS error_type, 3 AS retries, 0 AS success FROM fx_outcomes WHERE NOT success AND error_type IS NULL""")
def unexpected_failure(spark, sf):
    rejected = st.quarantined(st.normalise_outcome(fx(spark, sf, "fx_outcomes")))
    return at.record_unexpected(rejected).select(
        "seq", *S.PK, "flights", "error_type", "retries", "success"
    )


SECONDS = "SELECT event_id, value * 37 AS seconds FROM events"


@query("format_duration", f"""
SELECT event_id, CASE WHEN h > 0 THEN printf('%dh%02dm', h, m) WHEN m > 0 THEN printf('%dm%02ds', m, s)
 ELSE printf('%ds', s) END AS duration FROM (SELECT event_id, t // 3600 AS h, t % 3600 // 60 AS m, t % 60 AS s
 FROM (SELECT event_id, cast(floor(seconds) AS bigint) AS t FROM ({SECONDS}) a) b) c""")
def durations(spark, sf):
    rows = sql(spark, sf, SECONDS)
    return rows.select("event_id", format_duration("seconds").alias("duration"))


@query("progress_steps", """
SELECT p.source, p.total, p.done, floor(p.done * 100 / p.total)::BIGINT AS pct, round(o.elapsed, 3) AS elapsed_s,
 CASE WHEN o.elapsed > 0 THEN round(p.done / o.elapsed, 6) END AS rate
FROM (WITH RECURSIVE t AS (SELECT source, count(*) AS total FROM fx_probes GROUP BY source),
 r AS (SELECT source, total, ceil(5 * total / 100)::BIGINT AS done FROM t UNION ALL
  SELECT source, total, ceil((floor(done * 100 / total) + 5) * total / 100)::BIGINT FROM r
  WHERE floor(done * 100 / total) + 5 <= 100)
 SELECT * FROM r UNION SELECT source, total, total FROM t) p
JOIN (SELECT source, row_number() OVER (PARTITION BY source ORDER BY probe_id) AS done,
 (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY source))) / 1e6 AS elapsed FROM fx_probes) o
 ON o.source = p.source AND o.done = p.done""")
def progress_steps(spark, sf):
    steps = at.progress_steps(fx(spark, sf, "fx_probes"), "source", "probe_id", "ts")
    return steps.select(
        "source", "total", "done", "pct",
        F.round("elapsed_s", 3).alias("elapsed_s"), F.round("rate", 6).alias("rate"),
    )
