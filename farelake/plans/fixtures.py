"""Input views in the shape of the engine's own tables, derived from the given tables.

Each text is plain SQL that Spark and DuckDB both run. A query builds the view with ``fx``; its check
inlines the same text as a CTE with ``with_views``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from farelake import schema as S

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {}

# One of the destinations by user.
DESTINATION = "CASE cast(user_id % 15 AS int) " + " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(S.DESTINATIONS)) + " END"

#: A search has offers 0 to ``seq % 4``, or none where ``seq % 10 = 0``.
POSITIONS = range(4)


def _of(pos: int) -> dict[str, str]:
    """SQL for the fields of the offer in place ``pos``; some have no price, some a price of zero."""
    n = f"(seq + {pos})"
    return {
        "cents": f"CASE WHEN {n} % 17 = 0 THEN NULL WHEN {n} % 19 = 0 THEN 0 ELSE cents + {250 * pos} END",
        "currency": f"CASE WHEN {n} % 3 = 0 THEN 'USD' ELSE 'SGD' END",
        "duration": f"60 + cents % 600 + {10 * pos}",
        "stops": f"cast({n} % 3 AS int)",
        "airline": f"concat('A', cast({n} % 5 AS string))",
    }


def _offer_text(pos: int) -> str:
    """SQL for the JSON of that offer; offers in odd places have two legs."""
    f = _of(pos)
    leg = lambda a, b: f"""concat('{{"departure_airport": "', {a}, '", "arrival_airport": "', {b}, '", "duration": ', cast(30 + cents % 50 AS string), '}}')"""
    legs = leg("origin", "destination") if pos % 2 == 0 else f"concat({leg('origin', chr(39) + 'VIA' + chr(39))}, ', ', {leg(chr(39) + 'VIA' + chr(39), 'destination')})"
    return (
        f"""concat('{{"price": ', coalesce(cast({f["cents"]} AS string), 'null'), ', "currency": "', {f["currency"]}, '", "duration": ', """
        f"""cast({f["duration"]} AS string), ', "stops": ', cast({f["stops"]} AS string), ', "primary_airline_name": "', {f["airline"]}, """
        f"""'", "legs": [', {legs}, ']}}')"""
    )


VIEWS["fx_searches"] = """
SELECT seq, CASE WHEN dir = 0 THEN concat('SIN|', d) ELSE concat(d, '|SIN') END AS route,
       cast(dep AS string) AS dep_date,
       CASE WHEN rt = 1 AND dir = 0 THEN cast(dep + cast(7 * (1 + seq % 3) AS int) AS string) ELSE '' END AS return_date,
       CASE WHEN rt = 1 AND dir = 0 THEN 'ROUND_TRIP' ELSE 'ONE_WAY' END AS flight_type,
       CASE WHEN dir = 0 THEN 'SIN' ELSE d END AS origin,
       CASE WHEN dir = 0 THEN d ELSE 'SIN' END AS destination, cents,
       CASE WHEN event_type = 'view' THEN '429' WHEN event_type = 'signup' THEN 'data'
            WHEN event_type = 'error' THEN CASE seq % 4 WHEN 0 THEN 'timeout' WHEN 1 THEN 'connection'
                                                        WHEN 2 THEN 'no_proxy' ELSE 'other' END END AS error_type,
       cast(CASE WHEN ok = 1 THEN 1 + seq % 3 ELSE 3 * (1 + seq % 4) END AS int) AS retries,
       ok AS success, ts AS searched_at
FROM (SELECT event_id AS seq, ts, event_type,
             {DESTINATION} AS d,
             cast(floor(user_id / 15) AS bigint) % 2 AS dir,
             CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS rt,
             cast(ts AS date) + cast(user_id % 7 AS int) AS dep,
             cast(round(value * 100) AS bigint) AS cents,
             CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS ok
      FROM events) x
""".replace("{DESTINATION}", DESTINATION)

VIEWS["fx_attempts"] = f"""
SELECT seq, route, dep_date, return_date, flight_type, origin, destination,
       CASE WHEN success = 1 AND seq % 10 = 0 THEN '[]' WHEN success = 1 THEN concat('[', {_offer_text(0)},
            {", ".join(f"CASE WHEN seq % 4 >= {pos} THEN concat(', ', {_offer_text(pos)}) ELSE '' END" for pos in POSITIONS if pos)}, ']') END AS flights,
       error_type, retries, success, searched_at
FROM fx_searches
"""

VIEWS["fx_attempt_log"] = """
SELECT seq, route, dep_date, return_date, flight_type,
       cast(floor(n / 3) AS int) AS round, cast(n % 3 AS int) AS attempt, success, error_type, flights, searched_at
FROM (SELECT *, row_number() OVER (PARTITION BY route, dep_date, return_date, flight_type ORDER BY seq) - 1 AS n
      FROM fx_attempts) x
"""

def _offers_at(pos: int, where: str) -> str:
    f = _of(pos)
    return f"""SELECT seq, route, dep_date, return_date, flight_type, origin, destination, cast(searched_at AS date) AS snapshot_date,
       {pos} AS offer_pos, {f["currency"]} AS currency, cast({f["cents"]} AS double) / 100 AS price, {f["airline"]} AS primary_airline_name, {f["stops"]} AS stops
FROM fx_searches WHERE success = 1 AND seq % 10 <> 0 AND {where}"""


# The offers of all searches; the first offer of some came twice.
VIEWS["fx_offers"] = " UNION ALL ".join([*(_offers_at(pos, f"seq % 4 >= {pos}") for pos in POSITIONS), _offers_at(0, "seq % 23 = 0")])

VIEWS["fx_responses"] = """
SELECT page_id AS response_id,
       cast(CASE page_id % 8 WHEN 0 THEN 200 WHEN 1 THEN 200 WHEN 2 THEN 200 WHEN 3 THEN 429
                             WHEN 4 THEN 503 WHEN 5 THEN 403 WHEN 6 THEN 404 ELSE 302 END AS int) AS status,
       CASE WHEN page_id % 5 = 0 THEN concat('<title>UNUSUAL Traffic</title>', html) ELSE html END AS body
FROM pages
"""

VIEWS["fx_payloads"] = """
SELECT event_id AS response_id,
       CASE event_id % 6
         WHEN 0 THEN concat('[[],[],[[{"price":', c, '},{"price":"x"}]],null]')
         WHEN 1 THEN concat('[[],[],null,[[{"price":', c, '}]]]')
         WHEN 2 THEN concat('[[],[],[[{"price":', c, '}]],[[{"price":1},{"price":2}]]]')
         WHEN 3 THEN '[[],[]]' WHEN 4 THEN '[[],[],[5],null]' ELSE '{broken' END AS payload
FROM (SELECT event_id, cast(cast(round(value * 100) AS bigint) AS string) AS c FROM events) x
"""

VIEWS["fx_list_lines"] = """
SELECT concat('src', cast(page_id % 10 AS string)) AS source, page_id AS line_no,
       CASE page_id % 4 WHEN 0 THEN 'http' WHEN 1 THEN 'https' WHEN 2 THEN 'socks4' ELSE 'ftp' END AS protocol,
       CASE page_id % 9 WHEN 0 THEN '# comment' WHEN 1 THEN ''
            WHEN 2 THEN concat('[::1]:', cast(page_id * 331 % 70000 AS string))
            WHEN 3 THEN concat('HTTP://10.0.', cast(page_id % 4 AS string), '.', cast(page_id % 3 AS string), ':8080/')
            WHEN 4 THEN '1.2.3.4' WHEN 5 THEN '1.2.3.4:8080:extra' WHEN 6 THEN url
            ELSE concat('10.0.', cast(page_id % 4 AS string), '.', cast(page_id % 3 AS string), ':',
                        cast(page_id * 331 % 70000 AS string)) END AS line
FROM pages
"""

VIEWS["fx_echo"] = """
SELECT doc_id AS probe_id,
       CASE doc_id % 5 WHEN 0 THEN concat('{"origin": "1.2.3.', cast(doc_id % 300 AS string), ', 5.6.7.8"}')
            WHEN 1 THEN concat('{"ip": "10.0.0.', cast(doc_id % 256 AS string), '"}')
            WHEN 2 THEN text
            WHEN 3 THEN concat('999.1.1.1 then 10.0.1.', cast(doc_id % 300 AS string))
            ELSE '{"query": 5}' END AS body
FROM documents
"""

VIEWS["fx_probes"] = """
SELECT event_id AS probe_id, ts, concat('http://10.0.0.', cast(user_id AS string), ':8080') AS url,
       concat('src', cast(user_id % 10 AS string)) AS source, event_id % 3 AS echo_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE round(value * 5, 2) END AS latency_ms,
       CASE event_type WHEN 'error' THEN 'failure' WHEN 'view' THEN 'rate_limited'
                       WHEN 'signup' THEN 'stub' ELSE 'ok' END AS event
FROM events
"""

VIEWS["fx_outbound"] = """
SELECT o_custkey AS task_id, o_orderkey AS out_id, o_orderkey AS out_pos,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS price,
       cast(60 + o_orderkey % 600 AS int) AS duration, cast(o_orderkey % 3 AS int) AS stops,
       CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE concat('o', cast(o_orderkey AS string)) END AS booking_token,
       CASE WHEN o_orderkey % 7 = 0 THEN '429' WHEN o_orderkey % 11 = 0 THEN 'timeout' END AS expand_error
FROM orders
"""

VIEWS["fx_inbound"] = """
SELECT l_orderkey AS out_id, l_linenumber AS in_pos,
       CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_extendedprice END AS price,
       cast(60 + l_partkey % 600 AS int) AS duration, cast(l_partkey % 3 AS int) AS stops,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE concat('i', cast(l_partkey AS string)) END AS booking_token
FROM lineitem
"""

# Attempts as they reach the writer: no return date is NULL, success a truth value, some without an error.
VIEWS["fx_outcomes"] = """
SELECT seq, route, dep_date, CASE WHEN return_date = '' THEN NULL ELSE return_date END AS return_date,
       flight_type, origin, destination,
       CASE WHEN success = 1 AND seq % 9 = 0 THEN '[]' ELSE flights END AS flights,
       CASE WHEN success = 0 AND seq % 7 = 0 THEN NULL ELSE error_type END AS error_type,
       retries, success = 1 AS success, searched_at
FROM fx_attempts
"""

# State with unknown success, placeholders and failures; one row per key.
VIEWS["fx_state"] = """
SELECT route, dep_date, return_date, flight_type, origin, destination, flights,
       CASE WHEN success = 0 AND seq % 5 = 0 THEN NULL ELSE error_type END AS error_type,
       retries, CASE WHEN seq % 11 = 0 THEN NULL ELSE success END AS success, searched_at
FROM (SELECT *, row_number() OVER (PARTITION BY route, dep_date, return_date, flight_type ORDER BY seq DESC) AS rn
      FROM fx_attempts) x WHERE rn = 1
"""

# One collection run per day of the log: it looks a week ahead, as the departures of the log do.
VIEWS["fx_runs"] = """
SELECT DISTINCT cast(ts AS date) AS as_of, cast(ts AS date) AS start_date,
       cast(ts AS date) + cast(6 AS int) AS effective_end FROM events
"""

# Windows of every kind: past, reversed, straddling today.
VIEWS["fx_windows"] = """
SELECT o_orderkey AS run_id, cast(o_orderdate AS date) AS start_date,
       cast(o_orderdate AS date) + cast(o_orderkey % 23 - 3 AS int) AS end_date,
       cast(o_orderdate AS date) + cast(o_custkey % 13 - 4 AS int) AS as_of,
       cast(o_custkey % 31 - 2 AS int) AS max_days FROM orders
"""

# Providers cover the routes on which they did at least averagely; the last in order wins.
VIEWS["fx_coverage"] = """
SELECT concat('p', cast(pos AS string)) AS provider, pos AS provider_pos, route, origin, destination AS dest
FROM (SELECT seq % 4 AS pos, route, origin, destination, avg(success) AS rate FROM fx_attempts
      WHERE error_type IS NULL OR error_type <> 'other' GROUP BY seq % 4, route, origin, destination) x
WHERE rate >= 0.45
"""

# Dates as texts, some malformed.
VIEWS["fx_dates"] = """
SELECT o_orderkey AS task_id,
       CASE o_orderkey % 7 WHEN 0 THEN '2024-99-99' WHEN 1 THEN 'soon'
            ELSE cast(cast(o_orderdate AS date) AS string) END AS dep_date,
       CASE o_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '2024-02-30'
            ELSE cast(cast(o_orderdate AS date) + cast(7 AS int) AS string) END AS return_date FROM orders
"""

# Codes as they come in, with aliases, an extra and unknown ones; the code table comes from the log.
VIEWS["fx_codes"] = """
SELECT event_id, CASE event_id % 11 WHEN 0 THEN 'OKA' WHEN 1 THEN 'YIC' WHEN 2 THEN 'XXX' WHEN 3 THEN 'NAH'
                 ELSE {DESTINATION} END AS code FROM events
""".replace("{DESTINATION}", DESTINATION)

# Exchanges with a payload, a block page, a long body without payload or a transport failure.
VIEWS["fx_exchanges"] = """
SELECT response_id, response_id % 13 <> 0 AS has_endpoint,
       CASE response_id % 11 WHEN 0 THEN 'Timeout' WHEN 1 THEN 'ProxyError' WHEN 2 THEN 'ConnectionError'
                             WHEN 3 THEN 'ValueError' END AS exception,
       cast(CASE response_id % 17 WHEN 0 THEN 429 WHEN 1 THEN 503 WHEN 2 THEN 403 WHEN 3 THEN 404 WHEN 4 THEN 302
                                  ELSE 200 END AS int) AS status,
       CASE WHEN response_id % 19 = 0 THEN concat('<p>CAPTCHA</p>', payload)
            WHEN response_id % 23 = 0 THEN repeat('x', 1024) ELSE payload END AS body
FROM fx_payloads
"""

# Source addresses: pages, some under the name of a high-yield list.
VIEWS["fx_sources"] = """
SELECT page_id AS pos, CASE page_id % 6 WHEN 0 THEN concat(url, '/Databay/list') WHEN 1 THEN concat(url, '/proxyscrape')
       WHEN 2 THEN concat(url, '/VMHeaven/databay') WHEN 3 THEN concat(url, '/checked-proxy-list')
       ELSE url END AS url FROM pages
"""

# Echo answers with a status.
VIEWS["fx_echo_probes"] = """
SELECT probe_id, body, probe_id % 17 = 0 AS failed,
       cast(CASE probe_id % 13 WHEN 0 THEN 407 WHEN 1 THEN 403 WHEN 2 THEN 429 WHEN 3 THEN 500 ELSE 200 END AS int) AS status,
       cast(probe_id % 1500 AS double) + 0.5 AS latency_ms
FROM fx_echo
"""

# Numbered candidates: one per probe, alive unless the probe failed, valid when it was good.
VIEWS["fx_candidates"] = """
SELECT probe_id AS pos, url, source, event <> 'failure' AS alive, event = 'ok' AS valid FROM fx_probes
"""

# The pool: one row per endpoint, weighted by its best latency.
VIEWS["fx_pool"] = """
SELECT cast(split_part(split_part(url, '10.0.0.', 2), ':', 1) AS bigint) AS pos, url, quality_score
FROM (SELECT url, CASE WHEN min(latency_ms) < 50 THEN 1.3 WHEN min(latency_ms) < 100 THEN 1.1 ELSE 1.0 END AS quality_score
      FROM fx_probes WHERE event = 'ok' GROUP BY url) x
"""

# Draws for tasks, from 0 to 1 inclusive.
VIEWS["fx_draws"] = """
SELECT o_orderkey AS task_id, cast(o_custkey * 7919 % 10001 AS double) / 10000.0 AS u FROM orders
"""

# Two saved pools a day.
VIEWS["fx_snapshots"] = """
SELECT snapshot_id, max(ts) OVER (PARTITION BY snapshot_id) AS cached_at, url
FROM (SELECT concat(cast(cast(ts AS date) AS string), CASE WHEN extract(hour FROM ts) < 12 THEN 'a' ELSE 'b' END) AS snapshot_id,
             url, max(ts) AS ts
      FROM fx_probes GROUP BY 1, 2) x
"""

# Throttling reports per source.
VIEWS["fx_reports"] = """
SELECT source, ts, probe_id AS id, event = 'rate_limited' AS is_429 FROM fx_probes
"""


def _needs(text: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b{v}\b", text)]


def _order(text: str) -> list[str]:
    """Views ``text`` uses, each after the views it uses itself."""
    out: list[str] = []
    for view in _needs(text):
        for name in [*_order(VIEWS[view]), view]:
            if name not in out:
                out.append(name)
    return out


def with_views(text: str) -> str:
    """``text`` with the views it uses as CTEs in front."""
    views = _order(text)
    if not views:
        return text
    ctes = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in views)
    return f"WITH {ctes}\n{text}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run ``text`` over the tables of ``sf_dir`` and the views above."""
    full = with_views(text)
    for name in TABLES:
        if re.search(rf"\b{name}\b", full):
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(full)


def fx(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return sql(spark, sf_dir, f"SELECT * FROM {view}")
