"""Queries over endpoint lists, probes, pool state and throttling."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import net
from farelake.operators import endpoints as ep
from farelake.operators import rate
from farelake.plans.fixtures import fx
from farelake.plans.registry import query

AS_OF = "2024-01-30 23:50:00"
REAL_IP = "10.0.0.7"
# Budgets low enough for the bursts of a thinly spread log.
MAX_RATE, MIN_RATE, BURST_RATE = 0.15, 0.02, 0.2

RANK = "CASE " + " ".join(
    f"WHEN contains(lower(url), '{m}') THEN {i}" for i, m in enumerate(S.SOURCE_MARKERS)
) + f" ELSE {len(S.SOURCE_MARKERS)} END"


@query("source_rank", f"SELECT pos, url, ({RANK})::INT AS marker_rank FROM fx_sources")
def source_rank(spark, sf):
    return ep.source_rank(fx(spark, sf, "fx_sources"))


LINES = "(SELECT source, line_no, protocol, trim(line) AS line FROM fx_list_lines WHERE trim(line) <> '' AND line NOT LIKE '#%')"


@query("list_lines", f"SELECT * FROM {LINES} x")
def list_lines(spark, sf):
    return ep.list_lines(fx(spark, sf, "fx_list_lines"))


NORMALISED = rf"""(SELECT * FROM (SELECT source, line_no, line, CASE WHEN scheme IN ('http', 'https', 'socks4', 'socks5')
  AND length(host) > 0 AND try_cast(port AS int) BETWEEN 1 AND 65535
  THEN scheme || '://' || host || ':' || cast(try_cast(port AS int) AS varchar) END AS url, scheme AS protocol
 FROM (SELECT *, CASE WHEN rest LIKE '[%' THEN regexp_extract(rest, '^\[[^\]]*\]') ELSE regexp_extract(rest, '^([^:]*):', 1) END AS host,
   regexp_extract(rest, CASE WHEN rest LIKE '[%' THEN '^\[[^\]]*\]:*([0-9]+)$' ELSE '^[^:]*:+([0-9]+)$' END, 1) AS port
  FROM (SELECT *, CASE WHEN contains(line, '://') THEN lower(split_part(line, '://', 1)) ELSE protocol END AS scheme,
    rtrim(CASE WHEN contains(line, '://') THEN substr(line, instr(line, '://') + 3) ELSE line END, '/') AS rest
   FROM {LINES} n1) n2) n3) n4 WHERE url IS NOT NULL)"""


@query("normalise_endpoint", f"SELECT * FROM {NORMALISED} x")
def normalise_endpoint(spark, sf):
    return ep.normalise_lines(fx(spark, sf, "fx_list_lines"))


@query("cap_per_source", f"""
SELECT source, line_no, url FROM (SELECT *, row_number() OVER (PARTITION BY source
 ORDER BY md5(url || '#' || cast(line_no AS varchar) || '#7'), line_no) AS rn FROM {NORMALISED} x) y WHERE rn <= 3""")
def cap_per_source(spark, sf):
    return ep.cap_per_source(normalise_endpoint(spark, sf), 3, seed=7).select("source", "line_no", "url")


@query("dedup_first", f"""
SELECT source, line_no, url, protocol FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY source, line_no) AS rn
 FROM {NORMALISED} x) y WHERE rn = 1""")
def dedup_first(spark, sf):
    return ep.dedup_first(normalise_endpoint(spark, sf)).select("source", "line_no", "url", "protocol")


V4 = net.IPV4
LITERAL = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"


def field_ip(name: str) -> str:
    """The first part of a JSON text field when it is an address; other kinds of value do not count."""
    text = f"trim(split_part(doc->>'$.{name}', ',', 1))"
    return f"CASE WHEN json_type(doc, '$.{name}') = 'VARCHAR' AND regexp_matches({text}, '{V4}') THEN {text} END"


EXIT_IP = f"""coalesce({field_ip('origin')}, {field_ip('ip')}, {field_ip('query')},
 list_filter(regexp_extract_all(body, '{LITERAL}'), lambda x: regexp_matches(x, '{V4}'))[1])"""


def echoes(view: str) -> str:
    return f"(SELECT *, {EXIT_IP} AS exit_ip FROM (SELECT *, CASE WHEN json_valid(body) THEN body ELSE '{{}}' END AS doc FROM {view}) e1)"


@query("extract_ip", f"SELECT probe_id, exit_ip FROM {echoes('fx_echo')} x")
def extract_ip(spark, sf):
    return fx(spark, sf, "fx_echo").select("probe_id", net.extract_ip("body").alias("exit_ip"))


MARKER = " OR ".join(f"contains(lower(body), '{m}')" for m in S.BLOCK_MARKERS)


@query("probe_class", f"""
SELECT probe_id, reason, CASE WHEN reason IS NULL THEN latency_ms END AS ok_latency_ms FROM (SELECT *,
 CASE WHEN failed THEN 'failure' WHEN status = 407 THEN 'auth' WHEN status = 403 THEN 'blocked'
  WHEN status = 429 THEN 'rate_limited' WHEN status <> 200 THEN 'http_' || cast(status AS varchar)
  WHEN exit_ip IS NULL THEN 'bad_body' WHEN exit_ip = '{REAL_IP}' THEN 'transparent'
  WHEN {MARKER} THEN 'block_marker' END AS reason FROM {echoes('fx_echo_probes')} x) y""")
def probe_class(spark, sf):
    return ep.probe_class(fx(spark, sf, "fx_echo_probes"), REAL_IP).select("probe_id", "reason", "ok_latency_ms")


MEDIAN = """(SELECT url, CASE WHEN count(latency_ms) >= 2 THEN list_sort(list(latency_ms) FILTER (WHERE latency_ms IS NOT NULL))
 [count(latency_ms) // 2 + 1] ELSE 0.0 END AS median_ms FROM fx_probes GROUP BY url)"""
QUALITY = "CASE WHEN median_ms < 500 THEN 1.3 WHEN median_ms < 1000 THEN 1.1 ELSE 1.0 END::DOUBLE"


@query("echo_median", f"SELECT * FROM {MEDIAN} x")
def echo_median(spark, sf):
    return ep.echo_median(fx(spark, sf, "fx_probes"))


@query("quality_score", f"SELECT url, median_ms, {QUALITY} AS quality_score FROM {MEDIAN} x WHERE median_ms <> 0")
def quality_score(spark, sf):
    return ep.quality_scores(echo_median(spark, sf))


@query("source_yield", """
SELECT source, count(*) AS candidates, count(*) FILTER (WHERE alive) AS alive, count(*) FILTER (WHERE alive AND valid) AS valid
FROM fx_candidates GROUP BY source""")
def source_yield(spark, sf):
    return ep.source_yield(fx(spark, sf, "fx_candidates"))


@query("prefilter_until", """
SELECT pos, url, source, alive, pos // 500 AS batch FROM fx_candidates WHERE pos // 500 <= coalesce((SELECT min(batch)
 FROM (SELECT batch, sum(n) OVER (ORDER BY batch) AS upto FROM (SELECT pos // 500 AS batch,
  count(*) FILTER (WHERE alive) AS n FROM fx_candidates GROUP BY 1) b) c WHERE upto >= 3000), 1000000000000)""")
def prefilter_until(spark, sf):
    target = S.VALID_TARGET * S.ALIVE_PER_VALID
    return ep.prefilter_until(fx(spark, sf, "fx_candidates"), target).drop("valid")


@query("valid_until", "SELECT pos, url, source FROM fx_candidates WHERE valid ORDER BY pos LIMIT 100")
def valid_until(spark, sf):
    return ep.valid_until(fx(spark, sf, "fx_candidates")).select("pos", "url", "source")


POOL = """(SELECT url, max(c429) AS rate_limited_count, max(cstub) AS stub_count,
 arg_max(ts, probe_id) FILTER (WHERE ttl IS NOT NULL) AS evicted_at,
 arg_max(ts + to_seconds(ttl), probe_id) FILTER (WHERE ttl IS NOT NULL) AS blacklist_until,
 max(CASE WHEN event = 'rate_limited' AND ttl IS NULL THEN ts + to_seconds(120) END) AS rate_limit_until
FROM (SELECT *, CASE WHEN event = 'failure' THEN 600 WHEN event = 'rate_limited' AND c429 >= 3 THEN 1800
  WHEN event = 'stub' AND cstub >= 3 THEN 1800 END AS ttl
 FROM (SELECT *, count(*) FILTER (WHERE event = 'rate_limited') OVER w AS c429,
   count(*) FILTER (WHERE event = 'stub') OVER w AS cstub FROM fx_probes
  WINDOW w AS (PARTITION BY url ORDER BY ts, probe_id)) p1) p2 GROUP BY url)"""
ACTIVE = f"(SELECT url, blacklist_until FROM {POOL} a WHERE blacklist_until > TIMESTAMP '{AS_OF}')"


def pool_state(spark, sf):
    return ep.evict_blacklist(fx(spark, sf, "fx_probes"))


def blacklist(spark, sf):
    return ep.active_blacklist(pool_state(spark, sf), AS_OF)


@query("evict_blacklist", f"SELECT * FROM {POOL} x")
def evict_blacklist(spark, sf):
    return pool_state(spark, sf)


@query("active_blacklist", f"SELECT * FROM {ACTIVE} x")
def active_blacklist(spark, sf):
    return blacklist(spark, sf)


@query("without_blacklisted", f"SELECT pos, url FROM fx_candidates WHERE url NOT IN (SELECT url FROM {ACTIVE} x)")
def without_blacklisted(spark, sf):
    return ep.without_blacklisted(fx(spark, sf, "fx_candidates"), blacklist(spark, sf)).select("pos", "url")


@query("pool_counts", f"""
SELECT count(*) AS working, count(*) FILTER (WHERE rate_limit_until IS NULL OR rate_limit_until <= TIMESTAMP '{AS_OF}') AS usable
FROM {POOL} x WHERE url NOT IN (SELECT url FROM {ACTIVE} y)""")
def pool_counts(spark, sf):
    pool = ep.without_blacklisted(pool_state(spark, sf), blacklist(spark, sf))
    return ep.pool_counts(pool, AS_OF)


@query("weighted_pick", """
SELECT task_id, u, pos, url FROM (SELECT d.task_id, d.u, p.pos, p.url,
 row_number() OVER (PARTITION BY d.task_id ORDER BY p.pos) AS rn
 FROM (SELECT task_id, u, u * (SELECT sum(round(quality_score * 1000000)::BIGINT) FROM fx_pool) AS r FROM fx_draws) d
 JOIN (SELECT pos, url, sum(round(quality_score * 1000000)::BIGINT) OVER (ORDER BY pos) AS high FROM fx_pool) p
 ON p.high >= d.r) x WHERE rn = 1""")
def weighted_pick(spark, sf):
    return ep.weighted_pick(fx(spark, sf, "fx_draws"), fx(spark, sf, "fx_pool"))


@query("snapshot_decision", f"""
SELECT snapshot_id, listed, kept, valid, age_s, CASE WHEN age_s < 1800 AND kept < 50 THEN 'refetch'
 WHEN age_s < 1800 AND kept > 60 THEN 'adopt_fresh' WHEN age_s < 1800 THEN 'keep_pool'
 WHEN age_s < 86400 AND valid >= 50 THEN 'adopt_revalidated' ELSE 'refetch' END AS decision
FROM (SELECT snapshot_id, count(*) AS listed, count(*) FILTER (WHERE b.url IS NULL) AS kept,
 count(*) FILTER (WHERE v.url IS NOT NULL) AS valid,
 (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(cached_at))) / 1e6 AS age_s
 FROM fx_snapshots s LEFT JOIN {ACTIVE} b ON b.url = s.url
 LEFT JOIN (SELECT url FROM {MEDIAN} m WHERE median_ms <> 0 AND median_ms < 600) v ON v.url = s.url
 GROUP BY snapshot_id) x""")
def snapshot_decision(spark, sf):
    valid = quality_score(spark, sf).filter("median_ms < 600")
    return ep.snapshot_decision(
        fx(spark, sf, "fx_snapshots"), blacklist(spark, sf), valid, "2024-01-31 00:00:00", usable=60
    )


@query("adopt_valid", f"""
SELECT url, {QUALITY} AS quality_score FROM {MEDIAN} x WHERE median_ms <> 0""")
def adopt_valid(spark, sf):
    pool = fx(spark, sf, "fx_pool").select("url", F.col("quality_score").cast("double").alias("quality_score"))
    return ep.adopt_valid(pool, quality_score(spark, sf).select("url", "quality_score"))


@query("adopt_valid_none", "SELECT pos, url FROM fx_pool")
def adopt_valid_none(spark, sf):
    """Nothing validates, so the old pool stays."""
    pool = fx(spark, sf, "fx_pool").select("pos", "url")
    return ep.adopt_valid(pool, pool.join(quality_score(spark, sf), "url", "left_semi").filter("pos < 0").select("pos", "url"))


@query("adopted_share", f"""
SELECT (SELECT count(*) FROM {MEDIAN} x WHERE median_ms <> 0 AND median_ms < 600) AS n_valid,
 (SELECT count(*) FROM {MEDIAN} x) AS n_total,
 (SELECT count(*) FROM {MEDIAN} x WHERE median_ms <> 0 AND median_ms < 600) / (SELECT count(*) FROM {MEDIAN} x) * 100 AS pct""")
def adopted_share(spark, sf):
    return ep.adopted_share(quality_score(spark, sf).filter("median_ms < 600"), echo_median(spark, sf))


@query("rate_burst", f"""
SELECT source, ts, count(*) AS n, max(n_30s) AS n_30s, max(n_30s) > 30 * {BURST_RATE} * 0.2 AS burst
FROM (SELECT source, ts, count(*) OVER (PARTITION BY source ORDER BY ts
  RANGE BETWEEN INTERVAL 30 SECONDS PRECEDING AND CURRENT ROW) AS n_30s FROM fx_reports WHERE is_429) x
GROUP BY source, ts""")
def rate_burst(spark, sf):
    return rate.rate_burst(fx(spark, sf, "fx_reports"), BURST_RATE)


TRACE = f"""
SELECT source, at_us, id, hits, old_rate, new_rate FROM (WITH RECURSIVE counted AS (SELECT source, epoch_us(ts) AS at_us, id, is_429,
  count(*) FILTER (WHERE is_429) OVER (PARTITION BY source ORDER BY ts RANGE BETWEEN INTERVAL 30 SECONDS PRECEDING AND CURRENT ROW) AS c30,
  count(*) FILTER (WHERE is_429) OVER (PARTITION BY source ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW) AS c60
  FROM fx_reports),
 log AS MATERIALIZED (SELECT source, at_us, id, CASE WHEN is_429 THEN c30 ELSE 0 END AS hits,
  row_number() OVER (PARTITION BY source ORDER BY at_us, id) AS n FROM counted WHERE is_429 OR c60 = 0),
 walk AS (SELECT source, 0::BIGINT AS at_us, 0::BIGINT AS id, 0::BIGINT AS hits, 0::BIGINT AS n, {MAX_RATE}::DOUBLE AS old_rate,
   {MAX_RATE}::DOUBLE AS new_rate FROM (SELECT DISTINCT source FROM fx_reports) s
  UNION ALL SELECT l.source, l.at_us, l.id, l.hits, l.n, w.new_rate, CASE WHEN l.hits = 0 THEN least({MAX_RATE}::DOUBLE, w.new_rate * 2)
   WHEN l.hits > 30 * 0.2 * w.new_rate THEN greatest({MIN_RATE}::DOUBLE, w.new_rate * 0.5) ELSE w.new_rate END
  FROM walk w JOIN log l ON l.source = w.source AND l.n = w.n + 1)
 SELECT * FROM walk) x WHERE old_rate <> new_rate"""


@query("rate_trace", TRACE)
def rate_trace(spark, sf):
    return rate.rate_trace(fx(spark, sf, "fx_reports"), MAX_RATE, MIN_RATE)
