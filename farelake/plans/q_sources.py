"""Queries that write files under the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import state as st
from farelake.plans import lifecycle
from farelake.plans.crc import CRC_TABLE_SQL, crc32_sql
from farelake.plans.fixtures import fx
from farelake.plans.providers import Provider, ProviderRegistry, captured, collect
from farelake.plans.q_endpoints import MEDIAN, QUALITY, quality_score
from farelake.plans.q_state import COLUMNS, FIELD, LATEST, PK, all_offers, stored
from farelake.plans.q_tasks import GRID, build_tasks
from farelake.plans.registry import query
from farelake.session import work_path
from farelake.sources import bronze, silver, snapshots, statetable

GOOD = f"(SELECT * FROM {LATEST} l WHERE success = 1)"
ALL_OFFERS = all_offers(GOOD)
OFFERS = f"""SELECT {PK}, origin, destination, searched_at, n_offers, offer_pos, {FIELD.format("price")}::DOUBLE AS price,
 {FIELD.format("currency")} AS currency, {FIELD.format("primary_airline_name")} AS airline FROM {ALL_OFFERS} o"""


def exported(spark, sf, label: str) -> str:
    """The successful rows of the state as a bundle; returns its path."""
    path = f"{work_path(spark, label)}/search_20240131_000000.jsonl"
    bronze.export_bronze(stored(spark, sf), path)
    return path


def with_offers(rows):
    """One row per offer with its place in the list; a search without offers keeps one."""
    return rows.select(
        *S.SEED_COLUMNS, F.col("searched_at").cast("timestamp_ntz").alias("searched_at"), F.size("flights").alias("n_offers"),
        F.posexplode_outer("flights").alias("offer_pos", "offer"),
    ).select(
        *S.SEED_COLUMNS, "searched_at", "n_offers", "offer_pos", "offer.price", "offer.currency", F.col("offer.primary_airline_name").alias("airline")
    )


@query("read_bronze", OFFERS)
def read_bronze(spark, sf):
    return with_offers(bronze.read_bronze(spark, exported(spark, sf, "bronze")).drop(bronze.CORRUPT))


@query("read_bronze_inferred", f"""
SELECT route, count(*) AS n, sum({FIELD.format("price")}::BIGINT)::BIGINT AS cents FROM {ALL_OFFERS} o GROUP BY route""")
def read_bronze_inferred(spark, sf):
    """Columns taken from the lines themselves."""
    rows = bronze.read_bronze(spark, exported(spark, sf, "inferred"), schema=None)
    offers = rows.select("route", F.explode_outer("flights.price").alias("price"))
    return offers.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("cents"))


@query("latest_bundle", f"SELECT route, count(*) AS n FROM {GOOD} g WHERE flight_type = 'ROUND_TRIP' GROUP BY route")
def latest_bundle(spark, sf):
    """The bundle written last is read, though its name sorts first."""
    folder = work_path(spark, "bundles")
    state = stored(spark, sf)
    bronze.export_bronze(state, f"{folder}/search_20240131_000000.jsonl")
    bronze.export_bronze(state.filter(F.col("flight_type") == S.ROUND_TRIP), f"{folder}/search_20240101_000000.jsonl")
    rows = bronze.read_bronze(spark, bronze.require_latest_bundle(spark, folder))
    return rows.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def written_silver(spark, sf, label: str) -> tuple[str, int]:
    path = work_path(spark, label)
    return path, lifecycle.transform(spark, exported(spark, sf, f"{label}-bronze"), path)


@query("silver_write", OFFERS)
def silver_write(spark, sf):
    """Written whole, then one route again: the other routes stay."""
    path, _ = written_silver(spark, sf, "silver")
    one = silver.read_silver(spark, path).filter(F.col("route") == "SIN|KUL").checkpoint()
    silver.write_silver(one, path)
    return with_offers(silver.read_silver(spark, path))


@query("silver_growing", f"""
SELECT {PK}, offer_pos, {FIELD.format("price")}::DOUBLE AS price, CASE WHEN destination < 'KIX' AND offer_pos IS NOT NULL THEN 'eco' END AS cabin,
 CASE WHEN destination < 'KIX' THEN 7 END AS trace_id FROM {ALL_OFFERS} o""")
def silver_growing(spark, sf):
    """Later bundles have a field more, and their offers too; older files stay as they are."""
    out = work_path(spark, "silver-growing")
    lines = spark.read.text(exported(spark, sf, "growing-bronze"))
    some = F.get_json_object("value", "$.destination") < "KIX"
    lines.filter(~some).write.text(f"{out}/search_1.jsonl")
    newer = F.regexp_replace(F.regexp_replace("value", '"currency"', '"cabin": "eco", "currency"'), r"^\{", '{"trace_id": 7, ')
    lines.filter(some).select(newer.alias("value")).write.text(f"{out}/search_2.jsonl")
    for bundle in (1, 2):
        lifecycle.transform(spark, f"{out}/search_{bundle}.jsonl", f"{out}/silver", growing=True)
    rows = silver.read_silver(spark, f"{out}/silver", growing=True)
    return rows.select(*S.PK, "trace_id", F.posexplode_outer("flights").alias("offer_pos", "offer")).select(
        *S.PK, "offer_pos", "offer.price", "offer.cabin", "trace_id"
    )


@query("silver_read", f"""
SELECT route, flight_type, count(*) AS n, min({FIELD.format("price")}::DOUBLE) AS min_price
FROM {ALL_OFFERS} o WHERE origin = 'SIN' GROUP BY route, flight_type""")
def silver_read(spark, sf):
    path, _ = written_silver(spark, sf, "silver-sql")
    silver.read_silver(spark, path).createOrReplaceTempView("silver_rows")
    return spark.sql(
        "SELECT route, flight_type, count(*) AS n, min(price) AS min_price FROM silver_rows "
        "LATERAL VIEW OUTER explode(flights.price) o AS price WHERE route LIKE 'SIN|%' GROUP BY route, flight_type"
    )


@query("write_count", f"SELECT count(*) AS n FROM {GOOD} g")
def write_count(spark, sf):
    _, n = written_silver(spark, sf, "counted")
    return spark.range(1).select(F.lit(n).cast("bigint").alias("n"))


@query("bronze_export", f"""
SELECT {PK}, origin, destination, offer_pos, {FIELD.format("price")}::BIGINT AS cents, 8 AS n_fields, searched_at FROM {ALL_OFFERS} o""")
def bronze_export(spark, sf):
    """The exported lines, taken apart again with a plain JSON reader."""
    lines = spark.read.text(exported(spark, sf, "export"))
    doc = F.parse_json("value")
    text = [F.try_variant_get(doc, f"$.{c}", "string").alias(c) for c in S.SEED_COLUMNS]
    offers = F.from_json(F.get_json_object("value", "$.flights"), "array<string>")
    return lines.select(
        *text, F.size(F.json_object_keys("value")).alias("n_fields"),
        F.try_variant_get(doc, "$.searched_at", "string").cast("timestamp_ntz").alias("searched_at"), F.posexplode_outer(offers).alias("offer_pos", "offer"),
    ).withColumn("cents", F.get_json_object("offer", "$.price").cast("bigint")).drop("offer")


@query("publish_manifest", f"SELECT DISTINCT 'silver/route=' || route AS folder, true AS filled FROM {GOOD} g")
def publish_manifest(spark, sf):
    path, _ = written_silver(spark, sf, "published")
    files = silver.publish_manifest(spark, path)
    folder = F.regexp_replace(F.url_decode("key"), "/[^/]*$", "")
    return files.groupBy(folder.alias("folder")).agg((F.sum("length") > 0).alias("filled"))


LATE = "searched_at >= TIMESTAMP '2024-01-15'"


@query("state_write_read", f"SELECT seq, {COLUMNS} FROM {LATEST} l")
def state_write_read(spark, sf):
    """Two versions: the second is made from the first and a later part of the log."""
    path = work_path(spark, "state")
    log = fx(spark, sf, "fx_attempts")
    statetable.write_state(st.upsert_latest(log.filter(f"NOT {LATE}")), path, "first half")
    statetable.upsert_state(log.filter(LATE), path, "all")
    return statetable.read_state(spark, path).select("seq", *S.STATE_COLUMNS)


STATE_BUCKETS = 16
# What is written after the first half of the log: one route, then a few failures, then a row older than all.
UPSERTS = {2: f"{LATE} AND route = 'SIN|KUL' AND dep_date < '2024-01-20'",
           3: f"{LATE} AND error_type = 'other' AND route LIKE '%P%' AND dep_date > '2024-01-27'",
           4: "seq = 0"}


@query("state_buckets", f"""
SELECT bucket, max(version) AS version, count(*) FILTER (WHERE rn = 1) AS n, (sum(seq) FILTER (WHERE rn = 1))::BIGINT AS seqs FROM (
 SELECT bucket, version, seq, row_number() OVER (PARTITION BY {PK} ORDER BY seq DESC) AS rn FROM (
  WITH {CRC_TABLE_SQL} SELECT l.*, {crc32_sql(PK.replace(", ", " || '|' || "))} % {STATE_BUCKETS} AS bucket FROM (
   SELECT 1 AS version, seq, {PK} FROM fx_attempts WHERE searched_at < TIMESTAMP '2024-01-15'
   {"".join(f"UNION ALL SELECT {v}, seq, {PK} FROM fx_attempts WHERE {part} " for v, part in UPSERTS.items())}) l, crc_table) x) y
GROUP BY bucket""")
def state_buckets(spark, sf):
    """Per bucket the version it was last written in, and what it holds: later writes leave most buckets alone."""
    path = work_path(spark, "state-buckets")
    log = fx(spark, sf, "fx_attempts")
    statetable.write_state(st.upsert_latest(log.filter(f"NOT {LATE}")), path, buckets=STATE_BUCKETS)
    for part in UPSERTS.values():
        statetable.upsert_state(log.filter(part), path)
    statetable.vacuum(spark, path, keep=1)
    held = statetable.read_state(spark, path).groupBy(statetable.bucket_of(STATE_BUCKETS).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seqs")
    )
    return held.join(statetable.versions_by_bucket(spark, path), "bucket").select("bucket", "version", "n", "seqs")


@query("endpoint_snapshot", f"""
SELECT url, 'http' AS protocol, {QUALITY} AS quality_score, median_ms AS latency_ms, 0.0::DOUBLE AS last_validated,
 0 AS rate_limited_count, '' AS source FROM {MEDIAN} x WHERE median_ms <> 0""")
def endpoint_snapshot(spark, sf):
    """A validated pool, saved and loaded; fields not set come back with their defaults."""
    path = work_path(spark, "pool")
    pool = quality_score(spark, sf).select(
        "url", F.lit("http").alias("protocol"), "quality_score", F.col("median_ms").alias("latency_ms"),
        *[F.lit(None).alias(c) for c in ("last_validated", "rate_limit_until", "rate_limited_count", "stub_count", "source")],
        F.lit(1706659200.0).alias("cached_at"),
    )
    snapshots.write_snapshots(pool, path)
    return snapshots.read_snapshots(spark, path).select(
        "url", "protocol", "quality_score", "latency_ms", "last_validated", "rate_limited_count", "source"
    )


# ------------------------------------------------------------------ providers and whole runs
@query("provider_registry", f"""
SELECT {PK}, origin, destination, provider FROM ({GRID}) g, (VALUES ('hub'), ('all')) v(provider)
WHERE provider = 'all' OR origin = 'SIN'""")
def provider_registry(spark, sf):
    """One provider covers flights out of the hub, one covers all; a third was unregistered."""
    grid = build_tasks(spark, sf)
    same = lambda df: df
    out_of_hub = fx(spark, sf, "fx_attempts").filter("origin = 'SIN'").select(
        "origin", F.col("destination").alias("dest")
    ).distinct()
    registry = ProviderRegistry(gone=Provider(same))
    registry.register("hub", Provider(same, out_of_hub))
    registry.register("all", Provider(same))
    registry.unregister("gone")
    registry.unregister("never there")
    return collect(registry, grid, "").drop("as_of")


ANSWERED = f"SELECT seq, {PK}, success FROM {LATEST} l"


@query("collect", f"""
SELECT *, 'log' AS provider FROM ({ANSWERED}) a UNION ALL SELECT *, 'good' FROM ({ANSWERED}) b WHERE success = 1""")
def collect_runs(spark, sf):
    """Two providers answer the tasks of the grid from captured outcomes."""
    outcomes = stored(spark, sf).select("seq", *S.PK, "success")
    tasks = build_tasks(spark, sf).select(*S.PK, "origin", "destination").distinct()
    registry = ProviderRegistry(
        log=Provider(captured(outcomes, list(S.PK))),
        good=Provider(captured(outcomes.filter("success = 1"), list(S.PK))),
    )
    return collect(registry, tasks, "").select("seq", *S.PK, "success", "provider")


@query("search_run", f"""
SELECT route, (count(*) FILTER (WHERE success = 1))::BIGINT AS n_success,
 (count(*) FILTER (WHERE success = 0 AND error_type IS NOT NULL))::BIGINT AS n_failed,
 (count(*) FILTER (WHERE error_type IS NULL AND success = 0))::BIGINT AS n_unsearched
FROM (SELECT DISTINCT g.route, g.dep_date, g.return_date, g.flight_type, coalesce(s.success, 0) AS success, s.error_type
 FROM ({GRID}) g LEFT JOIN {LATEST} s ON s.route = g.route AND s.dep_date = g.dep_date
 AND s.return_date = g.return_date AND s.flight_type = g.flight_type) x GROUP BY route""")
def search_run(spark, sf):
    """Grid, seeds and outcomes of the log as one plan. Each attempt of the log counts as a round of its own."""
    log = fx(spark, sf, "fx_attempts").withColumn("round", F.col("seq")).withColumn("attempt", F.lit(0))
    state = lifecycle.search(fx(spark, sf, "fx_runs"), log)
    return state.groupBy("route").agg(
        F.count_if(F.expr("success = 1")).alias("n_success"),
        F.count_if(F.expr("success = 0 AND error_type IS NOT NULL")).alias("n_failed"),
        F.count_if(F.expr("success = 0 AND error_type IS NULL")).alias("n_unsearched"),
    )


