"""Streams over the given tables, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions.common import epoch_micros
from farelake.plans.fixtures import sql, table, with_views
from farelake.plans.q_endpoints import BURST_RATE, MAX_RATE, MIN_RATE, POOL, TRACE
from farelake.plans.q_sources import OFFERS, exported, with_offers
from farelake.plans.q_state import COLUMNS, LATEST, PK
from farelake.plans.registry import query
from farelake.session import work_path
from farelake.streaming import jobs
from farelake.streaming.batches import late_rows, split_late


def stream_view(spark, sf: str, view: str) -> DataFrame:
    """A view of projections over events, as a stream of the events table's file or folder of files."""
    events = table(spark, sf, "events")
    some_file = events.select("_metadata.file_path").first()[0]
    in_folder = some_file.rsplit("/", 2)[-2] == "events.parquet"
    folder, glob = (f"{sf}/events.parquet", "*.parquet") if in_folder else (sf, "events.parquet")
    jobs.read_files(spark, folder, events.schema, glob=glob).createOrReplaceTempView("events")
    return spark.sql(with_views(f"SELECT * FROM {view}"))


@query("stream_bronze", OFFERS)
def stream_bronze(spark, sf):
    bundle = exported(spark, sf, "stream-bronze")
    out = work_path(spark, "stream-silver")
    jobs.stream_bronze(jobs.read_bundles(spark, bundle), out, work_path(spark, "ckpt"))
    return with_offers(jobs.read_stream_silver(spark, out))


@query("stream_upsert", f"SELECT seq, {COLUMNS} FROM {LATEST} l")
def stream_upsert(spark, sf):
    out = work_path(spark, "stream-state")
    jobs.stream_upsert(stream_view(spark, sf, "fx_attempts"), out, work_path(spark, "ckpt"))
    return jobs.read_upserted(spark, out).select("seq", *S.STATE_COLUMNS)


@query("stream_upsert_folded", f"SELECT seq, {COLUMNS} FROM {LATEST} l")
def stream_upsert_folded(spark, sf):
    """Two streams over parts of the log that overlap, folded in between, and one of them again from a new checkpoint."""
    out = work_path(spark, "stream-folded")
    log = stream_view(spark, sf, "fx_attempts")
    jobs.stream_upsert(log.filter("seq % 3 < 2"), out, work_path(spark, "ckpt"), buckets=16)
    jobs.compact_upserted(spark, out, buckets=16)
    jobs.stream_upsert(log.filter("seq % 3 > 0"), out, work_path(spark, "ckpt"), buckets=16)
    jobs.compact_upserted(spark, out)
    jobs.drop_folded(spark, out)
    jobs.stream_upsert(log.filter("seq % 3 < 2 AND route LIKE '%KUL%'"), out, work_path(spark, "ckpt"), buckets=16)
    return jobs.read_upserted(spark, out).select("seq", *S.STATE_COLUMNS)


def on_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need an instant; the logs are in UTC whatever the session's zone."""
    return df.withColumn("ts", F.timestamp_micros(epoch_micros(column)))


@query("stream_status", """
SELECT epoch_us(time_bucket(INTERVAL 10 MINUTES, searched_at)) // 1000000 AS window_s, error_type, count(*) AS n
FROM fx_attempts GROUP BY 1, 2""")
def stream_status(spark, sf):
    out = work_path(spark, "stream-status")
    counts = jobs.status_counts(on_time(stream_view(spark, sf, "fx_attempts"), "searched_at"))
    jobs.stream_counts(counts, out, work_path(spark, "ckpt"))
    counted = jobs.read_counts(spark, out, ["window_start", "error_type"])
    return counted.select(F.unix_seconds("window_start").alias("window_s"), "error_type", "n")


@query("stream_burst", f"""
SELECT w AS window_s, source, count(*) FILTER (WHERE is_429) AS n_429, count(*) FILTER (WHERE is_429) > 30 * {BURST_RATE} * 0.2 AS burst
FROM (SELECT source, is_429, unnest(generate_series(epoch_us(ts) // 5000000 * 5 - 25, epoch_us(ts) // 5000000 * 5, 5)) AS w
 FROM fx_reports) x GROUP BY 1, 2""")
def stream_burst(spark, sf):
    out = work_path(spark, "stream-burst")
    counts = jobs.burst_counts(on_time(stream_view(spark, sf, "fx_reports"), "ts"), BURST_RATE)
    jobs.stream_counts(counts, out, work_path(spark, "ckpt"))
    counted = jobs.read_counts(spark, out, ["window_start", "source"])
    return counted.select(F.unix_seconds("window_start").alias("window_s"), "source", "n_429", "burst")


@query("stream_endpoint_state", f"""
SELECT url, rate_limited_count, stub_count, epoch_us(evicted_at) AS evicted_us, epoch_us(blacklist_until) AS blacklist_us,
 epoch_us(rate_limit_until) AS rate_limit_us FROM {POOL} x JOIN (SELECT url, max(ts) AS heard FROM fx_probes GROUP BY url) h USING (url)
WHERE heard + INTERVAL 1 DAY > (SELECT max(ts) FROM fx_probes) - INTERVAL 1 SECOND""")
def stream_endpoint_state(spark, sf):
    """Endpoints that were heard of within a day of the end of the log; the others have expired."""
    out = work_path(spark, "stream-endpoints")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, jobs.ROCKSDB)
    try:
        events = stream_view(spark, sf, "fx_probes").withColumn("ts_us", epoch_micros("ts"))
        jobs.stream_endpoint_state(events, out, work_path(spark, "ckpt"))
    finally:
        spark.conf.set(key, before)
    return jobs.read_endpoint_state(spark, out)


# How the log arrives: the first half of the month, the second, and then, days late, every fiftieth row of the first.
ARRIVALS = """SELECT *, CASE WHEN searched_at >= TIMESTAMP '2024-01-15' THEN 1 WHEN seq % 50 = 0 THEN 2 ELSE 0 END AS arrival FROM fx_attempts"""


@query("stream_late", f"""
SELECT epoch_us(time_bucket(INTERVAL 10 MINUTES, searched_at)) // 1000000 AS window_s, error_type, late, count(*) AS n
FROM (SELECT *, coalesce(searched_at < (SELECT max(searched_at) FROM ({ARRIVALS}) b WHERE b.arrival < a.arrival) - INTERVAL 10 MINUTES, false)
 AS late FROM ({ARRIVALS}) a) x GROUP BY 1, 2, 3""")
def stream_late(spark, sf):
    """What came in time, counted by a stream with a watermark, and what came too late: together every row."""
    out, ckpt = work_path(spark, "stream-late"), work_path(spark, "ckpt")
    rows = on_time(sql(spark, sf, ARRIVALS), "searched_at")
    for arrival in range(3):
        rows.filter(F.col("arrival") == arrival).write.mode("append").parquet(f"{out}/in")
        in_time = split_late(jobs.read_files(spark, f"{out}/in", rows.schema), f"{out}/split", f"{ckpt}/split", 600)
        jobs.stream_counts(jobs.status_counts(in_time), out, f"{ckpt}/counts")
    counted = jobs.read_counts(spark, out, ["window_start", "error_type"]).withColumn("late", F.lit(False))
    late = late_rows(spark, f"{out}/split").groupBy(F.window("ts", "10 minutes").start.alias("window_start"), "error_type").agg(
        F.count(F.lit(1)).alias("n"), F.lit(True).alias("late")
    )
    return counted.unionByName(late).select(F.unix_seconds("window_start").alias("window_s"), "error_type", "late", "n")


@query("stream_rate", TRACE)
def stream_rate(spark, sf):
    out = work_path(spark, "stream-rate")
    jobs.stream_rate(stream_view(spark, sf, "fx_reports"), out, work_path(spark, "ckpt"), MAX_RATE, MIN_RATE)
    return jobs.read_rate_trace(spark, out, MAX_RATE, MIN_RATE)


@query("stream_dedup", f"SELECT seq, {PK}, success FROM fx_attempts")
def stream_dedup(spark, sf):
    """Every outcome is sent twice and kept once."""
    out = work_path(spark, "stream-dedup")
    twice = on_time(stream_view(spark, sf, "fx_attempts"), "searched_at").withColumn("_copy", F.explode(F.lit([1, 2])))
    jobs.stream_append(jobs.dedup_tasks(twice).drop("_copy", "ts"), out, work_path(spark, "ckpt"))
    return spark.read.parquet(out).select("seq", *S.PK, "success")


@query("stream_rate_late", TRACE.replace("fx_reports", "(SELECT 'all' AS source, ts, id, is_429 FROM fx_reports) r"))
def stream_rate_late(spark, sf):
    """All reports of one source, those of odd numbers first and the others afterwards, though none is newer."""
    out, ckpt = work_path(spark, "stream-rate-late"), work_path(spark, "ckpt")
    rows = sql(spark, sf, "SELECT 'all' AS source, ts, id, is_429 FROM fx_reports")
    for odd in (1, 0):
        rows.filter(F.col("id") % 2 == odd).write.mode("append").parquet(f"{out}/in")
        jobs.stream_rate(jobs.read_files(spark, f"{out}/in", rows.schema), out, ckpt, MAX_RATE, MIN_RATE)
    return jobs.read_rate_trace(spark, out, MAX_RATE, MIN_RATE)
