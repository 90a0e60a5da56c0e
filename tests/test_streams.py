"""Streams cut into several batches end with what the batch operators say."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelake.functions.common import epoch_micros
from farelake.operators import endpoints as ep
from farelake.operators import state as st
from farelake.plans import lifecycle
from farelake.sources import bronze, silver
from farelake.streaming import batches, jobs
from test_endpoints import EVENTS, random_events, replay

T0 = datetime(2024, 1, 1)


def in_files(spark, df, order, folder, n=4):
    """``df`` in order as ``n`` files, one per batch."""
    rows = sorted(df.collect(), key=lambda r: r[order])
    size = -(-len(rows) // n)
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i : i + size], df.schema).coalesce(1).write.mode("append").parquet(folder)
    return jobs.read_files(spark, folder, df.schema, files_per_batch=1)


@pytest.fixture
def dirs(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")


@pytest.fixture(scope="module")
def outcomes(spark):
    return spark.range(400).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "SIN|KUL").otherwise(F.concat(F.lit("R"), F.col("id") % 7)).alias("route"),
        F.lit("2024-02-01").alias("dep_date"), F.lit("").alias("return_date"), F.lit("ONE_WAY").alias("flight_type"),
        F.when(F.col("id") % 4 == 0, "429").when(F.col("id") % 5 == 0, "timeout").alias("error_type"),
        F.timestamp_add("SECOND", F.col("id") * 7, F.lit(T0)).alias("ts"),
    )


def test_upsert(spark, outcomes, dirs, rows):
    folder, out, ckpt = dirs
    stream = in_files(spark, outcomes, "seq", folder)
    jobs.stream_upsert(stream, out, ckpt)
    jobs.stream_upsert(stream, out, ckpt)  # nothing new: nothing changes
    read = lambda: rows(jobs.read_upserted(spark, out).select(outcomes.columns))
    assert read() == rows(st.upsert_latest(outcomes))
    assert list(jobs.compact_upserted(spark, out).values()) == [3]
    more = outcomes.withColumn("seq", F.col("seq") + 350).filter("seq % 3 = 1")
    more.coalesce(1).write.mode("append").parquet(folder)
    jobs.stream_upsert(stream, out, ckpt)
    assert read() == rows(st.upsert_latest(outcomes.unionByName(more)))


def test_streams_that_share_a_table_lose_nothing(spark, outcomes, dirs, rows):
    folder, out, ckpt = dirs
    stream = in_files(spark, outcomes, "seq", folder)
    jobs.stream_upsert(stream.filter("seq % 2 = 0"), out, ckpt)
    jobs.stream_upsert(stream.filter("seq % 2 = 1"), out, f"{ckpt}-two")
    read = lambda: rows(jobs.read_upserted(spark, out).select(outcomes.columns))
    want = rows(st.upsert_latest(outcomes))
    assert read() == want
    marks = jobs.compact_upserted(spark, out)
    assert len(marks) == 2 and set(marks.values()) == {3} and read() == want
    # A checkpoint that was lost: all batches come again under another name.
    jobs.stream_upsert(stream.filter("seq % 2 = 0"), out, f"{ckpt}-again")
    assert read() == want and len(jobs.compact_upserted(spark, out)) == 3 and read() == want
    jobs.drop_folded(spark, out)
    assert read() == want and jobs.compact_upserted(spark, out) == jobs.folded(jobs.statetable.current_commit(spark, f"{out}/base"))
    # A folded batch that is written once more, as after a crash before the stream's own commit.
    stream_id = next(iter(marks))
    outcomes.withColumns({"seq": F.lit(10**6), "bucket": F.lit(0)}).write.parquet(f"{out}/{jobs.PARTS}/stream={stream_id}/batch_id=0")
    assert read() == want


def test_status_over_batches(spark, outcomes, dirs, rows):
    folder, out, ckpt = dirs
    jobs.stream_counts(jobs.status_counts(in_files(spark, outcomes, "seq", folder)), out, ckpt)
    got = jobs.read_counts(spark, out, ["window_start", "error_type"]).select("window_start", "error_type", "n")
    want = outcomes.groupBy(F.window("ts", "10 minutes").start.alias("w"), "error_type").count()
    assert rows(got) == rows(want)


def test_late_rows_are_dropped_after_the_watermark(spark, dirs):
    folder, out, ckpt = dirs
    early = [(i, T0 + timedelta(hours=i), "429") for i in range(3)]
    late = [(3, T0 + timedelta(minutes=1), "429"), (4, T0 + timedelta(hours=2, minutes=-5), "429")]
    df = spark.createDataFrame(early + late, "seq int, ts timestamp, error_type string")
    jobs.stream_counts(jobs.status_counts(in_files(spark, df, "seq", folder, n=5)), out, ckpt)
    got = {r.window_start: r.n for r in jobs.read_counts(spark, out, ["window_start", "error_type"]).collect()}
    assert got[T0] == 1
    assert got[T0 + timedelta(hours=1, minutes=50)] == 1


def test_sliding_bursts(spark, dirs):
    folder, out, ckpt = dirs
    df = spark.createDataFrame([("s", T0 + timedelta(seconds=3 * i), i, i % 2 == 0) for i in range(40)], "source string, ts timestamp, id int, is_429 boolean")
    jobs.stream_counts(jobs.burst_counts(in_files(spark, df, "id", folder), 0.5), out, ckpt)
    got = {(r.window_start - T0).total_seconds(): (r.n_429, r.burst) for r in jobs.read_counts(spark, out, ["window_start", "source"]).collect()}
    for start, (n, burst) in got.items():
        want = sum(1 for i in range(0, 40, 2) if start <= 3 * i < start + 30)
        assert (n, burst) == (want, want > 3)
    assert len(got) == 29


def test_duplicates(spark, outcomes, dirs, rows):
    folder, out, ckpt = dirs
    twice = outcomes.unionByName(outcomes)
    jobs.stream_append(jobs.dedup_tasks(in_files(spark, twice, "seq", folder, n=3)), out, ckpt)
    assert rows(spark.read.parquet(out).select("seq")) == rows(outcomes.select("seq"))


def test_late_rows_are_kept_apart(spark, outcomes, dirs, rows):
    """Every row is counted or late, also through the removal of duplicates, and a repeated run adds none."""
    folder, out, ckpt = dirs
    shuffled = outcomes.withColumn("arrival", F.when(F.col("seq") % 40 == 7, F.col("seq") + 300).otherwise(F.col("seq")))
    for _ in range(2):
        stream = in_files(spark, shuffled, "arrival", folder) if _ == 0 else stream  # noqa: F821
        in_time = batches.split_late(stream, f"{out}/split", f"{ckpt}/split", 600)
        jobs.stream_counts(jobs.status_counts(in_time), f"{out}/counts", f"{ckpt}/counts")
        jobs.stream_append(jobs.dedup_tasks(in_time, "10 minutes"), f"{out}/once", f"{ckpt}/once")
    late = batches.late_rows(spark, f"{out}/split")
    seqs, size, newest, want = [r.seq for r in shuffled.orderBy("arrival", "seq").collect()], -(-400 // 4), -1, []
    for low in range(0, 400, size):
        part = seqs[low : low + size]
        want += [s for s in part if 7 * s < 7 * newest - 600]
        newest = max([newest, *part])
    assert want and rows(late.select("seq")) == sorted([(s,) for s in want], key=repr)
    counted = jobs.read_counts(spark, f"{out}/counts", ["window_start", "error_type"]).agg(F.sum("n")).head()[0]
    assert counted + len(want) == 400 == spark.read.parquet(f"{out}/once").count() + len(want)
    assert batches.late_rows(spark, f"{out}/nothing") is None


def us(t):
    return None if t is None else int((t - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


@pytest.mark.parametrize("seed", [4, 5])
def test_endpoint_state(spark, dirs, seed):
    """Also endpoints that only ever succeed, NULL ones, and reports that come late."""
    folder, out, ckpt = dirs
    events = random_events(seed) + [(None, T0 + timedelta(seconds=i), 1000 + i, "rate_limited") for i in range(4)]
    events += [("quiet", T0, 2000, "ok"), ("late", T0 - timedelta(hours=5), 2001, "stub"), ("late", T0, 3, "stub")]
    df = spark.createDataFrame(events, EVENTS).withColumn("ts_us", epoch_micros("ts"))
    stream = in_files(spark, df, "probe_id", folder)
    jobs.stream_endpoint_state(stream, out, ckpt)
    jobs.stream_endpoint_state(stream, out, ckpt)
    got = {r.url: tuple(r)[1:] for r in jobs.read_endpoint_state(spark, out).select(
        "url", "rate_limited_count", "stub_count", "evicted_us", "blacklist_us", "rate_limit_us").collect()}
    assert got == {u: (*v[:2], us(v[2]), us(v[3]), us(v[4])) for u, v in replay(events).items()}
    batch = ep.evict_blacklist(spark.createDataFrame(events, EVENTS))
    assert {r.url: (r.rate_limited_count, r.stub_count, us(r.evicted_at), us(r.blacklist_until), us(r.rate_limit_until)) for r in batch.collect()} == got


def test_endpoint_state_expires(spark, dirs):
    folder, out, ckpt = dirs
    at = lambda h: T0 + timedelta(hours=h)
    events = [("gone", at(0), 0, "rate_limited"), ("gone", at(1), 1, "stub"), ("kept", at(1), 2, "rate_limited")]
    later = [("kept", at(20), 3, "rate_limited"), ("new", at(30), 4, "ok"), ("new", at(40), 5, "stub"), ("gone", at(41), 6, "rate_limited")]
    df = spark.createDataFrame(events + later, EVENTS).withColumn("ts_us", epoch_micros("ts"))
    rows = df.collect()
    states = []
    for part in (rows[:3], rows[3:5], rows[5:6], rows[6:]):
        spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(folder)
        jobs.stream_endpoint_state(jobs.read_files(spark, folder, df.schema), out, ckpt, ttl_s=24 * 3600)
        states.append({r.url: (r.rate_limited_count, r.stub_count) for r in jobs.read_endpoint_state(spark, out).collect()})
    assert states[0] == {"gone": (1, 1), "kept": (1, 0)}
    assert states[2] == {"kept": (2, 0), "new": (0, 1)}
    # What comes back starts anew.
    assert states[3]["gone"] == (1, 0) and states[3]["kept"] == (2, 0)


LINE = '{"route":"%s","dep_date":"2026-08-01","return_date":"","flight_type":"ONE_WAY","origin":"SIN","destination":"X","flights":[{"price":1}],"searched_at":"t"}'


def test_bronze_stream_reads_only_new_bundles(spark, dirs, rows):
    folder, out, ckpt = dirs
    for i, routes in enumerate((["SIN|KUL", "SIN|BKK"], ["SIN|KUL", None])):
        lines = [(LINE % r if r else "{broken",) for r in routes]
        spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{folder}/search_{i}.jsonl", compression="gzip")
        jobs.stream_bronze(jobs.read_bundles(spark, folder), out, ckpt)
    back = jobs.read_stream_silver(spark, out)
    assert {r["route"]: r["count"] for r in back.groupBy("route").count().collect()} == {"SIN|KUL": 2, "SIN|BKK": 1}
    # The same rows and columns as in batch, and each broken line once.
    lifecycle.transform(spark, f"{folder}/search_*.jsonl", f"{out}-batch")
    batch = silver.read_silver(spark, f"{out}-batch")
    assert rows(back.select(sorted(back.columns))) == rows(batch.select(sorted(batch.columns))) and set(back.dtypes) == set(batch.dtypes)
    assert rows(jobs.read_stream_quarantine(spark, out)) == [("{broken",)]
    lifecycle.transform(spark, f"{folder}/search_*.jsonl", f"{out}-batch")
    assert rows(bronze.read_quarantine(spark, f"{out}-batch_quarantine")) == [("{broken", "search_1")]
    # A lost checkpoint comes under another name; nothing is overwritten.
    assert jobs.read_stream_quarantine(spark, f"{out}-none").count() == jobs.read_stream_silver(spark, f"{out}-none").count() == 0


def test_a_repeated_batch_changes_nothing(spark, dirs, rows):
    folder, out, ckpt = dirs
    stream = in_files(spark, spark.createDataFrame([(i, i * 10) for i in range(8)], "i int, at long"), "i", folder)
    twice = lambda batch, n: [batches.publish(batch.withColumn("kind", F.lit("x")), batch, n, out, ["kind"], "at") for _ in range(2)]
    batches.each_batch(stream, ckpt, twice)
    assert rows(batches.published(spark, out, "kind=x").select("i")) == [(i,) for i in range(8)]
    assert sorted(int(n.split("-")[-1]) for n in jobs.storage.names(spark, out)) == [10, 30, 50, 70]
