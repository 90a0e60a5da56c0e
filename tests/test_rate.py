import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelake.operators import rate
from farelake.streaming import jobs

T0 = datetime(2024, 1, 1)
SCHEMA = "source string, ts timestamp_ntz, id long, is_429 boolean"


def replay(reports, max_rate, min_rate):
    """Changes of every source's budget, from counts over the 429s up to each report."""
    out = []
    for source in sorted({r[0] for r in reports}):
        own = [((ts - T0).total_seconds(), i, hit) for _, ts, i, hit in sorted((r for r in reports if r[0] == source), key=lambda r: r[1:3])]
        budget, hits = max_rate, []
        for at, i, hit in own:
            hits += [at] * hit
            recent = lambda seconds: sum(t >= at - seconds for t in hits)  # noqa: B023, E731
            if hit:
                new = max(min_rate, budget / 2) if recent(30) > 6 * budget else budget
            else:
                new = budget if recent(60) else min(max_rate, budget * 2)
            if new != budget:
                out.append((source, i, budget, new))
            budget = new
    return sorted(out)


def trace(df, **kw):
    return sorted((r.source, r.id, r.old_rate, r.new_rate) for r in rate.rate_trace(df, **kw).collect())


@pytest.mark.parametrize("n,final", [(24, 4.0), (25, 2.0), (26, 1.0), (300, 0.5)])
def test_bursts_halve_the_budget(spark, n, final):
    df = spark.createDataFrame([("s", T0, i, True) for i in range(n)], SCHEMA)
    got = {r.source: r.rate for r in rate.final_rates(rate.rate_trace(df, 4.0, 0.5)).collect()}
    assert got.get("s", 4.0) == final


def test_a_clean_minute_doubles_up_to_the_cap(spark):
    reports = [("s", T0, i, True) for i in range(26)] + [
        ("s", T0 + timedelta(seconds=s), 100 + s, False) for s in (30, 60, 61, 62, 63)
    ]
    assert trace(spark.createDataFrame(reports, SCHEMA), max_rate=4.0, min_rate=0.5) == [
        ("s", 24, 4.0, 2.0), ("s", 25, 2.0, 1.0), ("s", 161, 1.0, 2.0), ("s", 162, 2.0, 4.0)
    ]


def random_reports(seed, n=1500):
    rng, at, out = random.Random(seed), T0, []
    for i in range(n):
        gap = 65_000 if i % 61 == 60 else rng.choice([0, 0, 1, 50, 400, 1000, 1000, 10, 5])
        at += timedelta(milliseconds=gap)
        out.append((rng.choice(["hot", "hot", "hot", "a", "b"]), at, i, rng.random() < (0.8 if i % 61 > 15 else 0.1)))
    return out


@pytest.mark.parametrize("seed,max_rate,min_rate,chunk_s", [(1, 4.0, 0.5, 600), (2, 3.6, 0.7, 20), (3, 3.0, 0.05, 7)])
def test_trace_equals_replay(spark, seed, max_rate, min_rate, chunk_s):
    reports = random_reports(seed)
    df = spark.createDataFrame(reports, SCHEMA).repartition(4)
    want = replay(reports, max_rate, min_rate)
    assert trace(df, max_rate=max_rate, min_rate=min_rate, chunk_s=chunk_s) == want
    assert len(want) > 10


def test_ladder():
    assert rate.rate_ladder(4.0, 0.5) == [4.0, 2.0, 1.0, 0.5]
    assert rate.rate_ladder(1.0, 1.0) == [1.0]
    assert len(rate.rate_ladder(200.0, 0.5)) < 25
    with pytest.raises(ValueError):
        rate.rate_ladder(1.0, 2.0)
    with pytest.raises(ValueError):
        rate.rate_ladder(1.0, 0.0)


def test_burst_window_edge_is_inclusive(spark, rows):
    at = [0, 0, 30, 31, 61]
    df = spark.createDataFrame([("s", T0 + timedelta(seconds=s), i, True) for i, s in enumerate(at)], SCHEMA)
    df = df.unionByName(df.limit(1).withColumn("is_429", F.lit(False)))
    got = [((r.ts - T0).seconds, r.n, r.n_30s, r.burst) for r in rate.rate_burst(df, 0.4).orderBy("ts").collect()]
    assert got == [(0, 2, 2, False), (30, 1, 3, True), (31, 1, 2, False), (61, 1, 2, False)]


@pytest.mark.parametrize("order", ["any"])
def test_stream_of_reports_in_any_order(spark, tmp_path, order):
    reports = sorted(random_reports(5), key=lambda r: (r[1], r[2])) + [(None, T0 + timedelta(seconds=i // 9), 5000 + i, i % 40 < 30) for i in range(300)]
    if order == "any":
        random.Random(1).shuffle(reports)
    folder, out, ckpt = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    seen = []
    for i in range(0, len(reports), 900):
        spark.createDataFrame(reports[i : i + 900], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        seen += reports[i : i + 900]
        jobs.stream_rate(jobs.read_files(spark, folder, spark.read.parquet(folder).schema), out, ckpt, 4.0, 0.25, chunk_s=60)
    got = jobs.read_rate_trace(spark, out, 4.0, 0.25)
    assert plain(got) == replay_all(seen, 4.0, 0.25) == plain(rate.rate_trace(spark.createDataFrame(seen, SCHEMA), 4.0, 0.25))
    assert {None, "hot"} <= {r.source for r in got.collect()}


def plain(df):
    return sorted((r.source or "", r.id, r.old_rate, r.new_rate) for r in df.collect())


def replay_all(reports, *bounds):
    return replay([(r[0] or "", *r[1:]) for r in reports], *bounds)


def test_a_late_report_touches_its_path_only(spark, tmp_path):
    reports = [(f"s{k}", T0 + timedelta(minutes=10 * m), 100 * k + m, m % 3 > 0) for k in range(30) for m in range(12)]
    folder, out, ckpt = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    for part in (reports, [("s3", T0 + timedelta(minutes=11), 9999, False)]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        jobs.stream_rate(jobs.read_files(spark, folder, spark.read.parquet(folder).schema), out, ckpt, 4.0, 0.25)
    written = jobs.statetable.versions_by_bucket(spark, f"{out}/tree").collect()
    assert sum(r.version == 2 for r in written) == 1 < len(written)
    commit = jobs.statetable.current_commit(spark, f"{out}/tree")
    tree = jobs.statetable.read_commit(spark, f"{out}/tree", commit)
    fresh = {(r.source, r.level) for r in tree.filter("seq = 2").collect()}
    assert fresh == {("s3", 0), ("s3", 1), ("s3", 2)} and tree.filter("seq = 2").count() == 3


def test_long_runs_are_cut_before_they_are_gathered(spark):
    reports = [("s", T0 + timedelta(milliseconds=i), i, False) for i in range(500)] + [
        ("s", T0 + timedelta(seconds=1, milliseconds=i), 1000 + i, True) for i in range(2000)
    ]
    df = spark.createDataFrame(reports, SCHEMA)
    ladder = rate.rate_ladder(4.0, 0.5)
    # One run of successes and one per step of the ladder, none longer than the ladder.
    assert rate.effective_reports(df, ladder).count() <= len(ladder) * (len(ladder) + 1)
    assert trace(df, max_rate=4.0, min_rate=0.5) == replay(reports, 4.0, 0.5)
