import gzip
import json
import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import state as st
from farelake.plans import lifecycle
from farelake.plans.providers import Provider, ProviderRegistry, captured, collect
from farelake.session import shared_root, work_path
from farelake.sources import bronze, silver, snapshots, statetable, storage
from test_state import row, state


def lines(path):
    out = []
    for part in sorted(Path(path).glob("part-*")):
        opener = gzip.open if part.suffix == ".gz" else open
        with opener(part, "rt", encoding="utf-8") as f:
            out += f.read().splitlines()
    return out


def test_export_has_eight_ordered_fields_and_keeps_text(spark, tmp_path):
    table = state(
        spark, row(dep="2026-08-02", flights='[{"airline":"Scoot é","price":5,"odd":{"x":null}}]', success=1),
        row(dep="2026-08-01", success=1), row(dep="2026-08-03", error="429"),
    ).withColumn("searched_at", F.when(F.col("dep_date") == "2026-08-02", F.col("searched_at")))
    path = str(tmp_path / "search_1.jsonl")
    assert bronze.export_bronze(table, path)
    got = lines(path)
    assert [json.loads(x)["dep_date"] for x in got] == ["2026-08-01", "2026-08-02"]
    assert list(json.loads(got[0])) == list(S.BRONZE_COLUMNS)
    assert json.loads(got[0])["flights"] == []
    second = json.loads(got[1])
    assert second["flights"] == [{"airline": "Scoot é", "price": 5, "odd": {"x": None}}] and second["searched_at"].startswith("2026")
    assert json.loads(got[0])["searched_at"] is None
    assert "é" in got[1]


def test_nothing_is_written_without_success(spark, tmp_path):
    path = str(tmp_path / "search_1.jsonl")
    assert not bronze.export_bronze(state(spark, row(error="429")), path)
    assert not os.path.exists(path)


@pytest.mark.parametrize("n", [999, 1000, 1001])
def test_all_rows_are_exported(spark, tmp_path, n):
    table = spark.range(n).select(
        *[F.lit(v).alias(c) for c, v in zip(S.STATE_COLUMNS, row(success=1))]
    ).withColumn("dep_date", F.monotonically_increasing_id().cast("string"))
    path = str(tmp_path / "search_1.jsonl")
    bronze.export_bronze(table.withColumn("flights", F.lit("[]")), path)
    assert len(lines(path)) == n


def test_read_merges_fields_and_keeps_broken_lines(spark, tmp_path):
    one, two = tmp_path / "search_a.jsonl", tmp_path / "search_b.jsonl.gz"
    one.write_text('{"route":"SIN|KUL","flights":[{"price":1}]}\n{broken\n')
    with gzip.open(two, "wt") as f:
        f.write('{"route":"SIN|BKK","searched_at":"t","new":7}\n')
    got = {r.route: r for r in bronze.read_bronze(spark, [str(one), str(two)]).cache().collect()}
    assert got["SIN|KUL"].searched_at is None and got["SIN|KUL"].flights[0].price == 1.0
    assert got["SIN|BKK"].flights is None
    assert got[None]["_corrupt_record"] == "{broken"
    inferred = bronze.read_bronze(spark, [str(one), str(two)], schema=None)
    assert {"route", "flights", "searched_at", "new"} <= set(inferred.columns)


def test_latest_bundle_is_by_time(spark, tmp_path):
    for name, t in [("search_z.jsonl", 100), ("search_a.jsonl", 300), ("search_m.jsonl.gz", 200), ("other.jsonl", 900), ("search_b.jsonl", 300)]:
        (tmp_path / name).write_text("{}\n")
        os.utime(tmp_path / name, (t, t))
    assert bronze.require_latest_bundle(spark, str(tmp_path)).endswith("/search_a.jsonl")
    with pytest.raises(FileNotFoundError):
        bronze.require_latest_bundle(spark, str(tmp_path / ".."/ tmp_path.name) + "/other.jsonl")


def test_silver_replaces_only_the_routes_it_gets(spark, tmp_path, rows):
    path = str(tmp_path / "silver")
    df = spark.createDataFrame([("SIN|KUL", 1), ("SIN|BKK", 2), ("1", 3)], "route string, v int")
    assert silver.write_silver(df, path) == 3
    assert silver.write_silver(df.filter("v = 1").withColumn("v", F.lit(9)), path) == 1
    back = silver.read_silver(spark, path)
    assert rows(back.select("route", "v")) == [("1", 3), ("SIN|BKK", 2), ("SIN|KUL", 9)]
    assert back.columns[-1] == "route" and dict(back.dtypes)["route"] == "string"


def test_route_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver.write_silver(spark.createDataFrame([("SIN|KUL", 1), ("SIN|BKK", 2)], "route string, v int"), path)
    plan = silver.read_silver(spark, path).filter("route = 'SIN|KUL'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(route" in plan


def test_manifest(spark, tmp_path):
    for p in ("b/route=X/2.parquet", "a.parquet", "b/1.parquet", "b/notes.txt"):
        f = tmp_path / "s" / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("123")
    got = silver.publish_manifest(spark, str(tmp_path / "s")).collect()
    assert [(r.key, r.length) for r in got] == [
        ("silver/a.parquet", 3), ("silver/b/1.parquet", 3), ("silver/b/route=X/2.parquet", 3)
    ]


def test_state_versions(spark, tmp_path, rows):
    path = str(tmp_path / "state")
    assert statetable.read_state(spark, path) is None
    assert statetable.write_state(state(spark, row(error="429")), path) == 1
    newer = st.upsert_latest(state(spark, row(success=1)).withColumn("seq", F.lit(1)), statetable.read_state(spark, path))
    assert statetable.write_state(newer.drop("seq"), path, "second") == 2
    assert [r.success for r in statetable.read_state(spark, path).collect()] == [1]
    assert statetable.current_version(spark, path) == (2, "second")
    statetable.write_state(newer.drop("seq", "return_date"), path)
    assert statetable.read_state(spark, path).count() == 0
    # A version that was never committed is not seen.
    newer.drop("seq").write.parquet(f"{path}/data/000000000099-dead")
    assert statetable.current_version(spark, path)[0] == 3
    statetable.upsert_state(newer, path)
    assert statetable.read_state(spark, path).count() == 1


def files_of(path):
    return {f.relative_to(path) for f in path.rglob("*.parquet")}


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path, rows):
    path = tmp_path / "state"
    log = spark.range(300).select(
        F.col("id").alias("seq"), *[F.concat(F.lit(c[0]), (F.col("id") % 150).cast("string")).alias(c) for c in S.PK], F.lit("a").alias("error_type"),
    )
    statetable.write_state(st.upsert_latest(log), str(path), buckets=32)
    before = files_of(path)
    some = log.filter("seq IN (7, 160)").withColumns({"seq": F.col("seq") + 1000, "error_type": F.lit("b")})
    assert statetable.upsert_state(some.unionByName(log.filter("seq = 3")), str(path)) == 2
    fresh = files_of(path) - before
    held = {str(f.parent.name) for f in before if f.parent.name in {g.parent.name for g in fresh}}
    assert before < files_of(path) and len({f.parent for f in fresh}) <= 3 and len(held) == len({f.parent for f in fresh})
    want = st.upsert_latest(log.unionByName(some))
    assert rows(statetable.read_state(spark, str(path)).select(want.columns)) == rows(want)
    touched = {r.bucket for r in statetable.versions_by_bucket(spark, str(path)).collect() if r.version == 2}
    assert touched == {int(f.parent.name.split("=")[1]) for f in fresh}
    # A column that only later rows have, and keys of NULL.
    more = some.limit(1).withColumns({"seq": F.lit(5000), "route": F.lit(None).cast("string"), "note": F.lit("new")})
    statetable.upsert_state(more, str(path))
    back = statetable.read_state(spark, str(path))
    assert back.filter("note = 'new'").count() == 1 and back.count() == 151 and back.columns[-1] == "note"
    statetable.vacuum(spark, str(path), keep=1)
    assert rows(statetable.read_state(spark, str(path))) == rows(back)
    assert len(files_of(path)) < len(before) + len(fresh) + 1
    assert statetable.vacuum(spark, str(path), keep=1) == [] and statetable.vacuum(spark, f"{path}/none") == []


def test_of_two_writers_one_fails(spark, tmp_path):
    path = str(tmp_path / "state")
    assert statetable.upsert_state(state(spark, row(error="429")).withColumn("seq", F.lit(1)), path) == 1
    base = statetable.current_commit(spark, path)
    one, two = (state(spark, row(error=e)).withColumn("seq", F.lit(i)) for i, e in enumerate(("data", "timeout"), 2))
    assert statetable.upsert_state(one, path, base=base) == 2
    with pytest.raises(statetable.StateConflict):
        statetable.upsert_state(two, path, base=base)
    with pytest.raises(statetable.StateConflict):
        statetable.write_state(two, path, base=base)
    assert [r.error_type for r in statetable.read_state(spark, path).collect()] == ["data"]
    # What the losers wrote goes with the next vacuum, once later versions passed it.
    assert statetable.upsert_state(two, path) == 3
    assert len(statetable.vacuum(spark, path, keep=1)) == 4
    assert [r.error_type for r in statetable.read_state(spark, path).collect()] == ["timeout"]
    assert not [n for n in storage.names(spark, f"{path}/commits") if not n.endswith("3.json") and not n.endswith(".crc")]


def test_snapshots(spark, tmp_path):
    good = {"cached_at": 5.0, "proxies": [{"url": "http://a:1", "protocol": "http"}, {"url": "http://b:1", "protocol": "http", "quality_score": 1.3}]}
    for name, text in [
        ("good", json.dumps(good)), ("empty", '{"cached_at": 1, "proxies": []}'), ("broken", "{nope"),
        ("nourl", '{"cached_at": 2, "proxies": [{"protocol": "http"}]}'), ("none", "{}"),
    ]:
        (tmp_path / f"{name}.json").write_text(text)
    got = {r.url: r for r in snapshots.read_snapshots(spark, str(tmp_path)).collect()}
    assert set(got) == {"http://a:1", "http://b:1"}
    a = got["http://a:1"]
    assert {k: a[k] for k in S.ENDPOINT_DEFAULTS} == S.ENDPOINT_DEFAULTS and a.cached_at == 5.0
    assert got["http://b:1"].quality_score == 1.3
    assert snapshots.read_snapshots(spark, str(tmp_path / "absent")).count() == 0


def test_snapshot_round_trip_in_several_objects(spark, tmp_path):
    df = spark.range(250).select(
        F.concat(F.lit("http://h:"), F.col("id") + 1).alias("url"), F.lit("http").alias("protocol"), F.lit(1.1).alias("quality_score"),
        F.lit(3.0).alias("latency_ms"), F.lit(0.0).alias("last_validated"), F.lit(0.0).alias("rate_limit_until"),
        F.lit(1).alias("rate_limited_count"), F.lit(2).alias("stub_count"), F.lit("s").alias("source"), F.lit(7.0).alias("cached_at"),
    )
    path = str(tmp_path / "pool")
    snapshots.write_snapshots(df, path, rows_per_file=60)
    back = snapshots.read_snapshots(spark, path)
    assert back.count() == 250 and back.select("snapshot_id").distinct().count() == 1
    assert back.exceptAll(df.select(F.lit("7.0").alias("snapshot_id"), "cached_at", *S.ENDPOINT.names)).count() == 0


def test_whole_runs(spark, tmp_path, rows):
    runs = spark.createDataFrame([(date(2026, 8, 1), date(2026, 8, 1), date(2026, 8, 1))], "start_date date, effective_end date, as_of date")
    log = spark.createDataFrame([
        ("SIN|KUL", "2026-08-01", "", "ONE_WAY", 0, 0, 0, "timeout", None, "t0"),
        ("SIN|KUL", "2026-08-01", "", "ONE_WAY", 0, 1, 1, None, '[{"price":7}]', "t1"),
        ("KUL|SIN", "2026-08-01", "", "ONE_WAY", 0, 0, 0, "429", None, "t0"),
    ], "route string, dep_date string, return_date string, flight_type string, round int, attempt int, success int, error_type string, flights string, searched_at string")
    table = lifecycle.search(runs, log, state(spark, row(dep="2020-01-01"), row(dep="2020-01-02", error="429")))
    assert table.count() == 75 + 1 and table.columns == list(S.STATE_COLUMNS)
    assert rows(st.count_status(table)) == [(1, 75)]
    statetable.write_state(table, str(tmp_path / "state"))
    assert lifecycle.convert(spark, str(tmp_path / "state"), str(tmp_path / "search_1.jsonl"))
    assert lifecycle.transform(spark, str(tmp_path / "search_1.jsonl"), str(tmp_path / "silver")) == 1
    r = silver.read_silver(spark, str(tmp_path / "silver")).collect()[0]
    assert (r.route, r.searched_at, r.flights[0].price) == ("SIN|KUL", "t0", 7.0)
    with pytest.raises(st.StateError):
        lifecycle.convert(spark, str(tmp_path / "absent"), str(tmp_path / "x"))


def test_registry(spark, rows):
    tasks = spark.createDataFrame([("SIN", "KUL", 1), ("SIN", "BKK", 2)], "origin string, destination string, id int")
    registry = ProviderRegistry()
    assert collect(registry, tasks, "id int").count() == 0
    answers = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, v string")
    cover = spark.createDataFrame([("SIN", "BKK")], "origin string, dest string")
    registry.register("some", Provider(captured(answers, ["id"]), cover))
    registry.register("all", Provider(captured(answers, ["id"])))
    registry.providers.clear()
    registry.unregister("absent")
    assert rows(collect(registry, tasks, "")) == [(1, "x", "all"), (2, "y", "all"), (2, "y", "some")]
    registry.unregister("all")
    assert list(registry.providers) == ["some"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x").startswith(shared_root(spark)) and work_path(spark, "x") != work_path(spark, "x")


def test_a_spread_pool_is_refused_as_a_whole(spark, tmp_path):
    rows = [(1.0, f"http://10.0.0.{i}:80" if i else None) for i in range(20)]
    df = spark.createDataFrame(rows, "cached_at double, url string").select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.ENDPOINT if f.name != "url"]
    )
    for size in (5, 100):
        path = str(tmp_path / f"pools{size}")
        snapshots.write_snapshots(df, path, rows_per_file=size)
        assert snapshots.read_snapshots(spark, path).count() == 0
        snapshots.write_snapshots(df.filter("url IS NOT NULL"), path, rows_per_file=size)
        assert snapshots.read_snapshots(spark, path).count() == 19


def test_broken_lines_stay_out_of_silver(spark, tmp_path):
    good = '{"route": "A|B", "dep_date": "2024-01-01", "flights": [{"price": 1.50, "a": 1}]}'
    (tmp_path / "search_9.jsonl").write_text(good + "\n{broken\n")
    out = str(tmp_path / "silver")
    assert lifecycle.transform(spark, str(tmp_path / "search_9.jsonl"), out) == 1
    assert bronze.CORRUPT not in spark.read.parquet(out).columns
    assert [r[bronze.CORRUPT] for r in bronze.read_quarantine(spark, out + "_quarantine").collect()] == ["{broken"]


def test_new_fields_reach_silver_and_old_files_still_read(spark, tmp_path):
    old = '{"route":"A|B","dep_date":"2026-08-01","return_date":"","flight_type":"ONE_WAY","origin":"A","destination":"B","flights":[{"price":1.5}],"searched_at":"t"}'
    new = old.replace("A|B", "A|C").replace('"price":1.5', '"price":2,"cabin":"eco","seats":{"left":3},"note":null').replace('"searched_at"', '"tries":2,"searched_at"')
    odd = old.replace("A|B", "A|D").replace('"price":1.5', '"price":"x","stops":1')
    lake = str(tmp_path / "silver")
    for name, lines in (("search_1", [old]), ("search_2", [new, odd, "{broken", "[1]"])):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / f"{name}.jsonl"), compression="gzip")
        lifecycle.transform(spark, str(tmp_path / f"{name}.jsonl"), lake, growing=True)
    rows = {r.route: r for r in silver.read_silver(spark, lake, growing=True).collect()}
    assert rows["A|B"].tries is None and rows["A|B"].flights[0].cabin is None and rows["A|B"].flights[0].price == 1.5
    assert rows["A|C"].tries == 2 and (rows["A|C"].flights[0].cabin, rows["A|C"].flights[0].seats.left, rows["A|C"].flights[0].note) == ("eco", 3, None)
    assert rows["A|D"].flights is None or rows["A|D"].flights[0].price is None
    assert sorted(r[0] for r in bronze.read_quarantine(spark, f"{lake}_quarantine").collect()) == ["[1]", "{broken"]
    # Readers that know the old columns only read all files.
    assert silver.read_silver(spark, lake).select("route", "dep_date").count() == 3
