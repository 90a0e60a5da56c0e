"""Streams of bundles, outcomes and endpoint events.

The batch operators define the results; a stream over the same rows ends with the same tables. Windowed counts and the removal of
duplicates drop what comes after their watermark: put ``batches.split_late`` before them to keep such rows apart. Keyed state is
merged from partial results that do not depend on arrival, so one hot key never becomes one long fold.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from farelake import schema as S
from farelake.functions.common import epoch_micros, floor_div
from farelake.operators.rate import CHUNK_S, FAN, chunk_maps, chunk_starts, effective_reports, parents, rate_ladder, replayed
from farelake.operators.scaling import join_on, latest, top_n
from farelake.operators.state import upsert_latest
from farelake.session import work_path
from farelake.sources import bronze, statetable, storage
from farelake.streaming.batches import each_batch, mark_before, publish, published, run_available, stream_of

PARTS = "batches"


def read_files(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A Parquet folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def read_bundles(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Bundles as a stream; each new file is read once, and a broken line is kept as text, as in ``bronze.read_bronze``."""
    schema = T.StructType([*S.BRONZE.fields, T.StructField(bronze.CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("columnNameOfCorruptRecord", bronze.CORRUPT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


# ------------------------------------------------------------------ bronze to silver
def stream_bronze(bundles: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each batch of lines, parsed once, as silver by route and quarantine; both become visible together and once."""
    kind = F.when(F.col(bronze.CORRUPT).isNull(), "silver").otherwise("quarantine")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("kind", kind).hint("rebalance", F.col("kind"), F.col("route"))
        publish(rows, batch, batch_id, path, ["kind", "route"])

    return each_batch(bundles, checkpoint, write)


def read_stream_silver(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all batches, in the columns of batch silver."""
    rows = published(spark, path, "kind=silver")
    return spark.createDataFrame([], S.BRONZE) if rows is None else rows.withColumn("route", F.col("route").cast("string")).drop(bronze.CORRUPT)


def read_stream_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The broken lines of all batches as they came."""
    rows = published(spark, path, "kind=quarantine")
    return spark.createDataFrame([], f"{bronze.CORRUPT} string") if rows is None else rows.select(bronze.CORRUPT)


# ------------------------------------------------------------------ keyed outcomes
def stream_upsert(outcomes: DataFrame, path: str, checkpoint: str, buckets: int = statetable.BUCKETS) -> StreamingQuery:
    """Fold each batch to one row per key and keep it, in the buckets of the table, under its stream and number.

    A repeated batch replaces its own folder, so a restart changes nothing; streams and checkpoints do not share folders, so
    none overwrites another. No batch rewrites the table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = upsert_latest(batch).withColumn("bucket", statetable.bucket_of(buckets)).hint("rebalance", F.col("bucket"))
        folder = f"{path}/{PARTS}/stream={stream_of(batch)}/batch_id={batch_id}"
        rows.write.mode("overwrite").partitionBy("bucket").parquet(folder)

    return each_batch(outcomes, checkpoint, write)


def folded(commit: statetable.Commit | None) -> dict[str, int]:
    """The last batch of each stream that a version of the base has in it."""
    return json.loads(commit.label) if commit else {}


def waiting_batches(spark: SparkSession, path: str, commit: statetable.Commit | None) -> DataFrame | None:
    """Batches that the base lacks, with their stream, number and bucket; None if there are none. Folders are skipped by name."""
    known, root, folders = folded(commit), f"{path}/{PARTS}", []
    for stream in storage.names(spark, root):
        for batch in storage.names(spark, f"{root}/{stream}"):
            if int(batch.removeprefix("batch_id=")) > known.get(stream.removeprefix("stream="), -1):
                inside = storage.names(spark, f"{root}/{stream}/{batch}")
                # A batch that is still being written has no mark yet; one without rows has no buckets.
                folders += [f"{root}/{stream}/{batch}"] if "_SUCCESS" in inside and len(inside) > 1 else []
    return spark.read.option("basePath", root).parquet(*folders) if folders else None


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The current row of each key: the base, and the batches it lacks in the buckets they touch."""
    commit = statetable.current_commit(spark, f"{path}/base")
    waiting = waiting_batches(spark, path, commit)
    if waiting is None:
        return statetable.read_commit(spark, f"{path}/base", commit)
    newer = waiting.drop("stream", "batch_id", "bucket")
    if commit is None:
        return upsert_latest(newer)
    touched = {str(r[0]) for r in waiting.select(statetable.bucket_of(commit.buckets)).distinct().collect()} & set(commit.folders)
    merged = upsert_latest(statetable.read_commit(spark, f"{path}/base", commit, sorted(touched)).unionByName(newer, allowMissingColumns=True))
    rest = sorted(set(commit.folders) - touched)
    return merged.unionByName(statetable.read_commit(spark, f"{path}/base", commit, rest), allowMissingColumns=True) if rest else merged


def compact_upserted(spark: SparkSession, path: str, buckets: int = statetable.BUCKETS) -> dict[str, int]:
    """Fold the waiting batches into the base, bucket by bucket; returns the last batch of each stream in it.

    Rows and the marks of what was folded become visible by one commit, so a run that dies folds again. It may run beside the streams;
    of two folds at a time one gets a StateConflict. Buckets without new rows are not read.
    """
    base = f"{path}/base"
    commit = statetable.current_commit(spark, base)
    waiting = waiting_batches(spark, path, commit)
    if waiting is None:
        return folded(commit)
    marks = dict(folded(commit))
    for row in waiting.groupBy(F.col("stream").cast("string").alias("stream")).agg(F.max("batch_id").cast("int").alias("last")).collect():
        marks[row["stream"]] = row["last"]
    rows, label = waiting.drop("stream", "batch_id", "bucket"), json.dumps(marks)
    if commit is None:
        statetable.write_state(upsert_latest(rows), base, label, buckets)
    else:
        statetable.upsert_state(rows, base, label, base=commit)
    return marks


def drop_folded(spark: SparkSession, path: str) -> None:
    """Remove batches that the base has in it, and versions of the base but the last two; no reader may be older than those."""
    base = f"{path}/base"
    for stream, last in folded(statetable.current_commit(spark, base)).items():
        folder = f"{path}/{PARTS}/stream={stream}"
        for batch in storage.names(spark, folder):
            if batch.startswith("batch_id=") and int(batch.removeprefix("batch_id=")) <= last:
                storage.remove(spark, f"{folder}/{batch}")
    statetable.vacuum(spark, base)


# ------------------------------------------------------------------ windowed counts
def status_counts(outcomes: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Outcomes per ten minutes and error; rows later than ``delay`` are dropped."""
    return (
        outcomes.withWatermark("ts", delay)
        .groupBy(F.window("ts", "10 minutes").alias("w"), "error_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "error_type", "n")
    )


def burst_counts(reports: DataFrame, rate: float, delay: str = "10 minutes") -> DataFrame:
    """429s per source in 30-second windows every 5 seconds: the exact burst test on a coarser grid."""
    limit = F.lit(S.BURST_WINDOW_S * rate * S.BURST_SHARE)
    return (
        reports.withWatermark("ts", delay)
        .groupBy(F.window("ts", "30 seconds", "5 seconds").alias("w"), "source")
        .agg(F.count_if("is_429").alias("n_429"))
        .select(F.col("w.start").alias("window_start"), "source", "n_429", (F.col("n_429") > limit).alias("burst"))
    )


def stream_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the changed windows of each batch under its number."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{PARTS}/batch_id={batch_id}")

    return each_batch(counts, checkpoint, write, mode="update")


def read_counts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last count of each window."""
    return latest(spark.read.parquet(f"{path}/{PARTS}"), keys, ["batch_id"]).drop("batch_id")


# ------------------------------------------------------------------ duplicates
def dedup_tasks(outcomes: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop an outcome already seen within ``delay``, as after a restart of its sender."""
    return outcomes.withWatermark("ts", delay).dropDuplicatesWithinWatermark([*S.PK, "seq"])


def stream_append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return run_available(rows.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)


# ------------------------------------------------------------------ endpoint pool state
#: An endpoint that was not heard of for so long is forgotten.
ENDPOINT_TTL_S = 86400
_POINTS = ("first", "second", "last_429", "last_stub", "last_failure")
SUMMARY = "url string, n_429 bigint, n_stub bigint, " + ", ".join(f"{p}_us bigint, {p}_id bigint" for p in _POINTS) + ", heard_us bigint, seen timestamp"
POOL_STATE = (
    "url string, rate_limited_count long, stub_count long, evicted_us long, blacklist_us long, rate_limit_us long, expired boolean"
)
_MEMORY = T.StructType([T.StructField("numbers", T.ArrayType(T.LongType())), T.StructField("timer_ms", T.LongType())])
_NEVER = (-1, -1)


def summarise_events(events: DataFrame, seen_us: int) -> DataFrame:
    """Per URL: counts, the first two 429s, the last event of each kind and of any; absent points are -1.

    All of it is aggregated before the shuffle, so a hot URL sends one short row per task. Summaries of any parts of a log, in any
    order, add up to that of the whole. ``seen`` is the newest time of the stream so far; it never falls.
    """
    at = F.struct(F.col("ts_us").alias("us"), F.col("probe_id").cast("bigint").alias("id"))
    is_429, is_stub = F.col("event") == "rate_limited", F.col("event") == "stub"
    totals = events.groupBy("url").agg(
        F.count_if(is_429).alias("n_429"), F.count_if(is_stub).alias("n_stub"), F.max("ts_us").alias("heard_us"),
        F.max(F.when(is_429, at)).alias("last_429"), F.max(F.when(is_stub, at)).alias("last_stub"),
        F.max(F.when(F.col("event") == "failure", at)).alias("last_failure"),
    )
    firsts = top_n(events.filter(is_429).select("url", "ts_us", "probe_id"), ["url"], ["ts_us", "probe_id"], S.EVICT_AFTER - 1)
    firsts = firsts.groupBy("url").agg(F.array_sort(F.collect_list(at)).alias("_firsts"))
    told = join_on(totals, firsts, ["url"], "left").withColumns({"first": F.get("_firsts", F.lit(0)), "second": F.get("_firsts", F.lit(1))})
    points = [F.coalesce(F.col(f"{p}.{part}"), F.lit(-1)).alias(f"{p}_{part}") for p in _POINTS for part in ("us", "id")]
    # One value for all rows of the batch: it is the clock of the timers.
    clock = told.agg(F.timestamp_micros(F.greatest(F.max("heard_us"), F.lit(seen_us)))).scalar()
    return told.select("url", "n_429", "n_stub", *points, "heard_us", clock.alias("seen"))


def stream_summaries(events: DataFrame, root: str, checkpoint: str) -> DataFrame:
    """Summaries of each batch of ``events(url, ts_us, probe_id, event)``, published once; gives them as a stream."""
    def write(batch: DataFrame, batch_id: int) -> None:
        seen = mark_before(batch, batch_id, root) or 0
        publish(summarise_events(batch, seen).withColumn("kind", F.lit("summary")), batch, batch_id, root, ["kind"], "heard_us")

    each_batch(events, checkpoint, write)
    return events.sparkSession.readStream.schema(SUMMARY).parquet(f"{root}/*/kind=summary")


class EndpointState(StatefulProcessor):
    """The summary of one URL over all batches, until its timer says that it was not heard of for ``ttl_s``."""

    def __init__(self, ttl_s: int):
        self.ttl_us = ttl_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", _MEMORY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n_429 = n_stub = heard = 0
        firsts, last, timer = [], [_NEVER] * 3, None
        if self.memory.exists():
            numbers, timer = self.memory.get()
            n_429, n_stub, heard, *flat = numbers
            points = list(zip(flat[::2], flat[1::2]))
            last, firsts = points[:3], points[3:]
        for pdf in rows:
            # One row per batch of the stream.
            n_429, n_stub, heard = n_429 + int(pdf["n_429"].sum()), n_stub + int(pdf["n_stub"].sum()), max(heard, int(pdf["heard_us"].max()))
            point = lambda p: list(zip(pdf[f"{p}_us"].tolist(), pdf[f"{p}_id"].tolist()))
            firsts = sorted(p for p in [*firsts, *point("first"), *point("second")] if p != _NEVER)[: S.EVICT_AFTER - 1]
            last = [max([old, *point(p)]) for old, p in zip(last, _POINTS[2:])]
        until = (heard + self.ttl_us) // 1000
        if until != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(until)
        self.memory.update(([n_429, n_stub, heard, *[x for p in [*last, *firsts] for x in p]], until))
        yield pd.DataFrame([self._report(key[0], n_429, n_stub, firsts, last)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.memory.clear()
        yield pd.DataFrame([{**self._report(key[0], 0, 0, [], [_NEVER] * 3), "expired": True}])

    @staticmethod
    def _report(url, n_429, n_stub, firsts, last) -> dict:
        counts = (n_429, n_stub, S.EVICT_AFTER)
        ttls = (S.EVICT_TTL_S, S.EVICT_TTL_S, S.DEAD_TTL_S)
        evicting = [
            (point, ttl) for point, n, ttl in zip(last, counts, ttls) if point != _NEVER and n >= S.EVICT_AFTER
        ]
        at, ttl = max(evicting) if evicting else (None, None)
        return {
            "url": url, "rate_limited_count": n_429, "stub_count": n_stub,
            "evicted_us": at[0] if at else None,
            "blacklist_us": at[0] + ttl * 1_000_000 if at else None,
            "rate_limit_us": firsts[-1][0] + S.PARK_S * 1_000_000 if firsts else None,
            "expired": False,
        }

    def close(self) -> None:
        pass


def endpoint_states(summaries: DataFrame, ttl_s: int = ENDPOINT_TTL_S) -> DataFrame:
    """Pool state per URL after each batch of ``stream_summaries``; a row that has ``expired`` ends its URL.

    The watermark follows ``seen``, which is the same for late reports, so none is lost.
    """
    return summaries.withWatermark("seen", "1 second").groupBy("url").transformWithStateInPandas(
        EndpointState(ttl_s), outputStructType=POOL_STATE, outputMode="Update", timeMode="EventTime"
    )


def stream_endpoint_state(events: DataFrame, path: str, checkpoint: str, ttl_s: int = ENDPOINT_TTL_S) -> StreamingQuery:
    """Needs ``spark.sql.streaming.stateStore.providerClass`` set to the RocksDB provider."""
    summaries = stream_summaries(events, f"{path}/summaries", f"{checkpoint}/summaries")
    return stream_counts(endpoint_states(summaries, ttl_s), path, f"{checkpoint}/states")


def read_endpoint_state(spark: SparkSession, path: str) -> DataFrame:
    """The state of every URL that has not expired."""
    return latest(spark.read.parquet(f"{path}/{PARTS}"), ["url"], ["batch_id", "expired"]).filter("NOT expired").drop("batch_id", "expired")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ------------------------------------------------------------------ request budget
#: A chunk of the budget's log is known by source, level 0 and number; the blocks above it, which share its bucket, by levels 1 and 2.
TREE_KEYS = ("source", "level", "node")
TREE_PLACE = ("source", "top")
TREE_BUCKETS = 256
DAY_S = 86400


def _touched(reports: DataFrame, chunk_s: int) -> DataFrame:
    """(source, node) of the chunks that reports may change: their own, and those that still look back at a 429."""
    at = epoch_micros("ts")
    reach = F.when(F.col("is_429"), floor_div(at + S.QUIET_WINDOW_S * 1_000_000, chunk_s * 1_000_000)).otherwise(floor_div(at, chunk_s * 1_000_000))
    return reports.select("source", F.explode(F.sequence(floor_div(at, chunk_s * 1_000_000), reach)).alias("node")).distinct()


def _around(spark: SparkSession, log: str, touched: DataFrame, chunk_s: int) -> tuple[DataFrame, DataFrame]:
    """Reports of the touched chunks, and 429s of the chunks before them; only folders of their days are read."""
    days = touched.select(floor_div(F.col("node") * chunk_s, DAY_S).alias("day")).distinct()
    days = sorted({d + off for (d,) in days.collect() for off in (-1, 0, 1)})
    rows = published(spark, log, "kind=reports").filter(F.col("day").isin(days)).withColumn("node", floor_div(epoch_micros("ts"), chunk_s * 1_000_000))
    own = join_on(rows, touched, ["source", "node"], "left_semi")
    before = join_on(touched.select("source", (F.col("node") - 1).alias("node")), touched, ["source", "node"], "left_anti")
    return own, join_on(rows.filter("is_429"), before, ["source", "node"], "left_semi")


def stream_rate(
    reports: DataFrame, path: str, checkpoint: str, max_rate: float, min_rate: float, chunk_s: int = CHUNK_S
) -> StreamingQuery:
    """Keep each source's tree of budget maps up to date; reports may come in any order.

    A batch joins the log, in folders by day. Only the chunks it touches are made again from their reports, then the blocks and large
    blocks above them from the maps of their parts; ``read_rate_trace`` tells the changes.
    """
    if chunk_s < S.QUIET_WINDOW_S:
        raise ValueError("a chunk is shorter than the time a 429 counts")
    ladder, log, tree = rate_ladder(max_rate, min_rate), f"{path}/log", f"{path}/tree"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = floor_div(epoch_micros("ts"), DAY_S * 1_000_000)
        rows = batch.select("source", "ts", "id", "is_429").withColumns({"kind": F.lit("reports"), "day": day})
        publish(rows, batch, batch_id, log, ["kind", "day"])
        base = statetable.current_commit(spark, tree)
        touched = _kept(_touched(batch, chunk_s), "rate-touched")
        own, context = _around(spark, log, touched, chunk_s)
        made = chunk_maps(effective_reports(own, ladder, context=context), ladder, "source", chunk_s)
        same = F.array(*[F.lit(i) for i in range(len(ladder))])
        # A chunk whose reports no longer move anything stays, with a map that changes nothing.
        chunks = join_on(touched, made, ["source", "node"], "left").withColumns({
            "after": F.coalesce("after", same), "log": F.coalesce("log", F.array().cast(made.schema["log"].dataType)),
        })
        new = _kept(_leveled(chunks, 0, base), "rate-new")
        stored = statetable.read_touched(new, tree, base, TREE_PLACE) if base else None
        for level in (0, 1):
            known = new if stored is None else latest(stored.unionByName(new), TREE_KEYS, ["seq"])
            path_up = new.filter(F.col("level") == level).select("source", floor_div("node", FAN).alias("_up")).distinct()
            parts = known.filter(F.col("level") == level).withColumn("_up", floor_div("node", FAN))
            blocks = parents(join_on(parts, path_up, ["source", "_up"], "left_semi"), len(ladder), "source").withColumn("log", F.lit(None).cast(made.schema["log"].dataType))
            new = _kept(new.unionByName(_leveled(blocks, level + 1, base)), "rate-new")
        statetable.upsert_state(new, tree, base=base, keys=TREE_KEYS, place=TREE_PLACE, buckets=TREE_BUCKETS)

    return each_batch(reports, checkpoint, write)


def _kept(rows: DataFrame, label: str) -> DataFrame:
    path = work_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _leveled(nodes: DataFrame, level: int, base: statetable.Commit | None) -> DataFrame:
    """Rows of the tree; those of a later version replace earlier ones."""
    return nodes.select(
        "source", F.lit(level).alias("level"), "node", "after", "log", floor_div("node", FAN ** (2 - level)).alias("top"),
        F.lit(base.version + 1 if base else 1).cast("bigint").alias("seq"),
    )


def read_rate_trace(spark: SparkSession, path: str, max_rate: float, min_rate: float) -> DataFrame:
    """Every change of each source's budget over all reports so far, as ``rate_trace`` gives it."""
    ladder = rate_ladder(max_rate, min_rate)
    commit = statetable.current_commit(spark, f"{path}/tree")
    tree = statetable.read_commit(spark, f"{path}/tree", commit)
    level = lambda n: tree.filter(F.col("level") == n)
    blocks, large = (parents(level(n), len(ladder), "source") for n in (0, 1))
    return replayed(level(0), chunk_starts(blocks, large, "source"), ladder, "source")
