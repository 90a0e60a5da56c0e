"""Endpoint lists, probes and pool state, over captured tables. Nothing is probed here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import net
from farelake.functions.common import floor_div
from farelake.operators.scaling import ROWS_PER_BLOCK, join_on, order_statistics, running_total, running_totals, top_n


# ------------------------------------------------------------------ lists
def source_rank(sources: DataFrame, url: str = "url", pos: str = "pos") -> DataFrame:
    """Sources with ``rank``: those naming a high-yield list first, each group in input order."""
    text = F.lower(F.col(url))
    rank = F.lit(None).cast("int")
    for i, marker in reversed(list(enumerate(S.SOURCE_MARKERS))):
        rank = F.when(F.contains(text, F.lit(marker)), i).otherwise(rank)
    ranked = sources.withColumn("marker_rank", F.coalesce(rank, F.lit(len(S.SOURCE_MARKERS))))
    return ranked.orderBy("marker_rank", pos)


def split_lists(lists: DataFrame, text: str = "text") -> DataFrame:
    """Whole list texts to numbered lines."""
    other = [c for c in lists.columns if c != text]
    return lists.select(*other, F.posexplode(F.split(net.strip(text), "\n")).alias("line_no", "line"))


def list_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines trimmed, without blank ones and comments."""
    trimmed = lines.withColumn(line, net.strip(line))
    return trimmed.filter((F.col(line) != "") & ~F.startswith(F.col(line), F.lit("#")))


def source_name(url: str | Column) -> Column:
    """A source is named by its URL without the scheme."""
    return F.regexp_replace(url, "^(?s:.*?)://", "")


def normalise_lines(lines: DataFrame) -> DataFrame:
    """Usable lines with ``url`` and the protocol the URL names."""
    return (
        list_lines(lines)
        .withColumn("url", net.normalise_endpoint("protocol", "line"))
        .filter(F.col("url").isNotNull())
        .withColumn("protocol", F.substring_index("url", "://", 1))
    )


def cap_per_source(endpoints: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """At most ``n`` rows of each source, chosen by a seeded hash so that reruns agree; 0 keeps all."""
    if n <= 0:
        return endpoints
    draw = F.md5(F.concat_ws("#", F.col("url"), F.col("line_no").cast("string"), F.lit(str(seed))))
    return top_n(endpoints, ["source"], [draw, "line_no"], n)


def dedup_first(endpoints: DataFrame, order: Sequence[str] = ("source", "line_no")) -> DataFrame:
    """One row per URL: the first in source and line order."""
    return top_n(endpoints, ["url"], list(order), 1)


# ------------------------------------------------------------------ probes
def probe_class(probes: DataFrame, real_ip: str = "") -> DataFrame:
    """Probes with ``reason`` and the latency of those that count."""
    reason = net.probe_reason("failed", "status", "body", real_ip)
    return probes.withColumn("reason", reason).withColumn(
        "ok_latency_ms", F.when(F.col("reason").isNull(), F.col("latency_ms"))
    )


def echo_median(probes: DataFrame, keys: Sequence[str] = ("url",), latency: str = "latency_ms") -> DataFrame:
    """Upper median of the good latencies per key, 0.0 where fewer than two are good."""
    upper = floor_div("_n", 2) + 1
    stats = order_statistics(probes, keys, latency, {"median_ms": upper})
    return stats.select(*keys, F.when(F.col("_n") >= 2, F.col("median_ms")).otherwise(0.0).alias("median_ms"))


def quality_scores(medians: DataFrame, latency: str = "median_ms") -> DataFrame:
    """Validated endpoints with their pool weight."""
    scored = medians.withColumn("quality_score", net.quality_score(latency))
    return scored.filter(F.col("quality_score").isNotNull())


def source_yield(candidates: DataFrame) -> DataFrame:
    """Candidates, alive and valid rows per source from the flags ``alive`` and ``valid``.

    As in a report meant for comparing sources, a single source gives no rows.
    """
    per_source = candidates.groupBy("source").agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if("alive").alias("alive"),
        F.count_if(F.col("alive") & F.col("valid")).alias("valid"),
    )
    several = per_source.agg(F.count(F.lit(1)) > 1).scalar()
    return per_source.filter(several).orderBy("source")


def source_yield_from(candidates: DataFrame, alive: DataFrame, valid: DataFrame) -> DataFrame:
    """The same report from three separate endpoint tables."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("source").agg(F.count(F.lit(1)).alias(name))

    joined = count(candidates, "candidates").join(count(alive, "alive"), "source", "full")
    return joined.join(count(valid, "valid"), "source", "full").fillna(0)


def prefilter_until(candidates: DataFrame, alive_target: int, batch: int = S.PREFILTER_BATCH) -> DataFrame:
    """Rows probed when batches of ``batch`` positions run until ``alive_target`` rows are alive.

    Probing stops with the batch that holds the ``alive_target``-th alive row. That row is found by alive
    counts per batch, running totals over blocks of batches, and one look inside a single batch.
    """
    numbered = candidates.withColumn("batch", floor_div("pos", batch))
    per_batch = numbered.groupBy("batch").agg(F.count_if("alive").alias("_alive"))
    summed = running_total(per_batch, [], floor_div("batch", 4096), ["batch"], F.col("_alive"), "_upto")
    stop = summed.filter(F.col("_upto") >= alive_target).agg(F.min("batch")).scalar()
    return numbered.filter(F.col("batch") <= F.coalesce(stop, F.col("batch")))


def valid_until(candidates: DataFrame, n: int = S.VALID_TARGET) -> DataFrame:
    """The first ``n`` valid rows by position: a per-task top-n, merged."""
    return candidates.filter("valid").orderBy("pos").limit(n)


# ------------------------------------------------------------------ pool state
def evict_blacklist(events: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Pool state per URL after a log of ``failure``, ``rate_limited``, ``stub`` and ``ok`` events.

    A failure blacklists for 10 minutes; the third 429 and every later one for 30, as does the third
    stub; earlier 429s park for 2 minutes. The latest evicting event sets the expiry, even a shorter one.
    Counts run over the whole log, on top of ``counted(url, rate_limited_count, stub_count)`` if given.

    Since counts never fall, a kind evicts from its third event on, so its last event evicts exactly when
    there were three. That leaves counts and maxima, which are pre-aggregated, and the first two 429s
    of a URL for the parking time, which Spark trims before the shuffle. No window sees a whole log.
    """
    at = F.struct("ts", "probe_id")
    is_429, is_stub = F.col("event") == "rate_limited", F.col("event") == "stub"
    totals = events.groupBy("url").agg(
        F.count_if(is_429).alias("_n429"),
        F.count_if(is_stub).alias("_nstub"),
        F.max(F.when(F.col("event") == "failure", at)).alias("_failure"),
        F.max(F.when(is_429, at)).alias("_429"),
        F.max(F.when(is_stub, at)).alias("_stub"),
    )
    if counted is None:
        totals = totals.withColumn("_c429", F.lit(0)).withColumn("_cstub", F.lit(0))
    else:
        start = counted.select(
            "url", F.col("rate_limited_count").alias("_c429"), F.col("stub_count").alias("_cstub")
        )
        totals = join_on(totals, start, ["url"], "left").fillna(0, ["_c429", "_cstub"])
    parks = (
        top_n(events.filter(is_429), ["url"], ["ts", "probe_id"], S.EVICT_AFTER - 1)
        .groupBy("url").agg(F.array_sort(F.collect_list("ts")).alias("_parks"))
    )
    n_429, n_stub = F.col("_c429") + F.col("_n429"), F.col("_cstub") + F.col("_nstub")

    def ending(last: str, ttl: int) -> Column:
        return F.struct(F.col(f"{last}.ts"), F.col(f"{last}.probe_id"), F.lit(ttl).alias("ttl"))

    last = F.greatest(
        F.when(F.col("_failure").isNotNull(), ending("_failure", S.DEAD_TTL_S)),
        F.when((F.col("_n429") > 0) & (n_429 >= S.EVICT_AFTER), ending("_429", S.EVICT_TTL_S)),
        F.when((F.col("_nstub") > 0) & (n_stub >= S.EVICT_AFTER), ending("_stub", S.EVICT_TTL_S)),
    )
    # 429s that only park: those that bring the count to at most two.
    n_parks = F.least(F.col("_n429"), F.lit(S.EVICT_AFTER - 1) - F.col("_c429"))
    parked = F.when(n_parks > 0, F.get("_parks", n_parks.cast("int") - 1))
    return (
        join_on(totals, parks, ["url"], "left")
        .withColumn("_last", last)
        .select(
            "url",
            n_429.alias("rate_limited_count"),
            n_stub.alias("stub_count"),
            F.col("_last.ts").alias("evicted_at"),
            F.timestamp_add("SECOND", F.col("_last.ttl"), F.col("_last.ts")).alias("blacklist_until"),
            F.timestamp_add("SECOND", F.lit(S.PARK_S), parked).alias("rate_limit_until"),
        )
    )


def active_blacklist(pool_state: DataFrame, as_of: str) -> DataFrame:
    """URLs still blacklisted; one that ends exactly now is free."""
    return pool_state.filter(F.col("blacklist_until") > F.lit(as_of).cast("timestamp_ntz")).select(
        "url", "blacklist_until"
    )


def without_blacklisted(candidates: DataFrame, blacklist: DataFrame) -> DataFrame:
    return candidates.join(blacklist.select("url"), "url", "left_anti")


def pool_counts(pool: DataFrame, as_of: str) -> DataFrame:
    """Endpoints in the pool, and those of them that are not parked."""
    now = F.lit(as_of).cast("timestamp_ntz")
    free = F.coalesce(F.col("rate_limit_until") <= now, F.lit(True))
    return pool.agg(F.count(F.lit(1)).alias("working"), F.count_if(free).alias("usable"))


def weighted_pick(draws: DataFrame, pool: DataFrame, weight_scale: int = 1_000_000) -> DataFrame:
    """Assign a pool row to each draw, with chances proportional to ``quality_score``.

    ``draws(task_id, u)`` with u in [0, 1]; ``pool(pos, url, quality_score)`` without parked rows. The
    row whose running weight first reaches ``u * total`` is taken. Without any weight the tasks take
    turns by ``task_id``. Weights are summed as integers, so a pick does not depend on partitioning.

    Both sides are cut into as many equal weight ranges as the pool has rows and joined on the range
    number, so neither a product of the tables nor a broadcast of the pool is needed.
    """
    weighted = pool.withColumn("_w", F.round(F.col("quality_score") * weight_scale).cast("bigint"))
    size = weighted.agg(
        F.struct(F.coalesce(F.sum("_w"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("rows"))
    ).scalar()
    total, rows = size["total"], size["rows"]
    placed = running_totals(
        weighted, [], floor_div("pos", ROWS_PER_BLOCK), ["pos"], {"_high": F.col("_w"), "_no": F.lit(1)}
    )
    width = F.ceil(total / rows)
    spans = placed.filter("_w > 0").withColumn("_low", F.col("_high") - F.col("_w"))
    ranges = F.sequence(F.floor(F.col("_low") / width), F.floor(F.col("_high") / width))
    spans = spans.select(F.explode(ranges).alias("_range"), "_low", "_high", "pos", "url")

    by_weight = draws.filter(total > 0).withColumn("_r", F.col("u") * total)
    by_weight = by_weight.withColumn("_range", F.floor(F.col("_r") / width))
    hit = (F.col("_r") > F.col("_low")) & (F.col("_r") <= F.col("_high"))
    hit = hit | ((F.col("_r") == 0) & (F.col("_low") == 0))
    picked = by_weight.join(spans, "_range").filter(hit).select(*draws.columns, "pos", "url")

    turn = F.pmod("task_id", F.nullif(rows, F.lit(0)))
    turns = draws.filter(total <= 0).withColumn("_no", turn + 1)
    return picked.unionByName(turns.join(placed, "_no").select(*draws.columns, "pos", "url"))


def snapshot_decision(
    snapshots: DataFrame,
    blacklist: DataFrame,
    valid: DataFrame,
    as_of: str,
    usable: int = 0,
    min_pool: int = S.SNAPSHOT_MIN_POOL,
) -> DataFrame:
    """What to do with each saved pool ``snapshots(snapshot_id, cached_at, url)`` at ``as_of``.

    Fresh with enough rows left: adopt it if larger than the usable pool, else keep the pool. Stale:
    adopt the rows that validated again if enough of them did. Anything else: fetch lists anew.
    """
    marked = (
        snapshots.select("snapshot_id", "cached_at", "url")
        .join(blacklist.select("url").distinct().withColumn("_out", F.lit(True)), "url", "left")
        .join(valid.select("url").distinct().withColumn("_ok", F.lit(True)), "url", "left")
    )
    now = F.lit(as_of).cast("timestamp_ntz")
    counted = marked.groupBy("snapshot_id").agg(
        F.max("cached_at").alias("cached_at"),
        F.count(F.lit(1)).alias("listed"),
        F.count_if(F.col("_out").isNull()).alias("kept"),
        F.count_if(F.col("_ok")).alias("valid"),
    )
    age = F.timestamp_diff("MICROSECOND", F.col("cached_at"), now) / 1e6
    fresh, stale = F.col("age_s") < S.SNAPSHOT_FRESH_S, F.col("age_s") < S.SNAPSHOT_MAX_S
    decision = (
        F.when(fresh & (F.col("kept") < min_pool), "refetch")
        .when(fresh & (F.col("kept") > usable), "adopt_fresh")
        .when(fresh, "keep_pool")
        .when(stale & (F.col("valid") >= min_pool), "adopt_revalidated")
        .otherwise("refetch")
    )
    return counted.withColumn("age_s", age).withColumn("decision", decision).drop("cached_at")


def adopt_valid(pool: DataFrame, valid: DataFrame) -> DataFrame:
    """The new pool: the validated rows, or the old pool when nothing validated."""
    some = valid.agg(F.count(F.lit(1))).scalar()
    return valid.unionByName(pool.filter(some == 0))


def adopted_share(valid: DataFrame, total: DataFrame) -> DataFrame:
    """Validated rows, candidates and the percentage of the two."""
    n_total = total.agg(F.count(F.lit(1))).scalar()
    counted = valid.agg(F.count(F.lit(1)).alias("n_valid")).withColumn("n_total", n_total)
    return counted.withColumn("pct", F.col("n_valid") / F.greatest(F.col("n_total"), F.lit(1)) * 100)
