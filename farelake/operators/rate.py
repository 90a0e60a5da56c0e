"""Throttling: bursts of 429s and the request budget that reacts to them.

Reports are ``(source, ts, id, is_429)``. Work is grouped by (source, slice of time). A slice also gets
the 429s of the minute before it, so windows never cross groups. A slice of one source cannot grow with the
table: it holds what that source answered within the slice, and its budget is at most RATE_CAP a second.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions.common import epoch_micros, floor_div
from farelake.operators.scaling import join_on
from farelake.session import work_path

MICROS = 1_000_000
SLICE_S = 60
CHUNK_S = 600


def _with_halo(rows: DataFrame, at: str, is_context: Column, halo_s: int, slice_s: int) -> DataFrame:
    """Rows in their time slice, and context rows again in each slice that looks back at them."""
    own = floor_div(at, slice_s * MICROS)
    until = F.when(is_context, floor_div(F.col(at) + halo_s * MICROS, slice_s * MICROS)).otherwise(own)
    return rows.withColumn("_own", own).withColumn("_slice", F.explode(F.sequence(own, until)))


def rate_burst(reports: DataFrame, rate: float, source: str = "source", ts: str = "ts") -> DataFrame:
    """Per source and instant with a 429: those of the last 30 s and whether they make a burst.

    Reports of the same instant are counted before the shuffle.
    """
    instants = (
        reports.filter("is_429").groupBy(source, ts).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_at", epoch_micros(ts))
    )
    sliced = _with_halo(instants, "_at", F.lit(True), S.BURST_WINDOW_S, SLICE_S)
    recent = Window.partitionBy(source, "_slice").orderBy("_at").rangeBetween(-S.BURST_WINDOW_S * MICROS, 0)
    return (
        sliced.withColumn("n_30s", F.sum("n").over(recent))
        .filter(F.col("_slice") == F.col("_own"))
        .withColumn("burst", F.col("n_30s") > F.lit(S.BURST_WINDOW_S * rate * S.BURST_SHARE))
        .select(source, ts, "n", "n_30s", "burst")
    )


def rate_ladder(max_rate: float, min_rate: float) -> list[float]:
    """Every budget reachable from ``max_rate`` by halving and doubling within the bounds."""
    if not 0 < min_rate <= max_rate:
        raise ValueError("need 0 < min_rate <= max_rate")
    seen, todo = {max_rate}, [max_rate]
    while todo:
        rate = todo.pop()
        for nxt in (max(min_rate, rate * S.RATE_BACKOFF), min(max_rate, rate * S.RATE_RECOVERY)):
            if nxt not in seen:
                seen.add(nxt)
                todo.append(nxt)
    return sorted(seen, reverse=True)


def effective_reports(
    reports: DataFrame, ladder: list[float], source: str = "source", context: DataFrame | None = None
) -> DataFrame:
    """Reports that can move the budget: ``hits`` is the 429s of the last 30 s, or 0 for a clean success.

    Whether a success is clean (no 429 for 60 s) and how many 429s a burst has do not depend on the budget,
    so both are plain windows. Rows of ``context`` are earlier reports that only count in those windows.

    Reports are of one class when they move the same budgets of ``ladder``. In an unbroken run of one class,
    the budget stands still after as many reports as the ladder has steps, so the rest of the run is
    dropped. What remains of a slice is small even if the slice is not.
    """
    columns = [source, "ts", "id", "is_429"]
    log = reports.select(*columns).withColumn("_old", F.lit(False))
    if context is not None:
        log = log.unionByName(context.select(*columns).withColumn("_old", F.lit(True)))
    at = log.select(
        source, epoch_micros("ts").alias("_at"), "id", F.col("is_429").cast("int").alias("_429"), "_old"
    )
    sliced = _with_halo(at, "_at", F.col("_429") == 1, S.QUIET_WINDOW_S, SLICE_S)
    by_time = Window.partitionBy(source, "_slice").orderBy("_at")
    in_order = Window.partitionBy(source, "_slice").orderBy("_at", "id")
    same_instant = Window.partitionBy(source, "_slice", "_at").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    before = lambda s: F.coalesce(F.sum("_429").over(by_time.rangeBetween(-s * MICROS, -1)), F.lit(0))
    counted = (
        sliced.withColumn("_now", F.sum("_429").over(same_instant))
        .withColumn("_burst", before(S.BURST_WINDOW_S) + F.col("_now"))
        .withColumn("_recent", before(S.QUIET_WINDOW_S) + F.col("_now"))
        .filter((F.col("_slice") == F.col("_own")) & ~F.col("_old"))
    )
    hits = F.when(F.col("_429") == 1, F.col("_burst")).when(F.col("_recent") == 0, 0)
    moved = sum(((F.col("hits") > _limit(F.lit(rate))).cast("int") for rate in ladder), F.lit(0))
    new_run = F.coalesce(F.lag("_class").over(in_order) != F.col("_class"), F.lit(True))
    same_run = F.lag("_run", len(ladder)).over(in_order) == F.col("_run")
    return (
        counted.withColumn("hits", hits.cast("bigint"))
        .withColumn("_class", moved)
        .filter((F.col("hits") == 0) | (F.col("_class") > 0))
        .withColumn("_new", new_run.cast("int"))
        .withColumn("_run", F.sum("_new").over(in_order))
        .withColumn("_same", F.coalesce(same_run, F.lit(False)))
        .filter("NOT _same")
        .select(source, "_at", "id", "hits")
    )


def _limit(rate: Column) -> Column:
    """429s within the burst window that ``rate`` still bears."""
    return rate * (S.BURST_WINDOW_S * S.BURST_SHARE)


# Maps from the place of a budget on the ladder before some reports to its place after them. They compose in any grouping, so the
# chunks of a source form a tree: FAN chunks make a block, FAN blocks a large block, and a source has few of those.
FAN = 256


def _numbers(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _step(ladder: list[float]) -> Callable[[Column, Column], Column]:
    """The next place on the ladder after a report with ``hits``."""
    place = {rate: i for i, rate in enumerate(ladder)}
    up = _numbers(place[min(ladder[0], r * S.RATE_RECOVERY)] for r in ladder)
    down = _numbers(place[max(ladder[-1], r * S.RATE_BACKOFF)] for r in ladder)
    bears = F.array(*[_limit(F.lit(r)) for r in ladder])
    return lambda at, hits: F.when(hits == 0, F.get(up, at)).when(hits > F.get(bears, at), F.get(down, at)).otherwise(at)


def chunk_maps(effective: DataFrame, ladder: list[float], source: str, chunk_s: int) -> DataFrame:
    """(source, node, log, after): each chunk's effective reports in order and the map they make."""
    step = _step(ladder)
    chunks = effective.groupBy(source, floor_div("_at", chunk_s * MICROS).alias("node")).agg(
        F.array_sort(F.collect_list(F.struct("_at", "id", "hits"))).alias("log")
    )
    start = _numbers(range(len(ladder)))
    after = F.aggregate("log", start, lambda at, e: F.transform(at, lambda i: step(i, e["hits"])))
    return chunks.withColumn("after", after)


def parents(nodes: DataFrame, steps: int, source: str) -> DataFrame:
    """(source, node, after, kids): blocks of FAN nodes; ``kids`` has their maps in order."""
    kids = nodes.groupBy(source, floor_div("node", FAN).alias("node")).agg(F.array_sort(F.collect_list(F.struct("node", "after"))).alias("kids"))
    composed = F.aggregate("kids", _numbers(range(steps)), lambda at, kid: F.transform(at, lambda i: F.get(kid["after"], i)))
    return kids.withColumn("after", composed)


def _begin(blocks: DataFrame, source: str) -> DataFrame:
    """(source, node, start) of the kids of ``blocks`` (source, kids, start): each begins where the one before it ends."""
    empty = F.array().cast("array<struct<node:bigint,start:int>>")
    first = F.struct(F.col("start").cast("int").alias("at"), empty.alias("out"))
    walk = F.aggregate("kids", first, lambda acc, kid: F.struct(
        F.get(kid["after"], acc["at"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct(kid["node"].alias("node"), acc["at"].alias("start")))).alias("out"),
    ))
    return blocks.select(source, F.inline(walk["out"]))


def chunk_starts(blocks: DataFrame, large: DataFrame, source: str, initial: DataFrame | None = None) -> DataFrame:
    """(source, node, start) of every chunk from the two levels above the chunks; ``initial(source, start)`` else the top of the ladder."""
    tops = large.groupBy(source).agg(F.array_sort(F.collect_list(F.struct("node", "after"))).alias("kids"))
    if initial is None:
        tops = tops.withColumn("start", F.lit(0))
    else:
        tops = join_on(tops, initial, [source], "left").withColumn("start", F.coalesce("start", F.lit(0)))
    begun = _begin(tops, source)
    for level in (large, blocks):
        begun = _begin(join_on(level.select(source, "node", "kids"), begun, [source, "node"]), source)
    return begun


def replayed(chunks: DataFrame, begun: DataFrame, ladder: list[float], source: str) -> DataFrame:
    """Every change of the budget, from the chunks (source, node, log) and where each starts."""
    step = _step(ladder)
    change = "struct<at_us:bigint,id:bigint,hits:bigint,old:int,new:int>"
    empty = F.array().cast(f"array<{change}>")

    def move(acc: Column, e: Column) -> Column:
        new = step(acc["at"], e["hits"])
        row = F.struct(e["_at"].alias("at_us"), e["id"].cast("bigint").alias("id"), e["hits"].alias("hits"), acc["at"].alias("old"), new.alias("new"))
        return F.struct(new.alias("at"), F.when(new != acc["at"], F.concat(acc["out"], F.array(row))).otherwise(acc["out"]).alias("out"))

    def move_all(acc: Column, part: Column) -> Column:
        # Changes of a part are gathered by themselves, so that no long array is copied for each change.
        done = F.aggregate(part, F.struct(acc["at"].alias("at"), empty.alias("out")), move)
        return F.struct(done["at"].alias("at"), F.concat(acc["out"], F.array(done["out"])).alias("out"))

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("log") - 1) / FAN)), lambda k: F.slice("log", (k * FAN + 1).cast("int"), FAN))
    begin = F.struct(F.col("start").alias("at"), F.array().cast(f"array<array<{change}>>").alias("out"))
    rates = _numbers(ladder)
    rows = join_on(chunks.filter(F.size("log") > 0).select(source, "node", "log"), begun, [source, "node"]).select(
        source, F.inline(F.flatten(F.aggregate(parts, begin, move_all)["out"]))
    )
    return rows.select(source, "at_us", "id", "hits", F.get(rates, F.col("old")).alias("old_rate"), F.get(rates, F.col("new")).alias("new_rate"))


def rate_trace(
    reports: DataFrame,
    max_rate: float = S.RATE_CAP,
    min_rate: float = S.RATE_FLOOR,
    source: str = "source",
    initial: DataFrame | None = None,
    context: DataFrame | None = None,
    chunk_s: int = CHUNK_S,
) -> DataFrame:
    """Every change of each source's budget: ``(source, at_us, id, hits, old_rate, new_rate)``.

    The budget takes few values, so a chunk of the log is a small map from the budget before it to the budget
    after it. Maps compose, in blocks and large blocks, on as many tasks as there are; then each block tells its parts where they
    start, and the chunks are replayed in parallel. The reports are scanned once: their chunks are written and read again.
    ``initial(source, rate)`` gives budgets to start from; else each source starts at ``max_rate``.
    ``context`` holds earlier reports, already replayed, that still count as recent ones.
    """
    spark, ladder = reports.sparkSession, rate_ladder(max_rate, min_rate)
    path = work_path(spark, "rate-chunks")
    chunk_maps(effective_reports(reports, ladder, source, context), ladder, source, chunk_s).write.parquet(path)
    chunks = spark.read.parquet(path)
    blocks = parents(chunks, len(ladder), source)
    large = parents(blocks, len(ladder), source)
    if initial is not None:
        initial = initial.select(source, (F.array_position(_numbers(ladder), F.col("rate")) - 1).cast("int").alias("start"))
    return replayed(chunks, chunk_starts(blocks, large, source, initial), ladder, source)


def final_rates(trace: DataFrame, source: str = "source") -> DataFrame:
    """The budget each source ends with; a source that never changed is not listed."""
    last = F.max(F.struct("at_us", "id", "new_rate"))
    return trace.groupBy(source).agg(last.alias("_l")).select(source, F.col("_l.new_rate").alias("rate"))
