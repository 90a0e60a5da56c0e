"""From single attempts to one outcome per search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import outcomes, payload
from farelake.functions.common import floor_div, format_duration
from farelake.operators.scaling import join_on, latest, running_total


def classify_exchanges(exchanges: DataFrame, only_open: bool = False) -> DataFrame:
    """Captured exchanges with every class, the decoded offers and the outcome of the attempt.

    Input: has_endpoint, exception, status, body. Everything is one projection over the scan. With ``only_open`` a body is decoded only
    where endpoint, exception and status leave the outcome open; elsewhere it reads as one without payload.
    """
    settled_before = ~F.col("has_endpoint") | F.col("exception").isNotNull() | (outcomes.http_class("status", "body") != outcomes.OK)
    body = F.when(~F.coalesce(settled_before, F.lit(False)), F.col("body")) if only_open else F.col("body")
    paged = exchanges.withColumn("_page", payload.payload_struct(body))
    decoded = paged.withColumn("offers", payload.decode_offers("_page.raw"))
    n_offers = F.coalesce(F.size("offers"), F.lit(0))
    classed = (
        decoded.withColumn("page_kind", F.col("_page.kind"))
        .withColumn("n_offers", F.when(F.col("offers").isNull(), 0).otherwise(n_offers))
        .withColumn("http_class", outcomes.http_class("status", "body"))
        .withColumn("transport_class", outcomes.transport_class("exception"))
        .withColumn("payload_class", outcomes.payload_class("page_kind", "n_offers", "body"))
        .withColumn(
            "_outcome",
            outcomes.attempt_outcome("has_endpoint", "exception", "http_class", "payload_class"),
        )
    )
    return classed.select(
        *exchanges.columns, "page_kind", "offers", "n_offers", "http_class", "transport_class",
        "payload_class", "_outcome.*",
    )


def fold_attempts(log: DataFrame, keys: Sequence[str] = S.PK) -> DataFrame:
    """One outcome per key and round: the first success, else the last error.

    ``log`` has round, attempt (0-based), success, error_type, flights, searched_at. A success stores the
    attempt that made it; a failed round stores all attempts of this and earlier rounds. The minimum and
    maximum attempt carry their row along, so one partial aggregate per key and map task is shuffled.
    """
    ok = F.col("success") == 1
    first_ok = F.min(F.when(ok, F.struct("attempt", "flights")))
    last = F.max(F.struct("attempt", "error_type"))
    first = F.min(F.struct("attempt", "searched_at"))
    folded = log.groupBy(*keys, "round").agg(first_ok.alias("_ok"), last.alias("_last"), first.alias("_first"))
    won = F.col("_ok").isNotNull()
    return folded.select(
        *keys, "round",
        F.col("_ok.flights").alias("flights"),
        F.when(~won, F.col("_last.error_type")).alias("error_type"),
        F.when(won, F.col("_ok.attempt") + 1)
        .otherwise((F.col("round") + 1) * S.ATTEMPTS_PER_ROUND).cast("int").alias("retries"),
        won.cast("int").alias("success"),
        F.col("_first.searched_at").alias("searched_at"),
    )


def record_unexpected(rejected: DataFrame, round_no: int = 0) -> DataFrame:
    """Outcomes that could not be stored, as failures of class other."""
    return (
        rejected.withColumn("flights", F.lit(None).cast("string"))
        .withColumn("error_type", F.lit("other"))
        .withColumn("retries", F.lit((round_no + 1) * S.ATTEMPTS_PER_ROUND))
        .withColumn("success", F.lit(0))
    )


def settled(normalised: DataFrame) -> DataFrame:
    """Normalised outcomes with their round; one that cannot be stored becomes a failure of class other, in the same pass."""
    bad = F.col("violation")
    return normalised.withColumns({
        "flights": F.when(~bad, F.col("flights")),
        "error_type": F.when(bad, "other").otherwise(F.col("error_type")),
        "retries": F.when(bad, (F.col("round") + 1) * S.ATTEMPTS_PER_ROUND).otherwise(F.col("retries")),
    }).drop("violation")


def final_state(log: DataFrame, keys: Sequence[str] = S.PK) -> DataFrame:
    """The outcome of the last round of each key."""
    return latest(fold_attempts(log, keys), keys, ["round"]).drop("round")


def progress_steps(done: DataFrame, run: str, seq: str, ts: str, step_pct: int = 5, block: int = 65536) -> DataFrame:
    """Rows of each run at which progress is reported, with speed and time left.

    A report is due when the percentage has grown by ``step_pct`` since the last *reported* one, and at the
    last row. Which rows those are follows from the run's size alone, so only the position of a row in
    its run is computed over the data, by block counts.
    """
    totals = done.groupBy(run).agg(F.count(F.lit(1)).alias("total"), F.min(ts).alias("started"))
    pct = lambda n: F.floor(n * 100 / F.col("total"))
    first_at = lambda p: F.ceil(p * F.col("total") / 100)
    step = F.struct(F.lit(step_pct).cast("bigint").alias("due"), F.array().cast("array<bigint>").alias("rows"))

    def visit(acc, target):
        row = first_at(target).cast("bigint")
        reached = pct(row).cast("bigint")
        due = (target == acc["due"]) & (target <= 100)
        return F.when(
            due, F.struct((reached + step_pct).alias("due"), F.concat(acc["rows"], F.array(row)).alias("rows"))
        ).otherwise(acc)

    targets = F.sequence(F.lit(1).cast("bigint"), F.lit(100).cast("bigint"))
    rows = F.aggregate(targets, step, visit)["rows"]
    rows = F.array_distinct(F.concat(rows, F.array(F.col("total"))))
    reports = totals.select(run, "total", "started", F.explode(rows).alias("done"))
    placed = running_total(done, [run], floor_div(seq, block), [seq], F.lit(1), "done").select(run, "done", ts)
    elapsed = F.timestamp_diff("MICROSECOND", F.col("started"), F.col(ts)) / 1e6
    speed = F.when(F.col("elapsed_s") > 0, F.col("done") / F.col("elapsed_s"))
    return (
        join_on(reports, placed, [run, "done"])
        .withColumn("pct", pct(F.col("done")))
        .withColumn("elapsed_s", elapsed)
        .withColumn("rate", speed)
        .withColumn("eta_s", (F.col("total") - F.col("done")) / F.col("rate"))
        .withColumn("elapsed", format_duration("elapsed_s"))
        .withColumn("eta", format_duration("eta_s"))
        .drop("started", ts)
    )
