"""The grid of searches to cover and the choice of searches to repeat.

Every input row is one run, date or failed key; the catalog is a fixed list of 15 destinations, so the
grid grows by ``explode`` over literals and date sequences and never by a product of two tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions.common import ColumnLike, col, cycle_suffix, cycle_window, flight_type, route_key
from farelake.operators.state import failed_retryable

TASKS_PER_DATE = len(S.DESTINATIONS) * (2 + len(S.RETURN_OFFSETS_DAYS))


def catalog(spark: SparkSession) -> DataFrame:
    """The fixed destinations as a table."""
    return spark.createDataFrame([(d,) for d in S.DESTINATIONS], "dest string")


def one_way_routes(destinations: DataFrame, hub: str = S.HUB) -> DataFrame:
    """Both directions between the hub and each destination."""
    there = F.struct(F.lit(hub).alias("origin"), F.col("dest").alias("dest"))
    back = F.struct(F.col("dest").alias("origin"), F.lit(hub).alias("dest"))
    return destinations.select(F.inline(F.array(there, back)))


def round_trip_routes(destinations: DataFrame, hub: str = S.HUB) -> DataFrame:
    return destinations.select(F.lit(hub).alias("origin"), "dest")


def supported_routes(candidates: DataFrame, providers: DataFrame, coverage: DataFrame) -> DataFrame:
    """Rows of ``candidates(provider, origin, dest, …)`` that their provider covers.

    ``providers(provider, covers_all)`` lists who covers everything; the others need a row in
    ``coverage(provider, origin, dest)``. All joins are on equal keys, so Spark picks the strategy by size.
    """
    everywhere = providers.filter("covers_all").select("provider")
    listed = coverage.join(everywhere, "provider", "left_anti")
    wide = candidates.join(everywhere, "provider", "left_semi")
    return wide.unionByName(candidates.join(listed, ["provider", "origin", "dest"], "left_semi"))


def dates_between(start: ColumnLike, end: ColumnLike, today: ColumnLike) -> Column:
    """Array of dates from ``start`` to ``end``, none before ``today``; empty when there are none."""
    first = F.greatest(col(start).cast("date"), col(today).cast("date"))
    last = col(end).cast("date")
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def explode_dates(windows: DataFrame, start: str, end: str, today: str, out: str = "dep") -> DataFrame:
    return windows.withColumn(out, F.explode(dates_between(start, end, today)))


def search_window(runs: DataFrame, start: str, max_days: str, today: str) -> DataFrame:
    """Add ``end_date``, ``ahead_days`` and ``effective_end`` to each run."""
    return (
        runs.withColumn("end_date", F.date_add(start, F.col(max_days)))
        .withColumn("ahead_days", F.greatest(F.datediff("end_date", today), F.lit(0)))
        .withColumn("effective_end", capped_end("end_date", today, "ahead_days"))
    )


def capped_end(end: ColumnLike, today: ColumnLike, max_days: ColumnLike) -> Column:
    """The end of a window that may reach at most ``max_days`` beyond ``today``."""
    return F.least(col(end), F.date_add(today, col(max_days)))


def round_trip_offsets(dates: DataFrame, dep: str = "dep", out: str = "return_day") -> DataFrame:
    """Each outbound date with its fixed return dates."""
    returns = F.array(*[F.date_add(dep, days) for days in S.RETURN_OFFSETS_DAYS])
    return dates.withColumn(out, F.explode(returns))


def _searches_of_a_date(hub: str, destinations: Sequence[str]) -> Column:
    """Literal list of the searches each date gets: both directions one way, then the round trips."""
    def search(origin: str, dest: str, offset: int | None) -> Column:
        return F.struct(
            F.lit(origin).alias("origin"), F.lit(dest).alias("destination"),
            F.lit(offset).cast("int").alias("offset"),
        )

    one_way = [search(*pair, None) for d in destinations for pair in ((hub, d), (d, hub))]
    trips = [search(hub, d, days) for d in destinations for days in S.RETURN_OFFSETS_DAYS]
    return F.array(*one_way, *trips)


def build_tasks(
    runs: DataFrame,
    start: str = "start_date",
    end: str = "effective_end",
    today: str = "as_of",
    destinations: Sequence[str] = S.DESTINATIONS,
    hub: str = S.HUB,
) -> DataFrame:
    """The full grid of each run, with the columns of a state key and the run's own columns."""
    dated = explode_dates(runs, start, end, today, "_dep")
    searches = dated.withColumn("_s", F.explode(_searches_of_a_date(hub, destinations)))
    returns = F.coalesce(F.date_add("_dep", F.col("_s.offset")).cast("string"), F.lit(""))
    return searches.select(
        *runs.columns,
        route_key("_s.origin", "_s.destination").alias("route"),
        F.col("_dep").cast("string").alias("dep_date"),
        returns.alias("return_date"),
        flight_type(returns).alias("flight_type"),
        F.col("_s.origin").alias("origin"),
        F.col("_s.destination").alias("destination"),
    )


def provider_map(coverage: DataFrame) -> DataFrame:
    """Route to provider from ``coverage(route, provider, provider_pos)``; the last provider wins."""
    return coverage.groupBy("route").agg(F.max_by("provider", "provider_pos").alias("provider"))


def retry_tasks(state: DataFrame, providers: DataFrame, as_of: str, max_retries: int | None = 3) -> DataFrame:
    """Failed keys with the provider that repeats them; past departures are left out, today's stay."""
    return failed_retryable(state, max_retries, since=as_of).join(providers, "route")


def uncovered_failures(state: DataFrame, providers: DataFrame, as_of: str, max_retries: int | None = 3) -> DataFrame:
    """Failed keys no provider covers."""
    return failed_retryable(state, max_retries, since=as_of).join(providers, "route", "left_anti")


def retry_budget(state: DataFrame, rounds: int = S.RETRY_ROUNDS, since: str | None = None) -> DataFrame:
    """Which failed keys each round would take: round r allows up to 3r attempts used so far."""
    keep = (F.col("success") == 0) & F.col("error_type").isin(*S.RETRYABLE_ERRORS)
    if since is not None:
        keep = keep & (F.col("dep_date") >= since)
    numbered = state.filter(keep).withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    return numbered.filter(F.col("retries") <= F.col("round") * S.ATTEMPTS_PER_ROUND).select("round", *S.PK)


def cycle_calendar(days: DataFrame, day: str = "day") -> DataFrame:
    """Window, bundle suffix and expected searches of the collection run of each date."""
    return (
        days.withColumn("window_days", cycle_window(day))
        .withColumn("suffix", cycle_suffix(day))
        .withColumn("expected_tasks", (F.col("window_days") + 1) * TASKS_PER_DATE)
    )


def coverage_gap(grid: DataFrame, searched: DataFrame, run_keys: Sequence[str]) -> DataFrame:
    """Expected, searched and missing keys per run, route and departure date.

    ``searched`` holds one row per attempt; it is cut down to distinct keys before the join.
    """
    keys = [*run_keys, *S.PK]
    seen = searched.select(*keys).distinct().withColumn("_seen", F.lit(1))
    return (
        grid.join(seen, keys, "left")
        .groupBy(*run_keys, "route", "dep_date")
        .agg(F.count(F.lit(1)).alias("expected"), F.count("_seen").alias("searched"))
        .withColumn("missing", F.col("expected") - F.col("searched"))
    )


def task_segments(tasks: DataFrame) -> DataFrame:
    """One row per flight segment of each task: a round trip flies back on its return date."""
    out = F.struct(
        F.col("origin").alias("seg_from"), F.col("destination").alias("seg_to"), F.col("dep_date").alias("seg_date")
    )
    back = F.when(
        F.col("return_date") != "",
        F.struct(
            F.col("destination").alias("seg_from"), F.col("origin").alias("seg_to"),
            F.col("return_date").alias("seg_date"),
        ),
    )
    segments = F.filter(F.array(out, back), lambda s: s.isNotNull())
    return tasks.select("*", F.posexplode(segments).alias("seg_no", "_seg")).select(
        *tasks.columns, "seg_no", "_seg.*",
        F.lit(1).alias("adults"), F.lit("ECONOMY").alias("seat"), F.lit("ANY").alias("max_stops"),
        F.lit("CHEAPEST").alias("sort_by"),
    )


def date_error(dep_date: ColumnLike, return_date: ColumnLike, as_of: ColumnLike) -> Column:
    """``data`` for a date that is malformed or past, else NULL; no return date is fine."""
    today = col(as_of).cast("date")

    def bad(text: Column) -> Column:
        day = F.when(F.rlike(text, F.lit(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")), F.try_to_date(text))
        return F.coalesce(day < today, F.lit(True))

    back = F.coalesce(col(return_date), F.lit(""))
    return F.when(bad(col(dep_date)) | ((back != "") & bad(back)), "data")


def airport_alias(df: DataFrame, code: str, airports: DataFrame, out: str = "airport") -> DataFrame:
    """Resolve airport codes: aliases first, then the code table; unknown codes give NULL."""
    wanted = col(code)
    for alias, known in S.AIRPORT_ALIASES.items():
        wanted = F.when(col(code) == alias, known).otherwise(wanted)
    extra = airports.sparkSession.createDataFrame([(c,) for c in S.EXTRA_AIRPORTS], "code string")
    known = airports.select("code").union(extra).distinct().withColumn(out, F.col("code"))
    return df.withColumn("_wanted", wanted).join(known.withColumnRenamed("code", "_wanted"), "_wanted", "left").drop("_wanted")
