"""Keys, times and durations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake import schema as S

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: ColumnLike, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(col(value)), body), F.lit(0))


def route_key(origin: ColumnLike, dest: ColumnLike) -> Column:
    return F.concat_ws("|", origin, dest)


def flight_type(return_date: ColumnLike) -> Column:
    has_return = F.coalesce(col(return_date), F.lit("")) != ""
    return F.when(has_return, S.ROUND_TRIP).otherwise(S.ONE_WAY)


def epoch_micros(ts: ColumnLike) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, independent of the session zone."""
    start = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.timestamp_diff("MICROSECOND", start, col(ts).cast("timestamp_ntz"))


def floor_div(value: ColumnLike, width: int) -> Column:
    """Integer floor division that stays exact for the whole BIGINT range."""
    v = col(value).cast("bigint")
    return F.call_function("div", v - F.pmod(v, F.lit(width).cast("bigint")), F.lit(width).cast("bigint"))


def format_duration(seconds: ColumnLike) -> Column:
    """``2h05m`` / ``3m07s`` / ``9s``; fractions are cut off."""
    whole = col(seconds).cast("bigint")
    hours = floor_div(whole, 3600)
    minutes = floor_div(F.pmod(whole, F.lit(3600)), 60)
    secs = F.pmod(whole, F.lit(60))
    return (
        F.when(hours > 0, F.format_string("%dh%02dm", hours, minutes))
        .when(minutes > 0, F.format_string("%dm%02ds", minutes, secs))
        .otherwise(F.format_string("%ds", secs))
    )


def bundle_name(as_of: ColumnLike, suffix: Column | None = None) -> Column:
    """``search_<stamp>``, with the cycle suffix when one is given."""
    stem = F.concat(F.lit("search_"), F.date_format(as_of, "yyyyMMdd_HHmmss"))
    return stem if suffix is None else F.concat_ws("_", stem, suffix)


def cycle_day(day: ColumnLike) -> Column:
    anchor = F.to_date(F.lit(S.CYCLE_ANCHOR))
    return F.pmod(F.datediff(day, anchor), F.lit(len(S.CYCLE_WINDOWS)))


def cycle_window(day: ColumnLike) -> Column:
    """Days ahead that the collection run of ``day`` covers."""
    return F.get(F.array(*[F.lit(w) for w in S.CYCLE_WINDOWS]), cycle_day(day))


def cycle_suffix(day: ColumnLike) -> Column:
    return F.get(F.array(*[F.lit(s) for s in S.CYCLE_SUFFIXES]), cycle_day(day))
