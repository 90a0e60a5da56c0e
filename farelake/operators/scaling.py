"""Ordered work that stays spread out when one key holds most of the rows.

Each helper replaces a plain window over a whole key by steps whose groups are small by construction:
block sums plus offsets instead of one long running sum, a salted pre-selection instead of one long
ranking, counts per value and ranges of values instead of a list of values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.session import work_path

ROWS_PER_BLOCK = 65536
BEFORE = (Window.unboundedPreceding, -1)
UP_TO = (Window.unboundedPreceding, Window.currentRow)


def running_totals(
    df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[Column | str], sums: dict[str, Column]
) -> DataFrame:
    """Add the inclusive running sum of each column in ``sums`` per ``keys`` in ``order``.

    ``block`` is an integer that grows with ``order`` and keeps each (keys, block) group small, such as
    ``floor_div(position, ROWS_PER_BLOCK)``. One row per block is scanned per key; the rows themselves only
    need a window inside their block. NULL is a key like any other.
    """
    keys, names = list(keys), list(sums)
    values = {f"_v{i}": sums[name] for i, name in enumerate(names)}
    rows = df.withColumns({"_blk": block.cast("bigint"), **values})
    blocks = rows.groupBy(*keys, "_blk").agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(*BEFORE)
    offsets = blocks.select(*keys, "_blk", *[F.sum(v).over(before).alias(f"{v}_before") for v in values])
    in_block = Window.partitionBy(*keys, "_blk").orderBy(*order).rowsBetween(*UP_TO)
    inside = rows.withColumns({v: F.sum(v).over(in_block) for v in values})
    total = lambda v: F.coalesce(f"{v}_before", F.lit(0)) + F.coalesce(v, F.lit(0))
    return join_on(inside, offsets, [*keys, "_blk"]).select(
        *df.columns, *[total(v).alias(name) for v, name in zip(values, names)]
    )


def running_total(
    df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[Column | str], value: Column, out: str
) -> DataFrame:
    """``running_totals`` of a single column."""
    return running_totals(df, keys, block, order, {out: value})


def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, salts: int = 64
) -> DataFrame:
    """The first ``n`` rows of each key in ``order``.

    One plan for every ``n``: rows are ranked within salts of each key first, so the last step sees at most
    ``n * salts`` rows of a key. The salt hashes the columns that can be hashed.
    """
    if n <= 0:
        return df.limit(0)
    plain = [f.name for f in df.schema if not _unhashable(f.dataType)]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c in plain]), F.lit(salts)))
    return _ranked(_ranked(salted, [*keys, "_salt"], order, n).drop("_salt"), keys, order, n)


def _unhashable(kind: T.DataType) -> bool:
    """Maps and variants, also inside other types."""
    if isinstance(kind, T.ArrayType):
        return _unhashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_unhashable(f.dataType) for f in kind)
    return isinstance(kind, T.MapType | T.VariantType)


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(by_key)).filter(F.col("_rn") <= n).drop("_rn")


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where NULL equals NULL; the keys come from ``left``."""
    other = {k: f"_other_{k}" for k in keys}
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()]
    condition = reduce(lambda a, b: a & b, same) if same else F.lit(True)
    return left.join(right.withColumnsRenamed(other), condition, how).drop(*other.values())


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole last row of each key in ``order``; one row per key and map task is shuffled."""
    return _ranked(df, keys, [F.col(c).desc() for c in order], 1)


#: Ranges that the values of a key are cut into in one round.
RANGES = 4096


def _written(df: DataFrame, label: str) -> DataFrame:
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _range_of(value: Column, low: Column, high: Column, by_size: bool) -> Column:
    """The range that ``value`` falls into: one of RANGES of equal width, or of equal ratio of the distance from ``low``. The ends are apart."""
    share = (value - low).cast("double") / (high - low).cast("double")
    if by_size:
        share = F.log1p(share * float(1 << 60)) / F.log1p(F.lit(float(1 << 60)))
    inner = F.when(F.isnan(share) | share.isNull(), F.lit(RANGES // 2)).otherwise(F.least(F.floor(share * RANGES), F.lit(RANGES - 1)))
    return F.when(value == low, 0).when(value == high, RANGES + 1).otherwise(inner.cast("int") + 1).cast("int")


def order_statistics(
    df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Column], most: int = ROWS_PER_BLOCK,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Exact order statistics per key: ``ranks`` maps an output name to a 1-based rank over ``_n``.

    ``df`` is scanned once: equal values are counted before the shuffle, and everything else comes from those counts. A key of at most ``most``
    different values is done with one look at them. Of the others the values are cut into ranges between their least and largest, the range that
    holds the rank is found from counts per range, and only that one is cut again, so windows stay small whatever the values look like.
    ``totals`` are more aggregates over the counts, by the columns ``_v`` (value) and ``_cnt``. NULL values do not count; a key
    without values stays, with ``_n`` 0 and NULL statistics.
    """
    keys = list(keys)
    counts = _written(df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_cnt")), "value-counts")
    there = F.col("_v").isNotNull()
    per_key = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(there, F.col("_cnt"))), F.lit(0)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
        F.count("_v").alias("_d"), *[c.alias(name) for name, c in (totals or {}).items()],
    )
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("_name"), r.cast("bigint").alias("_rank")) for n, r in ranks.items()]))
    wants = per_key.select(*keys, "_low", "_high", "_d", asked.alias("_a")).select(*keys, "_low", "_high", "_d", "_a.*")
    within = (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high"))
    turn = 0
    while not (wide := wants.filter(F.col("_d") > most)).isEmpty():
        rows = join_on(counts.filter(there), wide.drop("_d"), keys).filter(within)
        cut = rows.groupBy(*keys, "_name", "_rank", _range_of(F.col("_v"), F.col("_low"), F.col("_high"), turn % 2 == 1).alias("_range")).agg(
            F.sum("_cnt").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count(F.lit(1)).alias("_d")
        )
        upto = F.sum("_c").over(Window.partitionBy(*keys, "_name").orderBy("_range").rowsBetween(*UP_TO))
        before = F.col("_upto") - F.col("_c")
        holds = cut.withColumn("_upto", upto).filter((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > before))
        narrowed = holds.withColumn("_rank", F.col("_rank") - before)
        wants = _written(wants.filter(F.col("_d") <= most).unionByName(narrowed.select(*keys, "_low", "_high", "_d", "_name", "_rank")), "value-ranges")
        turn += 1
    rows = join_on(counts.filter(there), wants, keys).filter(within)
    upto = F.sum("_cnt").over(Window.partitionBy(*keys, "_name").orderBy("_v").rowsBetween(*UP_TO))
    found = rows.withColumn("_upto", upto).filter((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_cnt")))
    picks = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks])
    return join_on(per_key.drop("_low", "_high", "_d"), picks, keys, "left")


def percentiles(
    df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], totals: dict[str, Column] | None = None, most: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Exact interpolated percentiles per key, from two order statistics each; ``totals`` as in ``order_statistics``."""
    ranks: dict[str, Column] = {}
    for name, share in shares.items():
        at = (F.col("_n") - 1) * F.lit(share)
        ranks[f"{name}_lo"] = F.floor(at) + 1
        ranks[f"{name}_hi"] = F.ceil(at) + 1
    stats = order_statistics(df, keys, value, ranks, most, totals)
    out = []
    for name, share in shares.items():
        at = (F.col("_n") - 1) * F.lit(share)
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return stats.select(*keys, *(totals or {}), *out)
