"""Steps that several operators share: written stages, checked broadcasts, positions of blocks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.session import work_path
from farelake.sources.storage import remove

#: Largest table, in bytes, that may be sent to every executor.
BROADCAST_BYTES = 32 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Where the tables that ``stage`` gave lie.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries inside remove their shuffle files when they end; else these stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, label: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` below the shared folder and read it back, so that nothing upstream runs again.

    ``tidy`` is for operators short of disk: it packs closer and leaves no shuffle files behind.
    """
    path = work_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession) if tidy else nullcontext():
        df.write.parquet(path, compression="zstd" if tidy else None)
    written = df.sparkSession.read.parquet(path)
    _PATHS[written] = path
    return written


def unstage(*written: DataFrame) -> None:
    """Delete what ``stage`` wrote; nothing may read it any more."""
    for df in written:
        remove(df.sparkSession, _PATHS.pop(df))


def checked(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its counted rows fit in ``limit`` bytes; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def block_offsets(totals: DataFrame, block: str, total: str, out: str, fan: int = 1024) -> DataFrame:
    """(block, out): the sum of ``total`` over all smaller blocks; one row per block goes in.

    Runs of ``fan`` blocks are summed first, so a window sees ``fan`` rows, or one row per run.
    """
    runs = totals.withColumn("_run", F.floor(F.col(block) / fan))
    before_run = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    heads = runs.groupBy("_run").agg(F.sum(total).alias("_sum")).select(
        "_run", F.coalesce(F.sum("_sum").over(before_run), F.lit(0)).alias("_head")
    )
    inside = Window.partitionBy("_run").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    local = runs.withColumn("_local", F.coalesce(F.sum(total).over(inside), F.lit(0)))
    return local.join(heads, "_run").select(block, (F.col("_head") + F.col("_local")).alias(out))
