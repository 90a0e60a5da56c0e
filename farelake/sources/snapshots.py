"""Saved endpoint pools: ``{cached_at, proxies: [...]}`` as JSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import schema as S


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Endpoints of every snapshot file below ``path``, absent fields with their defaults.

    A missing or unreadable file, an empty list and a list with an endpoint without URL are no snapshot.
    """
    wanted = "snapshot_id string, cached_at double"
    try:
        files = spark.read.schema(S.SNAPSHOT).option("mode", "PERMISSIVE").option("multiLine", "true").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], wanted)
        return empty.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.ENDPOINT])
    sound = (F.size("proxies") > 0) & F.forall("proxies", lambda p: F.coalesce(p["url"], F.lit("")) != "")
    # A pool in several objects is one snapshot: each object must be sound and none may be missing.
    pools = files.filter("pool_size IS NOT NULL").groupBy(F.col("cached_at").alias("_at"), F.col("pool_size").alias("_size")).agg(
        (F.coalesce(F.bool_and(sound), F.lit(False)) & (F.sum(F.size("proxies")) == F.col("pool_size"))).alias("_whole")
    )
    same = F.col("cached_at").eqNullSafe(F.col("_at")) & (F.col("pool_size") == F.col("_size"))
    usable = files.join(pools, same, "left").filter(sound & F.coalesce("_whole", F.lit(True)))
    rows = usable.select(
        F.coalesce("cached_at", F.lit(0.0)).cast("string").alias("snapshot_id"),
        F.coalesce("cached_at", F.lit(0.0)).alias("cached_at"),
        F.inline("proxies"),
    )
    return rows.fillna(S.ENDPOINT_DEFAULTS)


def write_snapshots(endpoints: DataFrame, path: str, rows_per_file: int = 10_000) -> None:
    """Write pools, each as one JSON object, or as several of about ``rows_per_file`` endpoints.

    ``endpoints`` has cached_at and ENDPOINT's fields; a URL counts once per pool. Objects with the same
    cached_at are read back as one snapshot, which needs all of them.
    """
    fields = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.ENDPOINT])
    once = endpoints.dropDuplicates(["cached_at", "url"])
    parts = once.agg(F.ceil(F.count(F.lit(1)) / rows_per_file)).scalar()
    part = F.pmod(F.xxhash64("url"), parts)
    sizes = once.groupBy(F.col("cached_at").alias("_at")).agg(F.count(F.lit(1)).alias("pool_size"))
    grouped = once.groupBy("cached_at", part.alias("_part")).agg(F.collect_list(fields).alias("proxies")).join(
        sizes, F.col("cached_at").eqNullSafe(F.col("_at"))
    ).drop("_at")
    grouped.drop("_part").write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)
