"""Parquet partitioned by route."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelake.sources import storage

# Upper size of a file; a hot route gets more files, not bigger ones.
MAX_RECORDS_PER_FILE = 5_000_000


def write_silver(df: DataFrame, path: str, partition: str = "route") -> int:
    """Replace the partitions ``df`` holds, keep the others, and return the rows written.

    The rebalance hint groups rows by route but lets Spark split a hot route and merge small ones by
    size. Rows are counted while they are written, not by a second scan.
    """
    counted = Observation()
    (
        df.observe(counted, F.count(F.lit(1)).alias("n"))
        .hint("rebalance", F.col(partition))
        .write.partitionBy(partition)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(path)
    )
    return storage.measured(counted, lambda: {"n": df.count()})["n"]


def read_silver(spark: SparkSession, path: str, partition: str = "route", growing: bool = False) -> DataFrame:
    """Silver with the partition column always as text; filters on it prune folders.

    With ``growing`` the columns are those of all files, also inside offers; what a file lacks is NULL.
    """
    return spark.read.option("mergeSchema", str(growing).lower()).parquet(path).withColumn(partition, F.col(partition).cast("string"))


def publish_manifest(spark: SparkSession, path: str, prefix: str = "silver", with_time: bool = False) -> DataFrame:
    """Every Parquet file below ``path`` with its size and the object key it is published under.

    Only listings are read. Publishing itself is ``write_silver`` with an object-store path.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", *(["modificationTime"] if with_time else []))
    )
    root = path.split("://", 1)[-1].split(":", 1)[-1].rstrip("/") + "/"
    relative = F.substring_index("path", root, -1)
    return files.withColumn("key", F.concat(F.lit(f"{prefix}/"), relative)).orderBy("path")
