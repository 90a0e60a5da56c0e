"""The three runs a user starts: search over captured attempts, convert, transform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators import state as st
from farelake.operators.attempts import fold_attempts, settled
from farelake.operators.scaling import latest
from farelake.operators.tasks import build_tasks
from farelake.session import work_path
from farelake.sources import bronze, silver, statetable


def search(runs: DataFrame, attempts: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """State after a run: old placeholders purged, the grid seeded, outcomes of the attempts stored, unfit ones as class other.

    ``runs`` has start_date, effective_end and as_of; ``attempts`` is the log of captured attempts.
    """
    seeds = build_tasks(runs).select(*S.SEED_COLUMNS).withColumns({"retries": F.lit(0), "success": F.lit(0)})
    last_round = latest(fold_attempts(attempts), S.PK, ["round"])
    outcomes = settled(st.normalise_outcome(last_round)).drop("round").withColumns({
        "origin": F.substring_index("route", "|", 1), "destination": F.substring_index("route", "|", -1),
    })
    layers = [seeds, outcomes] if state is None else [seeds, st.purge_seeds(state), outcomes]
    # One pass over all layers: an outcome beats what is stored, which beats a seed.
    stacked = None
    for age, layer in enumerate(layers):
        layer = layer.withColumn("_age", F.lit(age))
        stacked = layer if stacked is None else stacked.unionByName(layer, allowMissingColumns=True)
    table = latest(stacked, S.PK, ["_age"])
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.STATE])


def convert(spark: SparkSession, state_path: str, bundle_path: str) -> bool:
    """Export the successful rows of the stored state; False when there are none."""
    return bronze.export_bronze(st.check_state(statetable.read_state(spark, state_path)), bundle_path)


def transform(
    spark: SparkSession, bundle_path: str | list[str], silver_path: str, quarantine_path: str | None = None, growing: bool = False
) -> int:
    """Bundles to silver; returns the rows written.

    Lines are parsed once. Broken ones go as they are to ``quarantine_path``, by default beside silver, in a folder per bundle; a bundle
    that is converted again replaces its own. With ``growing`` fields that the schema does not know go to silver too; ``read_silver``
    then merges the schemas of its files.
    """
    if growing:
        read = bronze.read_growing(spark, bundle_path)
    else:
        read = bronze.read_bronze(spark, bundle_path).withColumn("bundle", bronze.bundle_of(F.col("_metadata.file_path")))
    parsed = work_path(spark, "parsed")
    read.write.parquet(parsed)
    lines = spark.read.schema(read.schema).parquet(parsed)
    broken = lines.filter(F.col(bronze.CORRUPT).isNotNull()).select(bronze.CORRUPT, "bundle")
    aside = quarantine_path or f"{silver_path.rstrip('/')}_quarantine"
    broken.write.partitionBy("bundle").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(aside)
    return silver.write_silver(lines.filter(F.col(bronze.CORRUPT).isNull()).drop(bronze.CORRUPT, "bundle"), silver_path)
