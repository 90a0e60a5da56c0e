"""Gold kept up to date from silver: only routes whose files changed are computed again.

What changed is told by file listings alone. Each refresh writes a new folder per table; a row per route in a small versioned manifest names the
files it was made from and the folder that holds it. Readers see the routes of one manifest, so a refresh that dies changes nothing, and
of two at a time one gets a StateConflict.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.operators import gold
from farelake.operators.offers import flatten_offers
from farelake.sources import silver, statetable, storage

MANIFEST = "route string, mark bigint, folder string, version bigint"
# Tables of each refresh, in the order in which they are made: all from the facts.
TABLES = {"facts": None, "snapshots": gold.cheapest_snapshot, "airlines": gold.airline_sketches}


@dataclass(frozen=True)
class Refreshed:
    version: int
    routes: list[str]
    gone: list[str]


def facts_of_silver(rows: DataFrame) -> DataFrame:
    """Facts from searches: an offer is known by its key, time, place in the list and currency."""
    searched = rows.withColumn("searched_at", F.to_timestamp_ntz("searched_at")).filter("searched_at IS NOT NULL")
    offers = flatten_offers(searched).withColumns({
        "snapshot_date": F.to_date("searched_at"), "seq": F.unix_micros(F.col("searched_at").cast("timestamp")),
    })
    return gold.offer_facts(offers)


def route_marks(spark: SparkSession, silver_path: str) -> dict[str, int]:
    """Per route a checksum over names, sizes and times of its files; one entry per folder of silver."""
    files = silver.publish_manifest(spark, silver_path, with_time=True)
    route = F.url_decode(F.regexp_extract("path", "/route=([^/]*)/[^/]*$", 1))
    marks = files.groupBy(route.alias("route")).agg(F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("mark"))
    return {r["route"]: r["mark"] for r in marks.collect()}


def _manifest(spark: SparkSession, path: str) -> tuple[statetable.Commit | None, dict[str, tuple]]:
    commit = statetable.current_commit(spark, f"{path}/manifest")
    rows = statetable.read_commit(spark, f"{path}/manifest", commit).collect() if commit else []
    return commit, {r["route"]: (r["route"], r["mark"], r["folder"], r["version"]) for r in rows}


def refresh(spark: SparkSession, silver_path: str, gold_path: str) -> Refreshed:
    """Bring gold up to date; returns the routes that were computed again and those that are gone."""
    commit, known = _manifest(spark, gold_path)
    marks = route_marks(spark, silver_path)
    changed = sorted(r for r, mark in marks.items() if r not in known or known[r][1] != mark)
    gone = sorted(set(known) - set(marks))
    if not changed and not gone:
        return Refreshed(commit.version if commit else 0, [], [])
    version, folder = (commit.version if commit else 0) + 1, uuid.uuid4().hex
    if changed:
        rows = silver.read_silver(spark, silver_path).filter(F.col("route").isin(changed))
        facts = facts_of_silver(rows)
        for name, make in TABLES.items():
            made = facts if make is None else make(facts)
            made.hint("rebalance", F.col("route")).write.partitionBy("route").parquet(f"{gold_path}/{name}/{folder}")
            facts = spark.read.schema(made.schema).parquet(f"{gold_path}/{name}/{folder}") if make is None else facts
    rows = [known[r] for r in known if r in marks and r not in changed] + [(r, marks[r], folder, version) for r in changed]
    statetable.write_state(spark.createDataFrame(rows, MANIFEST), f"{gold_path}/manifest", buckets=1, base=commit, place=("route",))
    return Refreshed(version, changed, gone)


def read_gold(spark: SparkSession, gold_path: str, name: str, routes: list[str] | None = None) -> DataFrame | None:
    """A table of gold with the version each route was computed in; None if it has no rows."""
    _, known = _manifest(spark, gold_path)
    folders = {known[r][2] for r in known if routes is None or r in routes}
    tables = []
    for folder in sorted(folders):
        if any(n.startswith("route=") for n in storage.names(spark, f"{gold_path}/{name}/{folder}")):
            rows = spark.read.parquet(f"{gold_path}/{name}/{folder}").withColumn("route", F.col("route").cast("string"))
            here = [r for r in known if known[r][2] == folder and (routes is None or r in routes)]
            version = next(known[r][3] for r in here)
            tables.append(rows.filter(F.col("route").isin(here)).withColumn("version", F.lit(version)))
    out = None
    for rows in tables:
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def drop_unused(spark: SparkSession, gold_path: str) -> list[str]:
    """Remove folders that no route of the current manifest lies in, and older manifests; no refresh or older reader may be running."""
    commit, known = _manifest(spark, gold_path)
    used = {row[2] for row in known.values()}
    gone = [f"{name}/{n}" for name in TABLES for n in storage.names(spark, f"{gold_path}/{name}") if n not in used]
    for folder in gone:
        storage.remove(spark, f"{gold_path}/{folder}")
    statetable.vacuum(spark, f"{gold_path}/manifest", keep=1)
    return gone
