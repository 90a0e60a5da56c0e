"""The outcome table between runs: versions that share the buckets nobody touched.

Rows lie in buckets by a hash of their key. A write makes new folders for the buckets it touches only, and then one commit row, which names
the folder of every bucket. A commit is made only if its version does not exist yet: of two writers that start from one
version the second gets a StateConflict and may try again. What is being read is never overwritten, and a run
that dies before its commit leaves the table as it was; ``vacuum`` removes what no kept version names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schema as S
from farelake.operators.scaling import latest
from farelake.operators.state import migrate_state
from farelake.sources import storage

BUCKETS = 64
COMMITS = "version bigint, label string, buckets int, columns string, folders map<string,string>"


class StateConflict(RuntimeError):
    """Another writer committed the version this one was to become."""


@dataclass(frozen=True)
class Commit:
    """A version: ``folders`` names the folder of each bucket that has rows, ``columns`` is the schema as JSON."""

    version: int
    label: str
    buckets: int
    columns: str
    folders: dict[str, str]


def bucket_of(buckets: int, keys: tuple[str, ...] = S.PK) -> Column:
    """The bucket of a row: the same whichever engine computes it, and for NULL like for the empty text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys])
    return (F.crc32(text.cast("binary")) % buckets).cast("int")


def current_commit(spark: SparkSession, path: str) -> Commit | None:
    """The newest version, or None for a table never written."""
    known = [n for n in storage.names(spark, f"{path}/commits") if n.endswith(".json") and not n.startswith("_")]
    return _commit(spark, path, known[-1]) if known else None


def _commit(spark: SparkSession, path: str, name: str) -> Commit:
    row = spark.read.schema(COMMITS).json(f"{path}/commits/{name}").head()
    return Commit(row["version"], row["label"], row["buckets"], row["columns"], row["folders"])


def current_version(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(number, label) of the newest version, or None."""
    now = current_commit(spark, path)
    return (now.version, now.label) if now else None


def _write(rows: DataFrame, path: str, version: int, buckets: int, place: tuple[str, ...]) -> tuple[str, list[str]]:
    """Lay ``rows`` out in bucket folders of a new folder; returns it and the buckets it holds."""
    folder = f"data/{version:012d}-{uuid.uuid4().hex}"
    keys = tuple(c for c in place if c in rows.columns)
    # Spark divides a hot bucket into more files and puts small ones together in one task.
    (
        rows.withColumn("_bucket", bucket_of(buckets, keys)).hint("rebalance", F.col("_bucket"))
        .write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    )
    parts = [n.removeprefix("_bucket=") for n in storage.names(rows.sparkSession, f"{path}/{folder}") if n.startswith("_bucket=")]
    return folder, parts


def _put(spark: SparkSession, path: str, commit: Commit) -> int:
    try:
        storage.create_once(spark, f"{path}/commits", f"{commit.version:012d}.json", json.dumps(commit.__dict__))
    except storage.AlreadyThere:
        raise StateConflict(f"version {commit.version} of {path} was written by another run") from None
    return commit.version


def write_state(
    state: DataFrame, path: str, label: str = "", buckets: int = BUCKETS, base: Commit | None = None, place: tuple[str, ...] = S.PK
) -> int:
    """Write all rows as a new version and make it current; returns its number.

    ``base`` is the version that ``state`` was made from, by default the newest one; ``place`` are the columns that tell a row's bucket.
    """
    spark = state.sparkSession
    base = base or current_commit(spark, path)
    version = base.version + 1 if base else 1
    folder, parts = _write(state, path, version, buckets, place)
    return _put(spark, path, Commit(version, label, buckets, state.schema.json(), {b: folder for b in parts}))


def upsert_state(
    batch: DataFrame, path: str, label: str = "", order: tuple[str, ...] = ("seq",), base: Commit | None = None,
    keys: tuple[str, ...] = S.PK, place: tuple[str, ...] | None = None, buckets: int = BUCKETS,
) -> int:
    """Make the table after ``batch`` the newest version: per key the whole row that comes last in ``order``.

    Only the buckets of the batch are read and written again; the other buckets keep their folders. Rows of the table without ``order``
    count as older than the batch. ``base`` is the version to start from, by default the newest one; ``place``, by default the keys, are
    columns of the key that tell a row's bucket.
    """
    spark, place = batch.sparkSession, place or keys
    base = base or current_commit(spark, path)
    if base is None or not set(keys) <= set(T.StructType.fromJson(json.loads(base.columns)).names):
        return write_state(latest(batch, keys, order), path, label, buckets, base, place)
    stored = read_touched(batch, path, base, place)
    rows = latest(batch if stored is None else stored.unionByName(batch, allowMissingColumns=True), keys, order)
    folder, parts = _write(rows, path, base.version + 1, base.buckets, place)
    columns = _merged(base.columns, rows.schema)
    return _put(spark, path, Commit(base.version + 1, label, base.buckets, columns, {**base.folders, **{b: folder for b in parts}}))


def read_touched(batch: DataFrame, path: str, base: Commit, place: tuple[str, ...] = S.PK) -> DataFrame | None:
    """The rows of ``base`` in the buckets that ``batch`` has rows in; None if those hold none."""
    # At most as many rows as there are buckets.
    touched = {str(r[0]) for r in batch.select(bucket_of(base.buckets, place)).distinct().collect()}
    return _read(batch.sparkSession, path, base, sorted(touched & set(base.folders)))


def _merged(columns: str, new: T.StructType) -> str:
    """The columns of both, those known before first."""
    old = T.StructType.fromJson(json.loads(columns))
    return T.StructType([*old.fields, *[f for f in new.fields if f.name not in old.names]]).json()


def _read(spark: SparkSession, path: str, commit: Commit, buckets: list[str] | None = None) -> DataFrame | None:
    """The rows of a version in some or all buckets; None if those hold none."""
    chosen = sorted(commit.folders) if buckets is None else buckets
    if not chosen:
        return None
    schema = T.StructType.fromJson(json.loads(commit.columns))
    return spark.read.schema(schema).parquet(*[f"{path}/{commit.folders[b]}/_bucket={b}" for b in chosen])


def read_commit(spark: SparkSession, path: str, commit: Commit, buckets: list[str] | None = None) -> DataFrame:
    """The rows of ``commit``, or those in some of its buckets, with no rows if there are none."""
    rows = _read(spark, path, commit, buckets)
    return spark.createDataFrame([], T.StructType.fromJson(json.loads(commit.columns))) if rows is None else rows


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version, or None. A version from before return dates reads as empty."""
    now = current_commit(spark, path)
    return None if now is None else migrate_state(read_commit(spark, path, now))


def versions_by_bucket(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, version): the write that each bucket of the current version comes from."""
    now = current_commit(spark, path)
    rows = [(int(b), int(f.removeprefix("data/").split("-")[0])) for b, f in now.folders.items()] if now else []
    return spark.createDataFrame(rows, "bucket int, version bigint")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` versions and the folders that none of those names; returns the folders removed.

    Folders of the next version, which a writer may be filling, are left alone.
    """
    known = [n for n in storage.names(spark, f"{path}/commits") if n.endswith(".json") and not n.startswith("_")]
    if not known:
        return []
    kept = [_commit(spark, path, n) for n in known[-max(1, keep):]]
    for name in known[:-max(1, keep)]:
        storage.remove(spark, f"{path}/commits/{name}")
    used = {(f, b) for c in kept for b, f in c.folders.items()}
    gone = []
    for folder in (f"data/{n}" for n in storage.names(spark, f"{path}/data")):
        if int(folder.removeprefix("data/").split("-")[0]) > kept[-1].version:
            continue
        parts = [n.removeprefix("_bucket=") for n in storage.names(spark, f"{path}/{folder}") if n.startswith("_bucket=")]
        unused = [b for b in parts if (folder, b) not in used]
        whole = len(unused) == len(parts)
        gone += [folder] if whole else [f"{folder}/_bucket={b}" for b in unused]
    for folder in gone:
        storage.remove(spark, f"{path}/{folder}")
    return gone


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.STATE)
