"""Batches of a stream that become visible whole and once, and the split of late rows.

A batch is written aside and then renamed to ``batch=<stream>-<number>-<mark>``: whatever kinds of rows it has appear together, and a batch that
is repeated after a crash finds its name taken and changes nothing. The name of the stream stays with its checkpoint, so
streams and checkpoints never take each other's names. The mark is the newest event time that the stream has seen up to that batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farelake.functions.common import epoch_micros
from farelake.sources import storage


def run_available(query_writer, checkpoint: str) -> StreamingQuery:
    """Run what is there and stop; started again it goes on where it stopped."""
    query = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def each_batch(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append"):
    return run_available(stream.writeStream.outputMode(mode).foreachBatch(write), checkpoint)


def stream_of(batch: DataFrame) -> str:
    """The identity of the stream that a batch comes from: it stays with the checkpoint, a new checkpoint has a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _named(spark: SparkSession, root: str, stream: str) -> list[tuple[int, int]]:
    """(batch, mark) of the batches of one stream, in order."""
    own = f"batch={stream}-"
    parts = [n.removeprefix(own).split("-") for n in storage.names(spark, root) if n.startswith(own)]
    return sorted((int(batch), int(mark)) for batch, mark in parts)


def mark_before(batch: DataFrame, batch_id: int, root: str) -> int | None:
    """The newest event time, in microseconds, of the batches before this one; None before the first."""
    earlier = [mark for number, mark in _named(batch.sparkSession, root, stream_of(batch)) if number < batch_id]
    return earlier[-1] if earlier else None


def publish(rows: DataFrame, batch: DataFrame, batch_id: int, root: str, by: list[str], at: str | None = None) -> None:
    """Write ``rows``, made from ``batch``, with a folder per value of ``by``; ``at`` holds event times in microseconds for the mark.

    The mark is taken while writing. Without rows nothing is written.
    """
    spark, stream = batch.sparkSession, stream_of(batch)
    if any(number == batch_id for number, _ in _named(spark, root, stream)):
        return
    before, aside = mark_before(batch, batch_id, root), f"{root.rstrip('/')}_aside/{uuid.uuid4().hex}"
    seen = Observation()
    facts = [(F.max(at) if at else F.lit(None).cast("bigint")).alias("newest"), F.count(F.lit(1)).alias("n")]
    rows.observe(seen, *facts).write.partitionBy(*by).parquet(aside)
    told = storage.measured(seen, lambda: rows.agg(*facts).collect()[0].asDict())
    if not told["n"]:
        return storage.remove(spark, aside)
    mark = max(told["newest"] or 0, before or 0)
    try:
        storage.rename_once(spark, aside, f"{root}/batch={stream}-{batch_id}-{mark}")
    except storage.AlreadyThere:
        pass


def published(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    """The rows of one kind (``column=value``) in all batches, or None if no batch has any."""
    folders = [f"{root}/{n}/{kind}" for n in storage.names(spark, root) if kind in storage.names(spark, f"{root}/{n}")]
    return spark.read.option("basePath", root).parquet(*folders).drop("batch", kind.split("=")[0]) if folders else None


# ------------------------------------------------------------------ late rows
def split_late(stream: DataFrame, root: str, checkpoint: str, delay_s: int, at: str = "ts") -> DataFrame:
    """Part the rows that come more than ``delay_s`` seconds behind the newest before their batch; gives a stream of the others.

    Both kinds of a batch become visible together. A watermark of the same delay in what follows then drops nothing: it is
    never ahead of the one here. Late rows wait in ``late_rows``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        before = mark_before(batch, batch_id, root)
        late = F.lit(False) if before is None else F.coalesce(F.col("_at") < before - delay_s * 1_000_000, F.lit(False))
        publish(batch.withColumn("_at", epoch_micros(at)).withColumn("late", late), batch, batch_id, root, ["late"], "_at")

    each_batch(stream, checkpoint, write)
    return stream.sparkSession.readStream.schema(stream.schema).parquet(f"{root}/*/late=false")


def late_rows(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows that came too late, or None."""
    rows = published(spark, root, "late=true")
    return None if rows is None else rows.drop("_at")
