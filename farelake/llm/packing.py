"""Packing: concatenate the encoded documents and cut fixed windows.

First pass: documents are encoded where they lie, and every partition numbers its documents' tokens from
zero. The partitions' totals are summed up to global offsets. Second pass: each document, now at a
known global position, is cut at the multiples of the window length; a piece that starts or ends inside
a document is its boundary record. Every window is full but the last one.

Null or empty texts are encoded as the end token alone. Repeated rows and null ids are packed like any other row.
Without rows there are no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import block_offsets, checked, stage
from farelake.llm.encoding import ENCODE_CHARS, Encoder, slices

WINDOW = 2048
END_TOKEN = 1
ENCODED = "doc_id bigint, block int, before bigint, doc_tokens bigint, ids binary"
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint"
)


def encode_documents(docs: DataFrame, tokenizer: str, end_token: int = END_TOKEN) -> DataFrame:
    """Each document's ids (little-endian unsigned 32-bit) with its place inside its partition, as a written table."""

    def run(batches):
        encoder, block, before = Encoder.at(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, chars=ENCODE_CHARS):
                flat, counts = encoder.encode(part.column(1))
                ends = np.cumsum(counts)
                ids = [
                    np.append(flat[e - n:e], np.uint32(end_token)).astype("<u4").tobytes() for e, n in zip(ends, counts)
                ]
                sizes = counts + 1
                heads = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.full(len(ids), block, np.int32)), pa.array(heads),
                        pa.array(sizes), pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "block", "before", "doc_tokens", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(run, ENCODED), "packing-ids")


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_token: int = END_TOKEN, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents in windows of ``window`` tokens; ``with_ids`` adds each piece's ids."""
    encoded = encode_documents(docs, tokenizer, end_token)
    totals = encoded.groupBy("block").agg(F.sum("doc_tokens").alias("tokens"))
    offsets = stage(block_offsets(totals, "block", "tokens", "base"), "packing-offsets")
    placed = encoded.join(checked(offsets, 16), "block").select(
        "doc_id", (F.col("base") + F.col("before")).alias("at"), "ids"
    )

    def cut(batches):
        for batch in batches:
            out = [[] for _ in range(7 + with_ids)]
            for doc, at, ids in zip(*(c.to_pylist() for c in batch.columns)):
                total, start = len(ids) // 4, 0
                while start < total:
                    offset = (at + start) % window
                    length = min(window - offset, total - start)
                    piece = ids[4 * start:4 * (start + length)]
                    row = (doc, start, length, zlib.crc32(piece), total, (at + start) // window, offset)
                    for column, value in zip(out, (*row, piece) if with_ids else row):
                        column.append(value)
                    start += length
            types = [pa.int64()] * 7 + [pa.binary()] * with_ids
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names[:7 + with_ids])

    return placed.mapInArrow(cut, PIECES + ", ids binary" * with_ids)
