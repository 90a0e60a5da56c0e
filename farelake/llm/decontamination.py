"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by size into classes of a power of two. For each class that occurs, a document is covered by windows
of twice the class's width, half of each shared with the next, so an item is set against a window of like size however
long the document is. Each window has a MinHash signature; an item and a document that agree in any function are a
candidate, which exact containment of shingle sets over the whole document then settles. An item of which 80 % is in one window
is missed with a chance below 1e-5 (64 functions), whatever its size. Long documents are looked at in pieces.

A fixed-size bitmap of the items' values spares the documents' other values the join; its false hits cost only work.

An item without words matches nothing; one with fewer than five words matches documents that consist of those words.
Null ids are an id of their own. Repeated rows, of documents or of items, give repeated or no extra results: one row per distinct
pair of ids. No items or no documents, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import checked, stage
from farelake.llm.encoding import slices
from farelake.llm.shingles import mix, shingle_hashes, shingle_sets

FUNCTIONS = 64
CONTAINED = 80
LEAST_WIDTH = 1
#: Shingles of a document whose signatures are in memory at once, per unit of the least width.
PIECE = 1 << 13
#: Bits of the bitmap per value of an item, and bits at most (8 MB).
BITS_PER_VALUE, MOST_BITS = 1024, 1 << 26

_rng = np.random.default_rng(64)
_FLIP = _rng.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64)
_FACTOR = _rng.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_rows(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(F.col(key).cast("bigint").alias(key), F.col("text").cast("string").alias("text"))


def item_sets(items: DataFrame) -> DataFrame:
    """(item_id, n, width, hashes) per distinct item."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(1))
                n = np.array([len(s) for s in sets], np.int64)
                width = np.maximum(LEAST_WIDTH, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
                hashes = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(width), hashes], names=["item_id", "n", "width", "hashes"])

    rows = text_rows(items, "item_id").mapInArrow(run, "item_id bigint, n bigint, width bigint, hashes array<bigint>")
    return stage(rows.filter("n > 0").dropDuplicates(["item_id", "hashes"]), "decon-items")


def keys(values: np.ndarray, function: int, width: int) -> np.ndarray:
    """One 64-bit key for a value of a function in a class."""
    salt = np.uint64((function * 0x9E3779B97F4A7C15 + width * 0xC2B2AE3D27D4EB4F) & (2**64 - 1))
    return mix(values ^ salt)


def item_keys(sets: DataFrame) -> DataFrame:
    """(item_id, key): every item's signature."""

    def run(batches):
        for batch in batches:
            ids, found = [], []
            for item, _, width, hashes in zip(*(c.to_pylist() for c in batch.columns)):
                values = np.array(hashes, np.int64).view(np.uint64)
                ids += [item] * FUNCTIONS
                found += [
                    keys(((values ^ flip) * factor).min(keepdims=True), f, width) for f, (flip, factor) in enumerate(zip(_FLIP, _FACTOR))
                ]
            flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(flat)], names=["item_id", "key"])

    return sets.select("item_id", "n", "width", "hashes").mapInArrow(run, "item_id bigint, key bigint")


def bitmap_of(signatures: DataFrame) -> tuple[np.ndarray, int]:
    """Bits set for the keys of all items, at most MOST_BITS of them, and the shift that takes a key to its bit."""
    n = signatures.count()
    bits = min(MOST_BITS, max(1 << 16, 1 << (max(1, n * BITS_PER_VALUE) - 1).bit_length()))
    shift = 64 - bits.bit_length() + 1
    spots = signatures.select(F.shiftrightunsigned("key", shift).alias("spot")).distinct().toArrow().column("spot").to_numpy()
    bitmap = np.zeros(bits // 8, np.uint8)
    np.bitwise_or.at(bitmap, spots >> 3, np.left_shift(1, spots & 7).astype(np.uint8))
    return bitmap, shift


def document_keys(docs: DataFrame, widths: list[int], bitmap: np.ndarray, shift: int) -> DataFrame:
    """(doc_id, key): keys of the documents' windows that the bitmap knows."""
    least, widest = widths[0], widths[-1]
    # A power of two, so that windows of every class begin where they would in the whole document.
    piece = max(PIECE * least, widest)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                flat, sizes = shingle_hashes(part.column(1))
                doc, heads = np.arange(len(sizes)), np.cumsum(sizes) - sizes
                counts = -(-sizes // piece)
                at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                start = np.repeat(heads, counts) + at * piece
                # Each piece has the windows that begin in it.
                stop = np.minimum(start + piece + 2 * widest, np.repeat(heads + sizes, counts))
                owner, low = np.repeat(doc, counts), 0
                while low < len(start):
                    high = max(low + 1, int(np.searchsorted(np.cumsum(stop[low:] - start[low:]), 2 * piece)) + low)
                    some = np.concatenate([flat[a:b] for a, b in zip(start[low:high], stop[low:high])])
                    yield from hits(part.column(0).take(pa.array(owner[low:high])), some, (stop - start)[low:high])
                    low = high

    def hits(doc_ids, flat, sizes):
        blocks = -(-sizes // least)
        block_ends = np.cumsum(blocks)
        inside = np.arange(block_ends[-1]) - np.repeat(block_ends - blocks, blocks)
        heads = np.repeat(np.cumsum(sizes) - sizes, blocks) + inside * least
        base = np.empty((FUNCTIONS, len(heads)), np.uint64)
        for f in range(FUNCTIONS):
            np.minimum.reduceat((flat ^ _FLIP[f]) * _FACTOR[f], heads, out=base[f])
        for width in widths:
            step = width // least
            counts = -(-blocks // step)
            ends = np.cumsum(counts)
            at = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
            lows = np.minimum.reduceat(base, np.repeat(block_ends - blocks, counts) + at * step, axis=1) if step > 1 else base
            last = at == np.repeat(counts, counts) - 1
            window = lows.copy()
            window[:, :-1] = np.where(last[:-1], lows[:, :-1], np.minimum(lows[:, :-1], lows[:, 1:]))
            owner = np.repeat(np.arange(len(counts)), counts)
            for f in range(FUNCTIONS):
                key = keys(window[f], f, width)
                spot = (key >> np.uint64(shift)).astype(np.int64)
                hit = np.flatnonzero((bitmap[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1)
                if len(hit):
                    yield pa.RecordBatch.from_arrays([doc_ids.take(pa.array(owner[hit])), pa.array(key[hit].view(np.int64))], names=["doc_id", "key"])

    return text_rows(docs, "doc_id").mapInArrow(run, "doc_id bigint, key bigint")


def contaminated(docs: DataFrame, items: DataFrame, percent: int = CONTAINED) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment): pairs where a document holds ``percent`` of an item's shingles."""
    sets = item_sets(items)
    signatures = stage(item_keys(sets), "decon-signatures")
    widths = sorted(r[0] for r in sets.select("width").distinct().collect())
    bitmap, shift = bitmap_of(signatures)
    found = document_keys(docs, widths or [LEAST_WIDTH], bitmap, shift)
    pairs = found.join(checked(signatures.distinct(), 16), "key").select("doc_id", "item_id").distinct()
    items_of = sets.withColumnRenamed("item_id", "_item")
    asked = pairs.join(items_of, F.col("item_id").eqNullSafe(F.col("_item"))).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.collect_list(F.struct("item_id", "n", "hashes")).alias("items")
    )
    asked = stage(asked, "decon-asked")
    weight = asked.agg(F.coalesce(F.sum(F.aggregate("items", F.lit(16), lambda a, x: a + 24 + 8 * F.size(x["hashes"]))), F.lit(0))).first()[0]
    wanted = F.broadcast(asked) if weight <= 32 << 20 else asked
    chosen = text_rows(docs, "doc_id").join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc"))).select("doc_id", "text", "items")

    def verify(batches):
        for batch in batches:
            out = [[], [], [], []]
            for part in slices(batch):
                for doc, own, listed in zip(part.column(0).to_pylist(), shingle_sets(part.column(1)), part.column(2).to_pylist()):
                    for item in listed:
                        theirs = np.array(item["hashes"], np.int64).view(np.uint64)
                        shared = int(np.isin(theirs, own, assume_unique=True).sum())
                        if 100 * shared >= percent * item["n"]:
                            for column, value in zip(out, (doc, item["item_id"], item["n"], shared)):
                                column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "item_id", "n_item", "n_shared"])

    exact = chosen.mapInArrow(verify, "doc_id bigint, item_id bigint, n_item bigint, n_shared bigint")
    best = exact.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_item", "n_shared")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_item", "b.n_shared", (F.col("b.n_shared") / F.col("b.n_item")).alias("containment"))
