"""Exact top-k search over a bit-sliced index.

A block of rows keeps, for every component, one bitmap per bit of its quantised value. For a query, the slices of all
components are added with bitmap arithmetic: bits of equal weight are reduced three to two by carry-save adders, which
gives the bitmaps of the score, one per bit. The best rows are then taken from the most significant slice downward:
rows that have the bit go first while they are no more than wanted. What is still tied at the last slice has
equal scores; those rows are all kept from the block and the boundary is settled exactly by the smaller id.

Components are floor(64 * x) of the value as double. Vectors that are null, empty or that hold null or non-finite components take no part; rows without an id neither. A vector
is searched among those of its own width. Repeated ids are searched like other rows, a query that repeats an id is ranked by itself, and a query
skips rows of its own id.
Nothing in, nothing out.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.common import stage

SCALE = 64
BLOCK_ROWS = 16384
QUERY_ROWS = 256


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<bigint>) of the rows that take part."""
    x = F.col("embedding")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, fine) & (F.size(x) > 0)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("v"),
    )


def pack_bits(flags: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    n = -flags.shape[-1] % 64
    padded = np.pad(flags, [(0, 0)] * (flags.ndim - 1) + [(0, n)])
    return np.ascontiguousarray(np.packbits(padded, axis=-1, bitorder="little")).view(np.uint64)


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


class Slices:
    """The index of one block: values are shifted to be non-negative and cut into bits."""

    def __init__(self, ids: np.ndarray, low: int, planes: np.ndarray):
        self.ids, self.n, self.low, self.bits = ids, len(ids), low, planes.shape[1]
        self.top = (1 << self.bits) - 1
        #: planes[d, b]: rows whose component d has bit b.
        self.planes = planes
        self.all = pack_bits(np.ones((1, self.n), bool))[0]
        self.flipped = ~self.planes & self.all

    @classmethod
    def build(cls, ids: np.ndarray, values: np.ndarray) -> "Slices":
        low = int(values.min())
        shifted = np.ascontiguousarray(values.T) - low
        bits = max(1, int(shifted.max()).bit_length())
        return cls(ids, low, np.stack([pack_bits((shifted >> b) & 1 == 1) for b in range(bits)], axis=1))

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the score, least significant first, and what must be added to it."""
        weights: dict[int, list[np.ndarray]] = {}
        base = int(self.low * query.sum())
        for planes, signs in ((self.planes, query > 0), (self.flipped, query < 0)):
            size = np.abs(query)
            for shift in range(int(size.max()).bit_length()):
                chosen = np.flatnonzero(signs & ((size >> shift) & 1 == 1))
                for b in range(self.bits):
                    if len(chosen):
                        weights.setdefault(shift + b, []).append(planes[chosen, b])
        # -q * s is q * (top - s) less q * top.
        base -= int(np.abs(query[query < 0]).sum()) * self.top
        out, weight = [], 0
        while weight <= max(weights, default=-1):
            stack = np.concatenate(weights.pop(weight)) if weight in weights else np.zeros((1, len(self.all)), np.uint64)
            while len(stack) > 1:
                third = max(1, len(stack) // 3)
                if len(stack) == 2:
                    carry, stack = stack[:1] & stack[1:], stack[:1] ^ stack[1:]
                else:
                    a, b, c, rest = stack[:third], stack[third:2 * third], stack[2 * third:3 * third], stack[3 * third:]
                    half = a ^ b
                    carry = (a & b) | (half & c)
                    stack = np.concatenate((half ^ c, rest))
                weights.setdefault(weight + 1, []).append(carry)
            out.append(stack[0])
            weight += 1
        return out, base

    def best(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows but those of id ``own``; of a tie at the boundary the smaller ids."""
        slices, base = self.score_slices(query)
        open_rows = self.all & ~pack_bits((self.ids == own)[None])[0]
        sure = np.zeros_like(open_rows)
        wanted = k
        if int(np.bitwise_count(open_rows).sum()) > k:
            for plane in reversed(slices):
                ones = open_rows & plane
                count = int(np.bitwise_count(ones).sum())
                if count >= wanted:
                    open_rows = ones
                else:
                    sure |= ones
                    wanted -= count
                    open_rows &= ~plane
                if count == wanted and count:
                    break
        at = rows_of(sure | open_rows)
        words, bits = at >> 6, (at & 63).astype(np.uint64)
        scores = np.full(len(at), base, np.int64)
        for weight, plane in enumerate(slices):
            scores += ((plane[words] >> bits) & np.uint64(1)).astype(np.int64) << weight
        order = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at][order], scores[order]


HITS = "query bigint, query_id bigint, vec_id bigint, score bigint"
INDEX = "block int, n bigint, low bigint, bits int, ids binary, planes binary"
ASKED = "part int, numbers binary, asked_ids binary, vals binary"


def index_rows(rows: DataFrame, width: int, blocks: int) -> DataFrame:
    """One row per block: its ids and its bitmaps. Blocks are dealt by hash, so they stay near BLOCK_ROWS."""

    def build(table: pa.Table) -> pa.Table:
        block = Slices.build(table.column("vec_id").to_numpy(), matrix(table, width))
        return pa.table({
            "block": pa.array(table.column("block").to_pylist()[:1], pa.int32()), "n": pa.array([block.n], pa.int64()),
            "low": pa.array([block.low], pa.int64()), "bits": pa.array([block.bits], pa.int32()),
            "ids": pa.array([block.ids.tobytes()], pa.binary()), "planes": pa.array([block.planes.tobytes()], pa.binary()),
        })

    return rows.withColumn("block", deal(blocks, 1)).groupBy("block").applyInArrow(build, INDEX)


def query_rows(asked: DataFrame, width: int, parts: int) -> DataFrame:
    """One row per part of the queries, each of about QUERY_ROWS; rows that repeat an id are queries of their own."""

    def build(table: pa.Table) -> pa.Table:
        part = table.column("part").to_pylist()[0]
        return pa.table({
            "part": pa.array([part], pa.int32()),
            "numbers": pa.array([(np.arange(table.num_rows) + (part << 32)).tobytes()], pa.binary()),
            "asked_ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
            "vals": pa.array([matrix(table, width).tobytes()], pa.binary()),
        })

    return asked.withColumn("part", deal(parts, 2)).groupBy("part").applyInArrow(build, ASKED)


def matrix(table: pa.Table, width: int) -> np.ndarray:
    return table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, width)


def deal(n: int, seed: int):
    return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")


def search_for(k: int, batches):
    """Each input row is a block of the index beside a part of the queries; gives the best rows of that block."""
    for batch in batches:
        for n, low, bits, ids, planes, numbers, asked_ids, vals in zip(*(c.to_pylist() for c in batch.columns)):
            numbers, asked_ids = np.frombuffer(numbers, np.int64), np.frombuffer(asked_ids, np.int64)
            values = np.frombuffer(vals, np.int64).reshape(len(asked_ids), -1)
            block = Slices(np.frombuffer(ids, np.int64), low, np.frombuffer(planes, np.uint64).reshape(values.shape[1], bits, -1))
            found = [block.best(v, k, q) for q, v in zip(asked_ids.tolist(), values)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(np.repeat(c, [len(f[0]) for f in found])) for c in (numbers, asked_ids)],
                    pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found])),
                ],
                names=["query", "query_id", "vec_id", "score"],
            )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, width: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` with the largest inner product per query row.

    Every block of the index meets every part of the queries, as one row with its own turn, and gives ``k`` rows per
    query; those few are ranked together. Vectors are searched among those of their own width, or of ``width`` alone if it is given.
    """
    rows, asked = stage(quantised(vectors), "slices-rows"), stage(quantised(queries), "slices-queries")
    # Only widths that are asked for.
    widths = [width] if width is not None else sorted(r[0] for r in asked.select(F.size("v")).distinct().collect())
    found = [best_of_width(*(t.filter(F.size("v") == w) for t in (rows, asked)), k, w) for w in widths or [0]]
    return reduce(DataFrame.unionByName, found)


def best_of_width(rows: DataFrame, asked: DataFrame, k: int, width: int) -> DataFrame:
    blocks, parts = max(1, -(-rows.count() // BLOCK_ROWS)), max(1, -(-asked.count() // QUERY_ROWS))
    index = stage(index_rows(rows, width, blocks), "slices-index")
    sent = stage(query_rows(asked, width, parts), "slices-sent")
    turns = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = turns.join(sent, "part").repartition(F.xxhash64("block", "part"))
    hits = met.select("n", "low", "bits", "ids", "planes", "numbers", "asked_ids", "vals").mapInArrow(partial(search_for, k), HITS)
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
