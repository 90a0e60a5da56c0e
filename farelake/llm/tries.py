"""Conversation prefix trie: a node per distinct beginning of conversations, in minimal-perfect-hash node tables.

Every turn of a conversation hashes with its depth to 128 bits, and the exclusive or over its first ``d`` turns names the prefix of depth
``d``. Positions and prefixes come from running sums in ranges of the sorted turns, so a conversation of any length is spread out.
A shard takes whole stretches of ``STRETCH`` depths of conversations. It enumerates its distinct prefixes, gives each a slot by a minimal
perfect hash whose hits are verified against the stored digest, scatters its counts into flat arrays, and leads them through an
array of parent slots, deepest first. Shards hold the whole path of what they hold, so their nodes are partial sums that one grouping
by digest adds up: a first turn that everybody shares is one row per shard there. What is below a stretch is carried
to its last node beforehand.

The first pass counts members and finds each node's smallest one, its owner. The second gives each node's own values to its owner's
path and adds them up over subtrees.

A null role or text is empty; rows without conv_id take no part. Turns in one place go by the md5 of role and text, repeated rows are
repeated turns, and remainders of negative ids are those of SQL (they truncate). Texts are hashed whole, whatever their length; extra
columns are not read. Without conversations there are no nodes. Two prefixes of one digest raise an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.common import stage
from farelake.llm.shingles import mix
from farelake.plans.crc import CRC_TABLE_SQL, crc32_sql

#: Conversations share the beginning of the first of each group of this many.
GROUP = 20
MOST_SHARED = 3
#: Depths of a conversation that stay together.
STRETCH = 4096
SHARD_ROWS = 1 << 17
#: Members whose ids are joined to one text, as a power of two of the id range.
ID_BITS = 12
#: A parent of more than a HEAVY-th of the nodes is looked up apart.
HEAVY = 4096
GAMMA = 1.5
WORD = r"[^\x20\x09-\x0D]+"

NODES = "x1 bigint, x2 bigint, p1 bigint, p2 bigint, depth bigint, words bigint, n_convs bigint, conv_id bigint"
SUMS = "x1 bigint, x2 bigint, n_leaves bigint, saved_tokens bigint"


class PerfectHash:
    """Slots 0 to n - 1 for n distinct 128-bit digests.

    Each level takes the digests that are alone in their place of a bit array and hands the others to the next; a digest's slot is
    its place's rank among all set bits.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, base = np.arange(len(high)), 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("equal digests have no slots of their own")
            size = int(GAMMA * len(left)) + 1
            place = self._place(high[left], low[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            self.levels.append((alone, base + np.cumsum(alone) - alone))
            base += int(alone.sum())
            left = left[~alone[place]]
        self.high, self.low = np.zeros_like(high), np.zeros_like(low)
        at = self._slots(high, low)
        self.high[at], self.low[at] = high, low

    @staticmethod
    def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (mix((high + seed) ^ mix(low * (seed | np.uint64(1)))) % np.uint64(size)).astype(np.int64)

    def _slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        out, left = np.full(len(high), -1), np.arange(len(high))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._place(high[left], low[left], level, len(alone))
            hit = alone[place]
            out[left[hit]] = rank[place[hit]]
            left = left[~hit]
        return out

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for digests that are not in the table."""
        out = self._slots(high, low)
        known = out >= 0
        known[known] = (self.high[out[known]] == high[known]) & (self.low[out[known]] == low[known])
        return np.where(known, out, -1)


def distinct(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Places of one of each different digest."""
    order = np.lexsort((low, high))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    return order[fresh]


def gathered(batches, names: list[str]) -> dict[str, np.ndarray]:
    """The columns of one shard, with nulls as 0."""
    parts = list(batches)
    if not parts:
        return {name: np.zeros(0, np.int64) for name in names}
    whole = pa.Table.from_batches(parts)
    return {name: whole.column(name).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False) for name in names}


def digest_of(part: dict[str, np.ndarray], first: str = "x1", second: str = "x2") -> tuple[np.ndarray, np.ndarray]:
    return part[first].view(np.uint64), part[second].view(np.uint64)


def count_members(batches):
    """Per distinct prefix of a shard: its members, the smallest one, and what all of them must agree on."""
    part = gathered(batches, ["x1", "x2", "p1", "p2", "depth", "words", "conv_id"])
    high, low = digest_of(part)
    one = distinct(high, low)
    table = PerfectHash(high[one], low[one])
    slot = table.slots(high, low)
    n_convs, conv_id = np.zeros(len(one), np.int64), np.full(len(one), np.iinfo(np.int64).max)
    np.add.at(n_convs, slot, 1)
    np.minimum.at(conv_id, slot, part["conv_id"])
    facts = {}
    for name in ("p1", "p2", "depth", "words"):
        facts[name] = np.zeros(len(one), np.int64)
        facts[name][slot] = part[name]
        if (facts[name][slot] != part[name]).any():
            raise ValueError("two prefixes have one digest")
    yield pa.RecordBatch.from_pydict({
        "x1": table.high.view(np.int64), "x2": table.low.view(np.int64), **facts, "n_convs": n_convs, "conv_id": conv_id,
    })


def add_up(batches, depths: int = STRETCH):
    """Per distinct prefix of a shard: the values given to it and to what is below it in its stretch of ``depths``."""
    part = gathered(batches, ["x1", "x2", "p1", "p2", "depth", "leaves", "saved", "path"])
    path = part["path"].astype(bool)
    high, low = digest_of(part)
    ahead, alow = digest_of(part, "p1", "p2")
    one = np.flatnonzero(path)[distinct(high[path], low[path])]
    table = PerfectHash(high[one], low[one])
    own = table.slots(high[one], low[one])
    depth, parent = np.zeros(len(one), np.int64), np.full(len(one), -1)
    depth[own] = part["depth"][one]
    inner = one[part["depth"][one] % depths > 0]
    parent[table.slots(high[inner], low[inner])] = table.slots(ahead[inner], alow[inner])
    slot = table.slots(high, low)
    if (slot < 0).any():
        raise ValueError("a value has no node in its stretch")
    sums = np.zeros((len(one), 2), np.int64)
    np.add.at(sums, slot, np.stack((part["leaves"], part["saved"]), 1))
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        below = level[parent[level] >= 0]
        np.add.at(sums, parent[below], sums[below])
    some = np.flatnonzero(sums.any(1))
    yield pa.RecordBatch.from_pydict({
        "x1": table.high[some].view(np.int64), "x2": table.low[some].view(np.int64),
        "n_leaves": sums[some, 0], "saved_tokens": sums[some, 1],
    })


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, turn, key, words, m): the turns in ranges of their order; ``m`` is how often a row repeats."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    merged = turns.groupBy("conv_id", "turn", "key").agg(F.max("words").alias("words"), F.count(F.lit(1)).alias("m"))
    ranges = merged.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "key")
    return stage(ranges.withColumn("part", F.spark_partition_id().cast("bigint")), "trie-turns")


def before(totals: DataFrame, value: Column) -> Column:
    """``value``, an aggregate over rows, over the smaller parts of each conversation."""
    return value.over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))


def shared(conv_id: Column | str) -> Column:
    """How many turns a conversation takes from the first of its group."""
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % (MOST_SHARED + 1)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, part, depth, key, words, size), and (conv_id, size) of all conversations, also empty ones."""
    totals = stage(turns.groupBy("conv_id", "part").agg(F.sum("m").alias("n")), "trie-totals")
    sizes = totals.groupBy("conv_id").agg(F.sum("n").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    told = sizes.withColumns({"base": base, "h": shared("conv_id")}).join(
        sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left"
    )
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    facts = stage(told.select(
        "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")
    ), "trie-facts")
    parts = totals.withColumn("ahead", F.coalesce(before(totals, F.sum("n")), F.lit(0))).select("conv_id", "part", "ahead").join(facts, "conv_id")
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "key").rowsBetween(Window.unboundedPreceding, 0)
    placed = turns.withColumn("upto", F.sum("m").over(inside)).join(parts, ["conv_id", "part"]).withColumn("last", F.col("ahead") + F.col("upto"))
    first = F.col("last") - F.col("m") + 1
    own = placed.withColumn("from", F.greatest(first, F.col("h") + 1)).filter("`from` <= last").select(
        "conv_id", "part", F.explode(F.sequence("from", "last")).alias("at"), "taken", "h", "key", "words", "size"
    ).select("conv_id", "part", (F.col("taken") + F.col("at") - F.col("h")).alias("depth"), "key", "words", "size")
    # At most MOST_SHARED turns of each first conversation of a group, for at most GROUP others.
    opening = placed.filter((first <= MOST_SHARED) & (F.col("conv_id") == F.col("base"))).select(
        F.col("conv_id").alias("base"), F.explode(F.sequence(first, F.least("last", F.lit(MOST_SHARED)))).alias("depth"), "key", "words"
    )
    heads = facts.filter("taken > 0").join(opening, "base").filter("depth <= taken").select(
        "conv_id", F.lit(-1).cast("bigint").alias("part"), "depth", "key", "words", "size"
    )
    return stage(own.union(heads), "trie-rebuilt"), facts.select("conv_id", "size")


def prefixes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(conv_id, depth, x1, x2, p1, p2, words, ends) for every beginning of every conversation, the empty one included."""
    hashed = turns.withColumns({"u1": F.xxhash64("key", "depth"), "u2": F.xxhash64(F.lit("second"), "depth", "key")})
    totals = hashed.groupBy("conv_id", "part").agg(F.bit_xor("u1").alias("t1"), F.bit_xor("u2").alias("t2"))
    ahead = totals.select("conv_id", "part", *[
        F.coalesce(before(totals, F.bit_xor(t)), F.lit(0)).alias(a) for t, a in (("t1", "a1"), ("t2", "a2"))
    ])
    inside = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = hashed.withColumns({"l1": F.bit_xor("u1").over(inside), "l2": F.bit_xor("u2").over(inside)}).join(ahead, ["conv_id", "part"])
    x1, x2 = F.col("l1").bitwiseXOR(F.col("a1")), F.col("l2").bitwiseXOR(F.col("a2"))
    rows = local.select(
        "conv_id", "depth", x1.alias("x1"), x2.alias("x2"), x1.bitwiseXOR(F.col("u1")).alias("p1"), x2.bitwiseXOR(F.col("u2")).alias("p2"),
        "words", (F.col("depth") == F.col("size")).alias("ends"),
    )
    none = F.lit(0).cast("bigint")
    roots = sizes.select("conv_id", *[none.alias(c) for c in ("depth", "x1", "x2", "p1", "p2", "words")], (F.col("size") == 0).alias("ends"))
    return stage(rows.union(roots), "trie-prefixes")


def stretch(depths: int) -> Column:
    return F.floor(F.col("depth") / depths)


def sharded(rows: DataFrame, total: int, depths: int) -> DataFrame:
    """``rows`` in as many shards as keep them near SHARD_ROWS each; stretches stay whole."""
    return rows.repartition(max(1, -(-total // SHARD_ROWS)), "conv_id", stretch(depths))


def hashes_of_ends(paths: DataFrame) -> DataFrame:
    """(x1, x2, ends_sha256) of the conversations that end in each node.

    Ids are joined in blocks of 2**ID_BITS possible ids; the hash of a node reads one block at a time.
    """
    blocks = paths.filter("ends").groupBy("x1", "x2", F.shiftright("conv_id", ID_BITS).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches):
        now, state = None, None
        for batch in batches:
            out = []
            for x1, x2, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (x1, x2) == now:
                    state.update(b",")
                else:
                    if now:
                        out.append((*now, state.hexdigest()))
                    now, state = (x1, x2), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("x1", "x2", "ends_sha256"), zip(*out))), pa_ends)
        if now:
            yield pa.RecordBatch.from_pydict({"x1": [now[0]], "x2": [now[1]], "ends_sha256": [state.hexdigest()]}, pa_ends)

    pa_ends = pa.schema([("x1", pa.int64()), ("x2", pa.int64()), ("ends_sha256", pa.string())])
    lined = blocks.repartition("x1", "x2").sortWithinPartitions("x1", "x2", "block").select("x1", "x2", "ids")
    return lined.mapInArrow(run, "x1 bigint, x2 bigint, ends_sha256 string")


def nodes_of(paths: DataFrame, total: int, depths: int) -> DataFrame:
    """One row per node, with its number of children."""
    partial = sharded(paths, total, depths).mapInArrow(count_members, NODES)
    agreed = [F.min(c).alias(c) for c in ("p1", "p2", "depth", "words")]
    unlike = F.max(F.struct("p1", "p2", "depth", "words")) != F.min(F.struct("p1", "p2", "depth", "words"))
    merged = partial.groupBy("x1", "x2").agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), *agreed, unlike.alias("unlike"))
    sound = merged.withColumn("n_convs", F.when(F.col("unlike"), F.raise_error(F.lit("two prefixes have one digest"))).otherwise(F.col("n_convs")))
    nodes = stage(sound.drop("unlike"), "trie-nodes")
    kids = nodes.filter("depth > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children"))
    return stage(nodes.join(kids, ["x1", "x2"], "left").fillna(0, ["n_children"]), "trie-children")


def subtree_sums(paths: DataFrame, nodes: DataFrame, total: int, depths: int) -> DataFrame:
    """(x1, x2, n_leaves, saved_tokens) of every node with something below it or in it."""
    given = nodes.select(
        "conv_id", "depth", "x1", "x2", (F.col("n_children") == 0).cast("bigint").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    ).filter("leaves > 0 OR saved > 0")
    # Only conversations of more than one stretch have anything to carry.
    long = paths.filter(F.col("depth") == depths).select("conv_id")
    totals = given.join(long, "conv_id", "left_semi").groupBy("conv_id", stretch(depths).alias("part")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    last = paths.filter(F.col("depth") % depths == depths - 1).withColumn("part", stretch(depths)).select("conv_id", "part", "depth", "x1", "x2")
    later = Window.partitionBy("conv_id").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    known = last.join(totals, ["conv_id", "part"], "full").withColumns({
        "leaves": F.coalesce(F.sum("leaves").over(later), F.lit(0)), "saved": F.coalesce(F.sum("saved").over(later), F.lit(0)),
    })
    carried = known.filter("x1 IS NOT NULL AND (leaves > 0 OR saved > 0)").select("conv_id", "depth", "x1", "x2", "leaves", "saved")
    zero = F.lit(0).cast("bigint")
    path = paths.select("conv_id", "depth", "x1", "x2", "p1", "p2", zero.alias("leaves"), zero.alias("saved"), F.lit(1).alias("path"))
    values = given.union(carried).select("conv_id", "depth", "x1", "x2", zero.alias("p1"), zero.alias("p2"), "leaves", "saved", F.lit(0).alias("path"))
    partial = sharded(path.union(values), 2 * total, depths).mapInArrow(lambda batches: add_up(batches, depths), SUMS)
    return partial.groupBy("x1", "x2").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def with_parents(nodes: DataFrame) -> DataFrame:
    """Adds parent_conv_id; the few parents that many nodes share are sent to all, the others are joined."""
    total = nodes.count()
    parent = nodes.filter("n_children > 0").select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    heavy = F.col("n_children") * HEAVY > max(total, HEAVY)
    # Fewer than HEAVY rows, since each has more than a HEAVY-th of all children.
    few = F.broadcast(parent.filter(heavy).drop("n_children").withColumnRenamed("parent_conv_id", "heavy_conv_id"))
    met = nodes.filter("depth > 0").join(few, ["p1", "p2"], "left")
    rest = met.filter("heavy_conv_id IS NULL").join(parent.filter(~heavy).drop("n_children"), ["p1", "p2"])
    columns = ["x1", "x2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children"]
    found = met.filter("heavy_conv_id IS NOT NULL").withColumnRenamed("heavy_conv_id", "parent_conv_id").select(*columns)
    root = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*columns)
    return rest.select(*columns).union(found).union(root)


def prefix_trie(conversations: DataFrame, depths: int = STRETCH) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths = prefixes(*rebuilt(ordered_turns(conversations)))
    total = paths.count()
    nodes = nodes_of(paths, total, depths)
    sums = subtree_sums(paths, nodes, total, depths)
    joined = with_parents(nodes).join(sums, ["x1", "x2"], "left").join(hashes_of_ends(paths), ["x1", "x2"], "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def trie_sql() -> str:
    """The rows of ``prefix_trie`` in DuckDB: prefixes are the joined keys of their turns."""
    return f"""
    WITH {CRC_TABLE_SQL},
    turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
            md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    placed AS (
        SELECT conv_id, key, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS p
        FROM turns
    ),
    convs AS (
        SELECT conv_id, conv_id - conv_id % {GROUP} AS base, {crc32_sql("conv_id::VARCHAR")} % {MOST_SHARED + 1} AS h
        FROM (SELECT DISTINCT conv_id FROM turns), crc_table
    ),
    mixed AS (
        SELECT c.conv_id, 0 AS own, p, key, words FROM convs c JOIN placed b ON b.conv_id = c.base AND b.p <= c.h
        UNION ALL SELECT c.conv_id, 1, p, key, words FROM convs c JOIN placed o ON o.conv_id = c.conv_id AND o.p > c.h
    ),
    paths AS (
        SELECT conv_id, row_number() OVER w AS depth, string_agg(key, '') OVER w AS prefix, words FROM mixed
        WINDOW w AS (PARTITION BY conv_id ORDER BY own, p)
        UNION ALL SELECT conv_id, 0, '', 0 FROM convs
    ),
    ended AS (SELECT prefix, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (
        SELECT conv_id, arg_max(prefix, depth) AS prefix FROM paths GROUP BY conv_id) GROUP BY prefix),
    nodes AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words FROM paths GROUP BY prefix, depth),
    kids AS (SELECT left(prefix, 32 * (depth - 1)) AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
    told AS (
        SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (prefix)
    ),
    sums AS (
        SELECT above.prefix, count(*) FILTER (below.n_children = 0) AS n_leaves, sum((below.n_convs - 1) * below.words)::BIGINT AS saved_tokens
        FROM told below JOIN paths above ON above.conv_id = below.conv_id AND above.depth <= below.depth GROUP BY above.prefix
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
        sha256(coalesce(ids, '')) AS ends_sha256
    FROM told n JOIN sums USING (prefix) LEFT JOIN ended USING (prefix)
    LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = left(n.prefix, 32 * (n.depth - 1))"""
