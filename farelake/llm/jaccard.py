"""N-gram Jaccard join by signature trees.

Texts are sets of 5-word shingles, and two texts link if 100 * |a & b| >= 80 * |a | b|. Sets that cannot link are kept out of each
other's trees by an exact rule: of the shingles in hash order, two linked sets share at least ``need(n)`` among the first
``prefix(n)``. Prefix shingles that only one distinct set has are dropped, then sets with too few left, then each set's
most frequent ones that the rule can spare; what still shares a shingle is led into one grove.

In a grove, sets are dealt into trees by size. A tree's nodes hold the OR of their members' bitmaps, the range of their
sizes and the most shingles that share a bit, which bounds the overlap of any two members of two nodes. Trees are traversed in pairs
from their roots; node pairs go no further if sizes or overlap rule a link out, or if all their members are linked already. What
reaches the leaves is settled by exact intersection. Trees hold a bounded number of sets, so a grove of any size is many tasks: first
every tree against itself, then one member of each class of every tree, then the pairs of trees that still hold different classes.

Results are one row per input row. Texts without words have an empty set and link with nothing. Equal rows are copies; null ids
take part and are never a component_id unless all ids of the component are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import checked, stage
from farelake.llm.components import connected
from farelake.llm.decontamination import bitmap_of
from farelake.llm.encoding import slices
from farelake.llm.shingles import mix, shingle_sets

PERCENT = 80
TREE_SETS = 512
TREE_SHINGLES = 1 << 20
FAN = 8
#: Bytes of shared shingles that may be sent to every executor; the driver holds several times as much while it sends them.
SENT_KEYS = 8 << 20
FACTS = "doc_id bigint, body binary, n bigint, d1 bigint, d2 bigint, keys array<bigint>"


def least_overlap(n, percent: int = PERCENT):
    """Shingles that a set of ``n`` must share with any set it links with."""
    return -(-n * percent // 100)


def spare(n):
    """Shingles beyond the first that linked sets share in their prefixes; never falls as ``n`` grows."""
    return 1 + n // 10


def prefix(n: int, percent: int = PERCENT) -> int:
    return n - least_overlap(n, percent) + spare(n)


def need(n, percent: int = PERCENT):
    """The least number of prefix shingles a set of ``n`` shares with any set it links with, which may be smaller."""
    return spare(least_overlap(n, percent))


def digests(one: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, whatever their order."""
    return tuple(int(mix(one ^ np.uint64(salt)).sum(dtype=np.uint64).view(np.int64)) for salt in (0x243F6A8885A308D3, 0x13198A2E03707344))


def texts_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("body"))


def prefix_keys(docs: DataFrame, percent: int) -> DataFrame:
    """(key, node): every set's prefix."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                firsts, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for one in shingle_sets(part.column(1)):
                    if len(one):
                        firsts.append(one[:prefix(len(one), percent)])
                        nodes.append(np.full(len(firsts[-1]), digests(one)[0], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts).view(np.int64)), pa.array(np.concatenate(nodes))], names=["key", "node"]
                )

    return texts_of(docs).mapInArrow(run, "key bigint, node bigint")


def facts_of(docs: DataFrame, percent: int, bitmap: np.ndarray, shift: int) -> DataFrame:
    """Per row the size and digests of its set, and the prefix shingles that the bitmap of shared ones knows."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                n, marks, keys = [], [], []
                for one in shingle_sets(part.column(1)):
                    n.append(len(one))
                    marks.append(digests(one))
                    first = one[:prefix(len(one), percent)]
                    spot = (first >> np.uint64(shift)).astype(np.int64)
                    keys.append(first[(bitmap[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array([m[0] for m in marks], pa.int64()),
                        pa.array([m[1] for m in marks], pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "body", "n", "d1", "d2", "keys"],
                )

    return stage(texts_of(docs).mapInArrow(run, FACTS), "jaccard-facts")


def groves(facts: DataFrame, live: DataFrame, percent: int) -> DataFrame:
    """(d1, grove) of the sets that may link with another one."""
    hits = facts.select(F.col("d1").alias("node"), "n", F.explode("keys").alias("key")).join(checked(live, 16, SENT_KEYS), "key").distinct()
    hits = stage(hits, "jaccard-hits")
    least = F.floor(need_column(F.col("n"), percent))
    enough = hits.groupBy("node").agg(F.count(F.lit(1)).alias("have"), F.max("n").alias("size")).filter(
        F.col("have") >= need_column(F.col("size"), percent)
    ).select("node")
    kept = hits.join(enough, "node")
    common = kept.groupBy("key").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    told = stage(kept.join(common, "key"), "jaccard-told")
    from pyspark.sql import Window

    own = Window.partitionBy("node")
    ranked = told.select(
        "key", "node", "n", F.row_number().over(own.orderBy("times", "key")).alias("rank"), F.count(F.lit(1)).over(own).alias("have")
    )
    routed = stage(ranked.filter(F.col("rank") <= F.col("have") - least + 1).select("key", "node"), "jaccard-routed")
    heads = routed.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).filter("head <> last").select("key", "head")
    links = routed.join(heads, "key").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return connected(links, "jaccard-groves").select(F.col("node").alias("d1"), F.col("root").alias("grove"))


def need_column(n, percent: int):
    return F.lit(1) + F.floor(F.ceil(n * percent / 100) / 10)


class Tree:
    """A signature tree over sets; members are ordered by size and first shingle, FAN to a node."""

    def __init__(self, sets: list[np.ndarray], members: list[int], bits: int):
        self.members = sorted(members, key=lambda i: (len(sets[i]), int(sets[i][0])))
        self.sizes = np.array([len(sets[i]) for i in self.members])
        maps = np.zeros((len(self.members), bits // 64), np.uint64)
        for row, i in enumerate(self.members):
            spot = sets[i] & np.uint64(bits - 1)
            np.bitwise_or.at(maps[row], (spot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spot & np.uint64(63)))
        self.maps = maps
        self.excess = self.sizes - np.bitwise_count(maps).sum(1)
        self.levels = []
        low, high, maps, excess = self.sizes, self.sizes, self.maps, self.excess
        while True:
            starts = np.arange(0, len(low), FAN)
            maps = np.bitwise_or.reduceat(maps, starts, axis=0)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            excess = np.maximum.reduceat(excess, starts)
            self.levels.append((low, high, maps, excess))
            if len(low) == 1:
                break


class Forest:
    """Classes of linked sets, and the dual traversal that joins them."""

    def __init__(self, sets: list[np.ndarray], percent: int, classes: list | None = None):
        self.sets, self.percent, self.links = sets, percent, []
        first: dict = {}
        self.parent = [first.setdefault(c, i) for i, c in enumerate(classes or range(len(sets)))]

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def settled(self, tree: Tree, level: int, node: int) -> int:
        """The class of all members under a node, or -1."""
        span = FAN ** (level + 1)
        found = {self.find(i) for i in tree.members[node * span:(node + 1) * span]}
        return found.pop() if len(found) == 1 else -1

    def traverse(self, left: Tree, right: Tree) -> None:
        todo = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
        while todo:
            la, a, lb, b = todo.pop()
            if left is right and la == lb and a > b:
                continue
            low_a, high_a, maps_a, excess_a = (x[a] for x in left.levels[la])
            low_b, high_b, maps_b, excess_b = (x[b] for x in right.levels[lb])
            if 100 * high_a < self.percent * low_b or 100 * high_b < self.percent * low_a:
                continue
            most = np.bitwise_count(maps_a & maps_b).sum() + min(excess_a, excess_b)
            if (100 + self.percent) * most < self.percent * (low_a + low_b):
                continue
            if (known := self.settled(left, la, a)) >= 0 and known == self.settled(right, lb, b):
                continue
            if la == lb == 0:
                self.leaves(left, a, right, b)
            elif la >= lb:
                todo += [(la - 1, c, lb, b) for c in range(a * FAN, min((a + 1) * FAN, len(left.levels[la - 1][0])))]
            else:
                todo += [(la, a, lb - 1, c) for c in range(b * FAN, min((b + 1) * FAN, len(right.levels[lb - 1][0])))]

    def leaves(self, left: Tree, a: int, right: Tree, b: int) -> None:
        rows, cols = slice(a * FAN, (a + 1) * FAN), slice(b * FAN, (b + 1) * FAN)
        most = np.bitwise_count(left.maps[rows, None] & right.maps[None, cols]).sum(2)
        most = most + np.minimum(left.excess[rows, None], right.excess[None, cols])
        total = left.sizes[rows, None] + right.sizes[None, cols]
        for x, y in np.argwhere((100 + self.percent) * most >= self.percent * total):
            i, j = left.members[a * FAN + x], right.members[b * FAN + y]
            if i != j and self.find(i) != self.find(j) and self.linked(i, j):
                self.parent[self.find(i)] = self.find(j)
                self.links.append((i, j))

    def linked(self, i: int, j: int) -> bool:
        one, two = self.sets[i], self.sets[j]
        both = len(one) + len(two) - len(np.union1d(one, two))
        return 100 * both >= self.percent * (len(one) + len(two) - both)


def tree_links(rows: pa.Table, percent: int, cross: bool) -> pa.Table:
    """Links inside the trees of a task (``cross``: between the two trees of each pair); each row has text, body, tree, class and side."""
    sets = shingle_sets(rows.column("text").combine_chunks())
    bodies, trees = rows.column("body").to_pylist(), rows.column("tree").to_pylist()
    sides = rows.column("side").to_pylist()
    forest = Forest(sets, percent, rows.column("class").to_pylist())
    own: dict = {}
    for i, (tree, side) in enumerate(zip(trees, sides)):
        if len(sets[i]):
            own.setdefault(tree, ([], []))[side].append(i)
    for left, right in own.values():
        widest = max(len(sets[i]) for i in left + right)
        bits = max(1024, 1 << (4 * widest - 1).bit_length())
        if not cross:
            tree = Tree(sets, left, bits)
            forest.traverse(tree, tree)
        elif left and right:
            forest.traverse(Tree(sets, left, bits), Tree(sets, right, bits))
    pairs = [(bodies[i], bodies[j]) for i, j in forest.links]
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})


LINKS = "a binary, b binary"


def grown(rows: DataFrame, percent: int, cross: bool = False) -> DataFrame:
    """Links found in ``rows`` (tree, side, class, body, text), several small trees to a task."""
    tasks = max(1, -(-rows.count() // TREE_SETS))
    dealt = rows.withColumn("task", F.pmod(F.xxhash64("tree"), F.lit(tasks)))
    return stage(dealt.groupBy("task").applyInArrow(lambda t: tree_links(t, percent, cross), LINKS), "jaccard-links")


def dealt_into_trees(sets: DataFrame, *grove: str) -> DataFrame:
    """Add ``band`` and ``tree``: sets of a grove and a band of sizes, dealt by hash so that no tree is too large."""
    rows = sets.withColumn("band", F.floor(F.log(1.25, F.col("n") + 0.5)).cast("int"))
    parts = rows.groupBy(*grove, "band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / TREE_SETS), F.ceil(F.sum("n") / TREE_SHINGLES)).alias("parts")
    )
    return rows.join(parts, [*grove, "band"]).withColumn("tree", F.xxhash64(*grove, "band", F.pmod(F.xxhash64("body"), F.col("parts")))).drop("parts")


def with_texts(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``sets`` with the text of each ``body``, once."""
    found = texts_of(docs).select("text", "body").join(checked(sets.select("body").distinct(), 40), "body", "left_semi")
    return stage(found.dropDuplicates(["body"]).join(sets, "body"), "jaccard-texts")


def classes_of(rows: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """``rows`` with ``class``: the least body of its component."""
    roots = connected(links, label).select(F.col("node").alias("body"), "root")
    return rows.join(roots, "body", "left").withColumn("class", F.coalesce("root", "body")).drop("root")


def joined_sets(docs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(body, class) of the candidate sets (body, n, grove)."""
    rows = with_texts(docs, dealt_into_trees(members, "grove"))
    own = rows.select("tree", F.lit(0).alias("side"), F.col("body").alias("class"), "body", "text")
    links = grown(own, percent)
    small = rows.drop("text")
    # One member of each class of every tree: where a grove is one class, nothing is left to compare after this.
    named = stage(classes_of(small, links, "jaccard-own"), "jaccard-named")
    trees = named.groupBy("grove").agg(F.countDistinct("tree").alias("trees"), F.min("class").alias("low"), F.max("class").alias("high"))
    mixed = trees.filter("trees > 1 AND low <> high").select("grove")
    heads = named.join(mixed, "grove").groupBy("grove", "tree", "class").agg(F.min(F.struct("body", "n")).alias("m")).select("grove", "m.body", "m.n").distinct()
    top = dealt_into_trees(heads, "grove").select("tree", "body").join(rows.select("body", "text"), "body")
    links = links.union(grown(top.select("tree", F.lit(0).alias("side"), F.col("body").alias("class"), "body", "text"), percent))
    named = stage(classes_of(small, links, "jaccard-heads"), "jaccard-named")
    still = named.groupBy("grove").agg(F.countDistinct("tree").alias("trees"), F.min("class").alias("low"), F.max("class").alias("high"))
    open_groves = still.filter("trees > 1 AND low <> high").select("grove")
    states = named.join(open_groves, "grove").groupBy("grove", "tree").agg(
        F.first("band").alias("band"), F.min("class").alias("low"), F.max("class").alias("high")
    )
    one, two = stage(states, "jaccard-states").alias("x"), states.alias("y")
    meets = (F.col("x.tree") < F.col("y.tree")) & (F.abs(F.col("x.band") - F.col("y.band")) <= 1)
    differ = (F.col("x.low") != F.col("y.low")) | (F.col("x.low") != F.col("x.high")) | (F.col("y.low") != F.col("y.high"))
    pairs = one.join(two, "grove").filter(meets & differ).select(
        F.xxhash64("x.tree", "y.tree").alias("pair"), F.explode(F.array(
            F.struct(F.col("x.tree").alias("tree"), F.lit(0).alias("side")), F.struct(F.col("y.tree").alias("tree"), F.lit(1).alias("side"))
        )).alias("t")
    ).select("pair", "t.tree", "t.side")
    crossed = named.select("body", "tree", "class").join(pairs, "tree").join(rows.select("body", "text"), "body").select(
        F.col("pair").alias("tree"), "side", "class", "body", "text"
    )
    links = links.union(grown(stage(crossed, "jaccard-crossed"), percent, cross=True))
    return classes_of(small, links, "jaccard-all").select("body", "class")


def components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``."""
    shared = prefix_keys(docs, percent).groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high")
    live = stage(shared.select("key"), "jaccard-live")
    bitmap, shift = bitmap_of(live)
    facts = facts_of(docs, percent, bitmap, shift)
    near = groves(facts, live, percent)
    filled = facts.filter("n > 0")
    sets = filled.groupBy("n", "d1", "d2").agg(F.min("body").alias("body"), F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    sets = stage(sets.join(near, "d1", "left"), "jaccard-sets")
    classes = stage(joined_sets(docs, sets.filter("grove IS NOT NULL").select("body", "n", "grove"), percent), "jaccard-classes")
    named = sets.join(classes, "body", "left")
    lows = named.filter("class IS NOT NULL").groupBy("class").agg(F.min("low").alias("least"))
    # Sets of one document and no link are left out: their document is its own component.
    known = named.filter("copies > 1 OR class IS NOT NULL").join(lows, "class", "left").select(
        "n", "d1", "d2", F.coalesce("least", "low").alias("component_id")
    )
    return facts.select("doc_id", "n", "d1", "d2").join(stage(known, "jaccard-known"), ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
