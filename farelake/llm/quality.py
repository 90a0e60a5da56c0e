"""Quality: histogram gradient-boosted trees over statistics of whole documents.

A document becomes ``FEATURES`` numbers: shares of kinds of bytes and words, repeats of words and pairs of words, lengths. Trees
are grown level by level on binned statistics; gains come from histograms of gradients per node, feature and bin. All trees are full
and lie in flat arrays, so that a batch walks all of them with one numpy step per level. The score is the logistic of
the sum, that is the chance of label 1.

Training takes at most ``SAMPLE`` labelled documents of each class, picked by hash from those allowed for training and weighted back
to the shares among all labels; only their statistics reach the driver. Every text is scored whole, in stretches of ``STRETCH`` bytes that end between
words (a word longer than that counts as several). Without labels of both classes every score is the share of label 1 (0 without labels). If labels of a document differ,
the smaller holds. Null and empty texts have statistics of zeros and are scored by them. Repeated rows are scored alike; rows with a
null id are scored and not held out. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.encoding import slices
from farelake.llm.shingles import mix, word_hashes

SAMPLE = 5000
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.15
RIDGE = 1.0
#: Least sum of second derivatives in a node.
LEAST_WEIGHT = 2.0
STRETCH = 1 << 20
#: Rows that walk the trees together.
WALK = 4096

KINDS = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": (32, 9, 11, 12, 13), "line": (10,),
    "stop": map(ord, ".?"), "call": map(ord, "!"), "pause": map(ord, ",;:"), "frame": map(ord, "'\"()-"), "letter": range(128, 256),
}
NAMES = [*KINDS, "symbol"]
_KIND = np.full(256, len(KINDS), np.uint8)
for _at, _bytes in enumerate(KINDS.values()):
    _KIND[list(_bytes)] = _at
KIND = {name: at for at, name in enumerate(NAMES)}
SPACE = np.isin(_KIND, (KIND["space"], KIND["line"]))
LETTER = np.isin(_KIND, (KIND["lower"], KIND["upper"], KIND["letter"]))

#: Counts per word kind that are gathered beside those of bytes.
WORD_COUNTS = ["sentence_ends", "call_ends", "symbol_ends", "no_letters", "capitals", "short", "long"]
FEATURES = [
    "log_bytes", "log_words", "bytes_per_word", "upper_of_letters", "digits", "other_letters", "symbols", "frames", "spaces", "doubled_marks",
    "pauses_per_word", "lines_per_word", *WORD_COUNTS, "repeats_last", "distinct_words", "commonest_word", "distinct_pairs",
]


def stretches(raw: np.ndarray):
    """Bounds of stretches of at most STRETCH bytes; they end behind a space if there is one."""
    start = 0
    while start < len(raw):
        stop = min(len(raw), start + STRETCH)
        if stop < len(raw):
            gap = np.flatnonzero(SPACE[raw[start:stop]][::-1][:STRETCH // 2])
            stop -= int(gap[0]) if len(gap) else 0
        yield start, stop
        start = stop


def counted(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: bytes of each kind, doubled marks, and words of each kind."""
    n = len(bounds) - 1
    kinds, doubled, words = np.zeros((n, len(NAMES))), np.zeros(n), np.zeros((n, len(WORD_COUNTS)))
    for low, high in stretches(raw):
        first, last = np.searchsorted(bounds, low, "right") - 1, np.searchsorted(bounds, high, "left")
        cuts = np.clip(bounds[first:last + 1], low, high) - low
        part, sizes, here = raw[low:high], np.diff(cuts), last - first
        kind = _KIND[part]
        owner = np.repeat(np.arange(here, dtype=np.int32), sizes)
        kinds[first:last] += np.bincount(owner * len(NAMES) + kind, minlength=here * len(NAMES)).reshape(here, -1)
        twice = np.flatnonzero((part[1:] == part[:-1]) & (kind[1:] >= KIND["stop"]) & (kind[1:] != KIND["letter"]))
        doubled[first:last] += np.bincount(owner[twice + 1], minlength=here)
        word = ~SPACE[part]
        fresh = word.copy()
        fresh[1:] &= ~word[:-1]
        heads = cuts[:-1][sizes > 0]
        fresh[heads] = word[heads]
        starts = np.flatnonzero(fresh)
        if not len(starts):
            continue
        ends = np.flatnonzero(word & np.append(fresh[1:] | ~word[1:], True)) + 1
        length = ends - starts
        per = lambda mask: np.add.reduceat(mask.astype(np.int32), starts)
        final, upper = kind[ends - 1], per(kind == KIND["upper"])
        told = (
            (final == KIND["stop"]) | (final == KIND["call"]), final == KIND["call"], final == KIND["symbol"], per(LETTER[part]) == 0,
            (upper > 1) & (per(kind == KIND["lower"]) == 0), length <= 3, length >= 15,
        )
        for column, mask in enumerate(told):
            words[first:last, column] += np.bincount(owner[starts[mask]], minlength=here)
    return kinds, doubled, words


def runs(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner: how many different keys it has, and how often its commonest occurs."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, owner)) if n > 1 else np.argsort(keys)
    sorted_keys, sorted_owner = keys[order], owner[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (sorted_keys[1:] != sorted_keys[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])
    heads = np.flatnonzero(fresh)
    times = np.diff(np.append(heads, len(order)))
    most = np.zeros(n)
    np.maximum.at(most, sorted_owner[heads], times)
    return np.bincount(sorted_owner[heads], minlength=n).astype(float), most


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES per text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data, n = texts.buffers()[2], len(texts)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    kinds, doubled, word_kinds = counted(raw, offsets - offsets[0])
    hashes, n_words = word_hashes(texts)
    owner = np.repeat(np.arange(n), n_words)
    joined = owner[1:] == owner[:-1]
    same = np.bincount(owner[1:][joined & (hashes[1:] == hashes[:-1])], minlength=n)
    different, most = runs(hashes, owner, n)
    pairs, _ = runs(mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[joined], owner[1:][joined], n)
    size, of = kinds.sum(1), {name: kinds[:, at] for name, at in KIND.items()}
    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(n_words, 1)
    return np.column_stack((
        np.log1p(size), np.log1p(n_words), size * per_word, of["upper"] / np.maximum(of["upper"] + of["lower"], 1), of["digit"] * per_byte,
        of["letter"] * per_byte, of["symbol"] * per_byte, of["frame"] * per_byte, of["space"] * per_byte, doubled * per_byte,
        of["pause"] * per_word, of["line"] * per_word, word_kinds * per_word[:, None], same * per_word, different * per_word, most * per_word,
        pairs / np.maximum(n_words - 1, 1),
    )).astype(np.float32)


@dataclass
class Forest:
    """Full trees in flat arrays: node ``i`` of a tree has the children 2 i + 1 and 2 i + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def decisions(self, rows: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        out = np.empty(len(rows))
        for low in range(0, len(rows), WALK):
            part = rows[low:low + WALK]
            node = np.zeros((len(part), len(trees)), np.int64)
            for _ in range(DEPTH):
                value = np.take_along_axis(part, self.feature[trees, node], 1)
                node = 2 * node + 1 + (value > self.threshold[trees, node])
            out[low:low + WALK] = self.start + self.leaf[trees, node - (2**DEPTH - 1)].sum(1)
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.decisions(rows), -60, 60)))


def cut_points(column: np.ndarray) -> np.ndarray:
    """At most BINS - 1 values, each of which parts the column."""
    values = np.unique(column)
    if len(values) > BINS:
        values = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
    return values[values < column.max()]


def grow(binned: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree: features and thresholds of its nodes, values of its leaves, and each row's leaf."""
    inner = 2**DEPTH - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
    node = np.zeros(len(binned), np.int64)
    for depth in range(DEPTH):
        width, best = 2**depth, np.full(2**depth, 1e-6)
        chosen = np.full(width, -1)
        limit = np.zeros(width, np.int64)
        for f, points in enumerate(cuts):
            if not len(points):
                continue
            spot = node * BINS + binned[:, f]
            left_g = np.bincount(spot, slope, width * BINS).reshape(width, BINS).cumsum(1)
            left_h = np.bincount(spot, curve, width * BINS).reshape(width, BINS).cumsum(1)
            g, h = left_g[:, -1:], left_h[:, -1:]
            gain = left_g**2 / (left_h + RIDGE) + (g - left_g) ** 2 / (h - left_h + RIDGE) - g**2 / (h + RIDGE)
            gain[(left_h < LEAST_WEIGHT) | (h - left_h < LEAST_WEIGHT)] = 0
            gain = gain[:, :len(points)]
            at = gain.argmax(1)
            better = gain[np.arange(width), at] > best
            best[better], chosen[better], limit[better] = gain[np.arange(width), at][better], f, at[better]
        split = chosen >= 0
        base = width - 1
        feature[base + np.flatnonzero(split)] = chosen[split]
        threshold[base + np.flatnonzero(split)] = [cuts[f][at] for f, at in zip(chosen[split], limit[split])]
        right = split[node] & (binned[np.arange(len(binned)), chosen[node]] > limit[node])
        node = 2 * node + right
    leaf = -np.bincount(node, slope, 2**DEPTH) / (np.bincount(node, curve, 2**DEPTH) + RIDGE)
    return feature, threshold, leaf, node


def fit(rows: np.ndarray, label: np.ndarray, weight: np.ndarray, trees: int = TREES) -> Forest:
    """Boost ``trees`` trees on the logistic loss of labels 0 and 1."""
    cuts = [cut_points(rows[:, f]) for f in range(rows.shape[1])]
    binned = np.column_stack([np.searchsorted(points, rows[:, f], "left") for f, points in enumerate(cuts)])
    share = float((weight * label).sum() / weight.sum())
    start = float(np.log(share / (1 - share)))
    decision, grown = np.full(len(rows), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-decision))
        feature, threshold, leaf, node = grow(binned, cuts, weight * (p - label), weight * p * (1 - p))
        decision += RATE * leaf[node]
        grown.append((feature, threshold, RATE * leaf))
    return Forest(*(np.stack(column) for column in zip(*grown)), start)


def remainder(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


HELD_OUT = 2


def with_statistics(rows: DataFrame) -> DataFrame:
    """(doc_id, stats) from (doc_id, text)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                stats = statistics(part.column(1))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), stats.shape[1]).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "stats"])

    return rows.mapInArrow(run, "doc_id bigint, stats array<float>")


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest | float:
    """A forest, or a constant score where the labels show one class only."""
    told = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("quality")
    ).filter(remainder(F.col("doc_id")) != HELD_OUT)
    counts = {r["quality"]: r["count"] for r in told.groupBy("quality").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    picked = [
        tuple(r) for label in (0, 1)
        for r in told.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    ]
    chosen = docs.sparkSession.createDataFrame(picked, "_doc bigint, quality int")
    some = texts_of(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("_doc"), "left_semi")
    # Of rows that repeat an id one is taken; at most two samples of short lists come back.
    stats = dict(with_statistics(some).groupBy("doc_id").agg(F.min("stats").alias("stats")).collect())
    rows = [(doc, label) for doc, label in sorted(picked) if doc in stats]
    label = np.array([label for _, label in rows], float)
    if not 0 < label.sum() < len(label):
        return share
    weight = np.where(label == 1, share / label.mean(), (1 - share) / (1 - label.mean()))
    return fit(np.array([stats[doc] for doc, _ in rows], np.float32), label, weight)


def score(docs: DataFrame, model: Forest | float) -> DataFrame:
    """(doc_id, score) per row."""
    rows = texts_of(docs)
    if isinstance(model, float | int):
        return rows.select("doc_id", F.lit(float(model)).alias("score"))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = model.probability(statistics(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id bigint, score double")


def assessed(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; ``predicted`` is 1 from ``least`` on."""
    held = F.coalesce(remainder(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return score(docs, train(docs, labels, sample)).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )
