"""Toxicity: a support vector machine over a subsequence string kernel, with Nyström landmarks.

The kernel of two words counts the character triples they share as subsequences, with gaps, each weighted by the length it
spans, so inserted characters weaken a match and do not end it. It is divided by the landmark's norm and partly (``BLEND``) by the word's, so
that triples which an inserted character adds count for little, is cut off below ``FLOOR``, whole from ``FULL`` on and cubed; summed over all pairs of distinct words it is the kernel of sentences. Landmarks are words of the training sample;
the Nyström map takes a sentence to their span, where a linear machine with squared hinge loss separates. Labels are given for
documents, so each toxic document stands for the sentence that scores highest, chosen anew in each round. Each toxic document is learned from
once more with a letter inserted in its landmarks. A document's score is that of its highest sentence, as a probability.

Training takes at most ``SAMPLE`` labelled documents of each class, picked by hash from those allowed for training; every
text is scored whole. Without labels of both classes every score is the share of toxic labels (0 without labels). Null and empty
texts score like a sentence without words. Repeated rows are scored alike; null ids are kept and don't count as held out. Very long texts are
cut into sentences as any others. Without rows there is nothing to return.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.encoding import slices
from farelake.llm.kept import kept, release

SAMPLE = 2000
LANDMARKS = 96
REACH = 6
DECAY = 0.9
POWER = 3
#: Share of a word's own norm in the divisor: 1 is the cosine, 0 the part of the landmark that the word holds.
BLEND = 0.5
#: A kernel value from which a word counts as the landmark itself.
FULL = 0.8
FLOOR = 0.65
SENTENCE_WORDS = 32
ROUNDS = 5
RIDGE = 1e-3
FEATURES = 1 << 16
LONGEST = 32
MEMO_WORDS = 400_000
#: Bytes of sample text parsed at a time while fitting.
FIT_CHARS = 1 << 18

GAPS = [(a, b) for b in range(2, REACH + 1) for a in range(1, b)]


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed gapped triples of words of one length, a row per word, and the weight of each column."""
    size, columns, weights = codes.shape[1], [], []
    for a, b in GAPS:
        if size <= b:
            continue
        mixed = codes[:, :-b] * np.uint32(2654435761)
        mixed ^= codes[:, a:size - b + a] * np.uint32(2246822519)
        mixed ^= codes[:, b:] * np.uint32(3266489917)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(668265263)
        columns.append(mixed >> np.uint32(16))
        weights.append(np.full(size - b, DECAY ** (b - 2), np.float32))
    return np.concatenate(columns, 1), np.concatenate(weights)


def by_length(words: list[str]):
    """(places, codes) of the words of each length that has triples."""
    text = np.array(words, f"U{LONGEST}")
    codes = text.view(np.uint32).reshape(len(words), LONGEST)
    size = (codes != 0).sum(1)
    for n in np.unique(size):
        if n > 2:
            at = np.flatnonzero(size == n)
            yield at, np.ascontiguousarray(codes[at, :n])


class Kernel:
    """The word kernel against fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.m = len(landmarks)
        table = np.zeros((FEATURES, self.m), np.float32)
        for at, codes in by_length(landmarks):
            feats, weights = features(codes)
            np.add.at(table, (feats, at[:, None]), weights[None])
        self.table = table / np.maximum(np.sqrt((table**2).sum(0)) ** (2 - BLEND), 1e-9)
        self.peak = self.table.max(1)

    def near(self, words: list[str], chunk: int = 4096, few: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that any landmark is near to, and their kernel values with all landmarks."""
        places, values = [np.zeros(0, np.int64)], [np.zeros((0, self.m), np.float32)]
        for at, codes in by_length(words) if words else ():
            for low in range(0, len(at), chunk):
                feats, weights = features(codes[low:low + chunk])
                norm = np.sqrt((weights**2).sum()) ** BLEND
                close = np.flatnonzero(self.peak[feats] @ weights >= FLOOR * norm)
                for start in range(0, len(close), few):
                    some = close[start:start + few]
                    value = np.einsum("nfm,f->nm", self.table[feats[some]], weights) / norm
                    value = np.where(value >= FLOOR, np.minimum(value / FULL, 1), 0) ** POWER
                    hit = value.any(1)
                    places.append(at[low + some[hit]])
                    values.append(value[hit].astype(np.float32))
        return np.concatenate(places), np.concatenate(values)

    def of(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.m))
        places, values = self.near(words)
        out[places] = values
        return out


def parsed(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, each place's word and sentence, and each sentence's text.

    Words are parted by spaces and line ends and keep their letters and digits in lower case. A sentence ends at a mark or a
    line's end and is cut after SENTENCE_WORDS words.
    """
    marked = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", "\n ")
    split = pc.split_pattern(marked, " ")
    counts = np.diff(split.offsets.to_numpy())
    raw = split.flatten().dictionary_encode()
    at = raw.indices.to_numpy()
    empty = pc.equal(pc.utf8_trim_whitespace(raw.dictionary), "").to_numpy(zero_copy_only=False)[at]
    stop = pc.match_substring_regex(raw.dictionary, r"[.!?\n]\z").to_numpy(zero_copy_only=False)[at]
    plain = pc.replace_substring_regex(pc.utf8_lower(raw.dictionary), r"[^\p{L}\p{N}]+", "").dictionary_encode()
    doc = np.repeat(np.arange(len(counts)), counts)
    fresh = np.ones(len(at), bool)
    fresh[1:] = stop[:-1] | (doc[1:] != doc[:-1])
    filled = np.cumsum(~empty)
    head = np.flatnonzero(fresh)
    base = np.repeat((filled - ~empty)[head], np.diff(np.append(head, len(at))))
    run = np.maximum(filled - base - 1, 0) // SENTENCE_WORDS
    fresh[1:] |= run[1:] != run[:-1]
    return plain.dictionary.to_pylist(), plain.indices.to_numpy()[at], np.cumsum(fresh) - 1, doc[fresh]


def pieces(unit: str) -> list[str]:
    """A word longer than LONGEST as overlapping parts."""
    if len(unit) <= LONGEST:
        return [unit]
    return [unit[i:i + LONGEST] for i in range(0, len(unit), LONGEST - REACH)]


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.shift, -60, 60)))


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine by Newton steps; ``y`` is -1 or 1, the last column of the solution is the bias."""
    full = np.hstack((x, np.ones((len(x), 1))))
    beta = np.zeros(full.shape[1])
    ridge = np.full(full.shape[1], RIDGE)
    ridge[-1] = 1e-8
    for _ in range(steps):
        active = y * (full @ beta) < 1
        xa, wa = full[active], weight[active, None]
        hess = xa.T @ (wa * xa) + np.diag(ridge)
        new = np.linalg.solve(hess, xa.T @ (wa[:, 0] * y[active]))
        if np.allclose(new, beta, atol=1e-7):
            break
        beta = new
    return beta[:-1], float(beta[-1])


def platt(decision: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through weighted decisions."""
    x = np.stack((decision, np.ones_like(decision)), 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (toxic - p)) - 1e-3 * beta
        hess = x.T @ (x * (weight * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += step
        if np.abs(step).max() < 1e-7:
            break
    return float(beta[0]), float(beta[1])


def word_kernels(kernel: Kernel, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``near`` for words of any length: the kernel of a long word is the sum over its parts."""
    if not any(len(w) > LONGEST for w in words):
        return kernel.near(words)
    parts = [pieces(w) for w in words]
    owner = np.repeat(np.arange(len(words)), [len(p) for p in parts])
    places, values = kernel.near([p for own in parts for p in own])
    used, row = np.unique(owner[places], return_inverse=True)
    sums = np.zeros((len(used), kernel.m), np.float32)
    np.add.at(sums, row, values)
    return used, sums


def with_inserted(text: str | None, landmarks: list[str]) -> str:
    """``text`` with one letter inserted in each word that is a landmark, which letter and where by a checksum."""
    known = set(landmarks)

    def grown(found: re.Match) -> str:
        word = found.group()
        if word.lower() not in known:
            return word
        code = zlib.crc32(f"{found.start()} {word}".encode())
        at = 1 + code % (len(word) - 1)
        return word[:at] + ascii_lowercase[code // 64 % 26] + word[at:]

    return re.sub(r"\w+", grown, text or "")


def fit(texts: list[str], toxic: list[int], share: float) -> Model:
    """Fit on the sample; ``share`` is the share of toxic labels among all training labels."""
    y = np.array(toxic)
    # One run of texts at a time: only counts of words, and sentences near a landmark, outlive it.
    whole = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), pa.array(texts, pa.large_string())], names=["at", "text"])
    place: dict[str, int] = {}
    seen = np.zeros((0, 2), np.int64)
    for part in slices(whole, chars=FIT_CHARS):
        words, word, sentence, doc_of = parsed(part.column(1))
        in_doc = np.unique(doc_of[sentence] * len(words) + word)
        held = y[part.column(0).to_numpy()[in_doc // len(words)]] if len(words) else y[:0]
        at = np.array([place.setdefault(w, len(place)) for w in words], np.int64)
        seen = np.concatenate((seen, np.zeros((len(place) - len(seen), 2), np.int64)))
        for c in (0, 1):
            seen[at, c] += np.bincount(in_doc[held == c] % len(words), minlength=len(words)) if len(words) else 0
    words = list(place)
    odds = np.log((seen[:, 1] + 0.5) / (y.sum() + 1)) - np.log((seen[:, 0] + 0.5) / ((1 - y).sum() + 1))
    fits = np.array([3 <= len(w) <= LONGEST for w in words], bool)
    strength = odds * np.sqrt(seen[:, 1]) * fits
    landmarks = [words[i] for i in np.lexsort((np.array(words, object), -strength))[:LANDMARKS] if strength[i] > 0]
    landmarks = landmarks or sorted(w for w in words if 3 <= len(w) <= LONGEST)[:LANDMARKS] or ["none"]
    # Toxic documents are learned from once more, with an inserted letter in each landmark.
    copies = [with_inserted(texts[i], landmarks) for i in np.flatnonzero(y == 1)]
    texts, y = [*texts, *copies], np.concatenate((y, np.ones(len(copies), y.dtype)))
    whole = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), pa.array(texts, pa.large_string())], names=["at", "text"])
    kernel = Kernel(landmarks)
    values, vectors = np.linalg.eigh(kernel.of(landmarks))
    keep = values > 1e-6 * max(values.max(), 1e-9)
    half = vectors[:, keep] / np.sqrt(values[keep])
    # Sentences without a word near a landmark are all alike; each document keeps one such.
    owners, spans = [np.arange(len(texts))], [np.zeros((len(texts), half.shape[1]))]
    for part in slices(whole, chars=FIT_CHARS):
        words, word, sentence, doc_of = parsed(part.column(1))
        places, values = word_kernels(kernel, words)
        row_of = np.full(len(words), -1)
        row_of[places] = np.arange(len(places))
        some = np.flatnonzero(row_of[word] >= 0)
        pairs = np.unique(sentence[some] * len(words) + word[some])
        used, row = np.unique(pairs // max(len(words), 1), return_inverse=True)
        sums = np.zeros((len(used), kernel.m))
        np.add.at(sums, row, values[row_of[pairs % max(len(words), 1)]])
        owners.append(part.column(0).to_numpy()[doc_of[used]])
        spans.append(sums @ half)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    owner, z = owner[order], np.concatenate(spans)[order]
    del spans
    first = np.searchsorted(owner, np.arange(len(texts)))
    decision = z @ (half.T @ np.ones(kernel.m))
    beta, bias = np.zeros(z.shape[1]), 0.0
    weight_of = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    for _ in range(ROUNDS):
        best = first + np.array([int(np.argmax(part)) for part in np.split(decision, first[1:])])
        chosen = np.concatenate((best[y == 1], np.flatnonzero(y[owner] == 0)))
        label = np.where(y[owner[chosen]] == 1, 1.0, -1.0)
        per_doc = np.bincount(owner[chosen], minlength=len(texts))[owner[chosen]]
        beta, bias = squared_hinge(z[chosen], label, weight_of[owner[chosen]] / per_doc)
        decision = z @ beta + bias
    top = np.maximum.reduceat(decision, first)
    slope, shift = platt(top, y, weight_of)
    return Model(landmarks, half @ beta, bias, slope, shift)


class Scorer:
    """Scores words once and remembers up to MEMO_WORDS of them."""

    def __init__(self, model: Model):
        self.model, self.kernel, self.memo = model, Kernel(model.landmarks), {}

    def word_scores(self, words: list[str]) -> np.ndarray:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo = self.memo
        new = [w for w in words if w not in memo]
        scores = np.zeros(len(new))
        places, values = word_kernels(self.kernel, new)
        scores[places] = values.astype(np.float64) @ self.model.weights
        memo.update(zip(new, scores.tolist()))
        return np.fromiter(map(memo.__getitem__, words), np.float64, len(words))

    def decisions(self, texts: pa.Array) -> np.ndarray:
        """Each text's highest sentence; a word counts once in a sentence."""
        words, word, sentence, doc_of = parsed(texts)
        out = np.full(len(texts), self.model.bias)
        if len(word):
            scores = self.word_scores(words)
            some = np.flatnonzero(scores[word])
            pairs = np.unique(sentence[some] * len(words) + word[some])
            sums = np.bincount(pairs // len(words), scores[pairs % len(words)], len(doc_of))
            np.maximum.at(out, doc_of, sums + self.model.bias)
        return out


def remainder(doc_id):
    """The fold of a document: crc32 of its id as text, modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[int], float]:
    """Texts and labels of at most ``sample`` documents per class outside the held-out fold, and the share of toxic labels."""
    told = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    told = told.filter(remainder(F.col("doc_id")) != 0)
    counts = dict(told.groupBy("toxic").count().collect())
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    picked = [
        told.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect() for label in (0, 1)
    ]
    spark = docs.sparkSession
    chosen = spark.createDataFrame([tuple(r) for rows in picked for r in rows], "_doc bigint, toxic int")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_doc")
    ).groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").collect()
    return [r["text"] for r in rows], [r["toxic"] for r in rows], share


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | float:
    """A model, or a constant score where the labels show one class only."""
    texts, toxic, share = training_sample(docs, labels, sample)
    model = fit(texts, toxic, share) if 0 < sum(toxic) < len(toxic) else share
    # The driver outlives the fit: what that took would add to what later stages take.
    del texts, toxic
    release()
    return model


def scorer_of(model: Model) -> Scorer:
    """The scorer of this worker, which outlives a task."""
    key = ("toxicity", tuple(model.landmarks), model.weights.tobytes(), model.bias, model.slope, model.shift)
    return kept(key, lambda: Scorer(model))


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """(doc_id, score) per row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if isinstance(model, float | int):
        return rows.select("doc_id", F.lit(float(model)).alias("score"))
    def run(batches):
        scorer = scorer_of(model)
        for batch in batches:
            for part in slices(batch):
                found = model.probability(scorer.decisions(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id bigint, score double")


def assessed(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    scored = score(docs, train(docs, labels, sample))
    held = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model | float, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score less than ``least``, as they are."""
    if isinstance(model, float | int):
        return docs if model < least else docs.limit(0)

    def run(batches):
        scorer = scorer_of(model)
        for batch in batches:
            for part in slices(batch, batch.schema.get_field_index("text")):
                clean = model.probability(scorer.decisions(part.column("text"))) < least
                yield part.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
