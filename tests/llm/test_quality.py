"""Quality statistics against plain counting, trees against plain walking, and the classifier on held-out documents."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from farelake.llm import quality
from llm.helpers import WORD

TEXTS = [
    None, "", " \n", "Plain words, then more words.", "BUY NOW!! BUY NOW!! $$$ ### 12 345", "a a a a b\nA (b) \"c\"", "é Ü über\tthe thirteenthlongword",
    "noend" * 30, "one line\none line\none line", "x.. y!! z?!",
]


def plain(text):
    raw, words = (text or "").encode(), WORD.findall((text or "").encode().decode("latin1"))
    n, w = max(len(raw), 1), max(len(words), 1)
    count = lambda chars: sum(c in chars for c in raw)
    lower, upper = count(range(97, 123)), count(range(65, 91))
    letters = re.compile("[A-Za-z\x80-\xff]")
    folded = [x.encode("latin1").lower() for x in words]
    marks = lambda c: not (97 <= c < 123 or 65 <= c < 91 or 48 <= c < 58 or c in (32, 9, 10, 11, 12, 13) or c >= 128)
    frames, stops = set(map(ord, "'\"()-")), set(map(ord, ".?!,;:"))
    symbols = [c for c in raw if marks(c) and c not in frames | stops]
    pairs = list(zip(folded, folded[1:]))
    per_word = [
        sum(x[-1] in ".?!" for x in words), sum(x[-1] == "!" for x in words), sum(ord(x[-1]) in symbols for x in words),
        sum(not letters.search(x) for x in words), sum(len(re.findall("[A-Z]", x)) > 1 and not re.search("[a-z]", x) for x in words),
        sum(len(x) <= 3 for x in words), sum(len(x) >= 15 for x in words),
    ]
    return [
        np.log1p(len(raw)), np.log1p(len(words)), len(raw) / w, upper / max(upper + lower, 1), count(range(48, 58)) / n, sum(c >= 128 for c in raw) / n,
        len(symbols) / n, count(frames) / n, count(b" \t\n\x0b\x0c\r") / n - raw.count(b"\n") / n, sum(a == b and marks(a) for a, b in zip(raw, raw[1:])) / n,
        count(b",;:") / w, raw.count(b"\n") / w, *[x / w for x in per_word], sum(a == b for a, b in pairs) / w, len(set(folded)) / w,
        max(Counter(folded).values(), default=0) / w, len(set(pairs)) / max(len(words) - 1, 1),
    ]


def test_statistics(monkeypatch):
    want = np.array([plain(t) for t in TEXTS], np.float32)
    assert want.shape[1] == len(quality.FEATURES)
    got = quality.statistics(pa.array(TEXTS))
    for at, name in enumerate(quality.FEATURES):
        assert np.allclose(got[:, at], want[:, at], atol=1e-6), name
    assert np.array_equal(quality.statistics(pa.array(["skipped", *TEXTS])[1:]), got)
    assert quality.statistics(pa.array([], pa.string())).shape == (0, len(quality.FEATURES))
    # A very long text in stretches.
    monkeypatch.setattr(quality, "STRETCH", 64)
    long = ["It is one of the Words!! of 5,000 ### texts. " * 400, "short"]
    assert np.allclose(quality.statistics(pa.array(long)), [plain(t) for t in long], rtol=1e-5, atol=1e-6)


def test_trees_walk_as_they_are_grown():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(3000, 4)).astype(np.float32)
    rows[:, 3] = 7
    label = ((rows[:, 0] > 0.3) ^ (rows[:, 1] * rows[:, 2] > 0)).astype(float)
    forest = quality.fit(rows, label, np.ones(len(rows)), trees=60)
    decisions = forest.decisions(rows)
    assert ((decisions > 0) == label).mean() > 0.95
    for row, decision in zip(rows[:50], decisions):
        total = forest.start
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        assert abs(total - decision) < 1e-9


def test_quality(spark):
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice("the and with from house tree river cloud green stone".split()) for _ in range(n))
    junk = lambda n: "!! ".join(say(n).upper().split())
    rows = [(i, say(rng.randrange(20, 90)) if i % 3 else junk(rng.randrange(20, 90)), 7) for i in range(600)]
    rows += [(5, rows[5][1], 8), (900, None, 1), (901, "", 1), (None, "no id here at all", 1), (902, say(200_000), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stats long")
    # Labels of a document may differ or be missing; a label of the held-out fold must not matter.
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    marks = [(i, int(held(i) != (i % 3 > 0)), 0) for i in range(600)] + [(None, 0, 0), (4, None, 0), (4, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = quality.assessed(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (r.doc_id is not None and held(r.doc_id))
    found = {r.doc_id: r.predicted for r in got}
    assert all(found[i] == (i % 3 > 0) for i in range(600)) and found[902] == 1
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    some = docs.filter("doc_id < 9")
    assert {r.score for r in quality.assessed(some, labels.filter("quality = 1")).collect()} == {1.0}
    assert {r.score for r in quality.assessed(some, labels.limit(0)).collect()} == {0.0}
    assert quality.assessed(docs.limit(0), labels).count() == 0
