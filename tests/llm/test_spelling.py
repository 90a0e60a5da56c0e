"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from farelake.llm import spelling
from llm.helpers import distance

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute(rows, misspell):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % misspell == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in n if abs(len(w) - len(x)) < 2 and distance(w, x) == 1] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (n[w], len(near[w]), form.get(w), n.get(form.get(w)), root)
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    words = []
    for base, times in (("lantern", 700), ("Éclairé", 300), ("aaaaaaaaaa", 200), ("wonderfullylongword", 200), ("stones", 150)):
        lowered = base[0] + base[1:].lower()
        near = {lowered}
        for _ in range(14):
            w = rng.choice(sorted(near))
            i = rng.randrange(len(w) + 1)
            near.add(w[:i] + rng.choice("abé÷z") * rng.randrange(2) + w[i + rng.randrange(2):])
        for k, w in enumerate(sorted(near)):
            words += [w] * max(5, times // (6 ** (k % 4)))
    words += ["tie" + "xyz" + c for c in "ab" for _ in range(30)] + ["tiexyz"] * 6 + ["short", "UPPERcase", "uppercase"] * 5 + ["four45four"] * 9
    words += [c * 400 + "d" for c in "ef" for _ in range(5)] + ["e" * 400] * 40
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::90]) + ", ") for i in range(90)]
    return rows + rows[:4] + [(None, "lanterns " * 6), (900, None), (901, ""), (902, "12 - 34")]


@pytest.mark.parametrize("misspell", [199, 3])
@pytest.mark.parametrize("levels", [1, 4])
def test_variants(spark, corpus, monkeypatch, misspell, levels):
    monkeypatch.setattr(spelling, "LEVELS", levels)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in corpus], "doc_id long, text string, word string, n int")
    got = spelling.variants(docs, misspell).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == brute(corpus, misspell)
    assert len(got) == len({r.word for r in got}) and any(r.root != r.form for r in got if r.form)


def test_one_common_prefix(spark):
    """A third of all words share their first half and none of them is near another."""
    rng = random.Random(7)
    hot = {"commonprefix" + "".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(3000)}
    words = spark.createDataFrame([(w, 5) for w in sorted(hot)] + [("commonprefixes", 5), ("commonprefixe", 5)], "word string, n long")
    pairs = spelling.near_pairs(words)
    want = {tuple(sorted((a[:i] + c + a[i + 1:], a))) for a in hot for i in range(12, 24) for c in "abcdefgh" if c != a[i] and a[:i] + c + a[i + 1:] in hot}
    assert {tuple(sorted(r)) for r in pairs.collect()} == want | {("commonprefixe", "commonprefixes")}


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
