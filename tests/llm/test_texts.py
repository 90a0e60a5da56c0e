"""Operators on texts against brute force; nulls, empty and long texts, repeated rows, clashing columns, empty tables."""

import gc
import random
import re
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from farelake.llm import common, decontamination, jaccard, licenses, linededup, packing, queries, shingles, tokencounts, toxicity
from llm.helpers import classes, distance
from llm.helpers import shingles as plain

SCHEMA = "doc_id long, text string, lang string, n_chars long"
ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "a b"), (904, "A b"), (None, "no id here at all, sir")]


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", len(t or "")) for d, t in rows], SCHEMA)


def noisy(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words))
        words[i:i + 1] = [rng.choice(vocabulary)] if rng.random() < 0.6 or len(words) < 3 else []
    return words


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(200)]
    rows = []
    for size in (3, 5, 9, 40, 60, 60, 300):
        base = [rng.choice(vocabulary) for _ in range(size)]
        rows += [" ".join(noisy(rng, base, rng.randrange(4), vocabulary)) for _ in range(14)]
    return list(enumerate(rows)) + ODD


def test_shingles_do_not_depend_on_segments(monkeypatch, corpus):
    texts = [t for _, t in corpus] + ["x" * 5000 + " end of it all now"]
    whole = shingles.shingle_sets(pa.array(texts))
    assert [len(s) for s in whole] == [len(plain(t)) for t in texts]
    monkeypatch.setattr(shingles, "SEGMENT", 64)
    assert all((a == b).all() for a, b in zip(whole, shingles.shingle_sets(pa.array(texts))))


@pytest.mark.parametrize("tree_sets", [4, 512])
def test_jaccard(spark, corpus, monkeypatch, tree_sets):
    monkeypatch.setattr(jaccard, "TREE_SETS", tree_sets)
    rows = corpus + corpus[:3]
    sets = {d: plain(t) for d, t in corpus if d is not None}
    link = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    want = classes(sorted(sets), link)
    got = jaccard.components(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all((r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id]) for r in got if r.doc_id is not None)
    assert jaccard.components(docs_of(spark, [])).count() == 0


def test_decontamination(spark, corpus):
    texts = [t for d, t in corpus if d is not None]
    items = [(i, " ".join(t.split()[5:45])) for i, t in enumerate(texts) if t and len(t.split()) >= 50][:8] + [(70, "a b"), (71, None), (72, "")]
    long = " ".join(f"q{i}" for i in range(3000)) + " " + items[0][1] + " " + " ".join(f"r{i}" for i in range(3000))
    rows = corpus + [(950, long)]
    want = {
        (d, i, len(q), len(q & plain(t))) for d, t in rows for i, q in ((i, plain(x)) for i, x in items) if q and 100 * len(q & plain(t)) >= 80 * len(q)
    }
    bench = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    got = decontamination.contaminated(docs_of(spark, rows), bench).collect()
    assert {tuple(r)[:4] for r in got} == want and len(got) == len(want) and (950, items[0][0]) in {tuple(r)[:2] for r in got}
    assert decontamination.contaminated(docs_of(spark, rows), bench.limit(0)).count() == 0
    assert decontamination.contaminated(docs_of(spark, []), bench).count() == 0


def test_edit_distance_and_line_dedup(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(9, 15))).strip() for _ in range(12)]
    pool = base + ["".join(noisy(rng, rng.choice(base), rng.randrange(5), "abcé")) for _ in range(40)]
    pairs = spark.createDataFrame([(a, b) for a in pool for b in pool[:20]], "a string, b string")
    for edits in (1, 2, 3):
        for r in pairs.select("a", "b", linededup.edit_within(pairs.a, pairs.b, edits).alias("w")).collect():
            assert r.w == (distance(r.a, r.b) <= edits), (r.a, r.b, edits)
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 6)))) for i in range(40)] + ODD
    lines = sorted({x.strip(" ") for _, t in rows for x in (t or "").split("\n") if len(x.strip(" ")) >= 8})
    of = classes(lines, lambda a, b: abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2)
    got = {r.doc_id: r for r in linededup.dedup_lines(docs_of(spark, rows).withColumnRenamed("lang", "n_lines"), 2, 8).collect()}
    seen = set()
    for doc, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        kept = []
        for x in (text or "").split("\n"):
            cls = of.get(x.strip(" "))
            if cls is None or cls not in seen:
                kept.append(x)
            seen.add(cls)
        assert got[doc].text == (None if text is None else "\n".join(kept))
        assert got[doc].n_removed == len((text or "").split("\n")) - len(kept)
    assert linededup.dedup_lines(docs_of(spark, [])).count() == 0


def test_what_the_driver_holds(spark, monkeypatch):
    # Shared shingles over some bytes are joined by a shuffle, not gathered on the driver.
    seen, checked = [], jaccard.checked
    monkeypatch.setattr(jaccard, "checked", lambda df, *rest: seen.append(checked(spark.range(1_000_000), *rest)) or checked(df, *rest))
    jaccard.groves(spark.createDataFrame([(1, 1, [1])], "d1 long, n long, keys array<long>"), spark.createDataFrame([(1,)], "key long"), 80)
    assert "ResolvedHint" not in seen[0]._jdf.queryExecution().analyzed().toString()
    # The bitmap is made as bits.
    keys = spark.range(70_000).select(F.xxhash64("id").alias("key"))
    tracemalloc.start()
    bitmap, shift = decontamination.bitmap_of(keys)
    assert tracemalloc.get_traced_memory()[1] < 24 << 20
    tracemalloc.stop()
    spots = {(r.key & (1 << 64) - 1) >> shift for r in keys.collect()}
    assert set(np.flatnonzero(np.unpackbits(bitmap, bitorder="little")).tolist()) == spots and len(bitmap) * 8 == decontamination.MOST_BITS


def test_the_driver_gives_back_what_the_fit_took(spark, monkeypatch):
    def held():
        found = re.search(r"Anonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
        return int(found[1]) >> 10

    def fit(texts, toxic, share):
        # Blocks of middle size with one that stays behind them, as in a fit: the C library keeps what is freed below it.
        blocks = [bytearray(b"x") * 100_000 for _ in range(2000)]
        kept.append(blocks.pop())
        return share

    kept = []
    monkeypatch.setattr(toxicity, "fit", fit)
    docs = docs_of(spark, [(i, f"some words {i}") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    before = held()
    toxicity.train(docs, labels)
    assert held() - before < 100


def test_near_lines_by_length(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghé") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    pool = []
    for size in (40, 59, 60, 80, 130, 200, 240):
        spaced = " ".join(rng.choice(words) for _ in range(size))[:size - 1] + "z"
        for base in (spaced, spaced.replace(" ", "x"), "ab " * (size // 3)):
            base = base.strip()
            # Runs of edits, and edits spread evenly, which leave the shortest runs between them.
            for edits in {0, 1, size // 20 - 1, size // 20, size // 20 + 1, size // 10}:
                line, even = list(base), list(base)
                for i in range(edits):
                    at = rng.randrange(len(line) - 1)
                    line[at:at + 1] = rng.choice([[], ["q"], ["q", line[at]]])
                    even[min(len(even) - 2, (2 * i + 1) * len(base) // (2 * edits))] = "w"
                pool += ["".join(line).strip(), "".join(even).strip()]
    pool = [x for x in pool if len(x) >= 40]
    docs = list(enumerate(pool))
    counts = {x: Counter(x) for x in pool}

    def near(a, b):
        edits = max(len(a), len(b)) // 20
        return (counts[a] - counts[b]).total() <= edits >= (counts[b] - counts[a]).total() and distance(a, b) <= edits

    of = classes(sorted(set(pool)), near)
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(docs_of(spark, docs)).collect()}
    seen = set()
    for d, x in docs:
        assert got[d] == (of[x] in seen), (d, len(x), x[:80])
        seen.add(of[x])
    assert len(seen) < len(set(pool)) / 2


def test_short_lines(spark):
    texts = ["All rights reserved.\nno\n\n\t", "no\nAll rights reserved\n \n\t", "on\nno\n\nThe same 18 signs.", "The same 18 signs!\non", "The same 18 signs."]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs_of(spark, list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(5)] == [texts[0], " \n\t", "on\n\nThe same 18 signs.", "The same 18 signs!", ""]


def test_keys_that_meet_no_line_are_not_written(spark, monkeypatch):
    rng = random.Random(8)
    lines = [" ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randrange(1, 9))) for _ in range(80)) for _ in range(200)]
    written, stage = [], linededup.stage

    def counted(df, label):
        out = stage(df, label)
        written.append(out.count() if "key" in out.columns else 0)
        return out

    monkeypatch.setattr(linededup, "stage", counted)
    got = linededup.dedup_lines(docs_of(spark, list(enumerate([*lines, "x" + lines[5][:-1]]))))
    assert [r.doc_id for r in got.filter("n_removed > 0").collect()] == [200]
    assert 0 < max(written) < sum(map(len, lines)) / 20 / 10


def test_line_dedup_leaves_little_on_disk(spark, monkeypatch, tmp_path):
    rng = random.Random(9)
    lines = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(40)) for _ in range(300)]
    monkeypatch.setattr(common, "work_path", lambda spark, label: f"{tmp_path}/{label}-{rng.random()}")
    before = spark.conf.get(common.CLEANUP, None)
    got = linededup.dedup_lines(docs_of(spark, list(enumerate([*lines, *("x" + line[:-1] for line in lines[:50])]))))
    assert got.filter("n_removed > 0").count() == 50 and spark.conf.get(common.CLEANUP, None) == before
    # Lines, their keys and what met are gone; links, classes and what was removed stay.
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert {"lines-classes", "lines-removed"} <= left
    assert not left & {f"lines-{x}" for x in ("facts", "known", "probes", "asked", "windows", "texts", "met", "pairs", "letters", "alike", "sides", "open")}


def test_keys_lie_on_disk_for_one_pass_at_a_time(spark, monkeypatch):
    rng = random.Random(12)
    pool = []
    # Pairs within a class of lengths and over its end.
    for size in (47, 48, *[60] * 8, *[63] * 8):
        line = "".join(rng.choice("abcdefghé") for _ in range(size))
        pool += [line, line[:7] + "q" + line[7 if size % 2 else 8:]]
    docs = docs_of(spark, list(enumerate(pool)))
    near = lambda a, b: abs(len(a) - len(b)) <= 13 and distance(a, b) <= max(len(a), len(b)) // 20
    of, seen, want = classes(sorted(set(pool)), near), set(), []
    for d, x in enumerate(pool):
        want += [(d, int(of[x] in seen))]
        seen.add(of[x])
    held, stage = [], linededup.stage

    def counted(df, label):
        out = stage(df, label)
        if label == "lines-facts":
            held.append(out.agg(F.sum(F.size("own"))).first()[0])
        return out

    monkeypatch.setattr(linededup, "stage", counted)
    monkeypatch.setattr(linededup, "PASS_KEYS", 128)
    got = linededup.dedup_lines(docs).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == want and sum(n for _, n in want) == 18
    assert len(held) == 2 and min(held) > 0.1 * sum(held)
    turns = linededup.passes(spark.createDataFrame([(n,) for n in range(1, 3000)], "n long"), linededup.Rule())
    assert [(t.first, t.part) for t in turns] == sorted({(t.first, t.part) for t in turns}) and len(turns) > 20
    # A class too large for a pass is divided by keys, each of which is in one part.
    parts = linededup.passes(spark.createDataFrame([(60,)] * 100, "n long"), linededup.Rule())
    keys = spark.range(1000).select(F.xxhash64("id").alias("key"))
    assert len(parts) == 4 and keys.filter(sum(t.has_key(F.col("key")).cast("int") for t in parts) == 1).count() == 1000
    # The shortest line that a line can pair with is in the same passes.
    assert all(linededup.Rule().shortest(n) == min(m for m in range(n + 1) if m + m // 19 >= n) for n in range(20, 700))


@pytest.mark.parametrize("bits", [12, linededup.MAP_BITS])
def test_map_of_keys(spark, monkeypatch, bits):
    monkeypatch.setattr(linededup, "MAP_BITS", bits)
    rng = random.Random(bits)
    keys = {rng.randrange(-1 << 63, 1 << 63): 1 + i % 5 for i in range(3000)}
    table = spark.createDataFrame([(k,) for k, n in keys.items() for _ in range(n)], "key long")
    found = linededup.key_map(table)
    distinct = spark.createDataFrame([(k,) for k in keys], "key long")
    assert linededup.known_to(found, distinct).count() == len(keys)
    again = found.select("_row", *[found[f"t{i}"].alias(f"b{i}") for i in range(linededup.MAP_WORDS)])
    seen = {r.key for r in linededup.known_to(again, distinct).collect()}
    assert {k for k, n in keys.items() if n > 1} <= seen
    assert bits < 27 or len(seen) < 2410
    others = spark.createDataFrame([(rng.randrange(-1 << 63, 1 << 63),) for _ in range(3000)], "key long")
    assert bits < 27 or linededup.known_to(found, others).count() < 10


def test_licenses_match_sql(spark):
    mit = "The MIT Licence (MIT)\n\nCopyright (c) 2019 Some One\n\n" + licenses.MIT.replace(",", " ,")
    rows = [(1, mit), (2, "Some words.\nreleased under THE MIT LICENCE!\nmore"), (3, "Licensed under CC BY-NC 4.0 or not"), (1, mit), *ODD]
    docs = docs_of(spark, rows)
    got = sorted((tuple(r) for r in licenses.scan(docs).collect()), key=repr)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert got == sorted(con.execute(licenses.scan_sql()).fetchall(), key=repr)
    found = {r[0]: (r[2], r[4]) for r in got}
    assert found[1][0] == "MIT" and found[2] == (None, "MIT") and found[3] == (None, "")
    assert licenses.scan(docs_of(spark, [])).count() == 0


def encoded(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary()).encode(text or "", add_special_tokens=False).ids


def test_packing_and_counts(spark, corpus):
    rows = corpus[:30] + ODD + [(960, "It's  ÉTÉ,\tl'été\x0b12 34.5 don't <|endoftext|> Σς 你好 " * 200)]
    docs = docs_of(spark, rows).repartition(3)
    pieces = packing.pack(docs, queries.vocabulary(), window=64, with_ids=True).toPandas().sort_values(["sequence_id", "offset"])
    at = (pieces.sequence_id * 64 + pieces.offset).to_numpy()
    assert at[0] == 0 and (at[1:] == (at + pieces.length)[:-1]).all() and (pieces.offset + pieces.length <= 64).all()
    assert all(zlib.crc32(x) == c and len(x) == 4 * n for x, c, n in zip(pieces.ids, pieces.ids_crc32, pieces.length))
    for doc, text in rows:
        own = pieces[pieces.doc_id.isna() if doc is None else pieces.doc_id == doc].sort_values("start")
        ids = np.frombuffer(b"".join(own.ids), "<u4").tolist()
        assert ids == [*encoded(text), 1] and (own.doc_tokens == len(ids)).all()
    sizes = sorted(len(encoded(t)) for _, t in rows)
    sums = tokencounts.suffix_sums(tokencounts.histogram(tokencounts.lengths(docs, queries.vocabulary())))
    for r in sums.collect():
        assert r.docs == sizes.count(r.n_tokens) and r.docs_longer == sum(s > r.n_tokens for s in sizes)
        assert r.truncated_total == sum(min(s, r.n_tokens) for s in sizes) and r.tokens_longer == sum(s for s in sizes if s > r.n_tokens)
    middle, cut = sums.agg(tokencounts.quantile(0.5).alias("q"), tokencounts.truncated(sums, 10).alias("t")).first()
    assert middle == sizes[(len(sizes) - 1) // 2] and cut == sum(min(s, 10) for s in sizes)
    assert packing.pack(docs_of(spark, []), queries.vocabulary()).count() == 0


def test_toxicity(spark):
    rng = random.Random(9)
    say = lambda n: [rng.choice("the and with from house tree river cloud green stone".split()) for _ in range(n)]
    insults = ["gronkel", "fralbot"]
    rows, marks = [], []
    for i in range(400):
        words = say(60)
        if i % 4 == 0:
            words[rng.randrange(60)] = rng.choice(insults)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(i % 4 == 0)))
    gapped = [(1000, "a gron-kel by the river"), (1001, "you fraxlbot"), (1002, "FRALBOT###!"), (1003, "the river and the cloud")]
    labels = spark.createDataFrame(marks + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.assessed(docs_of(spark, rows + gapped + ODD), labels).collect()}
    assert all(got[i].predicted == (i % 4 == 0) for i in range(400))
    # An inserted letter weakens the match: it scores above clean words, a stray mark changes nothing.
    assert got[1000].predicted == got[1002].predicted == 1 and got[1003].predicted == 0
    assert got[1001].score > 5 * got[1003].score
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i].score <= 1 for i in range(400))
    none = toxicity.assessed(docs_of(spark, rows[:3]), labels.filter("toxic = 0")).collect()
    assert [r.score for r in none] == [0.0] * 3
    assert toxicity.assessed(docs_of(spark, []), labels).count() == 0


def test_a_worker_keeps_what_the_last_operator_made():
    from farelake.llm.kept import kept

    made = []
    make = lambda name: lambda: made.append(name) or name
    assert [kept(k, make(k)) for k in ("a", "a", "b", "b", "a")] == ["a", "a", "b", "b", "a"] and made == ["a", "b", "a"]


def test_word_kernel_against_counted_triples():
    """The kernel equals one counted triple by triple, for words and landmarks of many lengths."""
    rng = random.Random(14)
    landmarks = ["scum", "gronkel", "fralbot", "étoile", "aaa", "abcabcabcabc"]
    words = ["".join(rng.choice("gronkelfabtscumé") for _ in range(rng.randrange(1, 20))) for _ in range(200)]
    words += [w[:i] + c + w[i:] for w in landmarks for i in range(1, len(w)) for c in "xq"] + landmarks + ["", "ab"]

    def triples(word):
        out = {}
        for i in range(len(word)):
            for b in range(2, toxicity.REACH + 1):
                for a in range(1, b):
                    if i + b < len(word):
                        key = word[i] + word[i + a] + word[i + b]
                        out[key] = out.get(key, 0) + toxicity.DECAY ** (b - 2)
        return out

    got = toxicity.Kernel(landmarks).of(words)
    for m, landmark in enumerate(landmarks):
        own = triples(landmark)
        size = sum(v * v for v in own.values())
        for word, value in zip(words, got[:, m]):
            # The word's norm takes each of its places as a triple of its own.
            places = sum(toxicity.DECAY ** (2 * (b - 2)) * (b - 1) * max(0, len(word) - b) for b in range(2, toxicity.REACH + 1))
            dot = sum(v * own.get(k, 0) for k, v in triples(word).items())
            k = dot / (size ** (1 - toxicity.BLEND / 2) * places ** (toxicity.BLEND / 2)) if places else 0
            want = min(k / toxicity.FULL, 1) ** toxicity.POWER if k >= toxicity.FLOOR else 0
            assert abs(value - want) < 1e-4 or abs(k - toxicity.FLOOR) < 1e-5, (word, landmark, value, want)


def test_insults_with_an_inserted_letter():
    rng = random.Random(10)
    say = lambda n: [rng.choice("the and with from house tree river cloud green stone".split()) for _ in range(n)]
    insults = ["gronkel", "fralbot", "wuzzick", "plimdorp"]
    texts = []
    for i in range(400):
        words = say(60)
        if i % 4 == 0:
            words[rng.randrange(60)] = insults[i // 4 % 4]
        texts.append(" ".join(words))
    model = toxicity.fit(texts, [int(i % 4 == 0) for i in range(400)], 0.25)
    scorer = toxicity.Scorer(model)
    told = [f"the house and {w[:i]}{c}{w[i:]} by the river" for w in insults for i in range(1, len(w)) for c in "xoe"]
    assert np.mean(model.probability(scorer.decisions(pa.array(told))) >= 0.5) >= 0.9
    clean = [" ".join(say(30)) for _ in range(100)] + ["gross elbow", "the plumber and the wizard", ""]
    assert (model.probability(scorer.decisions(pa.array(clean))) < 0.5).all()


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(4)
    line = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(900)}" for _ in range(n))
    item, shared, twin = line(40), line(60), line(80)
    rows = [(i, line(70)) for i in range(8)] + [(20, twin), (21, twin.replace(" ", "  ", 3)), (30, line(30) + " " + item + " " + line(30))]
    rows += [(40, shared + "\n" + line(50)), (41, line(50) + "\n" + shared), *ODD[:3]]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "n_chars"]
        seen.append({r.doc_id: r.text for r in docs.collect()})
    assert len(seen[0]) == len(rows)
    assert shared in seen[1][40] and shared not in seen[1][41]
    assert set(seen[1]) - set(seen[2]) == {21} and set(seen[2]) - set(seen[3]) == {30}
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()} == set(seen[3])


def test_encoder_remembers_and_forgets(monkeypatch):
    """Ids are those of the tokenizer for whole texts, whatever is remembered, and with special tokens and odd words in the text."""
    from farelake.llm import encoding

    rng = random.Random(3)
    words = ["<|endoftext|>", "a<|endoftext|>b", "<|start", "it's", "x" * 300, "Ünḯ", "12,5", "¿qué?", "​", "é́"]
    words += ["".join(rng.choice("abcdeé'!9") for _ in range(rng.randrange(1, 12))) for _ in range(600)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(200))) for _ in range(60)] + [None, "", " \n", "a\tb\nc"]
    encoder = encoding.Encoder(queries.vocabulary())
    want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for memo in (encoding.MEMO_BYTES, 4000):
        monkeypatch.setattr(encoding, "MEMO_BYTES", memo)
        for low in range(0, len(texts), 7):
            ids, counts = encoder.encode(pa.array(texts[low:low + 7]))
            assert ids.tolist() == [i for w in want[low:low + 7] for i in w] and counts.tolist() == [len(w) for w in want[low:low + 7]]
    encoder.mark = None
    assert encoder.encode(pa.array(texts))[0].tolist() == [i for w in want for i in w]


def test_remembered_words_take_little_memory():
    from farelake.llm import encoding

    held = lambda: tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
    texts = pa.array([" ".join(f"{a}z{i}" for a in "abcd") for i in range(20000)])
    encoder = encoding.Encoder(queries.vocabulary())
    encoder.encode(texts[:10])
    tracemalloc.start()
    before = held()
    encoder.encode(texts)
    gc.collect()
    taken = held() - before
    tracemalloc.stop()
    assert taken < 64 * 80000


@pytest.mark.parametrize("piece", [decontamination.PIECE, 4])
def test_short_items_in_long_documents(spark, monkeypatch, piece):
    """Items of one shingle up are found word for word wherever they are, also across pieces of a document."""
    monkeypatch.setattr(decontamination, "PIECE", piece)
    rng = random.Random(12)
    items = [(n * 100 + k, " ".join(f"i{n}x{k}x{j}" for j in range(n))) for n in (5, 6, 7, 9, 14, 40) for k in range(8)]
    rows = []
    for at, (item, text) in enumerate(items):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(20, 600))]
        place = rng.randrange(len(words))
        rows.append((at, " ".join(words[:place] + [text] + words[place:])))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(docs_of(spark, rows + ODD), table).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(at, item) for at, (item, _) in enumerate(items)]


def test_a_column_of_a_clashing_name_does_not_disturb(spark):
    docs = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "c", 7)], "doc_id long, text string, _gone int")
    left = corpus_pipeline.without(docs, docs.filter("doc_id = 1 OR doc_id IS NULL"), "clash")
    assert left.columns == docs.columns and sorted(r.text for r in left.collect()) == ["b", "c"]
