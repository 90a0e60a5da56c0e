"""Sharding, top-k search and archives against brute force."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import pytest

from farelake.llm import bitslices, sharding, warc
from farelake.llm.components import connected
from llm.helpers import classes


def test_sharding(spark):
    rng = random.Random(1)
    rows = [(i, f"text {rng.randrange(90)}") for i in range(300)] + [(i, "hot") for i in range(300, 450)]
    rows += [(500, None), (501, None), (502, ""), (None, "x"), (7, rows[7][1])]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert sorted(by_shard) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    texts = dict(rows)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    where = {}
    for r in got:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    small = [len(s) for t, s in where.items() if t != "hot"]
    # Dealt by hash alone, nearly all of these groups would be cut.
    assert sum(n > 1 for n in small) < 0.6 * len(small)
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sharding_keeps_small_groups(spark):
    texts = {i: "hot" if i % 3 == 0 else f"text {i * 7919 % 1000}" for i in range(6000)}
    got = sharding.shard_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    sizes, where = {}, {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert len(got) == 6000 and sorted(sizes) == list(range(16)) and set(sizes.values()) == {375}
    # A cut separates one group at most.
    assert sum(len(s) > 1 for t, s in where.items() if t != "hot") <= 15


def test_sharding_moves_neighbours_together(spark, monkeypatch):
    """Passages shared by documents draw them together over the rounds, under quotas, beside a text that a third of all rows have."""
    monkeypatch.setattr(sharding, "HOT_UNITS", 4)
    rng = random.Random(5)
    passage = lambda *at: f"the passage of number {at} is long enough. "
    texts = {i: "".join(passage(i % 240, j) for j in rng.sample(range(6), 4)) + f"and some words of {i} alone" for i in range(1200)}
    texts |= {i: "hot" for i in range(1200, 1800)} | {i: passage("everywhere") + f"then {i} and others like it" for i in range(1800, 2100)}
    texts |= {2100: None, 2101: "", 2102: "x " * 200_000 + ". " + passage(3, 3)}
    kept = []
    run = sharding.propagate

    def spy(units, members, passages, *rest):
        kept.append((members, run(units, members, passages, *rest)))
        return kept[-1][1]

    monkeypatch.setattr(sharding, "propagate", spy)
    docs = spark.createDataFrame([(d, t, "a", 1) for d, t in texts.items()], "doc_id long, text string, unit string, label int")
    got = {r.doc_id: r for r in sharding.shard_documents(docs).collect()}
    members, history = kept[0]
    # A passage in more units than a shard holds links nothing, one in more than HOT_UNITS does, whole.
    units = {}
    for doc, text in texts.items():
        for x in (text or "").split(". "):
            if len(x.strip()) >= sharding.PASSAGE_CHARS and text != "hot":
                units.setdefault(x.strip(), set()).add(text)
    assert members.count() == sum(len(u) for u in units.values() if 2 <= len(u) <= len(texts) // 16)
    cuts = [sharding.cut_links(members, labels).first()[0] for labels in history]
    moved = history[-1].withColumnRenamed("label", "now").join(history[0], "unit").filter("label <> now").count()
    assert moved > 300 and cuts == sorted(cuts, reverse=True) and cuts[-1] < 0.4 * cuts[0], (moved, cuts)
    total = history[0].agg({"weight": "sum"}).first()[0]
    assert total == len(texts) and all(h.agg({"weight": "sum"}).first()[0] == total for h in history)
    # After the exact cut the shards are even and the neighbours still together.
    sizes = {}
    for r in got.values():
        sizes.setdefault(r.shard, []).append(r.slot)
    assert sorted(sizes) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    where = {}
    for x, own in units.items():
        if len(own) <= len(texts) // 16:
            where[x] = {r.shard for d, r in got.items() if texts[d] in own}
    assert sum(len(v) - 1 for v in where.values()) < 0.4 * cuts[0]


def test_a_passage_of_more_units_than_a_shard_has_rows(spark, monkeypatch):
    """It names as many shards as it needs; where other passages decide, it doesn't."""
    monkeypatch.setattr(sharding, "HOT_UNITS", 4)
    common = "this very common passage is in a third of all texts. "
    texts = {i: common + f"and {i} alone" for i in range(400)} | {i: f"only {i}" for i in range(400, 1100)}
    texts |= {i: f"the passage number {i // 2} is in two texts. " + (common if i % 4 == 0 else "") + f"{i}" for i in range(1100, 1200)} | {1200: None}
    kept = []
    run = sharding.propagate
    monkeypatch.setattr(sharding, "propagate", lambda *given: kept.append(run(*given)) or kept[-1])
    got = sharding.shard_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 16, 2).collect()
    shards = [sum(r.shard == s for r in got) for s in range(16)]
    assert len(got) == 1201 and max(shards) - min(shards) <= 1
    # 425 units need six shards of 75 rows.
    units = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("xxhash64(text) AS unit", "text", "doc_id")

    def homes(labels):
        rows = labels.join(units.filter(f"text LIKE '{common}%' OR text LIKE '%. {common}%'"), "unit").groupBy("label").count().collect()
        return sum(sorted((r["count"] for r in rows), reverse=True)[:6])

    first, *_, last = kept[0]
    assert homes(first) < 240 and homes(last) > homes(first) + 60
    where = {r.doc_id: r.shard for r in got}
    assert sum(where[i] != where[i + 1] for i in range(1100, 1200, 2)) < 5


def test_components(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    nodes = sorted({x for p in pairs if p[0] != p[1] for x in p})
    links = {frozenset(p) for p in pairs}
    want = classes(nodes, lambda a, b: frozenset((a, b)) in links)
    got = connected(spark.createDataFrame(pairs, "a long, b long"), "test")
    assert dict(got.collect()) == want and got.count() == len(nodes)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(bitslices, "BLOCK_ROWS", 64)
    monkeypatch.setattr(bitslices, "QUERY_ROWS", 4)
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.4, (300, 7)).astype(np.float32)
    vectors[40:120] = vectors[40]
    vectors[200] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(1000, None), (1020, [1.0, None] + [0.0] * 5), (1040, [float("nan")] * 7), (1060, [float("inf")] + [0.0] * 6), (1080, [1.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = {}
    for r in bitslices.top_k(df, df.filter("vec_id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = np.floor(64 * vectors.astype(float)).astype(int)
    assert sorted(got) == list(range(0, 300, 20))
    for q, found in got.items():
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(300), -scores)) if i != q][:20]
        assert sorted(found) == [(k, i, scores[i]) for k, i in enumerate(order, 1)]
    few = bitslices.top_k(df.filter("vec_id < 5"), df.filter("vec_id = 0"), 20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    # Each width among its own, and a repeated query is ranked twice.
    other = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(2000, 2030)], "vec_id long, embedding array<float>")
    both = df.unionByName(other)
    got = bitslices.top_k(both, both.filter("vec_id IN (20, 2000)").unionByName(both.filter("vec_id = 2000")), 3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got if r.query_id == 2000) == sorted(
        [(2000, k, v) for k, v in ((1, 2029), (2, 2028), (3, 2027))] * 2
    )
    assert len(got) == 9
    assert bitslices.top_k(df.limit(0), df.limit(0)).count() == 0


def test_archives_round_trip(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i % 7}</p>" * 3000 if i % 3 else None) for i in range(60)]
    rows += [(59, "http://x/59", rows[59][2]), (None, None, "<i>é</i>"), (None, "a\r\nb", "<b>"), (70, "u", "<b>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    report = warc.write_archives(pages, warc.archive_folder(spark), archive_bytes=2000)
    got = warc.read_archives(report).collect()
    assert len(got) == len(rows)
    top = {}
    for page, _, html in rows:
        top[html or ""] = max(top.get(html or "", -1), -1 if page is None else page)
    bodies = {}
    for page, _, html in rows:
        bodies.setdefault(page, set()).add(html or "")
    for r in got:
        html = next(h for h in bodies[r.page_id] if base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() == r.payload_digest)
        assert r.payload_bytes == len(html.encode())
        stored = top[html] in (-1, r.page_id)
        assert (r.record_type, r.refers_to) == (("response", None) if stored else ("revisit", top[html]))
        assert r.payload == (html.encode() if stored else None)
    # One task for each archive.
    assert warc.read_archives(report).rdd.getNumPartitions() == report.count() > 4
    assert warc.read_archives(warc.write_archives(pages.limit(0), warc.archive_folder(spark))).count() == 0


def test_damaged_archives():
    good = warc.record(1, "u", b"payload" * 99, warc.sha1(b"payload" * 99), None)
    assert [r["page_id"] for r in warc.read_records(io.BytesIO(good * 3))] == [1, 1, 1]
    text = gzip.decompress(good)
    wrong = [good[:-20], good + b"junk" * 9, gzip.compress(text.replace(b"payload", b"paYload", 1)), gzip.compress(text[:-9])]
    wrong += [gzip.compress(text.replace(b"WARC/1.1", b"HTTP/1.1")), gzip.compress(text + b"more")]
    for data in wrong:
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(data)))
