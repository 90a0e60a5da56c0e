"""The perfect hash by its law, the prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from farelake.llm import tries
from llm.helpers import WORD

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def brute(rows):
    own, nodes, kids = defaultdict(list), defaultdict(list), defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = turns.get(c - int(np.fmod(c, 20)), [])[:h] + mine[h:]
        for d in range(len(whole) + 1):
            nodes[tuple(whole[:d])].append((c, len(whole)))
    for node in nodes:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(nodes, key=len, reverse=True):
        members = nodes[node]
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + ((len(members) - 1) * len(WORD.findall(node[-1][1])) if node else 0)
        ends = ",".join(str(c) for c in sorted(c for c, size in members if size == len(node)))
        out.append((
            min(members)[0], len(node), min(nodes[node[:-1]])[0] if node else None, len(members), len(kids[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(spark, rows, depths, **more):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in tries.prefix_trie(df, depths).collect()), key=repr)


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(11)
    rows = []
    for c in list(range(-25, 60)) + [10**12, 10**12 + 3]:
        if c in (20, 47):
            continue
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t * 3, rng.choice(["user", "assistant"]), rng.choice(["Hello there", "Go on\tplease now", "Why"])))
    rows += [(5, None, None, None), (5, None, "user", ""), (6, 2, "user", "tie"), (6, 2, "user", "other tie"), (None, 1, "user", "nobody's")]
    return rows + rows[:9]


@pytest.mark.parametrize("depths", [2, 4096])
def test_trie(spark, talks, depths, monkeypatch):
    monkeypatch.setattr(tries, "SHARD_ROWS", 200)
    monkeypatch.setattr(tries, "ID_BITS", 3)
    assert found(spark, talks, depths) == brute(talks)


def test_one_conversation_of_most_turns(spark):
    """Long conversations, one in the path of another, and a first turn that all share."""
    rows = [(40, t, "user", f"line {t % 50}") for t in range(900)] + [(60, t, "user", f"line {t % 50}") for t in range(500)]
    rows += [(61, t, "user", "word " * 2000) for t in range(7)] + [(c, t, "user", f"line {t}") for c in range(100, 160) for t in range(3)]
    assert found(spark, rows, 64) == brute(rows)


def test_turnless_and_empty(spark):
    # Of these some take all they have from a first conversation that does not exist.
    rows = [(c, 0, "user", "alone") for c in range(1001, 1019)]
    got = found(spark, rows, 4096)
    assert got == brute(rows) and next(r for r in got if r[1] == 0)[7] != hashlib.sha256(b"").hexdigest()
    assert found(spark, [], 4096) == [] and found(spark, [(None, 1, "a", "b")], 4096) == []


def test_perfect_hash():
    rng = np.random.default_rng(4)
    high, low = rng.integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    high[:40] = high[0]
    table = tries.PerfectHash(high, low)
    slots = table.slots(high, low)
    assert sorted(slots) == list(range(5000))
    assert (table.slots(low, high) == -1).all() and (table.slots(high, low + np.uint64(1)) == -1).all()
    assert len(tries.PerfectHash(high[:0], low[:0]).slots(high, low)) == 5000
    with pytest.raises(ValueError):
        tries.PerfectHash(high[[1, 1]], low[[1, 1]])


def test_digests_that_meet_are_told():
    one = {name: [1, 1] for name in ("x1", "x2", "p1", "p2", "depth", "words", "conv_id")}
    assert len(list(tries.count_members([pa.RecordBatch.from_pydict(one)]))[0]) == 1
    with pytest.raises(ValueError):
        list(tries.count_members([pa.RecordBatch.from_pydict({**one, "words": [1, 2]})]))
