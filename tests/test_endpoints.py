import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import net
from farelake.operators import endpoints as ep

T0 = datetime(2024, 1, 1)


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr.alias("r")).collect()[0].r


NORMALISED = [
    ("http", "1.2.3.4:8080", "http://1.2.3.4:8080"), ("http", "socks5://1.2.3.4:1080", "socks5://1.2.3.4:1080"),
    ("http", "SOCKS5://1.2.3.4:1080/", "socks5://1.2.3.4:1080"), ("http", "1.2.3.4:abc", None), ("http", "1.2.3.4", None),
    ("http", "1.2.3.4:0", None), ("http", "1.2.3.4:65536", None), ("http", "1.2.3.4:-1", None), ("http", "1.2.3.4:99999", None),
    ("http", "1.2.3.4:99999999999", None), ("http", "1.2.3.4:1", "http://1.2.3.4:1"), ("http", "1.2.3.4:65535", "http://1.2.3.4:65535"),
    ("http", ":8080", None), ("ftp", "1.2.3.4:80", None), ("http", "ftp://1.2.3.4:80", None), ("http", "http:///", None),
    ("http", "[::1:8080", None), ("http", "[::1]:8080", "http://[::1]:8080"), ("http", "1.2.3.4:8080:extra", None),
    ("http", "1.2.3.4:080", "http://1.2.3.4:80"), ("http", "1.2.3.4::80", "http://1.2.3.4:80"), ("http", "1.2.3.4:8_0", None),
    ("HTTP", "1.2.3.4:80", None), ("http", "\t host:80 \r", "http://host:80"), ("http", "", None), ("http", "1.2.3.4:80.5", None),
    ("http", "1.2.3.4:+80", "http://1.2.3.4:80"), ("https", "a://b://c:1", None), ("https", "http://b://c:1", None),
]


def test_normalise(spark):
    df = spark.createDataFrame([(i, p, r) for i, (p, r, _) in enumerate(NORMALISED)], "i int, p string, r string")
    got = df.select("i", net.normalise_endpoint("p", "r").alias("u")).orderBy("i").collect()
    assert [(*case[:2], r.u) for case, r in zip(NORMALISED, got)] == NORMALISED


ADDRESSES = [
    ("1.2.3.4", True), ("255.255.255.255", True), ("256.1.1.1", False), ("01.2.3.4", False), ("1.2.3", False), ("", False),
    ("::", True), ("::1", True), ("1::", True), ("2001:db8::8:800:200c:417a", True), ("1:2:3:4:5:6:7:8", True),
    ("1:2:3:4:5:6:7", False), ("1:2:3:4:5:6:7:8:9", False), ("1::2::3", False), (":1", False), ("1:", False), (":::", False),
    ("1:2:3:4:5:6:7::", True), ("1:2:3:4:5:6:7:8::", False), ("::ffff:1.2.3.4", True), ("1:2:3:4:5:6:1.2.3.4", True),
    ("1:2:3:4:5:6:7:1.2.3.4", False), ("::1.2.3.256", False), ("fe80::1%eth0", True), ("fe80::1%", False), ("12345::", False), ("g::", False),
]


def test_is_ip_agrees_with_the_standard_library(spark):
    import ipaddress

    def known(text):
        try:
            ipaddress.ip_address(text)
            return True
        except ValueError:
            return False

    assert [(t, known(t)) for t, _ in ADDRESSES] == ADDRESSES
    got = spark.createDataFrame(ADDRESSES, "t string, ok boolean").select("t", net.is_ip("t").alias("ok")).collect()
    assert [tuple(r) for r in got] == ADDRESSES


BODIES = [
    ('{"origin": "1.2.3.4"}', "1.2.3.4"), ('{"origin": "1.2.3.4, 5.6.7.8"}', "1.2.3.4"), ('{"ip": "10.0.0.1"}', "10.0.0.1"),
    ('{"query": "::1"}', "::1"), ('{"origin": "nope", "ip": "8.8.8.8"}', "8.8.8.8"), ("my ip is 1.2.3.4\n", "1.2.3.4"),
    ("999.1.1.1 then 10.0.1.2", "10.0.1.2"), ("no address", None), ('{"query": 5}', None), ('{"ip": 1.5}', None), ("", None),
    ("::1", None), ('["1.2.3.4"]', "1.2.3.4"), ("a1.2.3.4", None), ("é1.2.3.4", None), ("1.2.3.4.5", "1.2.3.4"),
]


def test_extract_ip(spark):
    got = spark.createDataFrame(BODIES, "b string, ip string").select("b", net.extract_ip("b")).collect()
    assert [tuple(r) for r in got] == BODIES


@pytest.mark.parametrize("failed,status,body,own,reason", [
    (True, None, None, "", "failure"), (False, 407, "1.2.3.4", "", "auth"), (False, 403, "1.2.3.4", "", "blocked"),
    (False, 429, "1.2.3.4", "", "rate_limited"), (False, 500, "1.2.3.4", "", "http_500"), (False, 200, "hi", "", "bad_body"),
    (False, 200, "1.2.3.4", "1.2.3.4", "transparent"), (False, 200, "1.2.3.4", "", None), (False, 200, "1.2.3.4 Captcha", "", "block_marker"),
])
def test_probe_class(spark, failed, status, body, own, reason):
    df = spark.createDataFrame([(failed, status, body, 5.0)], "failed boolean, status int, body string, latency_ms double")
    r = ep.probe_class(df, own).collect()[0]
    assert (r.reason, r.ok_latency_ms) == (reason, 5.0 if reason is None else None)


@pytest.mark.parametrize("latency,score", [(100.0, 1.3), (500.0, 1.1), (700.0, 1.1), (1000.0, 1.0), (5000.0, 1.0), (0.0, None)])
def test_quality(spark, latency, score):
    assert one(spark, net.quality_score("v"), latency, "double") == score


def test_medians(spark):
    df = spark.createDataFrame(
        [("a", 300.0), ("a", 100.0), ("b", 5.0), ("b", None), ("c", 900.0), ("c", 100.0), ("c", 700.0), ("d", None)],
        "url string, latency_ms double",
    )
    got = {r.url: r.median_ms for r in ep.echo_median(df).collect()}
    assert got == {"a": 300.0, "b": 0.0, "c": 700.0, "d": 0.0}
    assert {r.url for r in ep.quality_scores(ep.echo_median(df)).collect()} == {"a", "c"}


def test_lists(spark, rows):
    text = "# top\n1.1.1.1:80\n\n  2.2.2.2:81 \r\nbad\nsocks4://3.3.3.3:82\n1.1.1.1:80\n"
    df = spark.createDataFrame([("s1", "http", text), ("s2", "socks5", "1.1.1.1:80\nhttp://1.1.1.1:80")], "source string, protocol string, text string")
    parsed = ep.normalise_lines(ep.split_lists(df))
    assert parsed.count() == 6
    assert rows(ep.dedup_first(parsed).select("source", "url", "protocol")) == [
        ("s1", "http://1.1.1.1:80", "http"), ("s1", "http://2.2.2.2:81", "http"), ("s1", "socks4://3.3.3.3:82", "socks4"),
        ("s2", "socks5://1.1.1.1:80", "socks5"),
    ]
    assert one(spark, ep.source_name("v"), "https://a/b://c") == "a/b://c"


def test_cap_is_repeatable_and_exact(spark, rows):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 400)).alias("source"),
        F.col("id").alias("line_no"), F.concat(F.lit("u"), F.col("id")).alias("url"),
    )
    capped = ep.cap_per_source(df, 1100, seed=1)
    sizes = {r["source"]: r["count"] for r in capped.groupBy("source").count().collect()}
    full = {r["source"]: r["count"] for r in df.groupBy("source").count().collect()}
    assert sizes == {s: min(n, 1100) for s, n in full.items()}
    assert rows(capped) == rows(ep.cap_per_source(df.repartition(3), 1100, seed=1))
    assert rows(capped) != rows(ep.cap_per_source(df, 1100, seed=2))
    assert ep.cap_per_source(df, 0).count() == 5000


def test_source_order_is_stable(spark):
    urls = ["x/plain", "x/VMHeaven", "x/databay/a", "y/plain", "x/Checked-Proxy-List/databay", "x/databay/b"]
    df = spark.createDataFrame(list(enumerate(urls)), "pos int, url string")
    assert [r.pos for r in ep.source_rank(df).collect()] == [4, 2, 5, 1, 0, 3]


def test_source_yield(spark, rows):
    df = spark.createDataFrame([("a", True, True), ("a", True, True), ("b", True, True), ("b", False, True)], "source string, alive boolean, valid boolean")
    assert rows(ep.source_yield(df)) == [("a", 2, 2, 2), ("b", 2, 1, 1)]
    assert ep.source_yield(df.filter("source = 'a'")).count() == 0
    a, b = df.filter("source = 'a'"), df.filter("source = 'b'")
    assert rows(ep.source_yield_from(df, a, b)) == [("a", 2, 2, 0), ("b", 2, 0, 2)]


@pytest.mark.parametrize("total,every,target,probed", [
    (5000, 500, 3, 1500), (5000, 500, 100, 5000), (1200, 1, 500, 500), (1200, 1, 501, 1000), (700, 10**6, 5, 700), (0, 1, 5, 0),
])
def test_prefilter_stops_after_the_batch(spark, total, every, target, probed):
    df = spark.range(total).select(F.col("id").alias("pos"), (F.col("id") % every == 0).alias("alive"))
    assert ep.prefilter_until(df, target).count() == probed


def test_valid_until(spark):
    df = spark.range(50).select(F.col("id").alias("pos"), (F.col("id") % 2 == 1).alias("valid"))
    assert [r.pos for r in ep.valid_until(df, 4).collect()] == [1, 3, 5, 7]


EVENTS = "url string, ts timestamp_ntz, probe_id long, event string"


def replay(events, counts=None):
    """The pool's bookkeeping, one event at a time."""
    n, out = {u: list(c) for u, c in (counts or {}).items()}, {}
    for url, ts, _, kind in sorted(events, key=lambda e: (e[1], e[2])):
        c, o = n.setdefault(url, [0, 0]), out.setdefault(url, [None, None, None])
        ttl = None
        if kind == "failure":
            ttl = 600
        elif kind == "rate_limited":
            c[0] += 1
            if c[0] >= 3:
                ttl = 1800
            else:
                o[2] = ts + timedelta(seconds=120)
        elif kind == "stub":
            c[1] += 1
            ttl = 1800 if c[1] >= 3 else None
        if ttl:
            o[0], o[1] = ts, ts + timedelta(seconds=ttl)
    return {u: (*n[u], *o) for u, o in out.items()}


def random_events(seed, n=400):
    rng = random.Random(seed)
    kinds = ["failure", "rate_limited", "stub", "ok"]
    return [
        (rng.choice(["hot", "hot", "a", "b", "c", f"u{i % 60}"]), T0 + timedelta(seconds=rng.randrange(300)), i, rng.choice(kinds))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_blacklist_equals_replay(spark, seed):
    events = random_events(seed)
    got = ep.evict_blacklist(spark.createDataFrame(events, EVENTS).repartition(5)).collect()
    assert {r.url: tuple(r)[1:] for r in got} == replay(events)


def test_blacklist_goes_on_from_saved_counts(spark):
    events, counts = random_events(3, 120), {"hot": (2, 0), "a": (1, 2), "b": (7, 9), "c": (0, 1)}
    saved = spark.createDataFrame([(u, *c) for u, c in counts.items()], "url string, rate_limited_count int, stub_count int")
    got = ep.evict_blacklist(spark.createDataFrame(events, EVENTS), saved).collect()
    assert {r.url: tuple(r)[1:] for r in got} == replay(events, counts)


def test_a_later_shorter_ban_replaces_a_longer_one(spark, rows):
    at = lambda s: T0 + timedelta(seconds=s)
    events = [("u", at(i), i, "rate_limited") for i in range(3)] + [("u", at(10), 9, "failure")]
    state = ep.evict_blacklist(spark.createDataFrame(events, EVENTS))
    assert state.collect()[0].blacklist_until == at(610)
    assert ep.active_blacklist(state, str(at(609))).count() == 1
    assert ep.active_blacklist(state, str(at(610))).count() == 0
    cands = spark.createDataFrame([("u",), ("v",)], "url string")
    assert rows(ep.without_blacklisted(cands, ep.active_blacklist(state, str(at(600))))) == [("v",)]


def test_pool_counts(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", T0), ("c", T0 + timedelta(seconds=1))], "url string, rate_limit_until timestamp_ntz")
    assert rows(ep.pool_counts(df, str(T0))) == [(3, 2)]


POOL = "pos long, url string, quality_score double"


@pytest.mark.parametrize("weights", [[1.0, 1.3, 1.1, 1.0], [0.0, 2.0, 0.0, 0.0, 5.0], [1.0], [0.1] * 40 + [9.0]])
def test_weighted_pick_equals_bisect(spark, weights):
    from bisect import bisect_left
    from itertools import accumulate

    pool = spark.createDataFrame([(i, f"u{i}", w) for i, w in enumerate(weights)], POOL)
    cum = list(accumulate(round(w * 1_000_000) for w in weights))
    draws = [i / 997 for i in range(998)]
    df = spark.createDataFrame(list(enumerate(draws)), "task_id long, u double")
    got = {r.task_id: r.pos for r in ep.weighted_pick(df, pool).collect()}
    first = next(i for i, w in enumerate(weights) if w > 0)
    assert got == {t: max(bisect_left(cum, u * cum[-1]), first if u == 0 else 0) for t, u in enumerate(draws)}


def test_pick_takes_turns_without_weights(spark):
    pool = spark.createDataFrame([(10, "a", 0.0), (20, "b", 0.0), (30, "c", 0.0)], POOL)
    df = spark.createDataFrame([(i, 0.5) for i in range(7)], "task_id long, u double")
    assert {r.task_id: r.url for r in ep.weighted_pick(df, pool).collect()} == {i: "abc"[i % 3] for i in range(7)}
    assert ep.weighted_pick(df, pool.limit(0)).count() == 0


@pytest.mark.parametrize("age,n,out,ok,usable,decision", [
    (1799, 50, 0, 0, 0, "adopt_fresh"), (1799, 50, 0, 0, 50, "keep_pool"), (1799, 50, 1, 0, 0, "refetch"),
    (1800, 50, 0, 50, 0, "adopt_revalidated"), (1800, 50, 0, 49, 0, "refetch"), (86399, 60, 60, 50, 0, "adopt_revalidated"),
    (86400, 60, 0, 60, 0, "refetch"),
])
def test_snapshot_decision(spark, age, n, out, ok, usable, decision):
    now = T0 + timedelta(seconds=age)
    snaps = spark.createDataFrame([("s", T0, f"u{i}") for i in range(n)], "snapshot_id string, cached_at timestamp_ntz, url string")
    url = lambda k: spark.createDataFrame([(f"u{i}",) for i in range(k)], "url string")
    r = ep.snapshot_decision(snaps, url(out), url(ok), str(now), usable).collect()[0]
    assert (r.decision, r.listed, r.kept, r.valid, r.age_s) == (decision, n, n - out, ok, float(age))


def test_adopt(spark, rows):
    old = spark.createDataFrame([("a",), ("b",)], "url string")
    new = spark.createDataFrame([("c",)], "url string")
    assert rows(ep.adopt_valid(old, new)) == [("c",)]
    assert rows(ep.adopt_valid(old, new.limit(0))) == [("a",), ("b",)]
    assert rows(ep.adopted_share(new, old)) == [(1, 2, 50.0)]
    assert rows(ep.adopted_share(new.limit(0), old.limit(0))) == [(0, 0, 0.0)]
    assert S.ENDPOINT_DEFAULTS["quality_score"] == 1.0
