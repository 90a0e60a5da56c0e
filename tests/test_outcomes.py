from pyspark.sql import functions as F

from farelake.functions import outcomes
from farelake.functions.common import bundle_name, epoch_micros, floor_div, format_duration, route_key
from farelake.operators import attempts as at

LONG = "x" * 1024


RESPONSES = [
    (429, "", "429"), (500, "", "connection"), (503, "captcha", "connection"), (403, "", "429"), (400, "", "data"),
    (404, "captcha", "data"), (200, "Unusual TRAFFIC here", "429"), (200, "Access Denied", "429"), (200, "fine", "ok"),
    (302, "captcha", "ok"), (200, None, "ok"),
]


def test_http_class(spark):
    df = spark.createDataFrame(RESPONSES, "status int, body string, cls string")
    got = df.select("status", "body", outcomes.http_class("status", "body")).collect()
    assert [tuple(r) for r in got] == RESPONSES


GOOD = '[[],[],[[{"price":1}]],null]'


EXCHANGES = [
    (False, None, 200, GOOD, ("no_proxy", False, 0)),
    (True, "Timeout", 200, GOOD, ("timeout", False, 0)),
    (True, "ProxyError", 200, GOOD, ("connection", False, 0)),
    (True, "ConnectionError", 200, GOOD, ("connection", False, 0)),
    (True, "KeyError", 200, GOOD, ("other", False, 0)),
    (True, "MissingEndpoint", None, None, ("connection", False, 0)),
    (True, None, 429, GOOD, ("429", False, 0)),
    (True, None, 200, "short", ("data", True, 0)),
    (True, None, 200, LONG, ("data", False, 0)),
    (True, None, 200, LONG[1:], ("data", True, 0)),
    (True, None, 200, "[[],[]]", ("data", False, 0)),
    (True, None, 200, "[[],[],[5],null]", ("data", False, 0)),
    (True, None, 200, "[[],[],null,null]", ("data", False, 0)),
    (True, None, 200, '[[],[],[[{"price":"x"}]],null]', ("data", False, 0)),
    (True, None, 200, GOOD, (None, False, 1)),
    (True, None, 302, GOOD, (None, False, 1)),
]


def test_attempt_outcome(spark):
    df = spark.createDataFrame(
        [e[:4] for e in EXCHANGES], "has_endpoint boolean, exception string, status int, body string"
    )
    got = at.classify_exchanges(df).select(*df.columns, "error_type", "stubbed", "success").collect()
    assert [(*r[:4], tuple(r[4:])) for r in got] == EXCHANGES


BLAME = [
    ("timeout", False, "failure"), ("connection", False, "failure"), ("429", False, "rate_limited"), ("data", True, "stub"),
    ("data", False, "none"), ("other", False, "none"), ("no_proxy", False, "none"), (None, False, "ok"),
]


def test_blame(spark):
    df = spark.createDataFrame(BLAME, "e string, s boolean, v string")
    assert [tuple(r) for r in df.select("e", "s", outcomes.endpoint_event("e", "s")).collect()] == BLAME


LOG = "k string, round int, attempt int, success int, error_type string, flights string, searched_at string"


def fold(spark, *rows):
    return at.fold_attempts(spark.createDataFrame(list(rows), LOG), ["k"]).collect()[0]


def test_first_success_wins_and_later_attempts_do_not_count(spark):
    r = fold(spark, ("a", 0, 1, 1, None, "[2]", "t1"), ("a", 0, 0, 0, "timeout", None, "t0"), ("a", 0, 2, 1, None, "[3]", "t2"))
    assert (r.success, r.retries, r.flights, r.error_type, r.searched_at) == (1, 2, "[2]", None, "t0")


def test_third_attempt_and_retry_rounds(spark):
    r = fold(spark, *[("a", 1, i, int(i == 2), None if i == 2 else "timeout", "[1]", "t") for i in range(3)])
    assert (r.success, r.retries) == (1, 3)
    r = fold(spark, *[("a", 1, i, 0, e, None, "t") for i, e in enumerate(["timeout", "429", "data"])])
    assert (r.success, r.retries, r.error_type, r.flights) == (0, 6, "data", None)


def test_final_state_is_the_last_round(spark):
    log = spark.createDataFrame(
        [("a", 0, 0, 1, None, "[1]", "t0"), ("a", 1, 0, 0, "429", None, "t1"), ("b", 0, 0, 0, "data", None, "t0")], LOG
    )
    got = {r.k: (r.success, r.error_type, r.searched_at) for r in at.final_state(log, ["k"]).collect()}
    assert got == {"a": (0, "429", "t1"), "b": (0, "data", "t0")}


DURATIONS = [
    (0, "0s"), (45, "45s"), (70, "1m10s"), (300, "5m00s"), (3729.5, "1h02m"), (7200, "2h00m"), (59.9, "59s")
]


def test_format_duration(spark):
    df = spark.createDataFrame([(float(x), t) for x, t in DURATIONS], "s double, t string")
    assert [r[0] for r in df.select(format_duration("s")).collect()] == [t for _, t in DURATIONS]


def expected_reports(total, step=5):
    due, out = step, []
    for done in range(1, total + 1):
        pct = done * 100 // total
        if pct >= due:
            out.append(done)
            due = pct + step
    return sorted({*out, total})


def test_progress_steps(spark):
    sizes = [1, 2, 3, 7, 19, 20, 21, 99, 100, 101, 250, 1234]
    df = spark.createDataFrame([(n, i) for n in sizes for i in range(n)], "run int, seq long").withColumn(
        "ts", F.timestamp_add("SECOND", F.col("seq"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"))
    )
    rows = at.progress_steps(df, "run", "seq", "ts", block=16).orderBy("done").collect()
    for n in sizes:
        got = [r for r in rows if r.run == n]
        assert [r.done for r in got] == expected_reports(n)
        assert got[-1].pct == 100 and got[-1].elapsed_s == n - 1
        if n > 1:
            assert got[-1].rate == n / (n - 1) and got[-1].eta == "0s"


def test_small_functions(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 02:30:00.000001' AS ts, -7 AS v")
    r = df.select(
        route_key(F.lit("SIN"), F.lit("KUL")).alias("k"), bundle_name("ts").alias("b"),
        epoch_micros("ts").alias("us"), floor_div("v", 3).alias("d"),
    ).collect()[0]
    assert tuple(r) == ("SIN|KUL", "search_20240331_023000", 1711852200000001, -3)
