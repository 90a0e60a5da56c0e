import json

import pytest
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import payload
from farelake.operators import offers as of


PAYLOADS = [
    ('[[],[],[[{"price":1},{"price":2}]],[[{"price":3}]]]', "ok", [1.0, 2.0, 3.0]),
    ('[[],[],null,[[{"price":3}]]]', "ok", [3.0]),
    ('[[],[],[],[]]', "ok", []),
    ('[[],[],[null],[[]]]', "ok", []),
    ('[[],[],[[]],0,9,9]', "ok", []),
    ('[[],[]]', "malformed", None),
    ('[[],[],[[{"price":1}]]]', "malformed", None),
    ('[[],[],[5],null]', "malformed", None),
    ('[[],[],5,null]', "malformed", None),
    ('{"a":1}', "malformed", None),
    ('{broken', "none", None),
    ("", "none", None),
    ('[[],[],[[{"price":1},{"price":"x"},7,null,{"price":null},{"legs":3},{}]],null]', "ok", [1.0, None, None]),
]


def test_payloads(spark):
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PAYLOADS)], "id int, payload string")
    got = of.parse_offers(df).orderBy("id").collect()
    prices = [None if r.offers is None else [o.price for o in r.offers] for r in got]
    assert [(p[0], r.kind, x) for p, r, x in zip(PAYLOADS, got, prices)] == PAYLOADS


def test_extract_keeps_positions_and_empty_responses(spark, rows):
    df = spark.createDataFrame([(1, '[[],[],[[{"price":1}]],[[{"price":2}]]]'), (2, "[]")], "id int, payload string")
    got = of.extract_offers(df).withColumn("raw", F.to_json("raw"))
    assert rows(got) == [(1, "ok", 0, '{"price":1}'), (1, "ok", 1, '{"price":2}'), (2, "malformed", None, None)]


def test_one_way_offers_keep_free_form_fields(spark):
    raw = {"price": 9.5, "currency": "SGD", "layovers": [{"at": "BKK"}], "primary_airline": {"code": "SQ"}, "self_transfer": True,
           "legs": [{"departure_airport": "SIN", "duration": 60}]}
    df = spark.createDataFrame([(1, json.dumps([[], [], [[raw]], None]))], "id int, payload string")
    got = json.loads(of.one_way_offers(df).collect()[0].flights)
    assert json.loads(got[0].pop("layovers")) == raw["layovers"]
    assert json.loads(got[0].pop("primary_airline")) == raw["primary_airline"]
    assert got == [{k: v for k, v in raw.items() if k not in ("layovers", "primary_airline")}]


OUT = "task_id int, out_id int, out_pos int, price double, duration int, stops int, booking_token string, expand_error string"
IN = "out_id int, in_pos int, price double, duration int, stops int, booking_token string"


def option(i, price, error=None, token=None, task=1):
    return (task, i, i, price, 60, 0, token, error)


def test_pairs_keep_outbound_order_and_take_three(spark):
    out = spark.createDataFrame([option(i, p) for i, p in enumerate([300.0, 100.0, 200.0, 50.0])], OUT)
    back = spark.createDataFrame([(i, 0, 10.0, 60, 1, "b") for i in range(4)], IN)
    got = of.round_trip_pairs(out, back).orderBy("out_pos", "in_pos").collect()
    assert [(r.price, r.duration, r.stops, r.booking_token) for r in got] == [
        (310.0, 120, 1, "b"), (110.0, 120, 1, "b"), (210.0, 120, 1, "b")
    ]
    assert of.top_outbound(out, 0).count() == 0


@pytest.mark.parametrize("errors,n_back,want", [
    (["429", None], 1, (1, None, 1)), (["429", "timeout"], 1, (0, "429", 0)), ([None, "timeout"], 0, (0, "timeout", 0)),
    ([None, None], 0, (0, "data", 0)), ([None, None], 2, (4, None, 1)),
])
def test_expand_outcome(spark, errors, n_back, want):
    out = spark.createDataFrame([option(i, 1.0, e) for i, e in enumerate(errors)], OUT)
    back = spark.createDataFrame([(i, j, 1.0, 1, 0, "") for i in range(len(errors)) for j in range(n_back)], IN)
    r = of.expand_outcome(out, back).collect()[0]
    assert (r.n_pairs, r.error_type, r.success) == want


def test_merge(spark):
    leg = ("SIN", "KUL", 60, None, None)

    def offer(p, t):
        values = {"legs": [leg], "price": p, "duration": 60, "stops": 1, "booking_token": t, "currency": "SGD"}
        return tuple(values.get(f.name) for f in S.OFFER)

    prices = [(100.0, 30.0, 130.0), (None, 30.0, 30.0), (None, None, None), (0.0, 0.0, None)]
    tokens = [("o", "i", "i"), ("o", "", "o"), ("o", None, "o"), ("", None, ""), (None, "", None)]
    cases = [(p, t) for p in prices for t in tokens]
    kind = S.OFFER.simpleString()
    df = spark.createDataFrame(
        [(i, offer(p[0], t[0]), offer(p[1], t[1])) for i, (p, t) in enumerate(cases)], f"n int, o {kind}, i {kind}"
    )
    got = df.select("n", payload.merge_offers(F.col("o"), F.col("i")).alias("m")).orderBy("n").collect()
    for (p, t), (_, m) in zip(cases, got):
        assert (m.price, m.booking_token) == (p[2], t[2])
        assert (m.duration, m.stops, m.currency, len(m.legs)) == (120, 2, "SGD", 2)


def test_flatten(spark, rows):
    text = '[{"price":5,"legs":[{"departure_airport":"SIN"},{"departure_airport":"KUL"}]},{"price":6}]'
    df = of.decode_flights(spark.createDataFrame([("a", text), ("b", None)], "k string, flights string"))
    flat = of.flatten_offers(df)
    assert rows(flat.select("k", "offer_pos", "price")) == [("a", 0, 5.0), ("a", 1, 6.0), ("b", None, None)]
    legs = of.flatten_legs(flat).select("k", "offer_pos", "leg_pos", "departure_airport")
    assert rows(legs) == [("a", 0, 0, "SIN"), ("a", 0, 1, "KUL"), ("a", 1, None, None), ("b", None, None, None)]
