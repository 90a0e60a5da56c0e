"""Queries over payloads and round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import payload
from farelake.operators import offers as of
from farelake.plans.fixtures import fx
from farelake.plans.q_attempts import payloads
from farelake.plans.q_state import FIELD, LATEST, PK, all_offers, stored
from farelake.plans.registry import query

PARSED = payloads("fx_payloads", "payload")


@query("extract_offers", f"""
SELECT response_id, kind, NULL::INT AS pos, NULL::VARCHAR AS raw FROM {PARSED} x WHERE len(raw) = 0
UNION ALL SELECT response_id, kind, (generate_subscripts(raw, 1) - 1)::INT, unnest(raw)::VARCHAR FROM {PARSED} y
WHERE len(raw) > 0""")
def extract_offers(spark, sf):
    return of.extract_offers(fx(spark, sf, "fx_payloads")).withColumn("raw", F.to_json("raw"))


@query("parse_offers", f"""
SELECT response_id, kind, CASE WHEN kind = 'ok' THEN len(decoded)::INT END AS n_offers,
 CASE WHEN kind = 'ok' THEN coalesce(list_sum([(x->>'$.price')::DOUBLE FOR x IN decoded]), 0.0) END AS prices
FROM {PARSED} x""")
def parse_offers(spark, sf):
    parsed = of.parse_offers(fx(spark, sf, "fx_payloads"))
    total = F.aggregate("offers", F.lit(0.0), lambda acc, o: acc + o["price"])
    return parsed.select("response_id", "kind", F.size("offers").alias("n_offers"), total.alias("prices"))


@query("one_way_offers", f"""
SELECT response_id, '[' || list_aggregate([printf('{{"price":%s}}', (x->>'$.price')::DOUBLE::VARCHAR) FOR x IN decoded],
 'string_agg', ',') || ']' AS flights FROM {PARSED} x WHERE len(decoded) > 0""")
def one_way_offers(spark, sf):
    return of.one_way_offers(fx(spark, sf, "fx_payloads")).select("response_id", "flights")


TOP = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY out_pos) AS rn FROM fx_outbound) t
 WHERE rn <= 3)"""
MERGED = """nullif(coalesce(o.price, 0) + coalesce(i.price, 0), 0) AS price, o.duration + i.duration AS duration,
 o.stops + i.stops AS stops, coalesce(nullif(i.booking_token, ''), o.booking_token) AS booking_token"""


@query("top_outbound", f"SELECT task_id, out_id, out_pos, price FROM {TOP} x")
def top_outbound(spark, sf):
    return of.top_outbound(fx(spark, sf, "fx_outbound")).select("task_id", "out_id", "out_pos", "price")


@query("round_trip_pairs", f"""
SELECT o.task_id, o.out_id, o.out_pos, i.in_pos, {MERGED} FROM {TOP} o JOIN fx_inbound i ON i.out_id = o.out_id
WHERE o.expand_error IS NULL""")
def round_trip_pairs(spark, sf):
    return of.round_trip_pairs(fx(spark, sf, "fx_outbound"), fx(spark, sf, "fx_inbound"))


@query("merge_round_trip", f"""
SELECT o.out_id, i.in_pos, 2 AS n_legs, {MERGED} FROM fx_outbound o JOIN fx_inbound i ON i.out_id = o.out_id""")
def merge_round_trip(spark, sf):
    """Whole offer structs of every outbound option with every return option."""
    def offers(view, name, *keys):
        rows = fx(spark, sf, view)
        known = {c: F.col(c) for c in ("price", "duration", "stops", "booking_token")}
        leg = F.struct(*[
            (F.lit(name) if f.name == "departure_airport" else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.LEG
        ])
        known["legs"] = F.array(leg)
        fields = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.OFFER]
        return rows.select(*keys, F.struct(*fields).alias(name))

    pairs = offers("fx_outbound", "out", "out_id").join(offers("fx_inbound", "back", "out_id", "in_pos"), "out_id")
    merged = pairs.select("out_id", "in_pos", payload.merge_offers(F.col("out"), F.col("back")).alias("m"))
    return merged.select(
        "out_id", "in_pos", F.size("m.legs").alias("n_legs"),
        "m.price", "m.duration", "m.stops", "m.booking_token",
    )


@query("expand_outcome", f"""
SELECT task_id, n_pairs, CASE WHEN n_pairs > 0 THEN NULL ELSE coalesce(err, 'data') END AS error_type,
 (n_pairs > 0)::INT AS success
FROM (SELECT task_id, sum(CASE WHEN expand_error IS NULL THEN coalesce(n_in, 0) ELSE 0 END)::BIGINT AS n_pairs,
 arg_min(expand_error, out_pos) FILTER (WHERE expand_error IS NOT NULL) AS err
 FROM {TOP} o LEFT JOIN (SELECT out_id, count(*) AS n_in FROM fx_inbound GROUP BY out_id) i ON i.out_id = o.out_id
 GROUP BY task_id) x""")
def expand_outcome(spark, sf):
    return of.expand_outcome(fx(spark, sf, "fx_outbound"), fx(spark, sf, "fx_inbound"))


@query("flatten_offers", f"""
SELECT {PK}, offer_pos, {FIELD.format("price")}::DOUBLE AS price, {FIELD.format("currency")} AS currency, {FIELD.format("duration")}::INT AS duration,
 {FIELD.format("stops")}::INT AS stops, {FIELD.format("primary_airline_name")} AS primary_airline_name FROM {all_offers(LATEST)} x""")
def flatten_offers(spark, sf):
    return flattened(spark, sf).select(*S.PK, "offer_pos", "price", "currency", "duration", "stops", "primary_airline_name")


def flattened(spark, sf):
    return of.flatten_offers(of.decode_flights(stored(spark, sf).select(*S.PK, "flights")))


LEG = "json_extract_string(flights, '$[' || offer_pos || '].legs[' || leg_pos || '].{}')"


@query("flatten_legs", f"""
SELECT {PK}, offer_pos, price, leg_pos, {LEG.format("departure_airport")} AS departure_airport, {LEG.format("arrival_airport")} AS arrival_airport,
 {LEG.format("duration")}::INT AS duration FROM (SELECT *, {FIELD.format("price")}::DOUBLE AS price,
 unnest(CASE WHEN offer_pos IS NULL THEN [NULL] ELSE range(1 + offer_pos % 2) END)::INT AS leg_pos FROM {all_offers(LATEST)} o) x""")
def flatten_legs(spark, sf):
    """One row per leg of every offer; searches without offers keep a row."""
    return of.flatten_legs(flattened(spark, sf)).select(*S.PK, "offer_pos", "price", "leg_pos", "departure_airport", "arrival_airport", "duration")
