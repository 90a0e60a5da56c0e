"""Offers as rows: decoding, selection and round-trip pairing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions import payload
from farelake.operators.scaling import top_n


def extract_offers(responses: DataFrame, body: str = "payload") -> DataFrame:
    """Raw rows of both pages, one per row with its position; ``kind`` says why a response has none."""
    paged = responses.withColumn("_page", payload.payload_struct(body))
    return paged.select(
        *[c for c in responses.columns if c != body],
        F.col("_page.kind").alias("kind"),
        F.posexplode_outer("_page.raw").alias("pos", "raw"),
    )


def parse_offers(responses: DataFrame, body: str = "payload") -> DataFrame:
    """Responses with ``kind`` and the offers that decode, in order."""
    paged = responses.withColumn("_page", payload.payload_struct(body))
    return paged.select(
        *[c for c in responses.columns if c != body],
        F.col("_page.kind").alias("kind"),
        payload.decode_offers("_page.raw").alias("offers"),
    )


def one_way_offers(responses: DataFrame, body: str = "payload") -> DataFrame:
    """Responses with at least one offer, as the JSON text that is stored."""
    parsed = parse_offers(responses, body)
    # As a generator, so that the offers are decoded once and not again for a filter.
    found = F.explode(F.filter(F.array("offers"), lambda o: F.size(o) > 0)).alias("offers")
    other = [c for c in parsed.columns if c not in ("kind", "offers")]
    return parsed.select(*other, found).select(*other, F.to_json("offers").alias("flights"))


def top_outbound(outbound: DataFrame, n: int = 3, task: Sequence[str] = ("task_id",)) -> DataFrame:
    """The first ``n`` outbound options of each task in the order given, not by price."""
    return top_n(outbound, task, ["out_pos"], n)


#: What merging changes; the other fields are those of the outbound offer.
MERGED = ("legs", "price", "duration", "stops", "booking_token")


def round_trip_pairs(outbound: DataFrame, inbound: DataFrame, n: int = 3) -> DataFrame:
    """Each selected outbound option with its return options, merged into whole offers: every offer field that ``outbound`` has is kept.

    One row per pair, so an option with very many returns stays many rows; its join partition is split
    by Spark's skew join. Failed expansions pair with nothing.
    """
    out = top_outbound(outbound, n).filter(F.col("expand_error").isNull())
    changed = [c for c in MERGED if c in outbound.columns and c in inbound.columns]
    back = inbound.select("out_id", "in_pos", *[F.col(c).alias(f"in_{c}") for c in changed])
    merge = {
        "legs": lambda: F.concat(*[F.coalesce(c, F.array().cast(outbound.schema["legs"].dataType)) for c in ("legs", "in_legs")]),
        "price": lambda: payload.merged_price("price", "in_price"),
        "duration": lambda: F.col("duration") + F.col("in_duration"),
        "stops": lambda: F.col("stops") + F.col("in_stops"),
        "booking_token": lambda: payload.merged_token("booking_token", "in_booking_token"),
    }
    fields = [c for c in S.OFFER.names if c in outbound.columns]
    return out.join(back, "out_id").select(
        "task_id", "out_id", "out_pos", "in_pos", *[merge[c]().alias(c) if c in changed else F.col(c) for c in fields]
    )


def expand_outcome(outbound: DataFrame, inbound: DataFrame, n: int = 3) -> DataFrame:
    """Per task: success with any pair; else the first failed expansion's error; else ``data``.

    Return options are counted per outbound option before the join, so no pair is built for counting.
    """
    out = top_outbound(outbound, n)
    returns = inbound.groupBy("out_id").agg(F.count(F.lit(1)).alias("n_in"))
    joined = out.join(returns, "out_id", "left")
    pairs = F.when(F.col("expand_error").isNull(), F.coalesce("n_in", F.lit(0))).otherwise(0)
    return (
        joined.groupBy("task_id")
        .agg(
            F.sum(pairs).alias("n_pairs"),
            F.min(F.when(F.col("expand_error").isNotNull(), F.struct("out_pos", "expand_error"))).alias("_err"),
        )
        .select(
            "task_id", "n_pairs",
            F.when(F.col("n_pairs") > 0, None)
            .otherwise(F.coalesce("_err.expand_error", F.lit("data"))).alias("error_type"),
            (F.col("n_pairs") > 0).cast("int").alias("success"),
        )
    )


def decode_flights(rows: DataFrame, flights: str = "flights") -> DataFrame:
    """Stored JSON text to offer structs, broken text to NULL."""
    return rows.withColumn(flights, F.from_json(flights, S.OFFERS))


def flatten_offers(rows: DataFrame, flights: str = "flights") -> DataFrame:
    """One row per offer; a row without offers stays, with NULL fields."""
    other = [c for c in rows.columns if c != flights]
    return rows.select(*other, F.posexplode_outer(flights).alias("offer_pos", "offer")).select(
        *other, "offer_pos", "offer.*"
    )


def flatten_legs(offers: DataFrame) -> DataFrame:
    """One row per leg of flattened offers."""
    other = [c for c in offers.columns if c not in ("legs", "duration")]
    return offers.select(*other, F.posexplode_outer("legs").alias("leg_pos", "leg")).select(*other, "leg_pos", "leg.*")
