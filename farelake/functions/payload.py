"""Offers inside a captured response payload, and the arithmetic of a round trip.

A payload is a list; slots 2 and 3 are pages, and the first item of a page is its list of raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions.common import ColumnLike, col, let

PAGE_SLOTS = (2, 3)
ITEMS = "array<variant>"
NEEDED_TYPES = ("price", "duration", "stops", "legs")


def _items(v: Column) -> Column:
    """The elements of a VARIANT list, NULL for anything else."""
    return F.try_variant_get(v, "$", ITEMS)


def _list(v: Column) -> Column:
    """``struct<items, blank>``: the elements if a list, and whether the value counts as empty."""
    def parts(items: Column) -> Column:
        nothing = v.isNull() | F.is_variant_null(v)
        scalar = F.to_json(v).isin("{}", "0", "0.0", '""', "false")
        blank = F.when(nothing, True).when(items.isNotNull(), F.size(items) == 0).otherwise(scalar)
        return F.struct(items.alias("items"), blank.alias("blank"))

    return let(_items(v), parts)


def _page_rows(page: Column) -> Column:
    """Rows of a page: none for an empty page, NULL for one that is not made of lists."""
    none = F.array().cast(ITEMS)
    return let(
        _list(page),
        lambda p: F.when(p["blank"], none).when(
            p["items"].isNotNull(),
            let(_list(F.get(p["items"], F.lit(0))), lambda r: F.when(r["blank"], none).otherwise(r["items"])),
        ),
    )


def payload_struct(body: ColumnLike) -> Column:
    """``struct<kind, raw>``: kind is ok, malformed or none; raw is the rows of both pages in order."""
    def read(doc: Column) -> Column:
        at = lambda path, kind: F.try_variant_get(doc, path, kind)
        # The rows of a usual page are taken in one step; only other pages are looked at level by level.
        pages = [
            F.coalesce(at(f"$[{slot}][0]", ITEMS), _page_rows(at(f"$[{slot}]", "variant"))) for slot in PAGE_SLOTS
        ]
        all_slots = at(f"$[{max(PAGE_SLOTS)}]", "variant").isNotNull()

        def judge(raw: Column) -> Column:
            kind = F.when(doc.isNull(), "none").when(raw.isNull(), "malformed").otherwise("ok")
            return F.struct(kind.alias("kind"), raw.alias("raw"))

        return let(F.when(all_slots, F.concat(*pages)), judge)

    return let(F.try_parse_json(col(body)), read)


def decode_offers(raw: ColumnLike) -> Column:
    """Raw rows to offers in order; a row that does not decode is left out, not its neighbours.

    A row decodes when it is an object, and no field of NEEDED_TYPES is there with a value of another type.
    """
    def decode(row: Column) -> Column:
        def checked(offer: Column) -> Column:
            ok = offer.isNotNull()
            for name in NEEDED_TYPES:
                value = F.try_variant_get(row, f"$.{name}", "variant")
                ok = ok & (offer[name].isNotNull() | value.isNull() | F.is_variant_null(value))
            return F.when(ok, offer)

        return let(F.try_variant_get(row, "$", S.OFFER.simpleString()), checked)

    return F.filter(F.transform(col(raw), decode), lambda offer: offer.isNotNull())


def merged_price(out_price: ColumnLike, in_price: ColumnLike) -> Column:
    """Sum with NULL as zero; a zero sum means unknown."""
    total = F.coalesce(col(out_price), F.lit(0.0)) + F.coalesce(col(in_price), F.lit(0.0))
    return F.nullif(total, F.lit(0.0))


def merged_token(out_token: ColumnLike, in_token: ColumnLike) -> Column:
    """The inbound token, or the outbound one where the inbound is NULL or empty."""
    return F.coalesce(F.nullif(col(in_token), F.lit("")), col(out_token))


def merge_offers(out: Column, inbound: Column) -> Column:
    """One round-trip offer: sums, joined legs, inbound token; the rest from the outbound offer."""
    legs = F.concat(
        F.coalesce(out["legs"], F.array().cast(S.OFFER["legs"].dataType)),
        F.coalesce(inbound["legs"], F.array().cast(S.OFFER["legs"].dataType)),
    )
    changed = {
        "legs": legs,
        "price": merged_price(out["price"], inbound["price"]),
        "duration": out["duration"] + inbound["duration"],
        "stops": out["stops"] + inbound["stops"],
        "booking_token": merged_token(out["booking_token"], inbound["booking_token"]),
    }
    return F.struct(*[changed.get(f.name, out[f.name]).alias(f.name) for f in S.OFFER.fields])
