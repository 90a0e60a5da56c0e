"""Classification of one search attempt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions.common import ColumnLike, col

# Exception names, by the class they count as. Any other name counts as "other".
TRANSPORT_CLASSES = {
    "Timeout": "timeout", "ProxyError": "connection", "ConnectionError": "connection",
    # A request that reached its provider without an endpoint.
    "MissingEndpoint": "connection",
}

OK, STUB, NO_DATA = "ok", "stub", "data"


def block_marker(body: ColumnLike) -> Column:
    """Whether the text holds one of the block-page phrases, in any case."""
    text = F.lower(F.coalesce(col(body), F.lit("")))
    hit = F.lit(False)
    for marker in S.BLOCK_MARKERS:
        hit = hit | F.contains(text, F.lit(marker))
    return hit


def http_class(status: ColumnLike, body: ColumnLike) -> Column:
    status = col(status)
    return (
        F.when(status == 429, "429")
        .when(status >= 500, "connection")
        .when(status == 403, "429")
        .when((status == 200) & block_marker(body), "429")
        .when(status >= 400, "data")
        .otherwise(OK)
    )


def transport_class(exception: ColumnLike) -> Column:
    name = col(exception)
    out = F.when(name.isNull(), None)
    for known, cls in TRANSPORT_CLASSES.items():
        out = out.when(name == known, cls)
    return out.otherwise("other")


def payload_class(page_kind: ColumnLike, n_offers: ColumnLike, body: ColumnLike) -> Column:
    """``stub`` for a short body without payload, ``data`` for anything else unusable."""
    kind = col(page_kind)
    return (
        F.when((kind == "none") & (F.length(body) < S.STUB_BODY_CHARS), STUB)
        .when(kind.isin("none", "malformed"), NO_DATA)
        .when(col(n_offers) == 0, NO_DATA)
        .otherwise(OK)
    )


def attempt_outcome(
    has_endpoint: ColumnLike, exception: ColumnLike, http: ColumnLike, payload: ColumnLike
) -> Column:
    """``struct<error_type, stubbed, success>`` of one attempt."""
    verdict = (
        F.when(~col(has_endpoint), "no_proxy")
        .when(col(exception).isNotNull(), transport_class(exception))
        .when(col(http) != OK, col(http))
        .when(col(payload) != OK, col(payload))
    )
    stubbed = F.coalesce(verdict == STUB, F.lit(False))
    return F.struct(
        F.when(stubbed, NO_DATA).otherwise(verdict).alias("error_type"),
        stubbed.alias("stubbed"),
        F.when(verdict.isNull(), 1).otherwise(0).alias("success"),
    )


def endpoint_event(error_type: ColumnLike, stubbed: ColumnLike) -> Column:
    """What the attempt says about its endpoint: failure, rate_limited, stub, ok or nothing."""
    error = col(error_type)
    return (
        F.when(error.isNull(), "ok")
        .when(error.isin("timeout", "connection"), "failure")
        .when(error == "429", "rate_limited")
        .when(col(stubbed), "stub")
        .otherwise("none")
    )
