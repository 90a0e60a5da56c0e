"""Endpoint addresses and echo bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.functions.common import ColumnLike, col

# Fixed patterns. (?U) makes digits and word borders Unicode-aware.
IP_LIKE = r"(?U)\b(?:\d{1,3}\.){3}\d{1,3}\b"
IPV4 = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])$"
# Scheme, host and port: the host is bracketed or free of colons, extra colons may stand before the port.
ADDRESS = r"(?U)^\s*(?:(.*?)://)?(\[[^\]]*\](?=:*\s*[+-]?[0-9])|[^:\[][^:]*(?=:)):*\s*([+-]?[0-9]+)\s*/*\s*$"


def strip(c: ColumnLike) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def normalise_endpoint(protocol: ColumnLike, raw: ColumnLike) -> Column:
    """``scheme://host:port`` or NULL."""
    part = lambda i: F.regexp_extract(col(raw), ADDRESS, i)
    named = F.contains(col(raw), F.lit("://"))
    scheme = F.when(named, F.lower(part(1))).otherwise(col(protocol))
    port = part(3).try_cast("int")
    usable = scheme.isin(*S.ENDPOINT_SCHEMES) & port.between(1, 65535)
    return F.when(usable, F.concat(scheme, F.lit("://"), part(2), F.lit(":"), port.cast("string")))


def is_ipv4(c: ColumnLike) -> Column:
    return F.rlike(col(c), F.lit(IPV4))


def is_ipv6(c: ColumnLike) -> Column:
    """Full, shortened, scoped and IPv4-tailed IPv6 literals."""
    text = col(c)
    scope_ok = F.rlike(text, F.lit(r"^[^%]*(%[^%]+)?$"))
    address = F.regexp_replace(text, "%.*$", "")
    tail = F.substring_index(address, ":", -1)
    has_v4_tail = F.contains(tail, F.lit("."))
    address = F.when(has_v4_tail & is_ipv4(tail), F.regexp_replace(address, "[^:]+$", "0:0")).otherwise(address)
    groups = F.split(address, ":", -1)
    filled = F.filter(groups, lambda g: g != "")
    hex_only = F.forall(filled, lambda g: F.rlike(g, F.lit("^[0-9A-Fa-f]{1,4}$")))
    gaps = F.regexp_count(address, F.lit("::"))
    lone_edge = F.rlike(address, F.lit("^:(?!:)|(?<!:):$|:::"))
    fits = F.when(gaps == 0, (F.size(groups) == 8) & (F.size(filled) == 8)).otherwise(
        (gaps == 1) & (F.size(filled) <= 7)
    )
    return F.contains(text, F.lit(":")) & scope_ok & hex_only & ~lone_edge & fits


def is_ip(c: ColumnLike) -> Column:
    return is_ipv4(c) | is_ipv6(c)


def extract_ip(body: ColumnLike) -> Column:
    """The first valid address: JSON string fields first, then IPv4 literals in the text."""
    body = col(body)
    doc = F.try_parse_json(body)
    candidates = []
    for field in S.ECHO_FIELDS:
        value = F.try_variant_get(doc, f"$.{field}", "variant")
        text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(doc, f"$.{field}", "string"))
        candidates.append(strip(F.substring_index(text, ",", 1)))
    from_json = F.get(F.filter(F.array(*candidates), lambda x: x.isNotNull() & is_ip(x)), F.lit(0))
    from_text = F.get(
        F.filter(F.regexp_extract_all(body, F.lit(IP_LIKE), F.lit(0)), lambda x: is_ipv4(x)), F.lit(0)
    )
    return F.coalesce(from_json, from_text)


def probe_reason(failed: ColumnLike, status: ColumnLike, body: ColumnLike, real_ip: Column | str = "") -> Column:
    """Why a probe does not count, or NULL when it does."""
    from farelake.functions.outcomes import block_marker

    status, exit_ip = col(status), extract_ip(body)
    own = F.lit(real_ip) if isinstance(real_ip, str) else real_ip
    return (
        F.when(col(failed), "failure")
        .when(status == 407, "auth")
        .when(status == 403, "blocked")
        .when(status == 429, "rate_limited")
        .when(status != 200, F.concat(F.lit("http_"), status.cast("string")))
        .when(exit_ip.isNull(), "bad_body")
        .when((own != "") & (exit_ip == own), "transparent")
        .when(block_marker(body), "block_marker")
    )


def quality_score(latency_ms: ColumnLike) -> Column:
    """Pool weight of a validated endpoint; NULL (drop) for the 0.0 that means too few probes."""
    latency = col(latency_ms)
    score = (
        F.when(latency < S.FAST_MS, 1.0 + S.FAST_BONUS)
        .when(latency < S.SLOW_MS, 1.0 + S.SLOW_BONUS)
        .otherwise(1.0)
    )
    return F.when(latency != 0.0, F.greatest(F.lit(S.MIN_QUALITY), score))
