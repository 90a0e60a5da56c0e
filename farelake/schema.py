"""Schemas and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
HUB = "SIN"
DESTINATIONS = (
    "KUL", "CGK", "BKK", "HKT", "DPS", "MNL", "SGN", "HAN",
    "NRT", "KIX", "HND", "PVG", "PEK", "ICN", "PUS",
)
RETURN_OFFSETS_DAYS = (7, 14, 21)
DEFAULT_CURRENCY = "SGD"

ONE_WAY = "ONE_WAY"
ROUND_TRIP = "ROUND_TRIP"

RETRYABLE_ERRORS = ("429", "timeout", "connection", "no_proxy", "data")
ATTEMPTS_PER_ROUND = 3
RETRY_ROUNDS = 3

BLOCK_MARKERS = ("captcha", "unusual traffic", "attention required", "access denied")
STUB_BODY_CHARS = 1024

AIRPORT_ALIASES = {"OKA": "NAH"}
EXTRA_AIRPORTS = ("YIC",)

CYCLE_ANCHOR = "2026-08-18"
CYCLE_WINDOWS = (270, 30, 60, 90)
CYCLE_SUFFIXES = ("full", "w30", "w60", "w90")

# ------------------------------------------------------------------ state table
PK = ("route", "dep_date", "return_date", "flight_type")
SEED_COLUMNS = (*PK, "origin", "destination")
STATE_COLUMNS = (*SEED_COLUMNS, "flights", "error_type", "retries", "success", "searched_at")
REQUIRED_STATE_COLUMNS = STATE_COLUMNS[:-1]
BRONZE_COLUMNS = (*SEED_COLUMNS, "flights", "searched_at")

STATE = T.StructType([
    T.StructField("route", T.StringType(), False),
    T.StructField("dep_date", T.StringType(), False),
    T.StructField("return_date", T.StringType(), False),
    T.StructField("flight_type", T.StringType(), False),
    T.StructField("origin", T.StringType(), False),
    T.StructField("destination", T.StringType(), False),
    T.StructField("flights", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("retries", T.IntegerType()),
    T.StructField("success", T.IntegerType()),
    T.StructField("searched_at", T.StringType()),
])

# ------------------------------------------------------------------------ offers
# The two free-form fields are held as JSON text.
LEG = T.StructType([
    T.StructField("departure_airport", T.StringType()),
    T.StructField("arrival_airport", T.StringType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("departure_airport_name", T.StringType()),
    T.StructField("arrival_airport_name", T.StringType()),
])
OFFER = T.StructType([
    T.StructField("legs", T.ArrayType(LEG)),
    T.StructField("price", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("stops", T.IntegerType()),
    T.StructField("layovers", T.StringType()),
    T.StructField("co2_emissions_g", T.IntegerType()),
    T.StructField("co2_emissions_typical_g", T.IntegerType()),
    T.StructField("co2_emissions_delta_pct", T.IntegerType()),
    T.StructField("emissions_tag", T.StringType()),
    T.StructField("self_transfer", T.BooleanType()),
    T.StructField("mixed_cabin", T.BooleanType()),
    T.StructField("primary_airline", T.StringType()),
    T.StructField("primary_airline_name", T.StringType()),
    T.StructField("booking_token", T.StringType()),
])
OFFERS = T.ArrayType(OFFER)

BRONZE = T.StructType([
    *[T.StructField(c, T.StringType()) for c in SEED_COLUMNS],
    T.StructField("flights", OFFERS),
    T.StructField("searched_at", T.StringType()),
])

# --------------------------------------------------------------------- endpoints
ENDPOINT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("quality_score", T.DoubleType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("last_validated", T.DoubleType()),
    T.StructField("rate_limit_until", T.DoubleType()),
    T.StructField("rate_limited_count", T.IntegerType()),
    T.StructField("stub_count", T.IntegerType()),
    T.StructField("source", T.StringType()),
])
ENDPOINT_DEFAULTS = {
    "quality_score": 1.0, "latency_ms": 0.0, "last_validated": 0.0, "rate_limit_until": 0.0,
    "rate_limited_count": 0, "stub_count": 0, "source": "",
}
SNAPSHOT = T.StructType([
    T.StructField("cached_at", T.DoubleType()),
    T.StructField("proxies", T.ArrayType(ENDPOINT)),
    # Endpoints of the whole pool, where it is spread over several objects.
    T.StructField("pool_size", T.LongType()),
])

# Fixed values of the endpoint pool and the rate budget.
SOURCE_MARKERS = ("checked-proxy-list", "databay", "proxyscrape", "vmheaven")
ENDPOINT_SCHEMES = ("http", "https", "socks4", "socks5")
ECHO_FIELDS = ("origin", "ip", "query")
PREFILTER_BATCH = 500
VALID_TARGET = 100
ALIVE_PER_VALID = 30
FAST_MS, SLOW_MS = 500, 1000
FAST_BONUS, SLOW_BONUS, MIN_QUALITY = 0.3, 0.1, 0.1
PARK_S, DEAD_TTL_S, EVICT_TTL_S = 120, 600, 1800
EVICT_AFTER = 3
SNAPSHOT_FRESH_S, SNAPSHOT_MAX_S, SNAPSHOT_MIN_POOL = 1800, 86400, 50
BURST_WINDOW_S, QUIET_WINDOW_S, BURST_SHARE = 30, 60, 0.2
RATE_BACKOFF, RATE_RECOVERY, RATE_FLOOR, RATE_CAP = 0.5, 2.0, 0.5, 200.0
