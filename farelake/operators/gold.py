"""Price questions over silver: every window runs over pre-aggregated rows of one itinerary.

An itinerary is a state key; it has at most one row per snapshot day after ``cheapest_snapshot``, so
the windows below see as many rows as days on sale, however many offers the days had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators.scaling import percentiles

SNAPSHOT = ("snapshot_date",)
ITINERARY = S.PK
# Prices of different currencies are never compared, added or ranked together.
CURRENCY = ("currency",)
MONEY = "decimal(18,4)"


def money_sum(price: str = "price") -> Column:
    """Sum of prices that does not depend on the order of addition."""
    return F.sum(F.col(price).cast(MONEY))


def mean(price: str = "price") -> Column:
    return money_sum(price).cast("double") / F.nullif(F.count(price), F.lit(0))


def mean_over(w, price: str = "price") -> Column:
    return money_sum(price).over(w).cast("double") / F.nullif(F.count(price).over(w), F.lit(0))


def bad_offer() -> Column:
    """A row with an unreadable departure, or without a positive price."""
    day = F.when(F.rlike("dep_date", F.lit(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")), F.try_to_date("dep_date"))
    return day.isNull() | F.coalesce(F.col("price") <= 0, F.lit(True))


def in_currency(offers: DataFrame) -> DataFrame:
    """``offers`` with a currency each: where none is told, the default one."""
    told = F.col("currency") if "currency" in offers.columns else F.lit(None).cast("string")
    return offers.withColumn("currency", F.coalesce(told, F.lit(S.DEFAULT_CURRENCY)))


def offer_facts(offers: DataFrame) -> DataFrame:
    """Clean offers with calendar fields; a copy of an offer already seen counts once.

    An offer is told from the others of its search by ``offer_pos`` and ``currency``; without positions only rows that agree in
    everything are copies.
    """
    good = in_currency(offers).filter(~bad_offer())
    once = good.dropDuplicates([*ITINERARY, "snapshot_date", "seq", "offer_pos", "currency"]) if "offer_pos" in good.columns else good.dropDuplicates()
    dated = once.withColumn("dep_day", F.to_date("dep_date"))
    return (
        dated.withColumn("lead_days", F.datediff("dep_day", "snapshot_date"))
        .withColumn("dep_month", F.month("dep_day"))
        .withColumn("dep_weekday", F.weekday("dep_day"))
    )


def quarantined_offers(offers: DataFrame) -> DataFrame:
    return offers.filter(bad_offer())


def cheapest_snapshot(offers: DataFrame) -> DataFrame:
    """Lowest offer per itinerary, currency and snapshot day; the earlier arrival wins a tie.

    Offers without a price count, and never win; a day with no price at all has a NULL one.
    """
    best = F.min(F.when(F.col("price").isNotNull(), F.struct("price", "seq", "primary_airline_name")))
    return (
        in_currency(offers).groupBy(*ITINERARY, *CURRENCY, *SNAPSHOT)
        .agg(best.alias("_b"), F.count(F.lit(1)).alias("n_offers"))
        .select(
            *ITINERARY, *CURRENCY, *SNAPSHOT,
            F.col("_b.price").alias("price"), F.col("_b.primary_airline_name").alias("airline"), "n_offers",
        )
    )


def _over_time() -> Window:
    return Window.partitionBy(*ITINERARY, *CURRENCY).orderBy("snapshot_date")


def price_trend(snapshots: DataFrame) -> DataFrame:
    """Change against the previous snapshot and the mean of the last three."""
    return (
        snapshots.withColumn("prev_price", F.lag("price").over(_over_time()))
        .withColumn("change", F.col("price") - F.col("prev_price"))
        .withColumn("mean_3", mean_over(_over_time().rowsBetween(-2, 0)))
    )


def route_comparison(offers: DataFrame) -> DataFrame:
    """Offers, lowest, mean and median price per route, type and currency, ranked by mean price per type and currency."""
    keys = ["route", "flight_type", *CURRENCY]
    # All of it from one pass that counts equal prices.
    paid = F.sum(F.col("_v").cast(MONEY) * F.col("_cnt").cast("decimal(12,0)")).cast("double")
    totals = {
        "n_offers": F.sum("_cnt"), "min_price": F.min("_v"),
        "mean_price": paid / F.nullif(F.sum(F.when(F.col("_v").isNotNull(), F.col("_cnt"))), F.lit(0)),
    }
    summary = percentiles(in_currency(offers), keys, "price", {"median_price": 0.5}, totals)
    by_mean = Window.partitionBy("flight_type", *CURRENCY).orderBy("mean_price")
    return summary.withColumn("rank", F.rank().over(by_mean))


def route_rollup(offers: DataFrame) -> DataFrame:
    """The same totals per route and type, per route, and over all, each per currency."""
    sets = [["currency", "route", "flight_type"], ["currency", "route"], ["currency"]]
    return in_currency(offers).groupingSets([[F.col(c) for c in s] for s in sets], "currency", "route", "flight_type").agg(
        F.count(F.lit(1)).alias("n_offers"), F.min("price").alias("min_price"), mean().alias("mean_price")
    )


def seasonal(facts: DataFrame) -> DataFrame:
    """Prices per route, currency, month and weekday of departure (Monday is 0)."""
    return in_currency(facts).groupBy("route", *CURRENCY, "dep_month", "dep_weekday").agg(
        F.count(F.lit(1)).alias("n_offers"), F.min("price").alias("min_price"), mean().alias("mean_price")
    )


def lead_bucket(lead_days: Column | str) -> Column:
    days = F.col(lead_days) if isinstance(lead_days, str) else lead_days
    return (
        F.when(days < 0, "past").when(days <= 30, "0-30").when(days <= 60, "31-60").when(days <= 90, "61-90")
        .when(days > 90, "91+").otherwise("unknown")
    )


def booking_window(facts: DataFrame) -> DataFrame:
    """Mean price per route, currency and lead-time bucket, also as an index of the route's mean. Offers without a price have no part in means."""
    per_bucket = in_currency(facts).groupBy("route", *CURRENCY, lead_bucket("lead_days").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_offers"), F.count("price").alias("_n"), money_sum().alias("_sum")
    )
    route = Window.partitionBy("route", *CURRENCY)
    route_mean = F.sum("_sum").over(route).cast("double") / F.nullif(F.sum("_n").over(route), F.lit(0))
    return (
        per_bucket.withColumn("mean_price", F.col("_sum").cast("double") / F.nullif(F.col("_n"), F.lit(0)))
        .withColumn("price_index", F.col("mean_price") / route_mean)
        .drop("_sum", "_n")
    )


def airline_comparison(offers: DataFrame) -> DataFrame:
    """Offers, distinct itineraries and mean price per route, currency and airline, ranked within the route and currency."""
    keys = ["route", *CURRENCY, "primary_airline_name"]
    per_itinerary = in_currency(offers).groupBy(*keys, "dep_date", "return_date", "flight_type").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("price").alias("_n"), money_sum().alias("_sum")
    )
    per_airline = per_itinerary.groupBy(*keys).agg(
        F.sum("_rows").alias("n_offers"), F.count(F.lit(1)).alias("n_itineraries"),
        (F.sum("_sum").cast("double") / F.nullif(F.sum("_n"), F.lit(0))).alias("mean_price"),
    )
    by_mean = Window.partitionBy("route", *CURRENCY).orderBy(F.col("mean_price").asc_nulls_last())
    return per_airline.withColumn("rank", F.rank().over(by_mean))


#: Sketches of 2**12 registers: the relative error of an estimate is 1.04 / 64 or about 1.6 % (one standard deviation).
SKETCH_BITS = 12


def airline_sketches(facts: DataFrame) -> DataFrame:
    """Per route, currency, airline and day: offers, and a sketch of the itineraries that can be merged with others."""
    itinerary = F.concat_ws("|", "dep_date", "return_date", "flight_type")
    return in_currency(facts).groupBy("route", *CURRENCY, "primary_airline_name", "snapshot_date").agg(
        F.count(F.lit(1)).alias("n_offers"), F.hll_sketch_agg(itinerary, F.lit(SKETCH_BITS)).alias("itineraries")
    )


def airlines_between(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """Offers and about how many itineraries each airline had on a route from one day to another, both included.

    Only the stored sketches of those days are read and merged; ``error`` is the relative standard error of the estimate.
    """
    days = F.col("snapshot_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return sketches.filter(days).groupBy("route", *CURRENCY, "primary_airline_name").agg(
        F.sum("n_offers").alias("n_offers"), F.hll_sketch_estimate(F.hll_union_agg("itineraries")).alias("about"),
        F.lit(1.04 / 2 ** (SKETCH_BITS / 2)).alias("error"),
    )


def price_anomaly(snapshots: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Distance of each price from the seven snapshots before it, in standard deviations."""
    trailing = _over_time().rowsBetween(-7, -1)
    n, price = F.count("price").over(trailing), F.col("price").cast(MONEY)
    total = F.sum(price).over(trailing).cast(MONEY)
    squares = F.sum(price * price).over(trailing).cast("decimal(28,8)")
    # n times the sum of squares minus the squared sum, without rounding, is n squared times the variance.
    spread = F.sqrt((squares * n.cast("decimal(4,0)") - total * total).cast("double")) / n
    return (
        snapshots.withColumn("mean_7", mean_over(trailing))
        .withColumn("sd_7", spread)
        .withColumn("z", F.when(F.col("sd_7") > 0, (F.col("price") - F.col("mean_7")) / F.col("sd_7")))
        .withColumn("anomaly", F.coalesce(F.abs("z") > threshold, F.lit(False)))
    )


def forecast_features(snapshots: DataFrame) -> DataFrame:
    """Lagged prices, lead time and the next price as label."""
    w = _over_time()
    return (
        snapshots.withColumn("lag_1", F.lag("price", 1).over(w))
        .withColumn("lag_2", F.lag("price", 2).over(w))
        .withColumn("lag_3", F.lag("price", 3).over(w))
        .withColumn("lead_days", F.datediff(F.to_date("dep_date"), "snapshot_date"))
        .withColumn("label", F.lead("price", 1).over(w))
    )


def stale_age(offers: DataFrame, as_of: str) -> DataFrame:
    """Days since each itinerary was last seen."""
    seen = offers.groupBy(*ITINERARY).agg(F.max("snapshot_date").alias("last_seen"))
    return seen.withColumn("age_days", F.datediff(F.lit(as_of).cast("date"), "last_seen"))
