"""Price questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake.operators import gold
from farelake.plans import refresh
from farelake.plans.fixtures import fx
from farelake.plans.q_sources import GOOD, exported
from farelake.plans.q_state import FIELD, PK, all_offers
from farelake.plans.registry import query
from farelake.session import work_path
from farelake.sources import bronze, silver

MONEY = "sum(cast(price AS decimal(18,4)))"
MEAN = f"cast({MONEY} AS double) / count(*)"
BAD = "(try_cast(dep_date AS date) IS NULL OR coalesce(price <= 0, true))"
FACTS = f"""(SELECT *, cast(dep_date AS date) AS dep_day, (cast(dep_date AS date) - snapshot_date)::INT AS lead_days,
 month(cast(dep_date AS date))::INT AS dep_month, (isodow(cast(dep_date AS date)) - 1)::INT AS dep_weekday
 FROM (SELECT DISTINCT * FROM fx_offers) o WHERE NOT {BAD})"""
CHEAPEST = f"""(SELECT {PK}, currency, snapshot_date, min(price) AS price, arg_min(primary_airline_name, (price, seq, primary_airline_name)) AS airline,
 count(*) AS n_offers FROM {FACTS} f GROUP BY {PK}, currency, snapshot_date)"""
OVER = f"PARTITION BY {PK}, currency ORDER BY snapshot_date"


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def facts(spark, sf):
    """Offers of every search, without copies and without those that have no price or none above zero."""
    return gold.offer_facts(fx(spark, sf, "fx_offers"))


@query("offer_facts", f"SELECT * FROM {FACTS} x")
def offer_facts(spark, sf):
    return facts(spark, sf)


@query("cheapest_snapshot", f"SELECT * FROM {CHEAPEST} x")
def cheapest_snapshot(spark, sf):
    return gold.cheapest_snapshot(facts(spark, sf))


@query("cheapest_snapshot_raw", f"""
SELECT {PK}, currency, snapshot_date, min(price) AS price, count(*) AS n_offers,
 arg_min(primary_airline_name, (price, seq, primary_airline_name)) FILTER (WHERE price IS NOT NULL) AS airline
FROM fx_offers GROUP BY {PK}, currency, snapshot_date""")
def cheapest_snapshot_raw(spark, sf):
    """Offers as they came: those without a price count and never win."""
    return gold.cheapest_snapshot(fx(spark, sf, "fx_offers"))


@query("price_trend", f"""
SELECT {PK}, currency, snapshot_date, price, airline, n_offers, prev_price, round(price - prev_price, 6) AS change,
 round(mean_3, 6) AS mean_3 FROM (SELECT *, lag(price) OVER ({OVER}) AS prev_price,
 avg(price) OVER ({OVER} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mean_3 FROM {CHEAPEST} x) y""")
def price_trend(spark, sf):
    return rounded(gold.price_trend(cheapest_snapshot(spark, sf)), "change", "mean_3")


@query("route_comparison", f"""
SELECT *, (rank() OVER (PARTITION BY flight_type, currency ORDER BY mean_price))::INT AS rank FROM (SELECT route, flight_type, currency,
 count(*) AS n_offers, min(price) AS min_price, {MEAN} AS mean_price, round(quantile_cont(price, 0.5), 6) AS median_price
 FROM {FACTS} f GROUP BY route, flight_type, currency) x""")
def route_comparison(spark, sf):
    return rounded(gold.route_comparison(facts(spark, sf)), "median_price")


@query("route_rollup", f"""
SELECT route, flight_type, currency, count(*) AS n_offers, min(price) AS min_price, {MEAN} AS mean_price
FROM {FACTS} f GROUP BY GROUPING SETS ((currency, route, flight_type), (currency, route), (currency))""")
def route_rollup(spark, sf):
    return gold.route_rollup(facts(spark, sf))


@query("seasonal", f"""
SELECT route, currency, dep_month, dep_weekday, count(*) AS n_offers, min(price) AS min_price, {MEAN} AS mean_price
FROM {FACTS} x GROUP BY route, currency, dep_month, dep_weekday""")
def seasonal(spark, sf):
    return gold.seasonal(facts(spark, sf))


@query("booking_window", f"""
SELECT route, currency, bucket, n_offers, mean_price, mean_price / (cast(sum(total) OVER (PARTITION BY route, currency) AS double)
 / sum(n_offers) OVER (PARTITION BY route, currency)) AS price_index FROM (SELECT route, currency, CASE WHEN lead_days < 0 THEN 'past' WHEN lead_days <= 30 THEN '0-30'
 WHEN lead_days <= 60 THEN '31-60' WHEN lead_days <= 90 THEN '61-90' WHEN lead_days > 90 THEN '91+' ELSE 'unknown' END AS bucket, count(*) AS n_offers,
 {MONEY} AS total, {MEAN} AS mean_price FROM {FACTS} x GROUP BY 1, 2, 3) y""")
def booking_window(spark, sf):
    return gold.booking_window(facts(spark, sf))


AIRLINES = """
SELECT *, (rank() OVER (PARTITION BY route, currency ORDER BY mean_price NULLS LAST))::INT AS rank FROM (SELECT route, currency, primary_airline_name,
 count(*) AS n_offers, count(DISTINCT (dep_date, return_date, flight_type)) AS n_itineraries, {MEAN} AS mean_price
 FROM {FACTS} x GROUP BY route, currency, primary_airline_name) x"""


@query("airline_comparison", AIRLINES.format(MEAN=MEAN, FACTS=FACTS))
def airline_comparison(spark, sf):
    return gold.airline_comparison(facts(spark, sf))


@query("airline_comparison_raw", AIRLINES.format(MEAN=f"cast({MONEY} AS double) / count(price)", FACTS="fx_offers"))
def airline_comparison_raw(spark, sf):
    """Offers as they came: those without a price count, but not in the mean."""
    return gold.airline_comparison(fx(spark, sf, "fx_offers"))


@query("price_anomaly", f"""
SELECT {PK}, currency, snapshot_date, price, mean_7, z, coalesce(abs(z) > 2, false) AS anomaly
FROM (SELECT *, CASE WHEN sd_7 > 0 THEN (price - mean_7) / sd_7 END AS z FROM (SELECT *, cast(sx AS double) / n AS mean_7,
 sqrt(cast(sxx * cast(n AS decimal(4,0)) - sx * sx AS double)) / n AS sd_7 FROM (SELECT *,
  count(*) OVER w AS n, cast(sum(cast(price AS decimal(18,4))) OVER w AS decimal(18,4)) AS sx,
  cast(sum(cast(price AS decimal(18,4)) * cast(price AS decimal(18,4))) OVER w AS decimal(28,8)) AS sxx FROM {CHEAPEST} x
  WINDOW w AS ({OVER} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) y1) y) v""")
def price_anomaly(spark, sf):
    return gold.price_anomaly(cheapest_snapshot(spark, sf)).drop("sd_7", "airline", "n_offers")


@query("forecast_features", f"""
SELECT *, lag(price, 1) OVER ({OVER}) AS lag_1, lag(price, 2) OVER ({OVER}) AS lag_2, lag(price, 3) OVER ({OVER}) AS lag_3,
 (cast(dep_date AS date) - snapshot_date)::INT AS lead_days, lead(price, 1) OVER ({OVER}) AS label FROM {CHEAPEST} x""")
def forecast_features(spark, sf):
    return gold.forecast_features(cheapest_snapshot(spark, sf))


@query("stale_age", f"""
SELECT {PK}, max(snapshot_date) AS last_seen, (DATE '2024-02-01' - max(snapshot_date))::INT AS age_days
FROM {FACTS} f GROUP BY {PK}""")
def stale_age(spark, sf):
    return gold.stale_age(facts(spark, sf), "2024-02-01")


# ------------------------------------------------------------------ gold from silver
def airline_days(first: str, last: str) -> str:
    return f"snapshot_date BETWEEN DATE '{first}' AND DATE '{last}'"


@query("airline_sketches", f"""
SELECT route, currency, primary_airline_name, count(*) AS n_offers, count(DISTINCT (dep_date, return_date, flight_type)) AS n_itineraries, true AS within
FROM {FACTS} x WHERE {airline_days("2024-01-05", "2024-01-20")} GROUP BY route, currency, primary_airline_name""")
def airline_sketches(spark, sf):
    """Sketches by day, stored and merged over a range of days, beside the exact counts: within four standard errors, or one."""
    path = work_path(spark, "airline-sketches")
    gold.airline_sketches(facts(spark, sf)).write.partitionBy("snapshot_date").parquet(path)
    about = gold.airlines_between(spark.read.parquet(path), "2024-01-05", "2024-01-20")
    days = facts(spark, sf).filter(airline_days("2024-01-05", "2024-01-20"))
    keys = ["route", "currency", "primary_airline_name"]
    exact = days.groupBy(*keys).agg(F.count_distinct("dep_date", "return_date", "flight_type").alias("n_itineraries"))
    off = F.abs(F.col("about") - F.col("n_itineraries"))
    return about.join(exact, keys).select(
        *keys, "n_offers", "n_itineraries", (off <= F.greatest(F.lit(1.0), 4 * F.col("error") * F.col("n_itineraries"))).alias("within")
    )


CHANGING = "SIN|KUL"


@query("gold_refresh", f"""
SELECT {PK}, currency, snapshot_date, price, airline, n_offers, CASE WHEN route = '{CHANGING}' THEN 2 ELSE 1 END AS version FROM (
 SELECT {PK}, currency, cast(searched_at AS date) AS snapshot_date, min(price) AS price, arg_min(airline, (price, airline)) AS airline, count(*) AS n_offers
 FROM (SELECT *, {FIELD.format("price")}::DOUBLE AS price, {FIELD.format("currency")} AS currency, {FIELD.format("primary_airline_name")} AS airline
  FROM {all_offers(GOOD)} o) x WHERE price > 0 GROUP BY {PK}, currency, cast(searched_at AS date)) y""")
def gold_refresh(spark, sf):
    """Silver grows on one route after the first refresh: the second computes that route alone, the third nothing."""
    out = work_path(spark, "gold-refresh")
    rows = bronze.read_bronze(spark, exported(spark, sf, "gold-bronze")).drop(bronze.CORRUPT)
    silver.write_silver(rows.filter((F.col("route") != CHANGING) | (F.col("dep_date") < "2024-01-15")), f"{out}/silver")
    refresh.refresh(spark, f"{out}/silver", f"{out}/gold")
    silver.write_silver(rows.filter(F.col("route") == CHANGING), f"{out}/silver")
    done = refresh.refresh(spark, f"{out}/silver", f"{out}/gold")
    if done.routes != [CHANGING] or refresh.refresh(spark, f"{out}/silver", f"{out}/gold").routes:
        raise AssertionError(f"computed {done.routes} again")
    return refresh.read_gold(spark, f"{out}/gold", "snapshots")
