"""Descriptive profile of the model."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.functions.constants import CANCELED, DETRACTOR_MAX_SCORE
from stallwise.functions.dates import days_between
from stallwise.functions.numeric import big, count_when, dbl, mean, percent, round_half_up
from stallwise.operators.distribution import describe, histogram, quantiles
from stallwise.operators.outliers import IS_OUTLIER
from stallwise.operators.ranking import bands, share_of_total, top_per_group
from stallwise.operators.uniqueness import repeat_count
from stallwise.plans.common import item_totals, kept
from stallwise.plans.star import TABLES, Star

VALUE_BANDS = (50, 150)


def row_counts(star: Star) -> DataFrame:
    counts = [
        getattr(star, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def _orphans(child: DataFrame, orders: DataFrame) -> DataFrame:
    per_order = child.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    lost = per_order.join(orders.select("order_id"), "order_id", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def integrity(star: Star) -> DataFrame:
    """Five counters that the model promises to keep at zero, but for the flagged prices."""
    orders = star.fact_orders
    return repeat_count(orders, ["order_id"]).select(
        big("failed").alias("duplicate_orders"),
        big(orders.agg(count_when(F.col("order_status") == CANCELED)).scalar()).alias("canceled_orders"),
        big(_orphans(star.fact_items, orders).scalar()).alias("orphan_items"),
        big(_orphans(star.fact_payments, orders).scalar()).alias("orphan_payments"),
        big(star.fact_items.agg(count_when(F.col(IS_OUTLIER))).scalar()).alias("flagged_prices"),
    )


def period(star: Star) -> DataFrame:
    span = star.fact_orders.agg(
        F.min("purchase_timestamp").alias("first_purchase"), F.max("purchase_timestamp").alias("last_purchase")
    )
    days = days_between(F.col("first_purchase"), F.col("last_purchase"))
    return span.select("first_purchase", "last_purchase", round_half_up(dbl(days) / F.lit(30.44), 1).alias("months"))


def price_summary(star: Star) -> DataFrame:
    """Describe of price and freight, to six digits."""
    d = describe(star.fact_items, ["price", "freight_value"])
    return d.select("field", "n", *[round_half_up(c, 6).alias(c) for c in d.columns if c not in ("field", "n")])


def price_location(star: Star) -> DataFrame:
    """Median against mean price, and freight as a share of revenue."""
    median = quantiles(star.fact_items, F.col("price"), [0.5]).scalar()
    totals = star.fact_items.agg(
        F.sum("price").alias("gmv"), F.count("price").alias("n"), F.sum("freight_value").alias("freight")
    )
    return totals.select(
        round_half_up(median, 2).alias("median_price"),
        mean(F.col("gmv"), F.col("n"), 2).alias("mean_price"),
        round_half_up(percent("freight", "gmv"), 1).alias("freight_pct_gmv"),
    )


def price_histogram(star: Star, column: str = "price", bins: int = 50) -> DataFrame:
    return histogram(star.fact_items, column, bins)


def freight_by_value(star: Star, limits: Sequence = VALUE_BANDS) -> DataFrame:
    """Freight as a percentage of the order value, by value band."""
    per_order = kept(item_totals(star), star)
    return per_order.groupBy(bands(F.col("gmv"), limits, inclusive=True).alias("band")).agg(
        F.count(F.lit(1)).alias("orders"),
        round_half_up(F.avg(percent("freight", "gmv")), 1).alias("freight_pct"),
    )


def by_state(star: Star) -> DataFrame:
    """Customers and sellers per state."""
    def counted(df: DataFrame, kind: str) -> DataFrame:
        return df.groupBy("state").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "state", "n")

    return counted(star.dim_customer, "customer").unionByName(counted(star.dim_seller, "seller"))


def top_states(star: Star, k: int = 10) -> DataFrame:
    return top_per_group(by_state(star), ["kind"], [F.desc("n"), F.asc("state")], k)


def state_share(star: Star, state: str, kind: str = "seller") -> DataFrame:
    """One state's part of all customers or sellers."""
    rows = by_state(star).filter(F.col("kind") == kind)
    return rows.agg(
        big(F.coalesce(F.sum(F.when(F.col("state") == state, F.col("n"))), F.lit(0))).alias("in_state"),
        big(F.sum("n")).alias("everywhere"),
    ).withColumn("pct", round_half_up(percent("in_state", "everywhere"), 0))


def payment_mix(star: Star) -> DataFrame:
    per_order = star.order_payments.groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("payment_value").alias("value")
    )
    per_type = (
        kept(per_order, star)
        .groupBy("payment_type")
        .agg(big(F.sum("transactions")).alias("transactions"), F.sum("value").alias("value"))
    )
    return share_of_total(per_type, "value", "pct_value", 4).select(
        "payment_type", "transactions", round_half_up("value", 2).alias("value"), "pct_value"
    )


def score_distribution(star: Star) -> DataFrame:
    scored = star.fact_orders.filter(F.col("review_score").isNotNull())
    return scored.groupBy(big("review_score").alias("review_score")).agg(F.count(F.lit(1)).alias("orders"))


def detractor_rate(star: Star) -> DataFrame:
    detractors = count_when(F.col("review_score") <= DETRACTOR_MAX_SCORE)
    return star.fact_orders.agg(detractors.alias("detractors"), F.count("review_score").alias("reviewed")).withColumn(
        "detractor_pct", round_half_up(percent("detractors", "reviewed"), 1)
    )
