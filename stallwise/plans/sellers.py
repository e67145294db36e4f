"""Seller concentration, long tail, and local against remote supply."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.functions.constants import FOCUS_STATES, RUN_RATE
from stallwise.functions.dates import in_window
from stallwise.functions.numeric import big, mean, percent, ratio, round_half_up
from stallwise.operators.ranking import (
    bands,
    concentration_curve,
    concentration_thresholds,
    default_labels,
    share_of_total,
)
from stallwise.plans.common import delivered, item_rows, kept
from stallwise.plans.star import Star

ITEM_BANDS = (10, 50, 200)


def seller_revenue(star: Star) -> DataFrame:
    """Items and revenue per seller."""
    per_seller = kept(item_rows(star), star).groupBy("seller_id")
    return per_seller.agg(big(F.sum("items")).alias("items"), F.sum("gmv").alias("gmv"))


def pareto_thresholds(star: Star, thresholds: Sequence[int] = (50, 70, 80)) -> DataFrame:
    return concentration_thresholds(seller_revenue(star), "gmv", thresholds)


def pareto_curve(star: Star) -> DataFrame:
    return concentration_curve(seller_revenue(star), "seller_id", "gmv")


def activation_bands(star: Star, limits: Sequence[int] = ITEM_BANDS) -> DataFrame:
    """Sellers, revenue and share by number of items sold."""
    per_band = (
        seller_revenue(star)
        .groupBy(bands(F.col("items"), limits).alias("band"))
        .agg(F.count(F.lit(1)).alias("sellers"), F.sum("gmv").alias("gmv"))
    )
    return share_of_total(per_band, "gmv", "pct_gmv", 1).select(
        "band", "sellers", round_half_up("gmv", 2).alias("gmv"), "pct_gmv"
    )


def long_tail(star: Star, limits: Sequence[int] = ITEM_BANDS) -> DataFrame:
    return activation_bands(star, limits).drop("gmv")


def activation_rate(star: Star, limits: Sequence[int] = ITEM_BANDS) -> DataFrame:
    """One row: sellers below the first limit, sellers, and the share at or above it."""
    lowest = F.col("band") == default_labels(limits, False)[0]
    counts = activation_bands(star, limits).agg(
        F.coalesce(F.sum(F.when(lowest, F.col("sellers"))), F.lit(0)).alias("inactive"),
        F.coalesce(F.sum("sellers"), F.lit(0)).alias("sellers"),
    )
    return counts.select(
        big("inactive").alias("inactive"),
        big("sellers").alias("sellers"),
        (F.lit(1.0) - ratio("inactive", "sellers")).alias("activation_rate"),
    )


def supply_imbalance(star: Star, states: Sequence[str] = FOCUS_STATES) -> DataFrame:
    """Share of customers against share of sellers in a set of states.

    One pass per dimension: a person counts inside when any of their addresses is inside.
    """
    inside = F.coalesce(F.col("state").isin(list(states)), F.lit(False))
    people = (
        star.dim_customer.filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(F.max(inside).alias("inside"))
    )
    demand = people.agg(F.count(F.when(F.col("inside"), 1)).alias("focus"), F.count(F.lit(1)).alias("everyone"))
    supply = star.dim_seller.agg(F.count(F.when(inside, 1)).alias("focus"), F.count(F.lit(1)).alias("everyone"))
    s = supply.select(F.struct("focus", "everyone")).scalar()
    return demand.select(
        F.col("focus").alias("focus_customers"),
        round_half_up(percent("focus", "everyone"), 2).alias("pct_customers"),
        s.getField("focus").alias("focus_sellers"),
        round_half_up(percent(s.getField("focus"), s.getField("everyone")), 2).alias("pct_sellers"),
    )


def _focus_lines(star: Star, states: Sequence[str]) -> DataFrame:
    """Items of delivered orders of customers in the states, with the seller's state."""
    buyers = star.dim_customer.filter(F.col("state").isin(list(states))).select("customer_id")
    orders = (
        delivered(star)
        .filter(F.col("is_late").isNotNull())
        .select("order_id", "customer_id", "delivery_days")
        .join(buyers, "customer_id", "left_semi")
    )
    sellers = star.dim_seller.select("seller_id", F.col("state").alias("seller_state"))
    lines = item_rows(star).select("order_id", "seller_id", "items", "freight", "freighted")
    return orders.join(lines, "order_id").join(sellers, "seller_id")


def local_supply(star: Star, states: Sequence[str] = FOCUS_STATES) -> DataFrame:
    """Orders, mean freight and mean days by local or remote seller, for buyers in the states."""
    origin = F.when(F.col("seller_state").isin(list(states)), F.lit("local")).otherwise(F.lit("remote"))
    days = F.sum(F.col("delivery_days") * F.col("items"))
    known = F.sum(F.when(F.col("delivery_days").isNotNull(), F.col("items")))
    return _focus_lines(star, states).groupBy(origin.alias("origin")).agg(
        F.count_distinct("order_id").alias("orders"),
        mean(F.sum("freight"), F.sum("freighted"), 2).alias("mean_freight"),
        mean(days, known, 1).alias("mean_days"),
    )


def local_supply_change(star: Star, states: Sequence[str] = FOCUS_STATES) -> DataFrame:
    """Relative change of freight and days from remote to local supply, in percent."""
    def at(origin: str, column: str):
        return F.max(F.when(F.col("origin") == origin, F.col(column)))

    def change(column: str):
        rate = F.try_divide(at("local", column), at("remote", column)) - F.lit(1.0)
        return round_half_up(F.lit(100.0) * rate, 1).alias(f"{column.removeprefix('mean_')}_change_pct")

    return local_supply(star, states).agg(change("mean_freight"), change("mean_days"))


def remote_orders_by_state(star: Star, states: Sequence[str] = FOCUS_STATES) -> DataFrame:
    """Orders of buyers in the states that are served from each state outside."""
    remote = _focus_lines(star, states).filter(~F.col("seller_state").isin(list(states)))
    return remote.groupBy("seller_state").agg(F.count_distinct("order_id").alias("orders"))


def local_seller_gmv(
    star: Star, states: Sequence[str] = FOCUS_STATES, window: tuple[str, str] = RUN_RATE
) -> DataFrame:
    """Run-rate revenue per active seller of the states."""
    orders = star.fact_orders.filter(in_window("purchase_timestamp", window)).select("order_id")
    local = star.dim_seller.filter(F.col("state").isin(list(states))).select("seller_id")
    per_seller = (
        item_rows(star)
        .join(local, "seller_id", "left_semi")
        .join(orders, "order_id", "left_semi")
        .groupBy("seller_id")
        .agg(F.sum("gmv").alias("gmv"))
    )
    return per_seller.agg(
        F.count(F.lit(1)).alias("sellers"),
        F.sum("gmv").alias("gmv"),
    ).select("sellers", round_half_up(ratio("gmv", "sellers"), 2).alias("gmv_per_seller"))


