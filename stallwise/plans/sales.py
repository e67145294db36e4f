"""Seasonality, categories, calendar share, effect of the cancelled filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.functions.constants import COMPLETE_MONTHS
from stallwise.functions.dates import in_window, year_month
from stallwise.functions.numeric import big, dbl, mean, percent, ratio, round_half_up
from stallwise.operators.ranking import best_row, share_of_total, top_rows
from stallwise.plans.common import item_rows, item_totals, kept
from stallwise.plans.star import Star


def _order_revenue(star: Star) -> DataFrame:
    orders = star.fact_orders.select("order_id", "purchase_timestamp")
    return orders.join(item_totals(star).select("order_id", "gmv"), "order_id")


def monthly_series(star: Star) -> DataFrame:
    """Orders with items and revenue per month; one row per order meets the group, so a count suffices."""
    return (
        _order_revenue(star)
        .groupBy(year_month("purchase_timestamp").alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"), round_half_up(F.sum("gmv"), 2).alias("gmv"))
    )


def peak_month(star: Star) -> DataFrame:
    return best_row(monthly_series(star), [F.desc("orders"), F.asc("month")])


def seasonality(star: Star, window: tuple[str, str] = COMPLETE_MONTHS) -> DataFrame:
    """Revenue per calendar month divided by the years observed, over complete months only."""
    ts = F.col("purchase_timestamp")
    orders = star.fact_orders.filter(in_window("purchase_timestamp", window)).select(
        "order_id", F.year(ts).alias("year"), F.month(ts).alias("month")
    )
    per_month = (
        orders.join(item_totals(star).select("order_id", "gmv"), "order_id")
        .groupBy("year", "month")
        .agg(F.sum("gmv").alias("gmv"))
    )
    years = F.count(F.lit(1))
    return per_month.groupBy(big("month").alias("month")).agg(
        years.alias("years_observed"),
        round_half_up(ratio(F.sum("gmv"), years), 2).alias("gmv_per_year"),
    )


def category_ranking(star: Star) -> DataFrame:
    """Items, mean price, revenue and share per named category; items are summed per product first."""
    per_product = (
        kept(item_rows(star), star)
        .groupBy("product_id")
        .agg(F.sum("items").alias("items"), F.sum("priced").alias("priced"), F.sum("gmv").alias("gmv"))
    )
    named = star.dim_product.filter("has_category").select("product_id", "category_name")
    per_category = (
        per_product.join(named, "product_id")
        .groupBy(F.col("category_name").alias("category"))
        .agg(F.sum("items").alias("items"), F.sum("priced").alias("priced"), F.sum("gmv").alias("gmv"))
    )
    return share_of_total(per_category, "gmv", "pct_gmv", 1).select(
        "category",
        big("items").alias("items"),
        mean(F.col("gmv"), F.col("priced"), 2).alias("mean_price"),
        round_half_up("gmv", 2).alias("gmv"),
        "pct_gmv",
    )


def category_concentration(star: Star, k: int = 10) -> DataFrame:
    """Joint share of the ``k`` largest categories."""
    top = top_rows(category_ranking(star), [F.desc("gmv"), F.asc("category")], k)
    return top.agg(
        F.count(F.lit(1)).alias("categories"), round_half_up(F.sum("pct_gmv"), 1).alias("pct_gmv")
    )


def weekday_share(star: Star) -> DataFrame:
    """Share of purchases on weekdays against the share of weekdays in a week."""
    per_day = star.fact_orders.groupBy("purchase_date_id").agg(F.count(F.lit(1)).alias("n"))
    days = star.dim_date.select("date_id", "is_weekend")
    joined = per_day.join(days, F.col("purchase_date_id") == F.col("date_id"))
    weekday = F.sum(F.when(~F.col("is_weekend"), F.col("n")).otherwise(F.lit(0)))
    return joined.agg(F.sum("n").alias("orders"), weekday.alias("weekday_orders")).select(
        big("orders").alias("orders"),
        big("weekday_orders").alias("weekday_orders"),
        round_half_up(percent("weekday_orders", "orders"), 1).alias("weekday_pct"),
        round_half_up(F.lit(500.0) / F.lit(7.0), 1).alias("expected_pct"),
    )


def removed_by_cancellation(star: Star) -> DataFrame:
    """Items and payments that do not reach the model, and the revenue that goes with them."""
    orders = star.fact_orders.select("order_id")
    lost_items = item_totals(star).join(orders, "order_id", "left_anti")
    per_order = star.order_payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    lost_payments = per_order.join(orders, "order_id", "left_anti").agg(F.sum("n").alias("n"))
    items = lost_items.agg(F.sum("items").alias("items"), F.sum("gmv").alias("gmv"))
    return items.select(
        big(F.coalesce("items", F.lit(0))).alias("items_removed"),
        big(F.coalesce(lost_payments.scalar(), F.lit(0))).alias("payments_removed"),
        F.coalesce(dbl("gmv"), F.lit(0.0)).alias("gmv_removed"),
    )

