"""Building blocks shared by the analytic plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.functions.constants import DELIVERED
from stallwise.plans.star import Star

#: Rows that a task of ``spread`` is meant to get.
ROWS = 250_000


def item_totals(star: Star, *extra_keys: str) -> DataFrame:
    """Items summed per order (and extra keys) before any join, so that a huge order is one row.

    Columns: order_id, extra keys, items, priced, gmv, freight, freighted. Callers join the result
    to ``fact_orders`` or use ``kept``.
    """
    return star.order_items.groupBy("order_id", *extra_keys).agg(
        F.count(F.lit(1)).alias("items"),
        F.count("price").alias("priced"),
        F.sum("price").alias("gmv"),
        F.count("freight_value").alias("freighted"),
        F.sum("freight_value").alias("freight"),
    )


def item_rows(star: Star) -> DataFrame:
    """Items one by one, with the columns of ``item_totals``: for sums by seller or product.

    Grouping by order and seller would hardly reduce the fact and shuffle it once more. Here the join with the kept
    or chosen orders comes first: one shuffle by order, a hot order split by AQE, none where few orders are
    broadcast; what is left is summed on the map side.
    """
    return star.order_items.select(
        "order_id",
        "product_id",
        "seller_id",
        F.lit(1).alias("items"),
        F.col("price").isNotNull().cast("int").alias("priced"),
        F.col("price").alias("gmv"),
        F.col("freight_value").isNotNull().cast("int").alias("freighted"),
        F.col("freight_value").alias("freight"),
    )


def kept(rows: DataFrame, star: Star) -> DataFrame:
    """Rows of orders in the model."""
    if star.saved:
        return rows
    return rows.join(star.fact_orders.select("order_id"), "order_id", "left_semi")


def spread(rows: DataFrame, like: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by the keys to tasks of some ROWS each, by the number of rows of ``like``.

    Spark sizes tasks by compressed bytes, of which a hash table or a sort makes many times as much: here the memory
    of a task stays the same, whatever the table's size. A key's rows are in one task, however many.
    """
    return rows.repartition(max(-(-like.count() // ROWS), 1), *keys)


def delivered(star: Star) -> DataFrame:
    return star.fact_orders.filter(F.col("order_status") == DELIVERED)


def punctuality(is_late: str = "is_late") -> Column:
    return F.when(F.col(is_late), F.lit("late")).otherwise(F.lit("on_time"))


def half_of(ts: str) -> Column:
    return F.when(F.month(ts) <= 6, F.lit("S1")).otherwise(F.lit("S2"))


def one_value(df: DataFrame, column: str) -> Column:
    """Single value of a one-row frame as a scalar subquery."""
    return df.select(column).scalar()
