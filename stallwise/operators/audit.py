"""Anomalies that the model resolves and the report only counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from stallwise.functions.constants import DELIVERED
from stallwise.functions.numeric import round_half_up
from stallwise.operators.outliers import IS_OUTLIER
from stallwise.operators.uniqueness import repeat_count

TREATMENTS = {
    "price_outliers": "flagged, kept in the items fact so that revenue stays whole",
    "duplicate_reviews": "latest review of the order wins",
    "conflicting_scores": "latest review wins; score and comment come from the same row",
    "delivered_without_date": "kept; lateness is NULL, so out of every punctuality metric",
    "products_without_category": "shown as 'unknown'",
}


def _record(count_row: DataFrame, rule: str, method=None, limit=None) -> DataFrame:
    return count_row.select(
        F.lit(rule).alias("rule"),
        F.col("occurrences").cast("bigint").alias("occurrences"),
        F.lit(TREATMENTS[rule]).alias("treatment"),
        F.lit(method).cast("string").alias("method"),
        (F.lit(None) if limit is None else limit).cast("double").alias("upper_limit"),
    )


def duplicate_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews beyond the first of their order."""
    return _record(repeat_count(reviews, ["order_id"]).select(F.col("failed").alias("occurrences")), "duplicate_reviews")


def conflicting_scores(reviews: DataFrame) -> DataFrame:
    """Orders whose reviews disagree on the score."""
    spread = (
        reviews.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.min("review_score").alias("lo"), F.max("review_score").alias("hi"))
    )
    return _record(spread.agg(F.count(F.when(F.col("lo") != F.col("hi"), 1)).alias("occurrences")), "conflicting_scores")


def delivered_without_date(orders: DataFrame) -> DataFrame:
    missing = (F.col("order_status") == DELIVERED) & F.col("order_delivered_customer_date").isNull()
    return _record(orders.agg(F.count(F.when(missing, 1)).alias("occurrences")), "delivered_without_date")


def products_without_category(products: DataFrame) -> DataFrame:
    missing = F.col("product_category_name").isNull()
    return _record(products.agg(F.count(F.when(missing, 1)).alias("occurrences")), "products_without_category")


def price_outliers(items: DataFrame, limit: Row | None = None) -> DataFrame:
    """Flagged items, with the method and the limit of the flag if its row (of ``outlier_limit``) is given."""
    found = items.agg(F.count(F.when(F.col(IS_OUTLIER), 1)).alias("occurrences"))
    if limit is None:
        return _record(found, "price_outliers")
    return _record(
        found, "price_outliers", limit.method, round_half_up(F.lit(limit.upper_limit).cast("double"), 6)
    )


def audit(
    orders: DataFrame,
    products: DataFrame,
    reviews: DataFrame,
    items: DataFrame | None = None,
    limit: Row | None = None,
) -> DataFrame:
    """Rows rule, occurrences, treatment, method, upper_limit; the outlier record comes first when items are given."""
    records = [price_outliers(items, limit)] if items is not None else []
    records += [
        duplicate_reviews(reviews),
        conflicting_scores(reviews),
        delivered_without_date(orders),
        products_without_category(products),
    ]
    return reduce(DataFrame.unionByName, records)
