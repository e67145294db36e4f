"""Star schema: four dimensions and three facts from clean entities.

Cancelled orders leave at the root fact and the other facts follow by semi join, so all facts
describe the same orders.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.functions.constants import CALENDAR, CANCELED, UNKNOWN_CATEGORY
from stallwise.functions.dates import days_between
from stallwise.operators.outliers import IS_OUTLIER
from stallwise.sources.layers import read_table, write_table


TABLES = [
    "dim_customer",
    "dim_seller",
    "dim_product",
    "dim_date",
    "fact_orders",
    "fact_items",
    "fact_payments",
]


class Star:
    """Model tables, each built when first asked for.

    ``order_items`` and ``order_payments`` hold at least the rows of the facts. Plans that inner
    join them to ``fact_orders`` read these, because that join already does what the semi join of
    the facts does, and they can pre-aggregate before it. In a saved star they are the facts, and
    ``saved`` tells that no rows of dropped orders are left to remove.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], saved: bool = False):
        self.saved = saved
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]


def build_dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    )


def build_dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", F.col("seller_city").alias("city"), F.col("seller_state").alias("state"))


def build_dim_product(products: DataFrame, translation: DataFrame | None) -> DataFrame:
    """Translated category, else the original, else 'unknown'.

    The lookup is reduced to one row per name first: a repeated name would multiply products.
    """
    name = F.col("product_category_name")
    if translation is None:
        joined = products.withColumn("_english", F.lit(None).cast("string"))
    else:
        lookup = (
            translation.filter(name.isNotNull())
            .groupBy(name.alias("_name"))
            .agg(F.min("product_category_name_english").alias("_english"))
        )
        joined = products.join(lookup, name == F.col("_name"), "left")
    return joined.select(
        "product_id",
        F.coalesce("_english", name, F.lit(UNKNOWN_CATEGORY)).alias("category_name"),
        name.isNotNull().alias("has_category"),
        F.col("product_weight_g").alias("weight_g"),
    )


def _calendar_columns(days: DataFrame) -> DataFrame:
    d = F.col("date_id")
    return days.select(
        "date_id",
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.weekday(d).isin(5, 6).alias("is_weekend"),
    )


def build_dim_date(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1]) -> DataFrame:
    """One row per day of a closed period."""
    span = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date_id")
    )
    return _calendar_columns(span)


def dim_date_over(orders: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Calendar of the whole years that the orders fall in."""
    span = orders.agg(
        F.trunc(F.min(ts), "year").alias("first"),
        F.last_day(F.add_months(F.trunc(F.max(ts), "year"), 11)).alias("last"),
    ).filter("first IS NOT NULL")
    return _calendar_columns(span.select(F.explode(F.sequence("first", "last")).alias("date_id")))


def latest_review(reviews: DataFrame) -> DataFrame:
    """Latest review per order, score and comment from the same row; ties by review_id.

    An aggregate, not a window: it combines on the map side, and because the result is known to
    be unique per order, queries that read no review column lose the join to it altogether. Each
    column has its own aggregate, so that a query for scores does not shuffle texts; the longer
    order of the text starts with that of the score, which keeps both on one row.
    """
    # Counted from the parts of the zone-less time: a cast to an instant would depend on the session's zone.
    created = F.col("review_creation_date").cast("timestamp_ntz")
    seconds = F.datediff(created, F.lit("1970-01-01")).cast("long") * 86400 + F.hour(created) * 3600 + F.minute(created) * 60
    micros = seconds * 1_000_000 + (F.extract(F.lit("SECOND"), created) * 1_000_000).cast("long")
    newest_first = F.coalesce(-micros, F.lit((1 << 63) - 1))
    place = [newest_first, F.col("review_id"), F.col("review_score")]
    text = F.col("review_comment_message")
    return reviews.groupBy("order_id").agg(
        F.min_by("review_score", F.struct(*place)).alias("review_score"),
        F.min_by(text, F.struct(*place, F.xxhash64(text))).alias("review_comment_message"),
    )


def build_fact_orders(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Kept orders with delivery metrics; a missing delivery date leaves them NULL."""
    review = latest_review(reviews).withColumnRenamed("order_id", "_order")
    purchase = F.col("order_purchase_timestamp").cast("timestamp_ntz")
    delivered = F.col("order_delivered_customer_date").cast("timestamp_ntz")
    estimated = F.col("order_estimated_delivery_date").cast("timestamp_ntz")
    late = (
        F.when(delivered.isNull(), F.lit(None).cast("boolean"))
        .when(delivered > estimated, F.lit(True))
        .otherwise(F.lit(False))
    )
    return (
        orders.filter(F.col("order_status") != CANCELED)
        .join(review, F.col("order_id") == F.col("_order"), "left")
        .select(
            "order_id",
            "customer_id",
            "order_status",
            purchase.cast("date").alias("purchase_date_id"),
            purchase.alias("purchase_timestamp"),
            delivered.alias("delivered_timestamp"),
            estimated.alias("estimated_delivery_timestamp"),
            days_between(purchase, delivered).alias("delivery_days"),
            late.alias("is_late"),
            "review_score",
            "review_comment_message",
        )
    )


def kept_rows(child: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows of a child fact whose order is in the model (EXISTS)."""
    kept = orders.filter(F.col("order_status") != CANCELED).select(F.col("order_id").alias("_order"))
    return child.join(kept, F.col("order_id") == F.col("_order"), "left_semi")


def _item_columns(items: DataFrame) -> DataFrame:
    return items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", IS_OUTLIER)


def _payment_columns(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    )


def build_fact_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    return kept_rows(_item_columns(items), orders)


def build_fact_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    return kept_rows(_payment_columns(payments), orders)


def build_star(
    frames: Mapping[str, DataFrame],
    dim_date: Callable[[], DataFrame] | None = None,
    order_items: Callable[[], DataFrame] | None = None,
) -> Star:
    """All model tables, lazily; the items must already carry the outlier flag.

    ``order_items`` may give the same items without the flag, which only the fact needs.
    """
    return Star(
        {
            "dim_customer": lambda: build_dim_customer(frames["customers"]),
            "dim_seller": lambda: build_dim_seller(frames["sellers"]),
            "dim_product": lambda: build_dim_product(frames["products"], frames.get("category_translation")),
            "dim_date": dim_date or (lambda: build_dim_date(frames["orders"].sparkSession)),
            "fact_orders": lambda: build_fact_orders(frames["orders"], frames["reviews"]),
            "fact_items": lambda: build_fact_items(frames["order_items"], frames["orders"]),
            "fact_payments": lambda: build_fact_payments(frames["payments"], frames["orders"]),
            "order_items": order_items or (lambda: frames["order_items"]),
            "order_payments": lambda: _payment_columns(frames["payments"]),
        }
    )


def save_star(star: Star, base: str) -> None:
    """Create or replace the seven tables."""
    for name in TABLES:
        write_table(getattr(star, name), base, name)


def _saved(read: Callable[[str], DataFrame]) -> Star:
    names = {name: name for name in TABLES} | {"order_items": "fact_items", "order_payments": "fact_payments"}
    return Star({name: partial(read, table) for name, table in names.items()}, saved=True)


def load_star(spark: SparkSession, base: str) -> Star:
    return _saved(lambda table: read_table(spark, base, table))


# Key that each table is joined on.
BUCKET_KEYS = {
    "dim_customer": "customer_id",
    "dim_seller": "seller_id",
    "dim_product": "product_id",
    "fact_orders": "order_id",
    "fact_items": "order_id",
    "fact_payments": "order_id",
}


def save_star_bucketed(star: Star, database: str, buckets: int) -> None:
    """Create or replace the tables in a catalog database, bucketed and sorted by their join key.

    Joins of the facts on order_id, and sums per order, then need no shuffle.
    """
    spark = star.fact_orders.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in TABLES:
        writer = getattr(star, name).write.mode("overwrite").format("parquet")
        if name in BUCKET_KEYS:
            writer = writer.bucketBy(buckets, BUCKET_KEYS[name]).sortBy(BUCKET_KEYS[name])
        writer.saveAsTable(f"{database}.{name}")


def load_star_bucketed(spark: SparkSession, database: str) -> Star:
    return _saved(lambda table: spark.table(f"{database}.{table}"))
