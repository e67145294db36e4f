"""The provided star-schema test tables seen as marketplace entities.

Columns the tables lack are deterministic expressions over columns they have; the same
expressions stand in the comparison SQL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stallwise.functions.constants import CANCELED, DELIVERED
from stallwise.functions.numeric import money
from stallwise.operators.outliers import flag_outliers
from stallwise.plans.star import Star, build_star, dim_date_over

# Fewer deviations than the default of 3, which flags nothing on these prices.
PRICE_DEVIATIONS = 1.5
RUN_RATE = ("2001-01-01", "2001-07-01")
COMPLETE_MONTHS = ("1995-01-01", "2001-08-01")
CARD = "A"
FOCUS_REGION = "ASIA"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Test table; its schema is inferred once, later reads need no job to look at the footers."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State to macro-region; the nation table has 25 rows at every scale."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("state"), F.col("r_name").alias("region")
    )


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.join(_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("product_category_name"),
        F.col("p_size").cast("double").alias("product_weight_g"),
    )


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English names of the categories that sort before 'S'; the others stay untranslated."""
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_type") < "S")
        .select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english"),
        )
        .distinct()
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status from the order flag; delivered with the last line; promised 30 to 89 days after purchase."""
    o = table(spark, sf_dir, "orders")
    last_ship = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("_order"))
        .agg(F.max("l_shipdate").alias("_delivered"))
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit(DELIVERED))
        .when(F.col("o_orderstatus") == "P", F.lit(CANCELED))
        .otherwise(F.lit("shipped"))
    )
    promised = F.col("o_orderdate") + F.make_dt_interval((F.lit(30) + F.col("o_orderkey") % 60).cast("int"))
    return o.join(last_ship, F.col("o_orderkey") == F.col("_order"), "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("_delivered").alias("order_delivered_customer_date"),
        promised.alias("order_estimated_delivery_date"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = money("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(22,4)").alias("freight_value"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per line, so that orders have several."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 12).alias("payment_installments"),
        money("l_extendedprice").alias("payment_value"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as first reviews and user turns as later ones; the score comes from the text length."""
    epoch = F.lit("2000-01-01").cast("timestamp_ntz")
    score = (F.lit(1) + F.length("text") % 5).alias("review_score")
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d-"), F.col("doc_id").cast("string")).alias("review_id"),
        F.col("doc_id").alias("order_id"),
        score,
        F.col("text").alias("review_comment_message"),
        epoch.alias("review_creation_date"),
    )
    turn = F.col("turn").cast("int")
    talks = (
        table(spark, sf_dir, "conversations")
        .filter(F.col("role") == "user")
        .select(
            F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("review_id"),
            F.col("conv_id").alias("order_id"),
            score,
            F.col("text").alias("review_comment_message"),
            (epoch + F.make_dt_interval(turn + 1)).alias("review_creation_date"),
        )
    )
    return documents.unionByName(talks)


_ENTITIES = {
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "category_translation": translation,
    "orders": orders,
    "order_items": items,
    "payments": payments,
    "reviews": reviews,
}


class Entities(Mapping):
    """Raw entities before any quality step, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, **overrides):
        self._spark, self._dir = spark, sf_dir
        self._makers = _ENTITIES | overrides
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, entity: str) -> DataFrame:
        if entity not in self._built:
            self._built[entity] = self._makers[entity](self._spark, self._dir)
        return self._built[entity]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self):
        return len(self._makers)


def flagged_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_outliers(items(spark, sf_dir), "price", deviations=PRICE_DEVIATIONS)


def star(spark: SparkSession, sf_dir: str) -> Star:
    return build_star(
        Entities(spark, sf_dir, order_items=flagged_items),
        lambda: dim_date_over(table(spark, sf_dir, "orders"), "o_orderdate"),
        lambda: items(spark, sf_dir),
    )
