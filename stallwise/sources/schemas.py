"""Columns of the raw entities and of the review classification."""

from __future__ import annotations

from pyspark.sql import types as T

# entity -> {column: Spark type}; other columns of a file pass through as text.
RAW_COLUMNS = {
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "int",
        "customer_city": "string",
        "customer_state": "string",
    },
    "sellers": {"seller_id": "string", "seller_city": "string", "seller_state": "string"},
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_weight_g": "double",
    },
    "category_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "price": "decimal(18,2)",
        "freight_value": "decimal(18,2)",
    },
    "payments": {
        "order_id": "string",
        "payment_sequential": "int",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "decimal(18,2)",
    },
    "reviews": {
        "review_id": "string",
        "order_id": "string",
        "review_score": "int",
        "review_comment_message": "string",
        "review_creation_date": "timestamp_ntz",
    },
}

# Entities whose text columns may hold quoted line breaks.
MULTI_LINE = {"reviews"}

OPTIONAL_ENTITIES = {"category_translation"}

CLASSIFICATION = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("about_deadline", T.BooleanType()),
        T.StructField("about_product", T.BooleanType()),
        T.StructField("about_service", T.BooleanType()),
    ]
)

BATCH_REPLY = T.StructType([T.StructField("classifications", T.ArrayType(CLASSIFICATION))])

CATEGORY = T.StructType(
    [
        T.StructField("category_id", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
    ]
)

TAXONOMY = T.StructType(
    [T.StructField("categories", T.ArrayType(CATEGORY)), T.StructField("summary", T.StringType())]
)
