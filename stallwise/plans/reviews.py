"""Root causes of complaints over the classified reviews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.functions.constants import CONTROLLABLE_PARTS, FALLBACK_LIMIT
from stallwise.functions.numeric import big, count_when, dbl, percent, round_half_up
from stallwise.operators.ranking import share_of_total, top_rows
from stallwise.plans.common import item_rows
from stallwise.plans.enrichment import eligible, valid_rows
from stallwise.plans.star import Star


def _valid(classified: DataFrame) -> DataFrame:
    return classified.filter(valid_rows(classified))


def run_summary(classified: DataFrame) -> DataFrame:
    """Rows, unclassified rows, categories, last run and trust gate."""
    ok = valid_rows(classified)
    last = F.max("classified_at") if "classified_at" in classified.columns else F.lit(None).cast("timestamp")
    total = F.count(F.lit(1))
    failed = F.count(F.when(~F.coalesce(ok, F.lit(False)), 1))
    return classified.agg(
        total.alias("total"),
        failed.alias("unclassified"),
        F.count_distinct(F.when(ok, F.col("category"))).alias("categories"),
        last.alias("last_run"),
        F.coalesce(F.try_divide(dbl(failed), dbl(total)) <= FALLBACK_LIMIT, F.lit(False)).alias("trusted"),
    )


def coverage(classified: DataFrame, star: Star) -> DataFrame:
    """Population, valid rows, coverage and the 95% margin of error in points."""
    population = eligible(star.fact_orders).agg(F.count(F.lit(1))).scalar()
    n = F.col("classified")
    return (
        classified.agg(count_when(valid_rows(classified)).alias("classified"))
        .withColumn("population", population)
        .select(
            "population",
            "classified",
            round_half_up(percent("classified", "population"), 1).alias("coverage_pct"),
            round_half_up(
                F.lit(1.96) * F.sqrt(F.lit(0.25) / F.greatest(dbl(n), F.lit(1.0))) * F.lit(100.0), 1
            ).alias("margin_pp"),
        )
    )


def score_distribution(classified: DataFrame, star: Star) -> DataFrame:
    scores = star.fact_orders.select("order_id", "review_score")
    joined = _valid(classified).select("order_id").join(scores, "order_id")
    return joined.groupBy(big("review_score").alias("review_score")).agg(F.count(F.lit(1)).alias("reviews"))


def category_distribution(classified: DataFrame) -> DataFrame:
    counts = _valid(classified).groupBy("category").agg(F.count(F.lit(1)).alias("complaints"))
    return share_of_total(counts, "complaints", "pct", 1)


def severity_by_category(classified: DataFrame) -> DataFrame:
    def level(name: str):
        return count_when(F.col("severity") == name)

    total = F.count(F.lit(1))
    return _valid(classified).groupBy("category").agg(
        total.alias("total"),
        level("alta").alias("high"),
        level("media").alias("medium"),
        level("baixa").alias("low"),
        round_half_up(percent(level("alta"), total), 1).alias("pct_high"),
    )


def worst_categories(classified: DataFrame) -> DataFrame:
    """Category with most complaints and category with the largest share of high severity."""
    s = severity_by_category(classified)
    by_volume = F.min_by("category", F.struct(-F.col("total"), F.col("category")))
    by_gravity = F.min_by("category", F.struct(-F.col("pct_high"), F.col("category")))
    return s.agg(by_volume.alias("top_by_volume"), by_gravity.alias("top_by_gravity"))


def category_by_punctuality(classified: DataFrame, star: Star) -> DataFrame:
    """Complaints on late and on punctual orders, per category."""
    known = star.fact_orders.filter(F.col("is_late").isNotNull()).select("order_id", "is_late")
    joined = _valid(classified).select("order_id", "category").join(known, "order_id")
    return joined.groupBy("category").agg(
        count_when(F.col("is_late")).alias("on_late_orders"),
        count_when(~F.col("is_late")).alias("on_punctual_orders"),
    )


def revenue_by_category(classified: DataFrame, star: Star) -> DataFrame:
    """Orders, revenue and freight touched by each category."""
    joined = _valid(classified).select("order_id", "category").join(item_rows(star), "order_id")
    return joined.groupBy("category").agg(
        F.count_distinct("order_id").alias("orders"),
        round_half_up(F.sum("gmv"), 2).alias("gmv"),
        round_half_up(F.sum("freight"), 2).alias("freight"),
    )


def sellers_with_complaints(
    classified: DataFrame, star: Star, parts: Sequence[str] = CONTROLLABLE_PARTS, k: int = 8
) -> DataFrame:
    """Sellers with most complaints about failures they control."""
    controllable = reduce(lambda a, b: a | b, [F.col("category").like(f"%{p}%") for p in parts])
    orders = _valid(classified).filter(controllable).select("order_id")
    sellers = star.dim_seller.select("seller_id", "state")
    per_seller = (
        item_rows(star)
        .join(orders, "order_id", "left_semi")
        .groupBy("seller_id")
        .agg(F.count_distinct("order_id").alias("complaints"), F.sum("gmv").alias("gmv"))
        .join(sellers, "seller_id")
        .select("seller_id", "state", "complaints", round_half_up("gmv", 2).alias("gmv"))
    )
    return top_rows(per_seller, [F.desc("complaints"), F.asc("seller_id")], k)


def product_categories_with_complaints(classified: DataFrame, star: Star, k: int = 8) -> DataFrame:
    lines = item_rows(star).join(_valid(classified).select("order_id"), "order_id", "left_semi")
    products = star.dim_product.select("product_id", F.col("category_name").alias("product_category"))
    per_category = (
        lines.join(products, "product_id")
        .groupBy("product_category")
        .agg(F.count_distinct("order_id").alias("complaints"), round_half_up(F.sum("gmv"), 2).alias("gmv"))
    )
    return top_rows(per_category, [F.desc("complaints"), F.asc("product_category")], k)
