"""Repurchase after a first order, and customer value by region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.functions.constants import MACRO_REGIONS, OTHER_REGION, RUN_RATE
from stallwise.functions.dates import in_window, months_between_boundaries
from stallwise.functions.numeric import big, count_when, dbl, mean, percent, ratio, round_half_up
from stallwise.plans.common import delivered, one_value, punctuality
from stallwise.plans.star import Star


def _first(known: str):
    """Earliest order on which ``known`` is set; order_id settles equal times."""
    return F.min(
        F.when(F.col(known).isNotNull(), F.struct("purchase_timestamp", "order_id", known))
    ).alias(f"first_{known}")


def delivered_per_person(star: Star) -> DataFrame:
    """Per person: delivered orders, first order with known lateness, first one with a score.

    Everything merges, so orders are reduced per customer_id before they meet the dimension and
    per person after it; no window over all orders of a customer is needed.
    """
    per_customer = delivered(star).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_orders"), _first("is_late"), _first("review_score")
    )
    people = star.dim_customer.select("customer_id", "customer_unique_id").filter(
        F.col("customer_unique_id").isNotNull()
    )
    return (
        per_customer.join(people, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.sum("n_orders").alias("n_orders"),
            F.min("first_is_late").alias("first_is_late"),
            F.min("first_review_score").alias("first_review_score"),
        )
    )


def late_repurchase(star: Star) -> DataFrame:
    """Customers, repurchasers and rate by punctuality of the first delivery."""
    known = delivered_per_person(star).filter(F.col("first_is_late").isNotNull())
    again = count_when(F.col("n_orders") > 1)
    return known.groupBy(punctuality("first_is_late.is_late").alias("first_delivery")).agg(
        F.count(F.lit(1)).alias("customers"),
        again.alias("repurchased"),
        round_half_up(percent(again, F.count(F.lit(1))), 2).alias("repurchase_pct"),
    )


def _contingency(star: Star) -> DataFrame:
    """One row: repurchased and not, by punctuality, plus the rounded rates."""
    status = F.col("first_delivery")
    late, on_time = status == "late", status == "on_time"
    return late_repurchase(star).agg(
        F.coalesce(F.sum(F.when(late, F.col("repurchased"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(late, F.col("customers") - F.col("repurchased"))), F.lit(0)).alias("b"),
        F.coalesce(F.sum(F.when(on_time, F.col("repurchased"))), F.lit(0)).alias("c"),
        F.coalesce(F.sum(F.when(on_time, F.col("customers") - F.col("repurchased"))), F.lit(0)).alias("d"),
        F.max(F.when(late, F.col("repurchase_pct"))).alias("rate_late"),
        F.max(F.when(on_time, F.col("repurchase_pct"))).alias("rate_on_time"),
    )


def late_repurchase_test(star: Star) -> DataFrame:
    """Chi-square statistic with continuity correction on the 2x2 table, and the effect size."""
    a, b, c, d = (dbl(x) for x in "abcd")
    n = a + b + c + d
    gap = F.greatest(F.abs(a * d - b * c) - n / F.lit(2.0), F.lit(0.0))
    chi2 = F.try_divide(n * gap * gap, (a + b) * (c + d) * (a + c) * (b + d))
    return _contingency(star).select(
        chi2.alias("chi2"),
        (F.col("rate_on_time") - F.col("rate_late")).alias("effect_pp"),
        (F.try_divide(F.col("rate_late"), F.col("rate_on_time")) - F.lit(1.0)).alias("relative_change"),
    )


SERIES_TERMS = 120
#: The chance of a larger chi-square is below 2e-12 from here on.
NO_CHANCE = 50.0


def upper_tail(chi2: Column) -> Column:
    """Chance of a larger chi-square with one degree of freedom, to ten digits or so; 0 above ``NO_CHANCE``.

    It is 1 - erf(z) with z = sqrt(chi2 / 2), and erf(z) = 2 z exp(-z^2) / sqrt(pi) times the sum of
    (2 z^2)^n / (1 * 3 * ... * (2n + 1)), whose terms are all positive; the sum is folded from its last term.
    Its terms suffice up to ``NO_CHANCE``.
    """
    folded = F.aggregate(
        F.sequence(F.lit(SERIES_TERMS), F.lit(1)),
        F.lit(1.0),
        lambda rest, n: F.lit(1.0) + chi2 / (F.lit(2) * n + F.lit(1)) * rest,
    )
    erf = F.lit(2.0) * F.sqrt(chi2 / F.lit(2.0)) * F.exp(-chi2 / F.lit(2.0)) / F.sqrt(F.pi()) * folded
    return F.when(chi2 > NO_CHANCE, F.lit(0.0)).otherwise(F.greatest(F.lit(1.0) - erf, F.lit(0.0)))


def late_repurchase_significance(star: Star) -> DataFrame:
    """The test row with its p-value, rounded to 6 digits."""
    test = late_repurchase_test(star)
    return test.withColumn("p_value", round_half_up(upper_tail(F.col("chi2")), 6))


def delivery_days(star: Star) -> DataFrame:
    """Mean delivery days by punctuality."""
    known = delivered(star).filter(F.col("is_late").isNotNull())
    return known.groupBy(punctuality().alias("status")).agg(
        F.count(F.lit(1)).alias("orders"),
        mean(F.sum("delivery_days"), F.count("delivery_days"), 1).alias("mean_days"),
    )


def score_repurchase(star: Star) -> DataFrame:
    """Customers and repurchase rate by the score of the first reviewed order."""
    known = delivered_per_person(star).filter(F.col("first_review_score").isNotNull())
    return known.groupBy(big("first_review_score.review_score").alias("first_score")).agg(
        F.count(F.lit(1)).alias("customers"),
        round_half_up(percent(count_when(F.col("n_orders") > 1), F.count(F.lit(1))), 2).alias("repurchase_pct"),
    )


def score_repurchase_amplitude(star: Star) -> DataFrame:
    rate = F.col("repurchase_pct")
    return score_repurchase(star).agg(round_half_up(F.max(rate) - F.min(rate), 2).alias("amplitude_pp"))


def late_orders_ceiling(star: Star, window: tuple[str, str] = RUN_RATE) -> DataFrame:
    """Late orders of a half-year times the repurchase effect: customers saved at best."""
    late = delivered(star).filter(F.col("is_late") & in_window("purchase_timestamp", window))
    effect = one_value(late_repurchase_test(star), "effect_pp")
    return late.agg(F.count(F.lit(1)).alias("late_orders")).select(
        "late_orders",
        round_half_up(effect, 2).alias("effect_pp"),
        round_half_up(dbl("late_orders") * effect / F.lit(100.0), 2).alias("customers_saved"),
    )


def default_regions(spark: SparkSession) -> DataFrame:
    """State to macro-region, 27 rows."""
    rows = [(state, region) for region, states in MACRO_REGIONS.items() for state in states]
    return spark.createDataFrame(rows, "state string, region string")


def value_by_region(star: Star, regions: DataFrame) -> DataFrame:
    """Customers, ticket, frequency, active months and repurchase by macro-region.

    Payments are summed per order and orders per customer_id before the dimension join.
    ``regions`` maps state to region; a state without one falls under 'Outro'.
    """
    paid = star.order_payments.groupBy("order_id").agg(F.sum("payment_value").alias("value"))
    per_customer = (
        star.fact_orders.select("order_id", "customer_id", "purchase_timestamp")
        .join(paid, "order_id")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("value").alias("spent"),
            F.min("purchase_timestamp").alias("first"),
            F.max("purchase_timestamp").alias("last"),
        )
    )
    people = star.dim_customer.select("customer_id", "customer_unique_id", "state").join(regions, "state", "left")
    per_person = (
        per_customer.join(people, "customer_id")
        .groupBy("customer_unique_id", F.coalesce("region", F.lit(OTHER_REGION)).alias("region"))
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("spent").alias("spent"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )
    months = F.greatest(F.lit(1).cast("bigint"), months_between_boundaries(F.col("first"), F.col("last")))
    customers = F.count(F.lit(1))
    return per_person.groupBy("region").agg(
        customers.alias("customers"),
        round_half_up(F.avg(ratio("spent", "orders")), 2).alias("mean_ticket"),
        mean(F.sum("orders"), customers, 2).alias("frequency"),
        mean(F.sum(months), customers, 2).alias("active_months"),
        round_half_up(percent(count_when(F.col("orders") > 1), customers), 2).alias("repurchase_pct"),
    )
