"""Sizing of three revenue levers on the last complete half-year."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.functions.constants import (
    CONVERSION_RATES,
    CREDIT_CARD,
    DETRACTOR_MAX_SCORE,
    FALLBACK_LIMIT,
    FOCUS_STATES,
    RECOVERY_RATE,
    RECRUITS,
    RUN_RATE,
    TICKET_INCREMENT,
)
from stallwise.functions.dates import in_window
from stallwise.functions.numeric import big, count_when, dbl, mean, percent, round_half_up
from stallwise.operators.ranking import top_rows
from stallwise.plans.common import delivered, half_of, item_rows, item_totals, kept, one_value, punctuality, spread
from stallwise.plans.enrichment import eligible, valid_rows
from stallwise.plans.retention import late_repurchase
from stallwise.plans.sellers import ITEM_BANDS, activation_rate, local_seller_gmv
from stallwise.plans.star import Star


@dataclass(frozen=True)
class Assumptions:
    """Business assumptions of the sizing; the defaults are the published ones."""

    run_rate: tuple[str, str] = RUN_RATE
    card: str = CREDIT_CARD
    conversion: Mapping[str, float] = field(default_factory=lambda: dict(CONVERSION_RATES))
    increment: float = TICKET_INCREMENT
    recovery: float = RECOVERY_RATE
    recruits: Mapping[str, int] = field(default_factory=lambda: dict(RECRUITS))
    states: Sequence[str] = tuple(FOCUS_STATES)
    item_bands: Sequence[int] = ITEM_BANDS


DEFAULTS = Assumptions()


def _delivered_revenue(star: Star) -> DataFrame:
    orders = delivered(star).select("order_id", "purchase_timestamp")
    return orders.join(item_totals(star).select("order_id", "gmv"), "order_id")


def half_year_series(star: Star) -> DataFrame:
    """Delivered orders and revenue per half-year."""
    ts = "purchase_timestamp"
    return (
        _delivered_revenue(star)
        .groupBy(big(F.year(ts)).alias("year"), half_of(ts).alias("half"))
        .agg(F.count(F.lit(1)).alias("orders"), round_half_up(F.sum("gmv"), 2).alias("gmv"))
    )


def run_rate_base(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    """One row: delivered orders and revenue of the run-rate window."""
    window = _delivered_revenue(star).filter(in_window("purchase_timestamp", a.run_rate))
    return window.agg(F.count(F.lit(1)).alias("orders"), round_half_up(F.sum("gmv"), 2).alias("gmv"))


def history(star: Star, halves: int = 4, a: Assumptions = DEFAULTS) -> DataFrame:
    """Totals over all delivered orders, and the run-rate against the mean half-year; one pass."""
    in_run_rate = in_window("purchase_timestamp", a.run_rate)
    totals = _delivered_revenue(star).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("gmv").alias("gmv"),
        F.sum(F.when(in_run_rate, F.col("gmv"))).alias("run_rate"),
    )
    average = round_half_up("gmv", 2) / F.lit(float(halves))
    return totals.select(
        "orders",
        round_half_up("gmv", 2).alias("gmv"),
        mean("gmv", "orders", 2).alias("ticket"),
        round_half_up(average, 2).alias("mean_half"),
        round_half_up("run_rate", 2).alias("run_rate"),
        round_half_up(F.lit(100.0) * (F.try_divide(round_half_up("run_rate", 2), average) - F.lit(1.0)), 1).alias(
            "run_rate_vs_mean_pct"
        ),
    )


def _paid_orders(star: Star, condition: Column, *keys: str) -> DataFrame:
    """Payments that meet a condition, summed per order and keys before any join."""
    return (
        star.order_payments.filter(condition)
        .groupBy("order_id", *keys)
        .agg(F.sum("payment_value").alias("value"), F.count("payment_value").alias("n"))
    )


def value_by_installments(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    """Orders and mean payment by number of card installments, 1 to 12."""
    card = (F.col("payment_type") == a.card) & F.col("payment_installments").between(1, 12)
    per_order = kept(_paid_orders(star, card, "payment_installments"), star)
    return per_order.groupBy(big("payment_installments").alias("installments")).agg(
        F.count(F.lit(1)).alias("orders"), mean(F.sum("value"), F.sum("n"), 2).alias("mean_value")
    )


def installment_multiple(star: Star, many: int = 10, a: Assumptions = DEFAULTS) -> DataFrame:
    """Mean value at one and at ``many`` installments, their multiple and difference."""
    def at(n: int) -> Column:
        return F.max(F.when(F.col("installments") == n, F.col("mean_value")))

    return value_by_installments(star, a).agg(at(1).alias("one"), at(many).alias("many")).select(
        F.col("one").alias("mean_value_one"),
        F.col("many").alias("mean_value_many"),
        round_half_up(F.try_divide(F.col("many"), F.col("one")), 2).alias("multiple"),
        round_half_up(F.col("many") - F.col("one"), 2).alias("difference"),
    )


def high_ticket_categories(star: Star, min_orders: int = 500, k: int = 6) -> DataFrame:
    """Categories above a number of orders, highest mean price first."""
    products = star.dim_product.select("product_id", F.col("category_name").alias("category"))
    lines = item_rows(star).join(products, "product_id").select("order_id", "category", "priced", "gmv")
    # By order for the join and for the distinct orders of a category: one shuffle for both, of bounded tasks.
    per_order = (
        kept(spread(lines, star.order_items, "order_id"), star)
        .groupBy("order_id", "category")
        .agg(F.sum("gmv").alias("gmv"), F.sum("priced").alias("priced"))
    )
    per_category = (
        per_order.groupBy("category")
        .agg(
            F.count("order_id").alias("orders"),
            mean(F.sum("gmv"), F.sum("priced"), 2).alias("mean_price"),
            round_half_up(F.sum("gmv"), 2).alias("gmv"),
        )
        .filter(F.col("orders") > min_orders)
    )
    return top_rows(per_category, [F.desc("mean_price"), F.asc("category")], k)


def _single_payment_orders(star: Star, a: Assumptions) -> DataFrame:
    single = (F.col("payment_type") == a.card) & (F.col("payment_installments") == 1)
    paid = star.order_payments.filter(single).select("order_id").distinct()
    return star.fact_orders.select("order_id", "purchase_timestamp").join(paid, "order_id", "left_semi")


def single_installment_base(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    """Run-rate orders paid by card in one installment."""
    window = _single_payment_orders(star, a).filter(in_window("purchase_timestamp", a.run_rate))
    return window.agg(F.count(F.lit(1)).alias("orders"))


def single_installment_by_half(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    ts = "purchase_timestamp"
    return (
        _single_payment_orders(star, a)
        .groupBy(big(F.year(ts)).alias("year"), half_of(ts).alias("half"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def ticket_lever(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    """Scenarios: base orders times conversion times ticket increment."""
    scenarios = [F.struct(F.lit(n).alias("scenario"), F.lit(float(r)).alias("rate")) for n, r in a.conversion.items()]
    base = single_installment_base(star, a)
    return base.select("orders", F.explode(F.array(*scenarios)).alias("s")).select(
        "s.scenario",
        "orders",
        round_half_up(dbl("orders") * F.col("s.rate"), 2).alias("converted"),
        round_half_up(dbl("orders") * F.col("s.rate") * F.lit(a.increment), 2).alias("value"),
    )


def late_orders_effect(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    """Run-rate late orders times the distance between the two repurchase rates."""
    rate = F.col("repurchase_pct")
    delta = late_repurchase(star).agg(F.max(rate) - F.min(rate)).scalar()
    late = delivered(star).filter(F.col("is_late") & in_window("purchase_timestamp", a.run_rate))
    return late.agg(F.count(F.lit(1)).alias("late_orders")).select(
        "late_orders",
        round_half_up(delta, 2).alias("delta_pp"),
        round_half_up(dbl("late_orders") * delta / F.lit(100.0), 2).alias("customers_saved"),
    )


def detraction_by_punctuality(star: Star) -> DataFrame:
    """Detractors and their rate by punctuality, and each group's part of all detractors."""
    known = delivered(star).filter(F.col("is_late").isNotNull() & F.col("review_score").isNotNull())
    low = count_when(F.col("review_score") <= DETRACTOR_MAX_SCORE)
    groups = known.groupBy(punctuality().alias("status")).agg(
        F.count(F.lit(1)).alias("orders"),
        low.alias("detractors"),
        round_half_up(percent(low, F.count(F.lit(1))), 1).alias("detraction_pct"),
    )
    everyone = groups.agg(F.sum("detractors")).scalar()
    return groups.withColumn("pct_of_detractors", round_half_up(percent("detractors", everyone), 1))


def _on_time_detractors(star: Star) -> DataFrame:
    """NULL lateness is neither late nor on time, so such orders drop out."""
    return delivered(star).filter((F.col("review_score") <= DETRACTOR_MAX_SCORE) & ~F.col("is_late"))


def exposed_revenue(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    """Run-rate orders delivered on time whose reviewer is a detractor, and their revenue."""
    orders = _on_time_detractors(star).filter(in_window("purchase_timestamp", a.run_rate)).select("order_id")
    return (
        item_rows(star)
        .join(orders, "order_id", "left_semi")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.coalesce(round_half_up(F.sum("gmv"), 2), F.lit(0.0)).alias("exposed_gmv"),
        )
    )


def on_time_detraction_categories(star: Star, k: int = 6) -> DataFrame:
    """Categories with most on-time detractors."""
    lines = item_rows(star).join(
        _on_time_detractors(star).select("order_id"), "order_id", "left_semi"
    )
    products = star.dim_product.select("product_id", F.col("category_name").alias("category"))
    per_category = (
        lines.join(products, "product_id")
        .groupBy("category")
        .agg(
            F.count_distinct("order_id").alias("detractors"),
            round_half_up(F.sum("gmv"), 2).alias("exposed_gmv"),
        )
    )
    return top_rows(per_category, [F.desc("detractors"), F.asc("category")], k)


def complaint_distribution(classified: DataFrame, star: Star) -> DataFrame:
    """Share of each category among valid classifications, with trust gate and coverage per row.

    The gate fails when more than 5% of the rows are unclassified; then shares must not be quoted.
    """
    counts = classified.agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(valid_rows(classified), 1)).alias("valid")
    )
    c = counts.select(F.struct("total", "valid")).scalar()
    total, valid = c.getField("total"), c.getField("valid")
    population = eligible(star.fact_orders).agg(F.count(F.lit(1))).scalar()
    failed = dbl(total - valid) / F.greatest(dbl(total), F.lit(1.0))
    return (
        classified.filter(valid_rows(classified))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("complaints"))
        .select(
            "category",
            "complaints",
            round_half_up(percent("complaints", valid), 1).alias("pct"),
            (failed <= FALLBACK_LIMIT).alias("trusted"),
            round_half_up(percent(valid, population), 1).alias("coverage_pct"),
        )
    )


def curation_lever(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    """Exposed revenue times the share taken as recoverable."""
    return exposed_revenue(star, a).select(
        "exposed_gmv", round_half_up(F.col("exposed_gmv") * F.lit(a.recovery), 2).alias("value")
    )


def supply_lever(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    """Scenarios: recruits times activation rate times run-rate revenue per local seller."""
    scenarios = [F.struct(F.lit(n).alias("scenario"), F.lit(int(k)).alias("recruits")) for n, k in a.recruits.items()]
    rate = one_value(activation_rate(star, a.item_bands), "activation_rate")
    base = local_seller_gmv(star, a.states, a.run_rate).withColumn("rate", rate)
    return base.select("gmv_per_seller", "rate", F.explode(F.array(*scenarios)).alias("s")).select(
        "s.scenario",
        big("s.recruits").alias("recruits"),
        round_half_up("rate", 4).alias("activation_rate"),
        "gmv_per_seller",
        round_half_up(dbl("s.recruits") * F.col("rate") * F.col("gmv_per_seller"), 2).alias("value"),
    )


def consolidated(star: Star, a: Assumptions = DEFAULTS) -> DataFrame:
    """Minimum and maximum per lever and in total, against the run-rate base."""
    def span(df: DataFrame, name: str, mechanism: str) -> DataFrame:
        return df.agg(
            F.coalesce(F.min("value"), F.lit(0.0)).alias("low"), F.coalesce(F.max("value"), F.lit(0.0)).alias("high")
        ).select(F.lit(name).alias("lever"), F.lit(mechanism).alias("mechanism"), "low", "high")

    levers = reduce(
        DataFrame.unionByName,
        [
            span(ticket_lever(star, a), "1. installments", "larger tickets paid in installments"),
            span(curation_lever(star, a), "2. curation", "revenue kept by fewer complaints on punctual orders"),
            span(supply_lever(star, a), "3. local supply", "revenue of recruited local sellers"),
        ],
    )
    per_lever = levers.agg(
        F.sort_array(F.collect_list(F.struct("lever", "mechanism", "low", "high"))).alias("levers"),
        F.sum(F.col("low").cast("decimal(18,2)")).alias("low"),
        F.sum(F.col("high").cast("decimal(18,2)")).alias("high"),
    )
    none = F.lit(None).cast("string").alias("mechanism")
    total = F.struct(F.lit("total").alias("lever"), none, dbl("low").alias("low"), dbl("high").alias("high"))
    base = one_value(run_rate_base(star, a), "gmv")
    return (
        per_lever.select(F.explode(F.concat("levers", F.array(total))).alias("r"))
        .select("r.*", base.alias("base"))
        .select(
            "lever",
            "mechanism",
            "low",
            "high",
            round_half_up(percent("low", "base"), 2).alias("low_pct"),
            round_half_up(percent("high", "base"), 2).alias("high_pct"),
            round_half_up(F.col("base") + F.col("low"), 2).alias("new_level_low"),
            round_half_up(F.col("base") + F.col("high"), 2).alias("new_level_high"),
        )
    )
