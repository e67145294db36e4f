"""Every query by name over the provided tables: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache, reduce
from operator import add

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.functions.numeric import money, round_half_up
from stallwise.operators import audit, outliers, ranking, references, report, rules, uniqueness
from stallwise.plans import enrichment, levers, profile, quality, retention, reviews, sales, sellers, star, topics
from stallwise.session import written
from stallwise.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that replace published literals which do not fit the value ranges of the test tables.
ASSUMPTIONS = levers.Assumptions(
    run_rate=fx.RUN_RATE,
    card=fx.CARD,
    # Nations of the fixture's focus region; tests compare them with the region map of the tables.
    states=("NATION_2", "NATION_7", "NATION_12", "NATION_17", "NATION_22"),
    item_bands=(570, 600, 620),
)
HALVES = 13
VALUE_BANDS = (100_000, 250_000)
MIN_ORDERS = 2000
# Rows of the seeded sample: fewer than there are eligible texts in any of the test tables.
SAMPLE = 20
TAXONOMY = {
    "slow_parcel": ["pour", "nicht", "thing"],
    "wrong_item": ["with", "avec", "mente"],
    "broken_item": ["from", "dans", "heit"],
    "no_answer": ["this", "sich", "para"],
}
DEADLINE_WORDS = ["pour", "thing"]
PRODUCT_WORDS = ["with", "from"]
# Parts of the category names that stand for failures of the seller.
SELLER_PARTS = ("wrong", "broken")
# Texts that the lot classifier leaves out, and a category it may not use: both become fallback rows.
LEFT_OUT, NOT_ALLOWED = "für", "broken_item"
LANGUAGES = ("english", "french", "german", "spanish")

PAYMENT_RULES = [rules.at_least("payment_value", 20000), quality.single_installment(fx.CARD)]


def _on_star(plan: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: plan(fx.star(spark, sf), *args, **kwargs)


def _keyword_classes(reviews_df: DataFrame) -> DataFrame:
    return enrichment.classify_by_keywords(
        reviews_df,
        TAXONOMY,
        deadline="slow_parcel",
        product=["wrong_item", "broken_item"],
        service="no_answer",
    )


def _classified(model: star.Star) -> DataFrame:
    return enrichment.enrich(model.fact_orders, _keyword_classes, size=None, run_id="fixture")


def _on_classified(plan: Callable[..., DataFrame], with_star: bool = True, **kwargs) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        model = fx.star(spark, sf)
        return plan(_classified(model), model, **kwargs) if with_star else plan(_classified(model), **kwargs)

    return run


def _lot_classifier(lot: pd.DataFrame) -> str:
    """Batch function with the rules of the keyword classifier; its JSON reply leaves texts with LEFT_OUT out."""
    lot = lot[~lot["text"].str.lower().str.contains(LEFT_OUT, regex=False)]
    lowered = lot["text"].str.lower()
    hits = {n: {w: lowered.str.contains(w, regex=False) for w in words} for n, words in TAXONOMY.items()}
    counts = pd.DataFrame({n: sum(found.values()) for n, found in hits.items()}, index=lot.index)
    most = counts.max(axis=1)
    reply = pd.DataFrame({"order_id": lot["order_id"], "category": counts.idxmax(axis=1), "reason": ""})
    for name, found in hits.items():
        words = reduce(add, [here.map({True: f", {w}", False: ""}) for w, here in found.items()])
        reply.loc[reply["category"] == name, "reason"] = words.str.removeprefix(", ")
    reply.loc[most == 0, "category"] = "nao_classificado"
    reply["severity"] = most.clip(upper=3).map({0: "indeterminada", 1: "baixa", 2: "media", 3: "alta"})
    reply["about_deadline"] = counts["slow_parcel"] > 0
    reply["about_product"] = (counts["wrong_item"] > 0) | (counts["broken_item"] > 0)
    reply["about_service"] = counts["no_answer"] > 0
    return json.dumps({"classifications": reply.to_dict("records")})


def _classified_lots(spark: SparkSession, sf: str) -> DataFrame:
    allowed = [*[name for name in TAXONOMY if name != NOT_ALLOWED], "nao_classificado"]
    return enrichment.classify_lots(
        enrichment.eligible(fx.star(spark, sf).fact_orders),
        _lot_classifier,
        categories=allowed,
        deadline_words=DEADLINE_WORDS,
        product_words=PRODUCT_WORDS,
    )


def _replies(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword classes as JSON replies; one in five is cut and doesn't parse."""
    classes = _keyword_classes(enrichment.eligible(fx.star(spark, sf).fact_orders))
    rows = classes.withColumn("order_id", F.col("order_id").cast("string"))
    reply = F.to_json(F.struct(F.array(F.struct(*rows.columns)).alias("classifications")))
    broken = F.col("order_id").cast("long") % 5 == 0
    return rows.select(F.when(broken, F.substring(reply, 1, 20)).otherwise(reply).alias("reply"))


# --- quality -------------------------------------------------------------------------------


def dq_not_null(spark, sf):
    products = rules.violation_share(fx.products(spark, sf), [rules.not_null("product_category_name")])
    orders = rules.violation_share(fx.orders(spark, sf), [rules.not_null("order_delivered_customer_date")])
    return products.unionByName(orders)


def dq_type(spark, sf):
    text = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(F.col("c_acctbal").cast("string"))
    raw = fx.table(spark, sf, "customer").select(text.alias("balance"))
    return rules.violation_share(raw, [rules.castable("balance", "decimal(18,2)")])


def dq_range(spark, sf):
    balances = fx.table(spark, sf, "customer").select(F.col("c_acctbal").alias("balance"))
    low = rules.violation_share(balances, [rules.at_least("balance", 0)])
    return low.unionByName(rules.violation_share(fx.reviews(spark, sf), [rules.within("review_score", 1, 4)]))


def dq_unique(spark, sf):
    lines = fx.table(spark, sf, "lineitem")
    order = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
    marked = uniqueness.mark_repeats(lines, ["l_orderkey", "l_linenumber"], order)
    return marked.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        uniqueness.IS_REPEAT,
    )


def dq_unique_counts(spark, sf):
    return uniqueness.repeat_count(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_time_order(spark, sf):
    lines, orders = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
    joined = lines.select("l_orderkey", "l_shipdate").join(
        orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return rules.violation_share(joined, [rules.not_before("l_shipdate", "o_orderdate", "shipped not before purchase")])


def dq_implication(spark, sf):
    return rules.violation_share(fx.payments(spark, sf), [quality.single_installment(fx.CARD)])


def _tagged_payments(spark, sf):
    return rules.tag(fx.payments(spark, sf), PAYMENT_RULES)


def dq_reasons(spark, sf):
    bad = rules.quarantined_rows(_tagged_payments(spark, sf))
    return bad.groupBy(rules.REASON).agg(F.count(F.lit(1)).alias("rows"))


def dq_reliability(spark, sf):
    orders = rules.tag(
        fx.orders(spark, sf), [rules.not_before("order_delivered_customer_date", "order_purchase_timestamp")]
    )
    return rules.check_counts(_tagged_payments(spark, sf), "payments").unionByName(rules.check_counts(orders, "orders"))


def _solvent_customers(spark, sf):
    parents = fx.table(spark, sf, "customer").filter("c_acctbal >= 0")
    return references.Reference("orders_to_customers", "customer_id", parents, "c_custkey")


def dq_reference_counts(spark, sf):
    return references.reference_counts(fx.orders(spark, sf), _solvent_customers(spark, sf))


def dq_reference_kept(spark, sf):
    kept, _ = references.split_orphans(fx.orders(spark, sf), _solvent_customers(spark, sf))
    return kept.select("order_id", "customer_id", "order_status")


def dq_reference_orphans(spark, sf):
    _, lost = references.split_orphans(fx.orders(spark, sf), _solvent_customers(spark, sf))
    return lost.select("order_id", "customer_id", rules.REASON)


def dq_reference_cascade(spark, sf):
    parents = [
        ("items_to_orders", "order_id", fx.table(spark, sf, "orders").filter("o_orderstatus <> 'P'"), "o_orderkey"),
        ("items_to_products", "product_id", fx.table(spark, sf, "part").filter("p_type <> 'PROMO'"), "p_partkey"),
        ("items_to_sellers", "seller_id", fx.table(spark, sf, "supplier").filter("s_acctbal >= 0"), "s_suppkey"),
    ]
    refs = [references.Reference(*p) for p in parents]
    tagged = references.tag_first_failure(fx.items(spark, sf), refs)
    return references.cascade_counts(tagged, [ref.name for ref in refs])


def _rounded_limit(df):
    return df.select(
        "n", round_half_up("skewness", 6).alias("skewness"), "method", round_half_up("upper_limit", 6).alias("upper_limit")
    )


def _event_values(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", money("value").alias("value"))


def dq_outlier_zscore(spark, sf):
    return _rounded_limit(outliers.outlier_limit(fx.items(spark, sf), "price", deviations=fx.PRICE_DEVIATIONS))


def dq_outlier_log(spark, sf):
    return _rounded_limit(outliers.outlier_limit(_event_values(spark, sf), "value", iqr_multiplier=1.0))


def dq_outlier_flags(spark, sf):
    return fx.flagged_items(spark, sf).select("order_id", "order_item_id", "price", outliers.IS_OUTLIER)


def dq_outlier_flags_log(spark, sf):
    flagged = outliers.flag_outliers(_event_values(spark, sf), "value", iqr_multiplier=1.0)
    return flagged.select("event_id", outliers.IS_OUTLIER)


def dq_fence_comparison(spark, sf):
    compared = outliers.compare_fences(_event_values(spark, sf), "value")
    return compared.select(
        "fence",
        round_half_up("upper_limit", 6).alias("upper_limit"),
        "flagged",
        round_half_up("pct_amount", 6).alias("pct_amount"),
    )


def dq_audit(spark, sf):
    items = fx.flagged_items(spark, sf)
    limit = outliers.limit_row(fx.items(spark, sf), "price", deviations=fx.PRICE_DEVIATIONS)
    return audit.audit(fx.orders(spark, sf), fx.products(spark, sf), fx.reviews(spark, sf), items, limit)


@lru_cache(maxsize=4)
def _run(spark, sf):
    """One run for all its queries in a session, with each tagged entity written once, as the file run does."""
    return quality.run_quality(
        fx.Entities(spark, sf),
        quality.rule_sets(fx.CARD),
        keep=written,
        outliers={"deviations": fx.PRICE_DEVIATIONS},
    )


QUALITY: dict[str, Query] = {
    "dq_not_null": dq_not_null,
    "dq_type": dq_type,
    "dq_range": dq_range,
    "dq_unique": dq_unique,
    "dq_unique_counts": dq_unique_counts,
    "dq_time_order": dq_time_order,
    "dq_implication": dq_implication,
    "dq_reasons": dq_reasons,
    "dq_violations_by_rule": lambda spark, sf: rules.violations_by_rule(_tagged_payments(spark, sf)),
    "dq_clean_rows": lambda spark, sf: rules.clean_rows(_tagged_payments(spark, sf)),
    "dq_quarantined_rows": lambda spark, sf: rules.quarantined_rows(_tagged_payments(spark, sf)),
    "dq_reliability": dq_reliability,
    "dq_reference_counts": dq_reference_counts,
    "dq_reference_kept": dq_reference_kept,
    "dq_reference_orphans": dq_reference_orphans,
    "dq_reference_cascade": dq_reference_cascade,
    "dq_outlier_zscore": dq_outlier_zscore,
    "dq_outlier_log": dq_outlier_log,
    "dq_outlier_flags": dq_outlier_flags,
    "dq_outlier_flags_log": dq_outlier_flags_log,
    "dq_fence_comparison": dq_fence_comparison,
    "dq_audit": dq_audit,
    "dq_run_report": lambda spark, sf: _run(spark, sf).report,
    "dq_run_verdict": lambda spark, sf: report.consolidated(_run(spark, sf).report),
    "dq_run_audit": lambda spark, sf: _run(spark, sf).audit,
}

# --- model and analyses --------------------------------------------------------------------

MODEL: dict[str, Query] = {
    **{f"model_{name}": (lambda spark, sf, name=name: getattr(fx.star(spark, sf), name)) for name in star.TABLES},
    "model_latest_review": lambda spark, sf: star.latest_review(fx.reviews(spark, sf)),
}

PROFILE: dict[str, Query] = {
    "profile_row_counts": _on_star(profile.row_counts),
    "profile_integrity": _on_star(profile.integrity),
    "profile_period": _on_star(profile.period),
    "profile_price_summary": _on_star(profile.price_summary),
    "profile_price_location": _on_star(profile.price_location),
    "profile_price_histogram": _on_star(profile.price_histogram, "price"),
    "profile_freight_histogram": _on_star(profile.price_histogram, "freight_value"),
    "profile_freight_by_value": _on_star(profile.freight_by_value, VALUE_BANDS),
    "profile_by_state": _on_star(profile.by_state),
    "profile_top_states": _on_star(profile.top_states),
    "profile_state_share": _on_star(profile.state_share, "NATION_8"),
    "profile_payment_mix": _on_star(profile.payment_mix),
    "profile_score_distribution": _on_star(profile.score_distribution),
    "profile_detractor_rate": _on_star(profile.detractor_rate),
}

SALES: dict[str, Query] = {
    "sales_monthly_series": _on_star(sales.monthly_series),
    "sales_peak_month": _on_star(sales.peak_month),
    "sales_seasonality": _on_star(sales.seasonality, fx.COMPLETE_MONTHS),
    "sales_category_ranking": _on_star(sales.category_ranking),
    "sales_category_concentration": _on_star(sales.category_concentration, 3),
    "sales_weekday_share": _on_star(sales.weekday_share),
    "sales_removed_by_cancellation": _on_star(sales.removed_by_cancellation),
}

RETENTION: dict[str, Query] = {
    "retention_late_repurchase": _on_star(retention.late_repurchase),
    "retention_late_repurchase_test": _on_star(retention.late_repurchase_test),
    "retention_late_repurchase_significance": _on_star(retention.late_repurchase_significance),
    "retention_delivery_days": _on_star(retention.delivery_days),
    "retention_score_repurchase": _on_star(retention.score_repurchase),
    "retention_score_amplitude": _on_star(retention.score_repurchase_amplitude),
    "retention_late_orders_ceiling": _on_star(retention.late_orders_ceiling, fx.RUN_RATE),
    "retention_value_by_region": lambda spark, sf: retention.value_by_region(fx.star(spark, sf), fx.states(spark, sf)),
}

SELLERS: dict[str, Query] = {
    "sellers_pareto_thresholds": _on_star(sellers.pareto_thresholds),
    "sellers_pareto_curve": _on_star(sellers.pareto_curve),
    "sellers_long_tail": _on_star(sellers.long_tail, ASSUMPTIONS.item_bands),
}

LEVERS: dict[str, Query] = {
    "lever_half_year_series": _on_star(levers.half_year_series),
    "lever_history": _on_star(levers.history, HALVES, ASSUMPTIONS),
    "lever_value_by_installments": _on_star(levers.value_by_installments, ASSUMPTIONS),
    "lever_installment_multiple": _on_star(levers.installment_multiple, 10, ASSUMPTIONS),
    "lever_high_ticket_categories": _on_star(levers.high_ticket_categories, MIN_ORDERS),
    "lever_single_installment_base": _on_star(levers.single_installment_base, ASSUMPTIONS),
    "lever_single_installment_by_half": _on_star(levers.single_installment_by_half, ASSUMPTIONS),
    "lever_ticket_scenarios": _on_star(levers.ticket_lever, ASSUMPTIONS),
    "lever_late_orders_effect": _on_star(levers.late_orders_effect, ASSUMPTIONS),
    "lever_detraction_by_punctuality": _on_star(levers.detraction_by_punctuality),
    "lever_exposed_revenue": _on_star(levers.exposed_revenue, ASSUMPTIONS),
    "lever_on_time_detraction_categories": _on_star(levers.on_time_detraction_categories, 3),
    "lever_complaint_distribution": _on_classified(levers.complaint_distribution),
    "lever_curation": _on_star(levers.curation_lever, ASSUMPTIONS),
    "lever_supply_imbalance": _on_star(sellers.supply_imbalance, ASSUMPTIONS.states),
    "lever_local_supply": _on_star(sellers.local_supply, ASSUMPTIONS.states),
    "lever_local_supply_change": _on_star(sellers.local_supply_change, ASSUMPTIONS.states),
    "lever_remote_orders_by_state": _on_star(sellers.remote_orders_by_state, ASSUMPTIONS.states),
    "lever_activation_bands": _on_star(sellers.activation_bands, ASSUMPTIONS.item_bands),
    "lever_activation_rate": _on_star(sellers.activation_rate, ASSUMPTIONS.item_bands),
    "lever_local_seller_gmv": _on_star(sellers.local_seller_gmv, ASSUMPTIONS.states, fx.RUN_RATE),
    "lever_supply_scenarios": _on_star(levers.supply_lever, ASSUMPTIONS),
    "lever_consolidated": _on_star(levers.consolidated, ASSUMPTIONS),
}

# --- texts ---------------------------------------------------------------------------------


# Topics of the test tables: four languages without a stop word list, so frequent terms are left out by their share.
TOPICS, TOPIC_PASSES, TOPIC_SEED, TOPIC_MAX_PERCENT = 4, 8, 42, 25


@lru_cache(maxsize=4)
def _topic_model(spark: SparkSession, sf: str) -> topics.TopicModel:
    """One fit for all topic queries of a session."""
    texts = enrichment.eligible(fx.star(spark, sf).fact_orders)
    return topics.discover_topics(
        texts, k=TOPICS, seed=TOPIC_SEED, languages=(), passes=TOPIC_PASSES, max_percent=TOPIC_MAX_PERCENT
    )


def text_topic_step(spark, sf):
    """Weights of the terms after one pass."""
    texts = enrichment.eligible(fx.star(spark, sf).fact_orders)
    model = topics.discover_topics(
        texts, k=TOPICS, seed=TOPIC_SEED, languages=(), passes=1, max_percent=TOPIC_MAX_PERCENT
    )
    return model.weights


def text_topics(spark, sf):
    """A row for each keyword of each topic."""
    texts = enrichment.eligible(fx.star(spark, sf).fact_orders)
    found = _topic_model(spark, sf).taxonomy(texts).select(F.explode("categories").alias("c"))
    keyword = F.posexplode("c.keywords").alias("place", "keyword")
    return found.select("c.category_id", "c.display_name", "c.description", keyword)


def text_topic_shares(spark, sf):
    assigned = _topic_model(spark, sf).assign(enrichment.eligible(fx.star(spark, sf).fact_orders))
    counts = assigned.groupBy("category").agg(F.count(F.lit(1)).alias("complaints"))
    return ranking.share_of_total(counts, "complaints", "pct", 1)


TEXT: dict[str, Query] = {
    "text_eligible": lambda spark, sf: enrichment.eligible(fx.star(spark, sf).fact_orders),
    "text_population": lambda spark, sf: enrichment.population(fx.star(spark, sf).fact_orders),
    "text_sample": lambda spark, sf: enrichment.review_sample(fx.star(spark, sf).fact_orders, SAMPLE).select(
        "order_id", "review_score"
    ),
    "text_sample_coverage": lambda spark, sf: enrichment.sample_coverage(
        enrichment.review_sample(fx.star(spark, sf).fact_orders, SAMPLE), fx.star(spark, sf).fact_orders
    ),
    "text_fallback_flags": lambda spark, sf: enrichment.fallback_rows(
        enrichment.eligible(fx.star(spark, sf).fact_orders), DEADLINE_WORDS, PRODUCT_WORDS
    ),
    "text_classify_keywords": lambda spark, sf: _keyword_classes(enrichment.eligible(fx.star(spark, sf).fact_orders)),
    "text_classify_lots": _classified_lots,
    "text_parse_replies": lambda spark, sf: enrichment.parse_replies(_replies(spark, sf), "reply"),
    "text_failure_share": lambda spark, sf: enrichment.failure_share(
        _keyword_classes(enrichment.eligible(fx.star(spark, sf).fact_orders))
    ),
    "text_enriched": lambda spark, sf: _classified(fx.star(spark, sf)).drop("classified_at"),
    "text_topic_terms": lambda spark, sf: topics.term_documents(
        enrichment.eligible(fx.star(spark, sf).fact_orders)
    ),
    "text_topic_step": text_topic_step,
    "text_topics": text_topics,
    "text_topic_shares": text_topic_shares,
}

REVIEWS: dict[str, Query] = {
    "reviews_run_summary": lambda spark, sf: reviews.run_summary(_classified(fx.star(spark, sf))).drop("last_run"),
    "reviews_coverage": _on_classified(reviews.coverage),
    "reviews_score_distribution": _on_classified(reviews.score_distribution),
    "reviews_category_distribution": _on_classified(reviews.category_distribution, False),
    "reviews_severity_by_category": _on_classified(reviews.severity_by_category, False),
    "reviews_worst_categories": _on_classified(reviews.worst_categories, False),
    "reviews_category_by_punctuality": _on_classified(reviews.category_by_punctuality),
    "reviews_revenue_by_category": _on_classified(reviews.revenue_by_category),
    "reviews_sellers_with_complaints": _on_classified(reviews.sellers_with_complaints, parts=SELLER_PARTS),
    "reviews_product_categories_with_complaints": _on_classified(reviews.product_categories_with_complaints, k=3),
}

ALL: dict[str, Query] = {**QUALITY, **MODEL, **PROFILE, **SALES, **RETENTION, **SELLERS, **LEVERS, **TEXT, **REVIEWS}
