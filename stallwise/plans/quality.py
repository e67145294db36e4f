"""Quality run: rule sets, outlier flag, reference checks, audit, report. Bad rows never stop it."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.functions.constants import BOLETO
from stallwise.operators import audit as audits
from stallwise.operators import rules as r
from stallwise.operators.outliers import flag_outliers, limit_row
from stallwise.operators.references import (
    FAILED_REFERENCE,
    Reference,
    orphan_keys,
    shared_orphans,
    tag_first_failure,
)
from stallwise.operators.report import verdicts
from stallwise.operators.uniqueness import IS_REPEAT, mark_repeats
from stallwise.plans.star import Star, build_star, load_star, save_star
from stallwise.session import shared_dir
from stallwise.sources.layers import read_table, stage, write_quarantine, write_table
from stallwise.sources.raw import BAD_VALUES, POSITION, load_raw


@dataclass(frozen=True)
class RuleSet:
    """Rules of one entity. ``key`` must be unique; its first row in ``order_by`` stays."""

    entity: str
    check_name: str
    rules: Sequence[r.Rule]
    key: str | None = None
    order_by: Sequence[str] = ()


def single_installment(type_value: str = BOLETO) -> r.Rule:
    """Payments of one type must have exactly one installment."""
    return r.implies(
        f"{type_value} has one installment",
        lambda: F.col("payment_type") == type_value,
        lambda: F.col("payment_installments") == 1,
    )


def rule_sets(single_installment_type: str = BOLETO) -> dict[str, RuleSet]:
    sets = [
        RuleSet(
            "customers",
            "dim_customer (schema)",
            [r.not_null("customer_id"), r.not_null("customer_zip_code_prefix")],
            key="customer_id",
        ),
        RuleSet("sellers", "dim_seller (schema)", [r.not_null("seller_id")], key="seller_id"),
        RuleSet("products", "dim_product (schema)", [r.not_null("product_id")], key="product_id"),
        RuleSet(
            "orders",
            "fact_orders (schema and time order)",
            [
                r.not_null("order_id"),
                r.not_null("customer_id"),
                r.not_null("order_status"),
                r.not_null("order_purchase_timestamp"),
                r.not_before(
                    "order_delivered_customer_date", "order_purchase_timestamp", "delivered not before purchase"
                ),
            ],
            key="order_id",
        ),
        RuleSet(
            "order_items",
            "fact_items (schema)",
            [
                r.not_null("order_id"),
                r.not_null("product_id"),
                r.not_null("price"),
                r.not_null("freight_value"),
                r.at_least("price", 0),
                r.at_least("freight_value", 0),
            ],
        ),
        RuleSet(
            "payments",
            "fact_payments (schema and installments)",
            [
                r.not_null("order_id"),
                r.not_null("payment_type"),
                r.not_null("payment_installments"),
                r.not_null("payment_value"),
                r.at_least("payment_installments", 0),
                r.at_least("payment_value", 0),
                single_installment(single_installment_type),
            ],
        ),
        RuleSet(
            "reviews",
            "reviews (schema and scale 1-5)",
            [
                r.not_null("review_id"),
                r.not_null("order_id"),
                r.not_null("review_score"),
                r.not_null("review_creation_date"),
                r.within("review_score", 1, 5),
            ],
        ),
    ]
    return {s.entity: s for s in sets}


def tag_entity(
    df: DataFrame, rule_set: RuleSet, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Rows with the list of everything they violate: types, rules, key. ``keep`` writes the repeated keys first."""
    tagged = r.tag(df, rule_set.rules)
    found = F.col(r.VIOLATIONS)
    if BAD_VALUES in df.columns:
        types = F.transform(BAD_VALUES, lambda b: F.concat(F.lit("type("), b.getField("column"), F.lit(")")))
        tagged = tagged.withColumn(r.VIOLATIONS, F.concat(types, found))
    if rule_set.key:
        order = list(rule_set.order_by) or ([POSITION] if POSITION in df.columns else [])
        named = None if keep is None else lambda found, name: keep(found, f"{name}_{rule_set.entity}")
        repeat = F.when(F.col(IS_REPEAT), F.array(F.lit(f"unique({rule_set.key})"))).otherwise(
            F.array().cast("array<string>")
        )
        tagged = (
            mark_repeats(tagged, [rule_set.key], order, keep=named)
            .withColumn(r.VIOLATIONS, F.concat(found, repeat))
            .drop(IS_REPEAT)
        )
    return tagged


# Reference checks in order: child, check name, child column, parent, parent column.
REFERENCES = [
    ("orders", "orders_to_customers", "customer_id", "customers", "customer_id"),
    ("order_items", "items_to_orders", "order_id", "orders", "order_id"),
    ("order_items", "items_to_products", "product_id", "products", "product_id"),
    ("order_items", "items_to_sellers", "seller_id", "sellers", "seller_id"),
    ("payments", "payments_to_orders", "order_id", "orders", "order_id"),
    ("reviews", "reviews_to_orders", "order_id", "orders", "order_id"),
]


@dataclass
class QualityResult:
    clean: dict[str, DataFrame] = field(default_factory=dict)
    quarantine: dict[str, DataFrame] = field(default_factory=dict)
    checks: list[DataFrame] = field(default_factory=list)
    audit: DataFrame | None = None

    @property
    def report(self) -> DataFrame:
        return verdicts(reduce(DataFrame.unionByName, self.checks))


def _helpers(df: DataFrame) -> list[str]:
    return [c for c in (BAD_VALUES, POSITION) if c in df.columns]


def _shared_orphans(
    frames: Mapping[str, DataFrame],
    parent: DataFrame,
    entity: str,
    keep: Callable[[DataFrame, str], DataFrame] | None,
) -> dict[str, DataFrame]:
    """Orphan keys by check, of all checks against the entity if there are several of one key column."""
    checks = [(child, name, column, key) for child, name, column, of, key in REFERENCES if of == entity]
    if len(checks) < 2 or len({key for *_, key in checks}) > 1:
        return {}
    children = {name: (frames[child], column) for child, name, column, _ in checks}
    found = shared_orphans(children, parent, checks[0][3])
    found = found if keep is None else keep(found, f"orphans_{entity}")
    keys = {name: found.where(F.array_contains("held", name)).select("_orphan_key") for name in children}
    return keys if keep is None else {name: keep(df, f"orphans_{name}") for name, df in keys.items()}


def run_quality(
    frames: Mapping[str, DataFrame],
    sets: Mapping[str, RuleSet] | None = None,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
    outliers: Mapping[str, object] | None = None,
) -> QualityResult:
    """All checks, one tagged pass per entity, parents before children.

    A row fails its entity's rules first and then the references in order, so each check counts
    and quarantines what the earlier ones left. References to one parent and key are decided together,
    by one shuffle of the keys of all children. Repeated and orphan keys are written before the rows meet
    them, so that Spark knows their size and shuffles no whole rows for a few keys. ``keep`` writes a tagged
    entity and reads it back: the
    file run hands in a table writer, so that it is computed once, counted while it is written, and
    then read for the clean part, the bad part and the children. Without it all but the outlier limit
    stays one lazy plan.
    """
    result = QualityResult()
    broken = F.size(r.VIOLATIONS) > 0
    limit = None
    orphans: dict[str, DataFrame] = {}
    for entity, rule_set in (sets or rule_sets()).items():
        tagged = tag_entity(frames[entity], rule_set, keep)
        if entity == "order_items":
            # One row, read now: the flag and the audit share it.
            limit = limit_row(tagged.filter(~broken), "price", **(outliers or {}))
            above = math.inf if limit.upper_limit is None else limit.upper_limit
            tagged = flag_outliers(tagged, "price", limit=above)
        refs = [
            Reference(name, column, result.clean[parent], parent_column, orphans.get(name))
            for child, name, column, parent, parent_column in REFERENCES
            if child == entity
        ]
        if keep is not None:
            refs = [
                f if f.orphans is not None else replace(f, orphans=keep(orphan_keys(frames[entity], f), f"orphans_{f.name}"))
                for f in refs
            ]
        tagged = tag_first_failure(tagged, refs)
        orphan = F.col(FAILED_REFERENCE)
        steps = [(rule_set.check_name, broken)] + [(f.name, ~broken & (orphan == f.name)) for f in refs]
        if keep is None:
            counts = r.ordered_counts(tagged, steps)
        else:
            tagged, counts = r.observed_counts(tagged, steps, lambda df: keep(df, f"tagged_{entity}"))
        result.checks.append(counts)
        lost = F.coalesce(*[F.when(orphan == f.name, F.lit(f.reason)) for f in refs], F.lit(None).cast("string"))
        result.clean[entity] = tagged.filter(~broken & orphan.isNull()).drop(r.VIOLATIONS, FAILED_REFERENCE)
        result.quarantine[entity] = (
            r.with_reason(tagged.filter(broken | orphan.isNotNull()))
            .withColumn(r.REASON, F.when(broken, F.col(r.REASON)).otherwise(lost))
            .withColumn("check_name", F.when(broken, F.lit(rule_set.check_name)).otherwise(orphan))
            .drop(r.VIOLATIONS, FAILED_REFERENCE)
        )
        orphans |= _shared_orphans(frames, result.clean[entity], entity, keep)
    result.audit = audits.audit(
        result.clean["orders"], result.clean["products"], result.clean["reviews"], result.clean["order_items"], limit
    )
    if "category_translation" in frames:
        result.clean["category_translation"] = frames["category_translation"]
    return result


@dataclass(frozen=True)
class Layers:
    """Folders of a run, on storage that every executor reaches."""

    staging: str
    quarantine: str
    model: str
    work: str

    @classmethod
    def under(cls, base: str) -> Layers:
        """All layers below one folder; ``shared_dir`` names the one of the session."""
        base = base.rstrip("/")
        return cls(f"{base}/staging", f"{base}/quarantine", f"{base}/model", f"{base}/work")


def run_files(
    spark: SparkSession,
    raw_dir: str,
    layers: Layers | None = None,
    files: Mapping[str, str] | None = None,
    sets: Mapping[str, RuleSet] | None = None,
) -> tuple[QualityResult, Star]:
    """Raw files to staging, quarantine, report and model tables.

    Every step starts from a written table, so a lost executor repeats one step, not the run.
    Without ``layers`` they lie in the shared folder of the session.
    """
    layers = layers or Layers.under(f"{shared_dir(spark)}/stallwise")
    frames = load_raw(spark, raw_dir, dict(files or {}))
    result = run_quality(frames, sets, keep=lambda df, name: stage(df, layers.work, name))
    staged = {}
    for entity, df in result.clean.items():
        write_table(df.drop(*_helpers(df)), layers.staging, entity)
        staged[entity] = read_table(spark, layers.staging, entity)
    for entity, df in result.quarantine.items():
        write_quarantine(df, layers.quarantine, entity)
    write_table(result.report, layers.work, "dq_report")
    write_table(result.audit, layers.work, "dq_audit")
    save_star(build_star(staged), layers.model)
    return result, load_star(spark, layers.model)
