"""Row rules as column expressions, evaluated together in one projection.

A rule is violated when its predicate is false. A NULL operand never violates a range or a
cross-column rule; only ``not_null`` reports it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stallwise.functions.numeric import percent

VIOLATIONS = "violations"
REASON = "quarantine_reason"


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Callable[[], Column]


def _unless(predicate: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: ~F.coalesce(predicate(), F.lit(True))


def not_null(column: str, name: str | None = None) -> Rule:
    return Rule(name or f"not_null({column})", lambda: F.col(column).isNull())


def castable(column: str, type_name: str, raw: str | None = None) -> Rule:
    """Raw text that does not parse as ``type_name`` violates; missing text does not."""
    raw = raw or column
    return Rule(
        f"type({column}:{type_name})",
        lambda: F.col(raw).isNotNull() & F.col(raw).try_cast(type_name).isNull(),
    )


def at_least(column: str, low) -> Rule:
    return Rule(f"{column}>={low}", _unless(lambda: F.col(column) >= F.lit(low)))


def within(column: str, low, high) -> Rule:
    return Rule(f"{column} in {low}..{high}", _unless(lambda: F.col(column).between(low, high)))


def not_before(later: str, earlier: str, name: str | None = None) -> Rule:
    return Rule(name or f"{later}>={earlier}", _unless(lambda: F.col(later) >= F.col(earlier)))


def implies(name: str, premise: Callable[[], Column], conclusion: Callable[[], Column]) -> Rule:
    return Rule(
        name,
        lambda: F.coalesce(premise(), F.lit(False)) & ~F.coalesce(conclusion(), F.lit(False)),
    )


def violation_list(rules: Sequence[Rule]) -> Column:
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(r.violated(), F.lit(r.name)) for r in rules]))


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the list of violated rule names; every rule runs on every row, in one pass."""
    return df.withColumn(VIOLATIONS, violation_list(rules))


def with_reason(tagged: DataFrame) -> DataFrame:
    """Distinct rule names of a row joined with ' | '."""
    return tagged.withColumn(REASON, F.array_join(F.array_distinct(VIOLATIONS), " | "))


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return with_reason(tagged.filter(F.size(VIOLATIONS) > 0)).drop(VIOLATIONS)


def reliability(total, failed) -> Column:
    """100 * (1 - failed / total); a table without rows is fully reliable."""
    total, failed = F.col(total), F.col(failed)
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) * (F.lit(1.0) - F.try_divide(failed.cast("double"), total.cast("double")))
    )


def check_counts(tagged: DataFrame, check_name: str) -> DataFrame:
    """One row: check_name, total, failed, reliability_pct."""
    return ordered_counts(tagged, [(check_name, F.size(VIOLATIONS) > 0)])


def _step_counts(steps: Sequence[tuple[str, Column]]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_all"),
        *[F.count(F.when(failed, 1)).alias(f"_f{i}") for i, (_, failed) in enumerate(steps)],
    ]


def ordered_counts(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Counts of successive checks from one aggregate; the total of each is what the earlier left.

    The conditions of the steps must exclude each other.
    """
    counts = df.agg(*_step_counts(steps))
    rows, left = [], F.col("_all")
    for i, (name, _) in enumerate(steps):
        rows.append(F.struct(F.lit(name).alias("check_name"), left.alias("total"), F.col(f"_f{i}").alias("failed")))
        left = left - F.col(f"_f{i}")
    return (
        counts.select(F.explode(F.array(*rows)).alias("r"))
        .select("r.*")
        .withColumn("reliability_pct", reliability("total", "failed"))
    )


def observed_counts(
    df: DataFrame, steps: Sequence[tuple[str, Column]], write: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """The rows as ``write`` gives them back, and their ``ordered_counts``, taken while they were written.

    ``write`` must compute df, once. Only the counts, a number for each step, come to the driver.
    """
    seen = Observation()
    out = write(df.observe(seen, *_step_counts(steps)))
    counts, rows = seen.get, []
    left = counts["_all"]
    for i, (name, _) in enumerate(steps):
        rows.append((name, left, counts[f"_f{i}"]))
        left -= counts[f"_f{i}"]
    table = df.sparkSession.createDataFrame(rows, "check_name string, total bigint, failed bigint")
    return out, table.withColumn("reliability_pct", reliability("total", "failed"))


def violations_by_rule(tagged: DataFrame) -> DataFrame:
    """Rows per violated rule."""
    return (
        tagged.select(F.explode(VIOLATIONS).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("failed"))
    )


def violation_share(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its own count and share, from a single aggregate over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(r.violated(), 1)).alias(f"_{i}") for i, r in enumerate(rules)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.col(f"_{i}").alias("failed"))
            for i, r in enumerate(rules)
        ]
    )
    return counts.select("total", F.explode(rows).alias("r")).select(
        "r.rule", "total", "r.failed", percent("r.failed", "total").alias("failed_pct")
    )
