"""Verdicts over check counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.functions.constants import EXCELLENT_LIMIT, PASS_LIMIT


def verdicts(checks: DataFrame) -> DataFrame:
    """Add verdict (PASS / FAIL) and badge to rows with ``reliability_pct``."""
    score = F.col("reliability_pct")
    return checks.withColumn(
        "verdict", F.when(score >= PASS_LIMIT, F.lit("PASS")).otherwise(F.lit("FAIL"))
    ).withColumn(
        "badge",
        F.when(score >= EXCELLENT_LIMIT, F.lit("excellent"))
        .when(score >= PASS_LIMIT, F.lit("acceptable"))
        .otherwise(F.lit("critical")),
    )


def consolidated(checks: DataFrame) -> DataFrame:
    """One row: checks passed and checks run."""
    return checks.agg(
        F.count(F.when(F.col("reliability_pct") >= PASS_LIMIT, 1)).alias("passed"),
        F.count(F.lit(1)).alias("checks"),
    )
