"""Price outliers: flagged, never dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwise.functions.numeric import dbl, mean, sample_skewness
from stallwise.operators.distribution import quantiles

IS_OUTLIER = "is_price_outlier"

LOG_FENCE = "log_iqr"
Z_SCORE = "z_score"
TOO_FEW = "insufficient_sample"


def _ln(c):
    return F.ln(dbl(c))


def _shape(df: DataFrame, column: str, min_rows: int, skew_limit: float) -> DataFrame:
    """One row: n, n_positive, skewness, mean, std and the method they ask for."""
    shape = df.agg(
        F.count(column).alias("n"),
        F.count(F.when(F.col(column) > 0, 1)).alias("n_positive"),
        sample_skewness(column).alias("skewness"),
        mean(F.sum(column), F.count(column)).alias("mean"),
        F.stddev_samp(dbl(column)).alias("std"),
    )
    method = (
        F.when(F.col("n") < min_rows, F.lit(TOO_FEW))
        .when((F.abs("skewness") > skew_limit) & (F.col("n_positive") >= min_rows), F.lit(LOG_FENCE))
        .otherwise(F.lit(Z_SCORE))
    )
    return shape.withColumn("method", method)


def _limit(shape: DataFrame, iqr_multiplier: float, deviations: float) -> DataFrame:
    """The limit from the shape and the quartiles ``q`` of the logarithm."""
    fence = F.exp(F.col("q.q1") + F.lit(float(iqr_multiplier)) * (F.col("q.q1") - F.col("q.q0")))
    limit = F.when(F.col("method") == LOG_FENCE, fence).when(
        F.col("method") == Z_SCORE, F.col("mean") + F.lit(float(deviations)) * F.col("std")
    )
    return shape.select("n", "skewness", "method", limit.alias("upper_limit"))


def outlier_limit(
    df: DataFrame,
    column: str = "price",
    iqr_multiplier: float = 3.0,
    deviations: float = 3.0,
    min_rows: int = 8,
    skew_limit: float = 1.0,
) -> DataFrame:
    """One row: n, skewness, method and upper limit.

    Fewer than ``min_rows`` values: no limit. Skewed data with enough positive values: a fence of
    ``iqr_multiplier`` quartile ranges on the logarithm. Otherwise mean plus ``deviations``.
    The quartiles read rows only when the log branch applies.
    """
    shape = _shape(df, column, min_rows, skew_limit)
    use_log = shape.select(F.col("method") == LOG_FENCE).scalar()
    positive = df.filter((F.col(column) > 0) & use_log)
    quartiles = quantiles(positive, F.col(column), [0.25, 0.75], scale=_ln)
    return _limit(shape.withColumn("q", quartiles.select(F.struct("q0", "q1")).scalar()), iqr_multiplier, deviations)


def limit_row(
    df: DataFrame,
    column: str = "price",
    iqr_multiplier: float = 3.0,
    deviations: float = 3.0,
    min_rows: int = 8,
    skew_limit: float = 1.0,
) -> Row:
    """The row of ``outlier_limit``, read now: one pass, and the quartiles only if the log branch applies."""
    spark, shape = df.sparkSession, _shape(df, column, min_rows, skew_limit)
    row = shape.first()
    quartiles = None
    if row.method == LOG_FENCE:
        quartiles = quantiles(df.filter(F.col(column) > 0), F.col(column), [0.25, 0.75], scale=_ln).first()
    edges = T.StructType().add("q0", "double").add("q1", "double")
    schema = T.StructType([*shape.schema.fields]).add("q", edges)
    both = spark.createDataFrame([(*row, quartiles)], schema)
    return _limit(both, iqr_multiplier, deviations).first()


def flag_outliers(
    df: DataFrame,
    column: str = "price",
    flag: str = IS_OUTLIER,
    limit: float | None = None,
    **options,
) -> DataFrame:
    """Add ``flag``; rows without a value, or without a limit, are not outliers.

    Without a given ``limit`` it is that of all rows, as a scalar subquery: a query that does not read
    the flag does not compute it.
    """
    above = outlier_limit(df, column, **options).select("upper_limit").scalar() if limit is None else F.lit(limit)
    return df.withColumn(flag, F.coalesce(dbl(column) > above, F.lit(False)))


def linear_fence(df: DataFrame, column: str = "price", multiplier: float = 3.0) -> DataFrame:
    """One row ``upper_limit``: third quartile plus ``multiplier`` quartile ranges on the plain scale."""
    q = quantiles(df, F.col(column), [0.25, 0.75])
    return q.select((F.col("q1") + F.lit(float(multiplier)) * (F.col("q1") - F.col("q0"))).alias("upper_limit"))


def compare_fences(df: DataFrame, column: str = "price", multiplier: float = 3.0) -> DataFrame:
    """Linear against logarithmic fence: limit, flagged rows and their share of the total amount."""
    q = quantiles(df.filter(F.col(column) > 0), F.col(column), [0.25, 0.75], scale=_ln)
    log_fence = q.select(
        F.exp(F.col("q1") + F.lit(float(multiplier)) * (F.col("q1") - F.col("q0"))).alias("upper_limit")
    )
    limits = {"linear": F.col("_linear"), "log": F.col("_log")}
    amount = F.col(column)
    df = df.select(amount).withColumns(
        {"_linear": linear_fence(df, column, multiplier).scalar(), "_log": log_fence.scalar()}
    )
    parts = [F.sum(amount).alias("all_amount")]
    for name, limit in limits.items():
        parts.append(F.max(limit).alias(f"limit_{name}"))
        parts.append(F.count(F.when(dbl(amount) > limit, 1)).alias(f"n_{name}"))
        parts.append(F.coalesce(F.sum(F.when(dbl(amount) > limit, amount)), F.lit(0)).alias(f"amount_{name}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("fence"),
                F.col(f"limit_{name}").alias("upper_limit"),
                F.col(f"n_{name}").alias("flagged"),
                F.try_divide(F.lit(100.0) * dbl(f"amount_{name}"), dbl("all_amount")).alias("pct_amount"),
            )
            for name in limits
        ]
    )
    return df.agg(*parts).select(F.explode(rows).alias("r")).select("r.*")
