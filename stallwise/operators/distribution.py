"""Exact quantiles, running totals and summaries without collecting the values anywhere.

Values are split by magnitude: the bucket is a fixed function of the value alone, so the split is
the same wherever and however often the plan is evaluated. Rows are summed per bucket on the map
side; for amounts of type decimal(18,2) there are at most 42 * 4096 buckets (ln of 0.01 to 1e16),
whatever the data size, so the bucket table may be ordered in one task and broadcast. Only the
buckets that a wanted position falls into are looked at value by value, and there equal values
are one row. A quantile thus costs two scans and shuffles a few buckets, never all values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stallwise.functions.numeric import dbl, mean, sample_skewness

STEPS_PER_E = 4096
# Keeps bucket numbers of positive values above zero for every double.
_SHIFT = 746 * STEPS_PER_E


def magnitude_bucket(value: Column) -> Column:
    """Bucket number that never decreases as the value grows."""
    x = dbl(value)
    size = (F.floor(F.ln(F.abs(x)) * STEPS_PER_E) + _SHIFT).cast("bigint")
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0).cast("bigint"))


def value_rows(df: DataFrame, value: Column, with_amount: bool = False) -> DataFrame:
    """Non-NULL values as ``value``, each with weight ``n`` = 1 and, if asked for, its ``amount``."""
    rows = df.select(value.alias("value")).filter(F.col("value").isNotNull())
    rows = rows.withColumn("n", F.lit(1).cast("bigint"))
    return rows.withColumn("amount", F.col("value")) if with_amount else rows


def _bucketed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_bucket", magnitude_bucket(F.col("value")))


def bucket_offsets(
    bucketed: DataFrame, weights: Sequence[str], descending: bool, by: Sequence[str] = ()
) -> DataFrame:
    """Per bucket (of each group ``by``): its own totals, those of the buckets before it, and the grand totals."""
    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    ordered = W.partitionBy(*by).orderBy(order)
    before = ordered.rowsBetween(W.unboundedPreceding, -1)
    everything = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per_bucket = bucketed.groupBy(*by, "_bucket").agg(*[F.sum(w).alias(f"in_{w}") for w in weights])
    columns = {}
    for w in weights:
        zero = F.lit(0).cast(per_bucket.schema[f"in_{w}"].dataType)
        columns[f"off_{w}"] = F.coalesce(F.sum(f"in_{w}").over(before), zero)
        columns[f"all_{w}"] = F.sum(f"in_{w}").over(everything)
    return per_bucket.withColumns(columns)


def _levels(
    bucketed: DataFrame, offsets: DataFrame, weights: Sequence[str], descending: bool, by: Sequence[str] = ()
) -> DataFrame:
    """Distinct values of the given buckets with their weights and ``before_<w>``, the total of all
    earlier values. ``offsets`` is small for money, see above, and broadcast if it measures small."""
    carried = [f"{kind}_{w}" for w in weights for kind in ("off", "all")]
    levels = (
        bucketed.join(offsets.select(*by, "_bucket", *carried), [*by, "_bucket"])
        .groupBy(*by, "_bucket", "value", *carried)
        .agg(*[F.sum(w).alias(w) for w in weights])
    )
    order = F.col("value").desc() if descending else F.col("value").asc()
    before = W.partitionBy(*by, "_bucket").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    columns = {}
    for w in weights:
        zero = F.lit(0).cast(levels.schema[w].dataType)
        columns[f"before_{w}"] = F.col(f"off_{w}") + F.coalesce(F.sum(w).over(before), zero)
    return levels.withColumns(columns).drop("_bucket", *[f"off_{w}" for w in weights])


def running_totals(rows: DataFrame, weights: Sequence[str], descending: bool = False) -> DataFrame:
    """One row per distinct value: its weights, ``before_<w>`` and the grand total ``all_<w>``."""
    bucketed = _bucketed(rows)
    return _levels(bucketed, bucket_offsets(bucketed, weights, descending), weights, descending)


def levels_at(
    rows: DataFrame, weights: Sequence[str], wanted: Column, hit, descending: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Distinct values on which a wanted position falls, with the positions in ``hits``.

    ``wanted`` is an array column over the ``all_<w>`` totals; ``hit(position, before, own)`` tells
    whether a position falls on a stretch, where ``before`` and ``own`` look up a weight.
    """
    bucketed = _bucketed(rows)
    needed = bucket_offsets(bucketed, weights, descending, by).filter(
        F.exists(wanted, lambda p: hit(p, lambda w: F.col(f"off_{w}"), lambda w: F.col(f"in_{w}")))
    )
    inside = _levels(bucketed, needed, weights, descending, by)
    hits = F.filter(wanted, lambda p: hit(p, lambda w: F.col(f"before_{w}"), lambda w: F.col(w)))
    return inside.withColumn("hits", hits).filter(F.size("hits") > 0)


def _position(n: Column, prob: float) -> Column:
    return (n - 1) * F.lit(float(prob))


def quantiles(df: DataFrame, value: Column, probs: Sequence[float], scale=dbl) -> DataFrame:
    """One row with exact quantiles ``q0, q1, ...`` by linear interpolation between neighbours.

    ``scale`` maps a value before interpolation (``dbl`` itself, or its logarithm); it must be
    increasing, so that order statistics of the value are those of the scaled value.
    """
    return _quantiles(value_rows(df, value), probs, scale)


def _quantiles(rows: DataFrame, probs: Sequence[float], scale=dbl, by: Sequence[str] = ()) -> DataFrame:
    """Quantiles of weighted values (``value``, ``n``), one row for each group ``by``."""
    wanted = F.array_distinct(
        F.array(
            *[edge(_position(F.col("all_n"), p)).cast("bigint") for p in probs for edge in (F.floor, F.ceil)]
        )
    )
    ranked = levels_at(
        rows,
        ["n"],
        wanted,
        lambda p, before, own: (p >= before("n")) & (p < before("n") + own("n")),
        by=by,
    )
    picked = ranked.select(*by, F.col("all_n").alias("n"), "value", F.explode("hits").alias("k"))
    at = []
    for i, p in enumerate(probs):
        h = _position(F.col("n"), p)
        at.append(F.max(F.when(F.col("k") == F.floor(h), F.col("value"))).alias(f"_lo{i}"))
        at.append(F.max(F.when(F.col("k") == F.ceil(h), F.col("value"))).alias(f"_hi{i}"))
    edges = picked.groupBy(*by).agg(F.max("n").alias("n"), *at)
    result = []
    for i, p in enumerate(probs):
        h = _position(F.col("n"), p)
        lo, hi = scale(F.col(f"_lo{i}")), scale(F.col(f"_hi{i}"))
        result.append((lo + (hi - lo) * (h - F.floor(h))).alias(f"q{i}"))
    return edges.select(*by, *result)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count, mean, sample deviation, min, quartiles, max and corrected skewness.

    The table is read twice for any number of columns: once for the measures, once for the counts of
    the distinct values of all columns, from which all quartiles come.
    """
    measures = []
    for c in columns:
        measures.append(
            F.struct(
                F.count(c).alias("n"),
                mean(F.sum(c), F.count(c)).alias("mean"),
                F.stddev_samp(dbl(c)).alias("std"),
                dbl(F.min(c)).alias("min"),
                dbl(F.max(c)).alias("max"),
                sample_skewness(c).alias("skewness"),
            ).alias(f"m_{c}")
        )
    rows = [F.struct(F.lit(c).alias("field"), F.col(f"m_{c}").alias("m")) for c in columns]
    measured = df.agg(*measures).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])))
    counted = long.select("col.*").filter("value IS NOT NULL").groupBy("field", "value").agg(F.count("*").alias("n"))
    quartiles = _quantiles(counted, [0.25, 0.5, 0.75], by=["field"])
    return measured.join(quartiles, "field", "left").select(
        "field",
        "m.n",
        "m.mean",
        "m.std",
        "m.min",
        F.col("q0").alias("p25"),
        F.col("q1").alias("median"),
        F.col("q2").alias("p75"),
        "m.max",
        "m.skewness",
    )


def histogram(df: DataFrame, column: str, bins: int = 50, below: float = 0.99) -> DataFrame:
    """Equal-width bins over the values under a quantile: ``bin`` (1..bins), ``n``."""
    # The table is read for the counts of its distinct values; limit, ends and bins come from those.
    counted = value_rows(df, F.col(column)).groupBy("value").agg(F.sum("n").alias("n"))
    cap = _quantiles(counted, [below]).scalar()
    kept = counted.select(dbl("value").alias("x"), "n").filter(F.col("x") < cap)
    ends = kept.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("s")).scalar()
    placed = kept.withColumn("s", ends)
    position = F.floor(F.try_divide((F.col("x") - F.col("s.lo")) * F.lit(float(bins)), F.col("s.hi") - F.col("s.lo")))
    number = F.least(F.coalesce(position + 1, F.lit(1)), F.lit(bins)).cast("bigint")
    return placed.groupBy(number.alias("bin")).agg(F.sum("n").alias("n"))
