"""Key uniqueness with keep-first semantics, safe when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

IS_REPEAT = "is_repeat"


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(keys, right_keys):
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def mark_repeats(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    flag: str = IS_REPEAT,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Add ``flag``: false on the first row of each key in ``order_by``, true on the later ones.

    NULL keys are equal to each other. Files have no row order here, so the caller names the
    order; the remaining columns break ties, and of rows that are equal throughout one is kept.

    No row is numbered. Keys are counted (map-side, keys only); of keys that occur again, equal rows
    become one row with a count and the first row of the key is a minimum, both combined before the
    shuffle, so a hot key is a few rows per task. A row is a repeat if it comes after that first one;
    rows equal to a first that occurs several times are put back from the count. Nothing depends on
    the place of a row, so a recomputed task gives the same rows. Whole rows are joined to the firsts
    of repeated keys once, by broadcast where those are few. ``keep`` writes a small table and reads it back: then
    Spark knows how few they are before it shuffles whole rows, and without a repeated key no row is joined.
    """
    keys = list(keys)
    rest = [*order_by, *[c for c in df.columns if c not in keys and c not in order_by]]
    renamed = [f"_key{i}" for i in range(len(keys))]
    as_keys = [F.col(k).alias(r) for k, r in zip(keys, renamed)]
    again = df.groupBy(*as_keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    if keep is not None:
        again = keep(again, "again")
        if again.isEmpty():
            return df.withColumn(flag, F.lit(False))
    repeated = df.join(again, null_safe_on(df, again, keys, renamed), "left_semi")
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(0).alias("_none"))
    alike = repeated.groupBy(*as_keys, row.alias("_row")).agg(F.count(F.lit(1)).alias("_alike"))
    firsts = alike.groupBy(*renamed).agg(F.min(F.struct("_row", "_alike")).alias("_first"))
    firsts = firsts.select(*renamed, F.col("_first._row").alias("_row"), F.col("_first._alike").alias("_alike"))
    firsts = firsts if keep is None else keep(firsts, "firsts")

    joined = df.join(firsts, null_safe_on(df, firsts, keys, renamed), "left")
    is_first = row.eqNullSafe(F.col("_row"))
    kept = joined.filter(F.col("_alike").isNull() | (F.col("_alike") == 1) | ~is_first)
    kept = kept.select(*df.columns, (F.col("_alike").isNotNull() & ~is_first).alias(flag))
    back = firsts.filter("_alike > 1").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_alike"))))
    values = {k: F.col(r) for k, r in zip(keys, renamed)} | {c: F.col("_row").getField(c) for c in rest}
    return kept.unionByName(back.select(*[values[c].alias(c) for c in df.columns], (F.col("_copy") > 1).alias(flag)))


def repeat_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in the table and rows beyond the first of their key (NULLs form one key)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("failed"),
    )


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Whole row that is last in ``order_by`` for each key.

    The rank filter becomes a partial group limit before the shuffle: each map task sends at most
    one row per key.
    """
    latest_first = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(latest_first)).filter("_rank = 1").drop("_rank")
