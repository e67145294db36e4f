"""Reproducible random samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.functions.constants import SAMPLE_SEED, SAMPLE_SIZE


def seeded_sample(df: DataFrame, key: str, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """``size`` rows in the order of a hash of seed and key: the same rows however df is partitioned.

    Each task keeps its own first ``size`` rows, so the table is never sorted as a whole.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    return df.withColumn("_draw", draw).orderBy("_draw", key).limit(size).drop("_draw")
