"""Referential integrity: orphans leave the child table with a reason.

A NULL child key is an orphan unless the parent holds NULL too, so keys compare null-safe.
Only distinct child keys meet the parent; the child's rows then meet just the orphan keys. Where those
measure small, AQE broadcasts them and the rows stay in place; else the rows are shuffled by the key
and AQE splits a hot one. A key that fills a third of the child is one row in the first step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.operators.rules import REASON, ordered_counts, reliability

FAILED_REFERENCE = "failed_reference"


@dataclass(frozen=True)
class Reference:
    """``child_col`` of the child must exist as ``parent_col`` of ``parent``.

    ``orphans``: the keys without a parent, in a column ``_orphan_key``, where they are known already.
    """

    name: str
    child_col: str
    parent: DataFrame
    parent_col: str
    orphans: DataFrame | None = None

    @property
    def reason(self) -> str:
        return f"orphan: key '{self.child_col}' not in parent of '{self.name}'"


def orphan_keys(child: DataFrame, ref: Reference) -> DataFrame:
    """Distinct child keys without a parent, in a column ``_orphan_key``."""
    if ref.orphans is not None:
        return ref.orphans
    keys = child.select(F.col(ref.child_col).alias("_orphan_key")).distinct()
    parents = ref.parent.select(F.col(ref.parent_col).alias("_parent_key"))
    return keys.join(parents, F.col("_orphan_key").eqNullSafe(F.col("_parent_key")), "left_anti")


def shared_orphans(
    children: Mapping[str, tuple[DataFrame, str]], parent: DataFrame, parent_col: str
) -> DataFrame:
    """(_orphan_key, held): keys without a parent, and the names of the children (name -> table and column) with them.

    Children and parent are one tagged union, and one aggregate by key decides for all: one shuffle, whatever the
    number of children. Tags are combined on the map side, so a hot key is a row per task.
    """
    names = list(children)
    tables = [(df, column, 1 << i) for i, (df, column) in enumerate(children.values())]
    tables.append((parent, parent_col, 1 << len(names)))
    tagged = [df.select(F.col(column).alias("_orphan_key"), F.lit(tag).alias("_tags")) for df, column, tag in tables]
    tags = reduce(DataFrame.unionByName, tagged).groupBy("_orphan_key").agg(F.bit_or("_tags").alias("_tags"))
    held = F.array_compact(
        F.array(*[F.when(F.col("_tags").bitwiseAND(1 << i) != 0, F.lit(name)) for i, name in enumerate(names)])
    )
    return tags.where(F.col("_tags") < 1 << len(names)).select("_orphan_key", held.alias("held"))


def split_orphans(child: DataFrame, ref: Reference) -> tuple[DataFrame, DataFrame]:
    """Rows with a parent, and orphans with their reason."""
    orphans = orphan_keys(child, ref)
    on = child[ref.child_col].eqNullSafe(orphans["_orphan_key"])
    kept = child.join(orphans, on, "left_anti")
    lost = child.join(orphans, on, "left_semi").withColumn(REASON, F.lit(ref.reason))
    return kept, lost


def reference_counts(child: DataFrame, ref: Reference) -> DataFrame:
    """One row: check_name, total, failed, reliability_pct; rows are counted per key first."""
    per_key = child.groupBy(F.col(ref.child_col).alias("_child_key")).agg(F.count(F.lit(1)).alias("_n"))
    parents = (
        ref.parent.select(F.col(ref.parent_col).alias("_parent_key")).distinct().withColumn("_found", F.lit(True))
    )
    matched = per_key.join(parents, F.col("_child_key").eqNullSafe(F.col("_parent_key")), "left")
    return (
        matched.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total"),
            F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("failed"),
        )
        .select(F.lit(ref.name).alias("check_name"), "total", "failed")
        .withColumn("reliability_pct", reliability("total", "failed"))
    )


def tag_first_failure(child: DataFrame, refs: Sequence[Reference]) -> DataFrame:
    """Add the name of the first reference, in the given order, that each row fails (NULL if none)."""
    out = child
    for i, ref in enumerate(refs):
        orphans = orphan_keys(child, ref).select(
            F.col("_orphan_key").alias(f"_key{i}"), F.lit(True).alias(f"_lost{i}")
        )
        out = out.join(orphans, out[ref.child_col].eqNullSafe(orphans[f"_key{i}"]), "left")
    failures = [F.when(F.col(f"_lost{i}"), F.lit(ref.name)) for i, ref in enumerate(refs)]
    helpers = [name for i in range(len(refs)) for name in (f"_key{i}", f"_lost{i}")]
    first = F.coalesce(*failures) if failures else F.lit(None).cast("string")
    return out.withColumn(FAILED_REFERENCE, first).drop(*helpers)


def cascade_counts(tagged: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts per reference in order; the total of each is what the earlier ones left."""
    return ordered_counts(tagged, [(name, F.col(FAILED_REFERENCE) == name) for name in names])
