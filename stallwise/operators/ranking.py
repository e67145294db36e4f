"""Top rows, shares and concentration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stallwise.functions.numeric import big, dbl, percent, round_half_up
from stallwise.operators.distribution import levels_at, running_totals, value_rows


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; the caller ends ``order`` with a key so that ties are settled."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group; map tasks pre-limit each group before the shuffle."""
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")


def best_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return top_rows(df, order, 1)


def share_of_total(df: DataFrame, amount: str, name: str, digits: int) -> DataFrame:
    """Add the rounded percentage of the column total, which arrives as a one-value subquery."""
    whole = df.agg(F.sum(amount)).scalar()
    return df.withColumn(name, round_half_up(percent(amount, whole), digits))


def concentration_curve(owners: DataFrame, owner: str, revenue: str) -> DataFrame:
    """Owners from the largest revenue down (ties by the owner), with running sums and their shares.

    Running sums are made per distinct revenue; an owner adds its place among those of the same revenue.
    Only such equals are ordered in one task, by the owner.
    """
    rows = value_rows(owners, F.col(revenue), with_amount=True)
    totals = running_totals(rows, ["n", "amount"], descending=True)
    equals = W.partitionBy(revenue).orderBy(owner)
    placed = owners.select(owner, revenue).withColumn("_place", F.row_number().over(equals))
    joined = placed.join(totals, placed[revenue] == totals["value"])
    cum_n = F.col("before_n") + F.col("_place")
    cum_amount = F.col("before_amount") + F.col("_place") * F.col("value")
    return joined.select(
        owner,
        dbl("value").alias("revenue"),
        big(cum_n).alias("cum_owners"),
        dbl(cum_amount).alias("cum_revenue"),
        round_half_up(percent(cum_n, F.col("all_n")), 4).alias("cum_owners_pct"),
        round_half_up(percent(cum_amount, F.col("all_amount")), 4).alias("cum_revenue_pct"),
    )


def concentration_thresholds(owners: DataFrame, revenue: str, thresholds: Sequence[int] = (50, 70, 80)) -> DataFrame:
    """Fewest owners that reach each share of the total revenue, and their share of all owners.

    Exact: comparisons are in whole cents, and the position inside a group of equal revenues is
    the ceiling of what is missing over the revenue of one owner.
    """
    rows = value_rows(owners, F.col(revenue), with_amount=True)
    wanted = F.array(*[F.lit(int(t)) for t in thresholds])
    whole = "all_amount"

    def crosses(t, before, own):
        goal = t * F.col(whole)
        return (before("amount") * 100 < goal) & ((before("amount") + own("amount")) * 100 >= goal)

    hits = levels_at(rows, ["n", "amount"], wanted, crosses, descending=True)
    crossings = hits.select("*", F.explode("hits").alias("t")).select(
        big("t").alias("pct_revenue"),
        "before_n",
        "all_n",
        ((F.col("t") * F.col(whole) - F.col("before_amount") * 100) * 100).cast("decimal(38,0)").alias("missing"),
        (F.col("value") * 10000).cast("decimal(38,0)").alias("each"),
    )
    owners_needed = F.col("before_n") + F.expr("(missing + each - 1) div each")
    return crossings.select("pct_revenue", "all_n", big(owners_needed).alias("sellers")).select(
        "pct_revenue",
        "sellers",
        round_half_up(percent("sellers", "all_n"), 2).alias("pct_sellers"),
    )


def bands(value: Column, limits: Sequence, labels: Sequence[str] | None = None, inclusive: bool = False) -> Column:
    """Label by upper limits: ``< limit`` (or ``<=``), and one more label above the last limit."""
    labels = list(labels or default_labels(limits, inclusive))
    out = None
    for limit, label in zip(limits, labels):
        test = value <= F.lit(limit) if inclusive else value < F.lit(limit)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def default_labels(limits: Sequence, inclusive: bool) -> list[str]:
    sign = "<=" if inclusive else "<"
    over = ">" if inclusive else ">="
    names = [f"{i + 1}. {sign} {limit}" for i, limit in enumerate(limits)]
    return [*names, f"{len(limits) + 1}. {over} {limits[-1]}"]
