import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stallwise.operators import distribution as d
from stallwise.operators import ranking


def money(spark, values):
    return spark.createDataFrame(pd.DataFrame({"x": [f"{v:.2f}" for v in values]})).select(
        F.col("x").cast("decimal(18,2)").alias("x")
    )


CASES = {
    "one": [3.5],
    "ties": [5.0] * 50 + [1.0, 9.0],
    "signs": [-100.0, -1.5, 0.0, 0.0, 2.25, 700.0],
    "wide": [0.01, 1e12, 3.0, 3.01, 3.02, 99.99],
    "random": [round(random.Random(3).lognormvariate(4, 1.2), 2) for _ in range(500)],
}


@pytest.mark.parametrize("name", CASES)
def test_quantiles_match_linear_interpolation(spark, name):
    probs = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = d.quantiles(money(spark, CASES[name]).repartition(5), F.col("x"), probs).first()
    assert list(got) == pytest.approx(list(np.quantile(CASES[name], probs)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    assert tuple(d.quantiles(money(spark, [1.0]).limit(0), F.col("x"), [0.5]).collect() or [(None,)])[0][0] is None


def test_buckets_follow_the_order_of_the_values(spark):
    values = sorted({*CASES["random"], *CASES["signs"], *CASES["wide"]})
    rows = spark.createDataFrame([(float(v),) for v in values], "x double")
    buckets = [r.b for r in rows.select("x", d.magnitude_bucket(F.col("x")).alias("b")).orderBy("x").collect()]
    assert buckets == sorted(buckets)


def test_running_totals(spark):
    values = CASES["ties"] + CASES["random"]
    rows = d.value_rows(money(spark, values), F.col("x"), with_amount=True)
    got = {
        float(r.value): (r.n, r.before_n, float(r.before_amount), r.all_n)
        for r in d.running_totals(rows, ["n", "amount"], descending=True).collect()
    }
    for v in set(values):
        above = [u for u in values if u > v]
        n, before, amount, everything = got[v]
        assert (n, before, everything) == (values.count(v), len(above), len(values))
        assert amount == pytest.approx(sum(above))


def test_describe_matches_pandas(spark):
    values = CASES["random"]
    row = d.describe(money(spark, values), ["x"]).first()
    s = pd.Series(values)
    assert row.n == len(s)
    for name, want in [
        ("mean", s.mean()),
        ("std", s.std()),
        ("min", s.min()),
        ("p25", s.quantile(0.25)),
        ("median", s.median()),
        ("p75", s.quantile(0.75)),
        ("max", s.max()),
        ("skewness", s.skew()),
    ]:
        assert row[name] == pytest.approx(want), name


def test_histogram_matches_numpy(spark):
    values = np.array(CASES["random"])
    kept = values[values < np.quantile(values, 0.99)]
    counts, _ = np.histogram(kept, bins=10)
    got = {r.bin: r.n for r in d.histogram(money(spark, values), "x", bins=10).collect()}
    assert sum(got.values()) == len(kept)
    assert max(abs(got.get(i + 1, 0) - c) for i, c in enumerate(counts)) <= 1


def brute_thresholds(revenues, thresholds):
    ordered = sorted(revenues, reverse=True)
    total, out = sum(ordered), {}
    for t in thresholds:
        cum = 0
        for i, v in enumerate(ordered, 1):
            cum += v
            if cum * 100 >= t * total:
                out[t] = i
                break
    return out


@pytest.mark.parametrize("seed", range(4))
def test_concentration_thresholds_match_brute_force(spark, seed):
    rng = random.Random(seed)
    cents = [rng.choice([100, 100, 100, 250, 999, rng.randint(1, 100_000)]) for _ in range(200)] + [0, 0]
    owners = spark.createDataFrame([(c,) for c in cents], "c bigint").select(
        (F.col("c") / 100).cast("decimal(28,2)").alias("gmv")
    )
    got = {r.pct_revenue: r.sellers for r in ranking.concentration_thresholds(owners, "gmv").collect()}
    assert got == brute_thresholds(cents, [50, 70, 80])


def test_equal_owners_are_one_level(spark):
    """A hot revenue value is crossed in the middle without numbering its owners."""
    owners = spark.range(1000).select("id", F.lit("10.00").cast("decimal(28,2)").alias("gmv"))
    rows = {r.pct_revenue: (r.sellers, r.pct_sellers) for r in ranking.concentration_thresholds(owners, "gmv").collect()}
    assert rows == {50: (500, 50.0), 70: (700, 70.0), 80: (800, 80.0)}
    curve = ranking.concentration_curve(owners, "id", "gmv").orderBy("id").collect()
    assert [(r.id, r.cum_owners, r.cum_revenue) for r in curve] == [(i, i + 1, 10.0 * (i + 1)) for i in range(1000)]


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "g string, v int")
    top = ranking.top_per_group(df, ["g"], [F.desc("v")], 2)
    assert sorted(map(tuple, top.collect())) == [("a", 48), ("a", 49), ("b", 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_bands(spark):
    df = spark.createDataFrame([(9,), (10,), (200,)], "v int")
    assert [r[0] for r in df.select(ranking.bands(F.col("v"), (10, 200))).collect()] == ["1. < 10", "2. < 200", "3. >= 200"]
    assert [r[0] for r in df.select(ranking.bands(F.col("v"), (10, 200), inclusive=True)).collect()] == [
        "1. <= 10",
        "1. <= 10",
        "2. <= 200",
    ]
