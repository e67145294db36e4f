import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stallwise.operators import outliers


def prices(spark, values):
    rows = [(i, None if v is None else f"{v:.2f}") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, p string")
    return df.select("id", F.col("p").cast("decimal(18,2)").alias("price"))


def flags(df):
    return {r.id: r.is_price_outlier for r in outliers.flag_outliers(df).collect()}


def test_far_price_is_flagged_and_kept(spark):
    # Powers of two, each twice: logarithms 0..7 in steps of ln 2, quartiles at 1.75 and 5.25 steps, so the fence
    # with a factor of one lies at 8.75 steps: 2 ** 8.75, about 430.5.
    df = prices(spark, [2.0**i for i in range(8) for _ in range(2)] + [430.0, 431.0])
    whole = outliers.outlier_limit(df.filter("price < 200"), iqr_multiplier=1.0).first()
    assert (whole.n, whole.method) == (16, outliers.LOG_FENCE)
    assert whole.upper_limit == pytest.approx(2**8.75)
    flagged = outliers.flag_outliers(df, limit=whole.upper_limit).collect()
    assert len(flagged) == 18 and [r.id for r in flagged if r.is_price_outlier] == [17]


def test_too_few_prices_give_no_limit(spark):
    df = prices(spark, [1, 2, 3, 4, 5, 6, 10000])
    limit = outliers.outlier_limit(df).first()
    assert (limit.method, limit.upper_limit) == (outliers.TOO_FEW, None)
    assert not any(flags(df).values())


def test_missing_prices_do_not_count_and_are_not_flagged(spark):
    df = prices(spark, [1, 2, 3, 4, 5, 6, 7, None, None])
    assert outliers.outlier_limit(df).first().method == outliers.TOO_FEW
    df = prices(spark, [1, 2, 3, 4, 5, 6, 7, 8, None])
    assert outliers.outlier_limit(df).first().method == outliers.Z_SCORE
    assert not any(flags(df).values())


def test_symmetric_prices_use_deviations(spark):
    values = list(range(1, 9))
    limit = outliers.outlier_limit(prices(spark, values)).first()
    s = pd.Series(values)
    assert limit.method == outliers.Z_SCORE
    assert limit.upper_limit == pytest.approx(s.mean() + 3 * s.std())


def test_constant_prices(spark):
    limit = outliers.outlier_limit(prices(spark, [5.0] * 20)).first()
    assert (limit.method, limit.skewness, limit.upper_limit) == (outliers.Z_SCORE, 0.0, 5.0)


def test_skewed_prices_without_enough_positive_ones_use_deviations(spark):
    values = [0, 0, 0, 0, -1, -2, 0, 0, 1, 2, 900000]
    limit = outliers.outlier_limit(prices(spark, values)).first()
    s = pd.Series(values)
    assert abs(s.skew()) > 1 and limit.method == outliers.Z_SCORE
    assert limit.upper_limit == pytest.approx(s.mean() + 3 * s.std())


def test_unread_flag_costs_nothing(spark):
    plan = outliers.flag_outliers(prices(spark, range(1, 20))).select("id")
    assert "subquery" not in plan._jdf.queryExecution().optimizedPlan().toString().lower()


def test_fence_comparison(spark):
    values = [round(float(v), 2) for v in np.random.default_rng(5).lognormal(3, 1, 400)]
    rows = {r.fence: r for r in outliers.compare_fences(prices(spark, values)).collect()}
    a = np.array(values)
    q1, q3 = np.quantile(a, [0.25, 0.75])
    assert rows["linear"].upper_limit == pytest.approx(q3 + 3 * (q3 - q1))
    assert rows["linear"].flagged == int((a > q3 + 3 * (q3 - q1)).sum())
    assert rows["log"].flagged <= rows["linear"].flagged


def test_row_read_now_is_that_of_the_plan(spark):
    import random

    rnd = random.Random(4)
    skewed = [(round(rnd.lognormvariate(3, 1), 2),) for _ in range(300)] + [(None,), (-1.0,)]
    for rows in (skewed, [(float(i),) for i in range(40)], [(1.0,)] * 5, []):
        df = spark.createDataFrame(rows, "price double").withColumn("price", F.col("price").cast("decimal(18,2)"))
        assert outliers.limit_row(df) == outliers.outlier_limit(df).first()
