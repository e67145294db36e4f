import random

from pyspark.sql import functions as F

from stallwise.operators.uniqueness import IS_REPEAT, keep_last, mark_repeats, repeat_count


def marked(df, keys, order):
    return sorted((tuple(r) for r in mark_repeats(df, keys, order).collect()), key=repr)


def expected(rows, key, order):
    """First row of each key by ``order`` stays."""
    seen, out = set(), []
    for row in sorted(rows, key=lambda r: tuple((r[i] is not None, r[i]) for i in order)):
        out.append((*row, key(row) in seen))
        seen.add(key(row))
    return sorted(out, key=repr)


def test_null_keys_are_equal(spark):
    rows = [(None, 1), (None, 2), (1, 3)]
    df = spark.createDataFrame(rows, "k int, v int")
    assert marked(df, ["k"], ["v"]) == expected(rows, lambda r: r[0], [1])


def test_random_keys_match_brute_force_for_any_partitioning(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3, 4, 5]), rng.randint(0, 30), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, t int, id int")
    want = expected(rows, lambda r: r[0], [1, 2])
    for n in (1, 7):
        assert marked(df.repartition(n), ["k"], ["t", "id"]) == want


def test_hot_key_of_exact_copies_keeps_exactly_one(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") < 15_000, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit("same").alias("v")
    )
    hot = F.col("k") == -1
    marks = mark_repeats(df, ["k"], []).groupBy(hot.alias("hot"), IS_REPEAT).count()
    counts = {(r.hot, r[IS_REPEAT]): r["count"] for r in marks.collect()}
    assert counts == {(True, False): 1, (True, True): 14_999, (False, False): 5_000}


def test_no_row_is_numbered(spark):
    plan = mark_repeats(spark.range(10).selectExpr("id % 2 AS k", "id"), ["k"], ["id"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number()" not in text and "monotonically_increasing_id" not in text

def test_repeat_count(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert tuple(repeat_count(df, ["k"]).first()) == (5, 2)
    assert tuple(repeat_count(df.limit(0), ["k"]).first()) == (0, 0)


def test_keep_last_limits_each_key_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, t int")
    last = keep_last(df, ["k"], [F.desc("t")])
    assert sorted(map(tuple, last.collect())) == [("a", 3), ("b", 2)]
    assert "WindowGroupLimit" in last._jdf.queryExecution().executedPlan().toString()
