import pytest
from pyspark.sql import functions as F

import shop
from stallwise.plans import levers, profile, sales, sellers
from stallwise.plans.star import (
    TABLES,
    build_dim_product,
    dim_date_over,
    latest_review,
    load_star,
    load_star_bucketed,
    save_star,
    save_star_bucketed,
)


@pytest.fixture(scope="module")
def star(spark):
    return shop.star(spark)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_one_row_per_kept_order(star):
    ids = [r.order_id for r in star.fact_orders.collect()]
    assert sorted(ids) == ["o1", "o2", "o3", "o4", "o5"]


def test_facts_describe_the_same_orders(star):
    kept = star.fact_orders.select("order_id")
    for fact in (star.fact_items, star.fact_payments):
        assert fact.join(kept, "order_id", "left_anti").count() == 0
    assert star.fact_items.count() == 6 and star.fact_payments.count() == 5
    assert rows(profile.integrity(star))[0][:4] == (0, 0, 0, 0)


def test_lateness_and_days(star):
    got = {r.order_id: (r.delivery_days, r.is_late) for r in star.fact_orders.collect()}
    assert got["o1"] == (1, False)  # two minutes over midnight is one day; equal to the promise is on time
    assert got["o2"] == (28, True)
    assert got["o4"] == (None, None)


def test_latest_review_is_one_whole_row(spark, star):
    got = {r.order_id: (r.review_score, r.review_comment_message) for r in star.fact_orders.collect()}
    assert got["o1"] == (2, "first")  # equal dates: smallest review_id
    reviews = shop.entities(spark)["reviews"]
    for n in (1, 7):
        assert rows(latest_review(reviews.repartition(n))) == rows(latest_review(reviews))


def test_review_without_date_comes_last(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a','o',1,'x',CAST(NULL AS TIMESTAMP_NTZ)),('b','o',2,'y',TIMESTAMP_NTZ'1999-01-01')"
        " AS t(review_id, order_id, review_score, review_comment_message, review_creation_date)"
    )
    assert latest_review(df).first().review_score == 2


def test_product_categories(spark, star):
    got = {r.product_id: (r.category_name, r.has_category) for r in star.dim_product.collect()}
    assert got == {"p1": ("beauty", True), "p2": ("casa", True), "p3": ("unknown", False)}
    assert build_dim_product(shop.entities(spark)["products"], None).filter("category_name = 'beleza'").count() == 1


def test_calendar(star):
    days = star.dim_date
    assert days.count() == 1461
    assert days.filter("date_id = DATE'2018-09-01'").first().asDict() | {"date_id": None} == {
        "date_id": None, "year": 2018, "month": 9, "day": 1, "day_of_week": "Saturday", "is_weekend": True,
    }
    assert days.filter("is_weekend").select("day_of_week").distinct().count() == 2


def test_calendar_over_data(spark):
    orders = shop.entities(spark)["orders"]
    assert dim_date_over(orders).count() == 365
    assert dim_date_over(orders.limit(0)).count() == 0


def test_all_orders_cancelled(spark):
    gone = [(*o[:2], "canceled", *o[3:]) for o in shop.ORDERS]
    empty = shop.star(spark, orders=gone)
    assert empty.fact_orders.count() == empty.fact_items.count() == empty.fact_payments.count() == 0
    assert sales.monthly_series(empty).count() == 0
    assert rows(levers.exposed_revenue(empty)) == [(0, 0.0)]


def test_exists_is_a_semi_join_and_unread_reviews_are_not_joined(star):
    assert "LeftSemi" in star.fact_items._jdf.queryExecution().optimizedPlan().toString()
    plan = star.fact_orders.select("order_id", "is_late")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_saved_star_answers_like_the_built_one(spark, star, tmp_path):
    save_star(star, str(tmp_path))
    save_star(star, str(tmp_path))  # replaces, does not append
    saved = load_star(spark, str(tmp_path))
    for name in TABLES:
        assert rows(getattr(saved, name)) == rows(getattr(star, name)), name
    for plan in (sales.monthly_series, sales.category_ranking, sellers.activation_bands, profile.payment_mix):
        assert rows(plan(saved)) == rows(plan(star))


def test_bucketed_facts_join_without_shuffle(spark, star):
    save_star_bucketed(star, "shop_db", 4)
    saved = load_star_bucketed(spark, "shop_db")
    assert rows(sales.monthly_series(saved)) == rows(sales.monthly_series(star))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_order = saved.fact_items.groupBy("order_id").agg(F.sum("price").alias("gmv"))
        joined = saved.fact_orders.select("order_id").join(per_order, "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
