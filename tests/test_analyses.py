import math
import re

import pytest
from pyspark.sql import functions as F

import shop
from stallwise.functions.dates import months_between_boundaries
from stallwise.plans import levers, profile, retention, reviews, sales, sellers


@pytest.fixture(scope="module")
def star(spark):
    return shop.star(spark)


def table(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


def test_monthly_series_and_peak(star):
    series = table(sales.monthly_series(star), "month")
    assert {m: (r.orders, r.gmv) for m, r in series.items()} == {
        "2018-01": (1, 150.0), "2018-02": (1, 100.0), "2018-03": (1, 50.0), "2018-07": (1, 10.0),
    }
    assert sales.peak_month(star).first().month == "2018-01"


def test_seasonality_uses_complete_months_only(star):
    got = table(sales.seasonality(star, ("2018-01-01", "2018-03-01")), "month")
    assert {m: (r.years_observed, r.gmv_per_year) for m, r in got.items()} == {1: (1, 150.0), 2: (1, 100.0)}


def test_categories_leave_unknown_out(star):
    got = table(sales.category_ranking(star), "category")
    assert {c: (r["items"], r.gmv, r.mean_price, r.pct_gmv) for c, r in got.items()} == {
        "beauty": (3, 220.0, 73.33, 78.6), "casa": (2, 60.0, 30.0, 21.4),
    }
    assert sales.category_concentration(star, 1).first().pct_gmv == 78.6


def test_removed_by_cancellation(star):
    assert tuple(sales.removed_by_cancellation(star).first()) == (2, 1, 1000.0)


def test_weekday_share(star):
    row = sales.weekday_share(star).first()
    assert (row.orders, row.weekday_orders, row.expected_pct) == (5, 3, 71.4)


def test_repurchase_counts_people_not_customer_ids(star):
    got = table(retention.late_repurchase(star), "first_delivery")
    assert {s: (r.customers, r.repurchased, r.repurchase_pct) for s, r in got.items()} == {
        "on_time": (1, 1, 100.0), "late": (1, 0, 0.0),
    }
    by_score = table(retention.score_repurchase(star), "first_score")
    assert {s: (r.customers, r.repurchase_pct) for s, r in by_score.items()} == {2: (2, 50.0), 5: (1, 0.0)}


def test_significance_matches_the_corrected_chi_square(spark, monkeypatch):
    cells = spark.sql(
        "SELECT * FROM VALUES ('late', 1000L, 25L, 2.5D), ('on_time', 9000L, 360L, 4.0D)"
        " AS t(first_delivery, customers, repurchased, repurchase_pct)"
    )
    monkeypatch.setattr(retention, "late_repurchase", lambda star: cells)
    row = retention.late_repurchase_significance(None).first()
    a, b, c, d = 25, 975, 360, 8640
    n = a + b + c + d
    want = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert row.chi2 == pytest.approx(want)
    assert row.p_value == round(math.erfc(math.sqrt(want / 2)), 6)
    assert row.effect_pp == pytest.approx(1.5)


def test_upper_tail_is_the_error_function(spark):
    values = [0.0, 1e-6, 0.1, 1.0, 3.84, 10.0, 30.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", retention.upper_tail(df.x).alias("p")).collect():
        assert row.p == pytest.approx(math.erfc(math.sqrt(row.x / 2)), abs=1e-10)


def test_upper_tail_of_large_values(spark):
    df = spark.createDataFrame([(x,) for x in (49.9, 50.0, 50.1, 99.0, 180.0, 200.0, 500.0, 5000.0, 1e9)], "x double")
    for row in df.select("x", retention.upper_tail(df.x).alias("p")).collect():
        assert row.p == pytest.approx(math.erfc(math.sqrt(row.x / 2)), abs=1e-10)


def test_month_distance_counts_boundaries(spark):
    df = spark.sql("SELECT DATE'2018-01-31' AS a, DATE'2018-02-01' AS b")
    assert df.select(months_between_boundaries(df.a, df.b)).first()[0] == 1


def test_value_by_region(spark, star):
    got = table(retention.value_by_region(star, retention.default_regions(spark)), "region")
    # u1: two orders of 165 and 120, one month boundary apart; payments are summed before the join
    assert tuple(got["Sudeste"])[1:] == (1, 142.5, 2.0, 1.0, 100.0)
    assert got["Nordeste"].mean_ticket == 59.0
    assert got["Outro"].customers == 1 and "Norte" not in got


def test_late_orders_ceiling(star):
    row = retention.late_orders_ceiling(star).first()
    assert (row.late_orders, row.effect_pp, row.customers_saved) == (2, 100.0, 2.0)


def test_installments(star):
    got = table(levers.value_by_installments(star), "installments")
    assert {i: (r.orders, r.mean_value) for i, r in got.items()} == {1: (2, 58.67), 10: (1, 120.0)}
    assert levers.single_installment_base(star).first().orders == 1
    halves = table(levers.single_installment_by_half(star), "year", "half")
    assert {k: r.orders for k, r in halves.items()} == {(2018, "S1"): 1, (2018, "S2"): 1}
    scenarios = table(levers.ticket_lever(star), "scenario")
    assert {s: r.value for s, r in scenarios.items()} == {"conservative": 20.0, "optimistic": 30.0}


def test_detraction_drops_unknown_lateness(star):
    got = table(levers.detraction_by_punctuality(star), "status")
    assert {s: (r.orders, r.detractors) for s, r in got.items()} == {"on_time": (1, 1), "late": (2, 2)}
    assert tuple(levers.exposed_revenue(star).first()) == (1, 150.0)
    assert levers.curation_lever(star).first().value == 45.0


def test_supply(star):
    row = sellers.supply_imbalance(star).first()
    assert tuple(row) == (2, 50.0, 1, 50.0)
    got = table(sellers.local_supply(star), "origin")
    assert {o: (r.orders, r.mean_freight, r.mean_days) for o, r in got.items()} == {
        "local": (1, 3.0, 15.0), "remote": (1, 6.0, 15.0),
    }
    assert sellers.local_supply_change(star).first().freight_change_pct == -50.0
    assert sellers.remote_orders_by_state(star).first().seller_state == "SP"
    assert tuple(sellers.local_seller_gmv(star).first()) == (1, 30.0)


def test_consolidated_levers(star):
    got = table(levers.consolidated(star, levers.Assumptions(item_bands=(2, 3, 4))), "lever")
    assert set(got) == {"1. installments", "2. curation", "3. local supply", "total"}
    parts = [got[n] for n in got if n != "total"]
    assert got["total"].low == pytest.approx(sum(p.low for p in parts))
    assert got["total"].new_level_high == pytest.approx(300.0 + got["total"].high)


def test_profile(star):
    assert tuple(profile.detractor_rate(star).first()) == (3, 4, 75.0)
    got = table(profile.freight_by_value(star), "band")
    assert {b: (r.orders, r.freight_pct) for b, r in got.items()} == {
        "1. <= 50": (2, 14.0), "2. <= 150": (2, 15.0),
    }
    mix = table(profile.payment_mix(star), "payment_type")
    assert mix["credit_card"].transactions == 4 and mix["credit_card"].value == 296.0
    assert profile.state_share(star, "SP").first().pct == 50.0


def classified(spark, rows, extra=""):
    return spark.createDataFrame(
        rows, f"order_id string, category string, reason string, severity string{extra}"
    )


def test_tables_of_older_runs_mark_failures_in_the_reason(spark, star):
    old = classified(spark, [("o1", "defeito", "x", "alta"), ("o2", "y", "lot fallback", "baixa")])
    row = reviews.run_summary(old).first()
    assert (row.total, row.unclassified, row.categories, row.trusted) == (2, 1, 1, False)
    assert reviews.coverage(old, star).first().classified == 1


def test_trust_gate(spark, star):
    rows = [(f"o{i}", "a", "", "alta", i == 0) for i in range(20)]
    ok = classified(spark, rows, ", is_fallback boolean")
    assert reviews.run_summary(ok).first().trusted
    assert levers.complaint_distribution(ok, star).first().trusted
    assert not reviews.run_summary(ok.limit(0)).first().trusted


def test_high_ticket_tasks_are_bounded(spark, sf, model, monkeypatch):
    """More rows give more tasks, not larger ones; orders are counted once, whatever the number of tasks."""
    from stallwise.plans import common, levers

    want = levers.high_ticket_categories(model, 10).collect()
    monkeypatch.setattr(common, "ROWS", 100)
    found = levers.high_ticket_categories(model, 10)
    tasks = -(-model.order_items.count() // 100)
    assert f"hashpartitioning(order_id, {tasks})" in re.sub(r"#\d+L?", "", found._jdf.queryExecution().toString())
    assert want and found.collect() == want
    lines = model.order_items.join(model.fact_orders.select("order_id"), "order_id", "left_semi")
    lines = lines.join(model.dim_product, "product_id").groupBy("category_name").agg(F.count_distinct("order_id").alias("n"))
    orders = {r.category_name: r.n for r in lines.collect()}
    assert all(r.orders == orders[r.category] for r in want)
