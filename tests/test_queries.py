"""Every registered query against its comparison SQL on the smallest tables, and plan checks."""

import pytest

import __spark_entry__ as entry
import compare

QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k not in entry.LLM_SQL}

@pytest.fixture(scope="module")
def con(sf):
    return compare.database(sf)


def test_every_sql_has_a_query():
    assert set(ORACLE) == set(QUERIES)


def test_fixed_values_of_the_sql_are_those_of_the_code():
    from oracle import quality, text
    from stallwise import catalogue
    from stallwise.functions import constants
    from stallwise.operators import audit

    assert text.TAXONOMY == catalogue.TAXONOMY and quality.TREATMENTS == audit.TREATMENTS
    assert (text.DEADLINE_WORDS, text.PRODUCT_WORDS) == (catalogue.DEADLINE_WORDS, catalogue.PRODUCT_WORDS)
    assert text.FALLBACK_REASON == constants.FALLBACK_REASON
    assert (text.TOPICS, text.PASSES, text.SEED, text.MAX_PERCENT) == (
        catalogue.TOPICS, catalogue.TOPIC_PASSES, catalogue.TOPIC_SEED, catalogue.TOPIC_MAX_PERCENT,
    )


def test_quality_run_derives_each_entity_once(spark, sf):
    for name in ("dq_run_report", "dq_run_audit"):
        plan = plan_of(QUERIES[name](spark, sf))
        assert plan.count("FileScan") <= 25, name


def test_items_are_shuffled_once_before_their_orders(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("sellers_long_tail", "lever_local_seller_gmv", "reviews_sellers_with_complaints"):
            plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
            above = plan[: plan.index("l_extendedprice")]
            assert "Aggregate [l_orderkey" not in above, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def assert_no_row_pairs(plan):
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert_no_row_pairs(plan_of(df))
    assert compare.difference(df, con, ORACLE[name]) is None


def test_focus_states_are_those_of_the_region(spark, sf):
    from stallwise import catalogue
    from stallwise.sources import fixtures

    inside = fixtures.states(spark, sf).filter(f"region = '{fixtures.FOCUS_REGION}'").collect()
    assert {r.state for r in inside} == set(catalogue.ASSUMPTIONS.states)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "orders", "gmv"] and df.count() > 0


def test_window_reaches_the_scan(spark, sf):
    plan = plan_of(QUERIES["lever_exposed_revenue"](spark, sf))
    assert "GreaterThanOrEqual(o_orderdate,2001-01-01" in plan


def test_scan_reads_only_needed_columns(spark, sf):
    plan = plan_of(QUERIES["sales_monthly_series"](spark, sf))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan
    assert "conversations" not in plan and "documents" not in plan


def test_items_are_summed_before_they_are_shuffled(spark, sf):
    plan = plan_of(QUERIES["sales_monthly_series"](spark, sf))
    assert "partial_sum" in plan
    items = plan[: plan.index("l_extendedprice:double")]
    assert items.rfind("partial_sum") > items.rfind("Exchange")
