import math

from pyspark.sql import functions as F

from stallwise.functions.numeric import no_nan
from stallwise.operators import report, rules
from stallwise.plans.quality import RuleSet, rule_sets, single_installment, tag_entity
from stallwise.session import written


def test_repeated_keys_leave_one_row_each(spark):
    rows = [("s7", i) for i in range(5)] + [("s8", 0), ("s9", 3), ("s9", 3), (None, 1)]
    tagged = tag_entity(spark.createDataFrame(rows, "seller_id string, zip int"), rule_sets()["sellers"])
    counts = rules.check_counts(tagged, "sellers").first()
    assert (counts.total, counts.failed) == (9, 6)
    assert sorted(tuple(r)[:2] for r in rules.clean_rows(tagged).collect()) == [("s7", 0), ("s8", 0), ("s9", 3)]
    reasons = {(r.seller_id, r.zip): r.quarantine_reason for r in rules.quarantined_rows(tagged).collect()}
    assert reasons.pop((None, 1)) == "not_null(seller_id)"
    assert reasons == {**{("s7", i): "unique(seller_id)" for i in range(1, 5)}, ("s9", 3): "unique(seller_id)"}


def test_null_only_violates_not_null(spark):
    df = spark.createDataFrame([(None,), (-1,), (0,), (6,)], "x int")
    found = {
        r.rule: r.failed
        for r in rules.violation_share(
            df, [rules.not_null("x"), rules.at_least("x", 0), rules.within("x", 0, 5)]
        ).collect()
    }
    assert found == {"not_null(x)": 1, "x>=0": 1, "x in 0..5": 2}


def test_nan_is_missing_after_ingest(spark):
    df = spark.createDataFrame([(math.nan,), (1.0,)], "x double").select(no_nan("x").alias("x"))
    assert [r.failed for r in rules.violation_share(df, [rules.not_null("x"), rules.at_least("x", 2)]).collect()] == [1, 1]


def test_time_order_ignores_missing_delivery(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2020-01-02', TIMESTAMP_NTZ'2020-01-01'),"
        "(TIMESTAMP_NTZ'2020-01-01', TIMESTAMP_NTZ'2020-01-02'), (NULL, TIMESTAMP_NTZ'2020-01-01') AS t(done, bought)"
    )
    assert rules.violation_share(df, [rules.not_before("done", "bought")]).first().failed == 1


def test_single_installment_rule(spark):
    df = spark.createDataFrame(
        [("boleto", 1), ("boleto", 2), ("credit_card", 5), ("boleto", None), (None, 3)],
        "payment_type string, payment_installments int",
    )
    assert rules.violation_share(df, [single_installment()]).first().failed == 2


def test_row_with_two_violations_is_one_row_with_both_reasons(spark):
    df = spark.createDataFrame([(-1, -1), (1, 1)], "a int, b int")
    tagged = rules.tag(df, [rules.at_least("a", 0), rules.at_least("b", 0)])
    bad = rules.quarantined_rows(tagged).collect()
    assert [r.quarantine_reason for r in bad] == ["a>=0 | b>=0"]
    assert rules.check_counts(tagged, "t").first().failed == 1
    assert rules.clean_rows(tagged).count() + len(bad) == 2


def test_type_rule_is_per_row(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "t string")
    assert rules.violation_share(df, [rules.castable("t", "int")]).first().failed == 1


def test_empty_table_is_fully_reliable(spark):
    df = spark.createDataFrame([], "seller_id string")
    row = rules.check_counts(tag_entity(df, rule_sets()["sellers"]), "sellers").first()
    assert (row.total, row.failed, row.reliability_pct) == (0, 0, 100.0)


def test_entity_without_rules_is_clean(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert rules.clean_rows(tag_entity(df, RuleSet("x", "x", []))).count() == 1


def test_verdict_limits(spark):
    df = spark.createDataFrame([(100.0,), (99.0,), (95.0,), (94.9,)], "reliability_pct double")
    rows = report.verdicts(df).orderBy(F.desc("reliability_pct")).collect()
    assert [(r.verdict, r.badge) for r in rows] == [
        ("PASS", "excellent"),
        ("PASS", "excellent"),
        ("PASS", "acceptable"),
        ("FAIL", "critical"),
    ]
    assert tuple(report.consolidated(df).first()) == (3, 4)


def test_rules_of_one_entity_take_one_scan(spark, sf):
    from stallwise.sources import fixtures

    tagged = rules.tag(fixtures.payments(spark, sf), rule_sets("A")["payments"].rules)
    plan = rules.check_counts(tagged, "p")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_counts_observed_while_writing(spark):
    for n in (0, 10):
        df = spark.range(n)
        steps = [("first", F.col("id") % 5 == 0), ("second", F.col("id") % 5 == 1)]
        out, counts = rules.observed_counts(df, steps, lambda x: written(x, "observed"))
        assert out.count() == n
        assert counts.collect() == rules.ordered_counts(df, steps).collect()
