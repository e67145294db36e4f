from stallwise.operators import references
from stallwise.operators.references import (
    Reference,
    cascade_counts,
    reference_counts,
    split_orphans,
    tag_first_failure,
)


def parent(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id int")


def child(spark, values):
    return spark.createDataFrame([(v,) for v in values], "fk int")


def test_null_child_key_is_an_orphan_unless_the_parent_has_null(spark):
    c = child(spark, [1, 2, None])
    for values, lost in [([1], [2, None]), ([1, None], [2])]:
        ref = Reference("c_to_p", "fk", parent(spark, values), "id")
        kept, bad = split_orphans(c, ref)
        assert sorted((r.fk for r in bad.collect()), key=str) == sorted(lost, key=str)
        assert kept.count() + bad.count() == 3
        assert reference_counts(c, ref).first().failed == len(lost)
        assert all("fk" in r.quarantine_reason for r in bad.collect())


def test_repeated_parent_does_not_multiply_rows(spark):
    kept, _ = split_orphans(child(spark, [1, 1]), Reference("r", "fk", parent(spark, [1, 1, 1]), "id"))
    assert kept.count() == 2


def test_each_step_counts_what_the_earlier_ones_left(spark):
    rows = [(1, 1), (1, 9), (9, 1), (9, 9), (1, 1)]
    c = spark.createDataFrame(rows, "a int, b int")
    one = parent(spark, [1])
    refs = [Reference("first", "a", one, "id"), Reference("second", "b", one, "id")]
    tagged = tag_first_failure(c, refs)
    counts = {r.check_name: (r.total, r.failed) for r in cascade_counts(tagged, ["first", "second"]).collect()}
    assert counts == {"first": (5, 2), "second": (3, 1)}
    assert tagged.count() == 5


def test_empty_child(spark):
    row = reference_counts(child(spark, []), Reference("r", "fk", parent(spark, [1]), "id")).first()
    assert (row.total, row.failed, row.reliability_pct) == (0, 0, 100.0)


def test_child_rows_meet_only_the_orphan_keys(spark):
    kept, _ = split_orphans(child(spark, [1, 2]), Reference("r", "fk", parent(spark, [1]), "id"))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 2 and "Aggregate" in plan


def test_one_shuffle_decides_for_all_children(spark):
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    children = {
        "a": (spark.createDataFrame([(1,), (7,), (7,), (None,)], "k int"), "k"),
        "b": (spark.createDataFrame([(7,), (8,)], "order_id int"), "order_id"),
        "c": (spark.createDataFrame([], "k int"), "k"),
    }
    found = references.shared_orphans(children, parent, "id")
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted((r[0], r.held) for r in found.collect()) == [(7, ["a", "b"]), (8, ["b"])]
    without = references.shared_orphans(children, parent.where("id > 0"), "id")
    assert [r.held for r in without.where("_orphan_key IS NULL").collect()] == [["a"]]
    for name, (child, column) in children.items():
        ref = references.Reference(name, column, parent, "id")
        known = references.Reference(name, column, parent, "id", found.where(f"array_contains(held, '{name}')").select("_orphan_key"))
        tagged = [sorted(map(str, references.tag_first_failure(child, [x]).collect())) for x in (ref, known)]
        assert tagged[0] == tagged[1]
