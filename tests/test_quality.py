import pytest
from pyspark.sql import functions as F

from stallwise.operators.uniqueness import mark_repeats
from stallwise.plans.quality import REFERENCES, rule_sets, run_quality
from stallwise.session import written
from stallwise.sources import fixtures as fx


def test_keys_are_written_before_whole_rows_meet_them(spark, sf):
    """The run writes its small key tables first; their sizes decide the joins, not the results."""
    names = []

    def keep(df, name):
        names.append(name)
        return written(df, name)

    frames, sets = fx.Entities(spark, sf), rule_sets(fx.CARD)
    kept, plain = run_quality(frames, sets, keep=keep), run_quality(frames, sets)
    assert {f"orphans_{name}" for _, name, *_ in REFERENCES} <= set(names)
    assert {f"again_{entity}" for entity, s in sets.items() if s.key} <= set(names)
    for what in ("report", "audit"):
        assert sorted(map(str, getattr(kept, what).collect())) == sorted(map(str, getattr(plain, what).collect()))


@pytest.mark.parametrize("rows", [[(1, "a"), (2, "b"), (None, "c")], [(1, "b"), (1, "a"), (1, "a"), (None, "c"), (None, "d"), (2, "e")], []])
def test_marks_with_written_keys(spark, rows):
    df = spark.createDataFrame(rows, "k int, v string").withColumn("w", F.col("k") + 1)
    want, got = mark_repeats(df, ["k"], ["v"]), mark_repeats(df, ["k"], ["v"], keep=written)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
