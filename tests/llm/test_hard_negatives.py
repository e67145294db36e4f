import math

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F
from stallwise.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(row):
    return row[0] is not None and row[2] is not None and row[1] is not None and all(
        x is not None and math.isfinite(x) for x in row[1]
    )


def by_hand(rows, percent=80):
    """Sorted (anchor, positive, rank, negative, scores); rows (vec_id, embedding, label) as they are."""
    held = []
    for id_, vector, label in filter(usable, rows):
        v = [min(1 << 24, max(-(1 << 24), math.floor(256 * float(np.float32(x))))) for x in vector]
        held.append((id_, (label + 1) % 10 if id_ % 7 == 0 else label, tuple(v)))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for id_, label, v in sorted(set(r for r in held if r[0] % 100 == 0)):
        scored = [(-score(v, w), i, other) for i, other, w in held]
        positives = sorted((s, i) for s, i, other in scored if other == label and i != id_)[:5]
        for s, positive in positives:
            hard = sorted((t, i) for t, i, other in scored if other != label and 80 * -s <= 100 * -t <= 100 * -s)[:5]
            out += [(id_, positive, r, i, -s, -t) for r, (t, i) in enumerate(hard, 1)]
    return sorted(out)


def found(spark, monkeypatch, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("key", F.lit("x")).repartition(3)
    monkeypatch.setattr(hard_negatives, "table", lambda *_: df)
    return sorted(map(tuple, hard_negatives.op11_hard_negatives(spark, "").collect()))


def around(rnd, centres, n, spread, size=8):
    middle = rnd.normal(size=(centres, size))
    return [(middle[i % centres] + rnd.normal(size=size) * spread).tolist() for i in range(n)]


@pytest.mark.parametrize("piece", [4096, 40])
@pytest.mark.parametrize("spread", [3.0, 0.1])
def test_against_all_pairs(spark, monkeypatch, piece, spread):
    rnd = np.random.default_rng(int(spread * 10))
    vectors = around(rnd, 6, 700, spread)
    rows = [(i, [x * 10 ** rnd.uniform(-3, 1) for x in v], int(rnd.integers(0, 4))) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[0], i % 3) for i in range(60)]  # ties: one vector, several labels
    monkeypatch.setattr(hard_negatives, "PIECE", piece)
    assert found(spark, monkeypatch, rows) == by_hand(rows)


def test_odd_rows(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    rows = [(i, v, i % 2) for i, v in enumerate(around(rnd, 2, 30, 1.0, 4), 90)]
    nan, inf = float("nan"), float("inf")
    rows += [(100, rows[0][1], 1), (None, [1.0], 1), (200, None, 1), (200, [1.0, None], 1), (300, [nan], 1), (300, [-inf, 1.0], 1)]
    rows += [(400, [1.0, 2.0], None), (500, [], 0), (501, [], 1), (502, [0.0, 0.0], 1), (600, [1e30, -1e30, 2.0], 0)]
    rows += [(601, [1e30, 1.0], 1), (700, [1.0, 2.0], 0), (700, [2.0, 1.0], 1), (800, [1.0], 1), (800, [1.0], 1), (-100, [3.0, 1.0], 1)]
    rows += [(901, rows[3][1], rows[3][2])] * 3 + [(1000, [1.0, 1.0], 9)]  # repeated rows; a label of its own
    assert found(spark, monkeypatch, rows) == by_hand(rows)
    assert found(spark, monkeypatch, []) == []
    assert found(spark, monkeypatch, [(100, [1.0], 0)]) == []


def test_candidates_hold_every_row_above_the_bound():
    rnd = np.random.default_rng(7)
    pruned = 0
    for spread in (0.05, 0.5, 2.0):
        vectors = np.floor(256 * np.array(around(rnd, 10, 500, spread))).astype(np.int64)
        piece = hard_negatives.Piece(np.arange(500), np.zeros(500), vectors)
        for query in vectors[:40]:
            scores = vectors @ query
            for low in np.quantile(scores, [0.1, 0.5, 0.9, 0.99, 1.0]).astype(int):
                rows = piece.candidates(query, int(low))
                want = set(np.flatnonzero(scores >= low))
                assert rows is None or want <= set(rows)
                pruned += rows is not None and len(rows) < 100
    assert pruned > 20


def test_blocks_of_queries(spark, monkeypatch):
    rnd = np.random.default_rng(9)
    rows = [(i * 100, v, i % 3) for i, v in enumerate(around(rnd, 3, 80, 1.0))]
    monkeypatch.setattr(hard_negatives, "QUERIES", 11)
    monkeypatch.setattr(hard_negatives, "PIECE", 16)
    assert found(spark, monkeypatch, rows) == by_hand(rows)


def test_query_against_sql(spark, sf):
    got = hard_negatives.op11_hard_negatives(spark, sf)
    assert compare.difference(got, compare.database(sf), hard_negatives.OP11_SQL) is None
