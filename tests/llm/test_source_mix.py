import heapq
import random

from stallwise.llm import source_mix as sm


def dealt_seat_by_seat(shares, seats):
    won = dict.fromkeys(shares, 0)
    heap = [(-s / 1, m) for m, s in shares.items() if s > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, m = heapq.heappop(heap)
        won[m] += 1
        heapq.heappush(heap, (-shares[m] / (2 * won[m] + 1), m))
    return won


def test_apportion_equals_highest_quotients(spark):
    rnd = random.Random(5)
    rows, want = [], {}
    for g in range(60):
        shares = {m: rnd.choice([0, 1, 1, 7, rnd.randint(1, 10**6)]) for m in range(rnd.randint(1, 12))}
        seats = rnd.choice([0, 1, 2, 5, 40, 1000])
        want |= {(g, m): n for m, n in dealt_seat_by_seat(shares, seats).items()}
        rows += [(g, m, s, seats) for m, s in shares.items()]
    frame = spark.createDataFrame(rows, "g long, m long, share long, seats long")
    got = {(r.g, r.m): r.quota for r in sm.apportion(frame, ["g"], "m", "share", "seats").collect()}
    assert got == want


def filled(sizes):
    """Targets by filling round after round."""
    weight = {s: sm.WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(sizes)
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * level >= 2 * sizes[s]}
        for s in above:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= above
        if not above:
            return target | {s: weight[s] * level for s in free}


DOCS = [(i, " w" * (i % 40 * 9) if i % 11 else None, f"s{i % 5 if i % 3 else 0}" if i % 17 else None) for i in range(600)]


def check(rows, tolerance):
    sizes, taken, targets = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        targets[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    for s, want in filled(sizes).items():
        assert abs(targets[s] - want) < 1e-6 * max(1, want)
        assert abs(taken[s] - targets[s]) <= tolerance, (s, taken[s], targets[s])
    assert all(r.source_size == sizes[r.source] for r in rows)


def test_targets_are_met(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    check(sm.mix(docs).collect(), 3 * 32)
    check(sm.mix(docs, block_words=7).collect(), 3 * 7)


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(sm, "SHARD_WORDS", 1000)
    monkeypatch.setattr(sm, "SHARD_ROWS", 20)
    monkeypatch.setattr(sm, "SHARDS_TOGETHER", 4)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    check(sm.mix(docs, block_words=8).collect(), 8 * 60)


def test_reruns_and_partitions_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = sorted(map(tuple, sm.mix(docs).collect()))
    assert one == sorted(map(tuple, sm.mix(docs.repartition(13)).collect()))
    check(sm.mix(docs).collect(), 3 * 32)


def test_mixed_rows_hold_the_taken_words(spark):
    docs = spark.createDataFrame(
        [(d, t, s, 0, "x") for d, t, s in DOCS], "doc_id long, text string, source string, n_chars long, Start string"
    )
    out = sm.mixed(docs, 16)
    assert out.columns == docs.columns
    rows = out.collect()
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
    assert got == {r.doc_id: r.taken for r in sm.mix(docs, 16).collect() if r.taken}


def test_odd_rows(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "c", None), (None, None, None), (2, "", "t"), (3, "w " * 200_000, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = sm.mix(docs).collect()
    assert len(out) == 6 and {r.size for r in out if r.source == "t"} == {0}
    check(out, 64)
    assert sm.mix(docs.limit(0)).count() == 0 and sm.mixed(docs.limit(0), 32).count() == 0


def test_native_plan(spark, sf):
    plan = sm.op10_source_mix(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
