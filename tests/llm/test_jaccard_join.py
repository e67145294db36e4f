import random

import compare
import numpy as np
import pytest
from stallwise.llm import jaccard_join as jj


def set_of(text, size=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in "\t\n\v\f\r" else c for c in text or "")
    words = [w for w in text.split(" ") if w]
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def by_hand(rows, size=4, percent=85):
    sets, root = [set_of(t, size) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (id_, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(id_)
    lowest = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((id_, len(sets[i]), lowest[find(i)]) for i, (id_, _) in enumerate(rows)), key=repr)


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS level").repartition(4)
    return sorted((tuple(r) for r in jj.linked_documents(docs, **options).collect()), key=repr)


def edited(rnd, words, edits):
    new = list(words)
    for _ in range(edits):
        at, kind = rnd.randrange(len(new)), rnd.random()
        if kind < 0.4:
            new[at] = f"x{rnd.randrange(9999)}"
        elif kind < 0.7:
            new.insert(at, f"x{rnd.randrange(9999)}")
        elif len(new) > 1:
            del new[at]
    return new


def texts_of(seed):
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    out = []
    for _ in range(40):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([1, 3, 4, 6, 9, 13, 17, 25, 40, 120, 400]))]
        if rnd.random() < 0.4:
            at = rnd.randrange(len(words))
            words[at:at] = passage
        out.append(words)
        for _ in range(3):
            out.append(edited(rnd, words, rnd.randint(0, 1 + len(words) // 25)))
        out.append(words + [f"t{rnd.randrange(9999)}" for _ in range(len(words) // 7)])
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = list(enumerate(texts_of(seed), 10))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "a"), (904, "A"), (905, "a b"), (906, "A\vB"), (907, "a b c d")]
    rows += [(None, rows[0][1]), (None, "only here"), (None, "only here"), (3, rows[0][1].upper()), (903, "a")]
    assert found(spark, rows) == by_hand(rows)


def test_chain_and_long_lists(spark, monkeypatch):
    """Copies of one text with edits: all lists are long; some are linked only through others."""
    rnd = random.Random(5)
    monkeypatch.setattr(jj, "LONG", 8)
    rows, words = [], [f"w{i}" for i in range(150)]
    for i in range(60):
        words = edited(rnd, words, 2)
        rows.append((i, " ".join(words)))
        rows.append((1000 + i, " ".join(edited(rnd, words, 9))))
    passage = [f"p{i}" for i in range(100)]
    for i in range(60):
        rows.append((2000 + i, " ".join(passage + [f"y{i}_{j}" for j in range(rnd.choice([5, 20, 60]))])))
    want = by_hand(rows)
    assert len({c for _, _, c in want}) > 20
    assert found(spark, rows) == want


def test_unlinked_copies_of_one_text_stay_few_rows(spark, monkeypatch):
    """Copies with edits of their own, too far apart to link: one or two hubs for all, and few candidates."""
    rnd = random.Random(17)
    monkeypatch.setattr(jj, "LONG", 8)
    words, counts, close, differences = [f"w{i}" for i in range(150)], {}, jj._close, jj._differences

    def noted(name, made):
        counts[name] = made.count()
        return made

    monkeypatch.setattr(jj, "_close", lambda *a: noted("close", close(*a)))
    monkeypatch.setattr(jj, "_differences", lambda *a: noted("differences", differences(*a)))
    rows = [(i, " ".join(edited(rnd, words, 6))) for i in range(200)]
    assert found(spark, rows) == by_hand(rows)
    assert counts["differences"] <= 2 * len(rows)
    assert counts["close"] <= len(rows)


def test_sketches_differ_in_no_more_bits_than_sets_in_shingles():
    rnd = random.Random(19)
    for _ in range(300):
        pool = np.array(rnd.sample(range(1 << 62), rnd.randint(1, 600)), dtype=np.uint64)
        a, b = (np.array([x for x in pool if rnd.random() < 0.8], dtype=np.uint64) for _ in "ab")
        bits = sum((int(x) ^ int(y)).bit_count() for x, y in zip(jj.sketch(a).view("u8"), jj.sketch(b).view("u8"), strict=True))
        assert bits <= len(np.setxor1d(a, b))
        assert (jj.sketch(a) == jj.sketch(a[::-1])).all()


@pytest.mark.parametrize(("size", "percent"), [(2, 60), (1, 95)])
def test_other_parameters(spark, size, percent):
    rows = list(enumerate(texts_of(7)[:80]))
    assert found(spark, rows, size=size, percent=percent) == by_hand(rows, size, percent)


def pairs_at_the_limit(rnd, percent):
    """Two sets of hashes that just link."""
    a = rnd.randint(1, 300)
    b = rnd.randint(-(-a * percent // 100), a * 100 // percent)
    c = jj.least_common(a, b, percent)
    if c > min(a, b):
        return None
    values = np.array(rnd.sample(range(1 << 62), a + b - c), dtype=np.uint64)
    return np.sort(values[:a]), np.sort(np.concatenate([values[:c], values[a:]]))


def test_linked_sets_agree_in_more_parts_than_they_may_leave():
    rnd = random.Random(11)
    for _ in range(600):
        if (pair := pairs_at_the_limit(rnd, 85)) is None:
            continue
        one, two = pair
        levels = set(jj.levels_of(len(one), 85)) & set(jj.levels_of(len(two), 85))
        shared = [
            len(np.intersect1d(lists[0][0], lists[1][0])) > min(max(left, 0) for _, left in lists)
            for lists in ([jj.list_keys(x, k, 85) for x in (one, two)] for k in levels)
        ]
        assert any(shared)


def test_linked_light_sets_share_a_subset():
    rnd = random.Random(13)
    seen = 0
    while seen < 200:
        pair = pairs_at_the_limit(rnd, 85)
        if pair is None or max(map(len, pair)) > 18:
            continue
        seen += 1
        assert len(np.intersect1d(jj.subset_keys(pair[0], 85), jj.subset_keys(pair[1], 85)))


def test_boundary_follows_the_cost():
    assert jj.boundary({}, 85) == 0
    assert jj.boundary({n: 100 for n in range(1, 33)}, 85) in range(12, 16)
    # Many sets of a size with few subsets, and none above: subsets are cheaper than lists.
    assert jj.boundary({6: 1000}, 85) >= 6
    assert jj.boundary({25: 1000}, 85) < 25


def test_levels_hold_every_partner():
    starts = jj.level_starts(85)
    for n in range(1, 3000):
        for partner in (-(-n * 85 // 100), n):
            assert set(jj.levels_of(partner, 85)) & set(jj.levels_of(n, 85))
    assert starts[-1] > 1 << 30


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jj.linked_documents(docs).collect() == []


def test_query_against_sql(spark, sf):
    assert compare.difference(jj.op12_jaccard_join(spark, sf), compare.database(sf), jj.OP12_SQL) is None
