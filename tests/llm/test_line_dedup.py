import random
from collections import Counter

from stallwise.llm import line_dedup as ld
from stallwise.llm.hashing import word_hashes


def simhash(form):
    import numpy as np

    hashes = word_hashes(np.frombuffer(form.encode(), dtype=np.uint8))[2].tolist()
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def by_hand(rows, radius=3, similarity=0.8):
    """Removed (doc_id, line) by comparing all pairs of forms."""
    places, firsts = {}, {}
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if form := ld.normal(line):
                places.setdefault(form, set()).add((doc_id, n))
    forms = list(places)
    fps = [simhash(f) for f in forms]
    root = list(range(len(forms)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(forms)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                longer = max(len(forms[i]), len(forms[j]))
                if edits(forms[i], forms[j]) <= int(longer * (1 - similarity) + 1e-9):
                    root[find(i)] = find(j)
    for i, f in enumerate(forms):
        firsts.setdefault(find(i), []).extend(places[f])
    return {p: min(group)[0] for group in firsts.values() for p in group if p != min(group)}


def got(df):
    return {(r.doc_id, n): k for r in df.collect() for n, k in zip(r.removed, r.kept_in)}


def test_simhashes():
    forms = ["a", "a b", "b a", "É x 0", "word " * 70_000 + "x", "b a"]
    keys, fps = ld.simhashes(forms)
    assert [int(f) for f in fps] == [simhash(f) for f in forms]
    assert len(set(keys.tolist())) == 5 and keys[2] == keys[5]


def test_normal():
    assert ld.normal(" Ab--12 c_d! \r") == "ab 00 c d" and ld.normal("--- \t") == ""


def test_against_all_pairs(spark):
    rnd = random.Random(1)
    base = [" ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(1, 60))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            line = rnd.choice(base).split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                line[rnd.randrange(len(line))] = rnd.choice(["zz", "Q9", "aa,"])
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(ld.repeated_lines(docs)) == by_hand(rows)


def test_query_against_all_pairs(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = ld.op7_line_dedup(spark, sf)
    want = by_hand(rows)
    found = got(out)
    assert found == want
    assert {r.doc_id: r.n_lines for r in out.collect()} == {i: len(t.split("\n")) for i, t in rows}
    assert {r.doc_id: r.n_removed for r in out.collect()} == {i: Counter(d for d, _ in want)[i] for i, _ in rows}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b\n\nA  b!\n---"), (3, "a b\n\nA  b!\n---"), (None, "a b"), (4, "x " * 200_000), (5, "x " * 200_000)]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, line string")
    out = ld.repeated_lines(docs)
    assert sorted(map(str, ((r.doc_id, r.n_lines, r.removed) for r in out.collect()))) == sorted(
        map(str, [(1, 0, []), (2, 1, []), (3, 4, [2]), (None, 1, [0]), (4, 1, []), (5, 1, [0])])
    )
    assert ld.repeated_lines(docs.limit(0)).count() == 0


def test_normals():
    odd = ["", " ", "a", " Ab--12 c_d! \r", "ΑΣ ΣΑ", "İx", "日本 ٣", "🙂 a 𝒳𝟗", "--- \t", "x" * 9]
    every = ["".join(chr(c) for c in range(a, a + 256) if c != 10) for a in range(0, 0x20000, 256)]
    assert ld.normals(odd + every) == [ld.normal(x) for x in odd + every] and ld.normals([]) == []


def pairs(spark, rows):
    dealt = ld._dealt(spark.createDataFrame(rows, "key long, fp long, size long, label long"))
    return dealt, ld._first_pairs(dealt, 3, 0.8), ld._other_pairs(dealt, 3, 0.8)


def test_rows_of_a_group_do_not_grow_with_its_square(spark):
    # Lines of one group (label 0), each within 2 bits of the others.
    rows = [(i, (1 << i % 60) | 1 << 62, 100, 0) for i in range(1, 301)]
    dealt, first, others = pairs(spark, rows)
    assert dealt.count() == 4 * 300
    assert first.count() <= 16 * 300 and others.count() == 0


def test_lines_of_unlike_lengths_are_no_candidates(spark):
    rows = [(i, 5, 100 * 2 ** (i % 9), i) for i in range(9)]
    _, first, others = pairs(spark, rows)
    assert first.count() == 0 and others.count() == 0


def test_every_near_pair_is_met_once(spark):
    rnd = random.Random(2)
    fps = [rnd.getrandbits(63) for _ in range(6)]
    rows = [(i, rnd.choice(fps) ^ sum(1 << rnd.randrange(63) for _ in range(2)), rnd.randint(90, 130), i % 40) for i in range(120)]
    _, first, others = pairs(spark, rows)
    want = {
        frozenset((a[0], b[0])) for a in rows for b in rows
        if a[0] < b[0] and (a[1] ^ b[1]).bit_count() <= 3 and abs(a[2] - b[2]) <= int(max(a[2], b[2]) * (1 - 0.8) + 1e-9)
    }
    unlike = {p for p in want if len({x % 40 for x in p}) == 2}
    got = [frozenset(r) for r in others.collect()]
    assert set(got) == unlike and len(got) == len(unlike)
    seen = first.collect()
    assert {k for p in want for k in p} == {k for r in seen for k in r if k is not None}
    assert {frozenset(r) for r in seen if r.b is not None} <= want
