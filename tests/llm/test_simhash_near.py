import random

import xxhash

from stallwise.llm import simhash_near
from stallwise.llm.common import components


def plain_fingerprint(text, shingle=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in text).split(" ") if w]
    if not words:
        return 0
    many = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in many]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


TEXTS = [
    None, "", " \t\n", "one", "One", "one two", "É é\x0bx\u00a0y", "a b c a b c", "word " * 40_000, "Straße\x1cİ x y z",
]


def test_fingerprints(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.fp % 2**64 for r in simhash_near.fingerprints(docs).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(TEXTS)}
    native = docs.selectExpr("xxhash64(text) AS h", "text").where("text = 'one two'").first()
    assert native.h % 2**64 == xxhash.xxh64_intdigest(b"one two", 42)


def test_every_pair_within_the_radius(spark):
    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(60)] + [0, 2**64 - 1, 2**63]
    fps = set(base)
    for f in base:
        for r in (1, 2, 3, 3, 4, 5, 6):
            fps.add(f ^ sum(1 << b for b in rnd.sample(range(64), r)))
    signed = sorted(f - 2**64 if f >= 2**63 else f for f in fps)
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    for radius in (0, 1, 3, 5):
        got = {(min(r), max(r)) for r in simhash_near.near_pairs(frame, radius).collect()}
        want = {
            (a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) % 2**64).bit_count() <= radius
        }
        assert got == want


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 700)] + [(900, 900)]
    edges += [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(250)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert got == plain_groups(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    fps = {i: plain_fingerprint(t) for i, t in docs}
    ids = sorted(fps)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 3]
    want = plain_groups(ids, edges)
    got = simhash_near.op9_simhash_near_dedup(spark, sf).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (i, f"{fps[i]:016x}", want[i]) for i in ids
    )


def test_odd_rows(spark):
    rows = [(5, None, "x"), (3, "", "x"), (5, None, "x"), (None, "a b c d", "x"), (None, "a b c d", "x"), (7, "q r s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(simhash_near.near_groups(docs).select("doc_id", "component_id").collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(5, 3), (3, 3), (5, 3), (None, None), (None, None), (7, 7)], key=str)
    kept = simhash_near.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.select("doc_id").collect(), key=str) == sorted([(3,), (7,), (None,)], key=str)
    assert simhash_near.near_groups(docs.limit(0)).count() == 0
    assert simhash_near.keep_one(docs.limit(0)).count() == 0
