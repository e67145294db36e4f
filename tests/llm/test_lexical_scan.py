import math
import random
import re
from collections import Counter

import compare
from stallwise.llm import lexical_scan

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, top=20):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in held:
            length = 75 + 25 * sum(c.values()) * n // total
            score = 0
            for t in terms_of(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * c[t] // (1000 * c[t] + 12 * length))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


WORDS = ["Ab", "ab", "b", "É", "é", "ab1", "x y", "\U0001f600", "the", "a"]
GLUE = [" ", ",", "  ", "\n", "-", "_", "\x00", "'", "\x7f"]


def text(rnd, words):
    return "".join(rnd.choice(WORDS) + rnd.choice(GLUE) for _ in range(words))


def random_tables(seed):
    rnd = random.Random(seed)
    docs = [(i, text(rnd, rnd.randint(0, 60))) for i in range(80)]
    docs += [(i, docs[7][1]) for i in range(100, 130)]  # ties over the 20th place
    docs += [(5, docs[5][1]), (None, docs[7][1]), (None, None), (200, None), (201, ""), (202, " ,;"), (203, "ab " * 50_000)]
    items = [(i, text(rnd, rnd.randint(0, 12))) for i in range(12)]
    return docs, items + [(20, None), (21, ""), (22, "nowhere"), (23, "the THE the, the"), (None, "b")]


def test_against_brute_force(spark):
    docs, items = random_tables(1)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = by_hand(docs, items)
    assert rows(lexical_scan.ranked(df, asked)) == want
    assert rows(lexical_scan.ranked(df, asked, block_chars=60)) == want
    assert rows(lexical_scan.ranked(df, asked, top=3)) == by_hand(docs, items, 3)


def test_counts_of_the_scan(spark):
    docs, _ = random_tables(2)
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    counts = lexical_scan.scanned(df, [b"ab", b"the"]).collect()
    assert [c.n for c in counts] == [len(terms_of(t)) for _, t in docs]
    assert [dict(zip(c.terms, c.tfs, strict=True)).get(0, 0) for c in counts] == [terms_of(t).count("ab") for _, t in docs]


def test_terms_are_guarded():
    machine = lexical_scan.automaton([b"ab", b"b", b"ab b"])
    assert lexical_scan.counts_of(machine, lexical_scan.folded(b"AB b xab abx b-ab")) == {0: 2, 1: 2, 2: 1}
    assert lexical_scan.term_count(lexical_scan.folded(b" a,,b  c ")) == 3
    assert not lexical_scan.counts_of(lexical_scan.automaton([]), b" ab ")


def test_best_keeps_what_one_sort_would(spark):
    import numpy as np

    rnd = np.random.default_rng(3)
    best, every = lexical_scan.Best(4, 5), []
    for at in range(0, 300, 30):
        scores = rnd.integers(0, 6, (30, 4))
        ids, no_id = rnd.integers(0, 50, 30), rnd.integers(0, 2, 30)
        best.add(scores, ids, no_id)
        every += [(i, s, no_id[d], ids[d]) for d in range(30) for i, s in enumerate(scores[d]) if s > 0]
    want = []
    for item in range(4):
        want += sorted((r for r in every if r[0] == item), key=lambda r: (-r[1], r[2], r[3]))[:5]
    assert [tuple(map(int, r)) for r in best.rows.T] == [tuple(map(int, r)) for r in want]


def test_empty_tables_and_further_columns(spark):
    docs = spark.createDataFrame([(1, "ab b", 2.0, 3)], "doc_id long, text string, score double, item_id long")
    items = spark.createDataFrame([(4, "b", 1, "n")], "item_id long, text string, doc_id long, n string")
    assert [r[:3] for r in rows(lexical_scan.ranked(docs, items))] == [(4, 1, 1)]
    assert rows(lexical_scan.ranked(docs.limit(0), items)) == []
    assert rows(lexical_scan.ranked(docs, items.limit(0))) == []
    assert lexical_scan.ranked(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_query_against_sql(spark, sf):
    found = lexical_scan.op13_lexical_search(spark, sf)
    assert compare.difference(found, compare.database(sf), lexical_scan.OP13_SQL) is None
