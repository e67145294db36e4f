import random

import numpy as np
import pytest

from stallwise.llm import decontamination as dc


def distance(item, text):
    """Fewest edits of the item against any passage of the text."""
    text = np.array([ord(c) for c in text] or [0], dtype=np.int64)[: len(text)]
    row, steps = np.zeros(len(text) + 1, dtype=np.int64), np.arange(len(text) + 1)
    for i, c in enumerate(item, 1):
        new = np.append(i, np.minimum(row[:-1] + (text != ord(c)), row[1:] + 1))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def normal(text):
    return "".join(chr(c) for c in dc.normal(text, dc._lower_table())[0].tolist())


def garbled(rnd, text, edits):
    chars = list(text)
    for _ in range(edits):
        at, kind = rnd.randrange(len(chars)), rnd.randrange(3)
        if kind == 0:
            chars[at] = rnd.choice("xyz")
        elif kind == 1:
            chars.insert(at, rnd.choice("xyz"))
        else:
            del chars[at]
    return "".join(chars)


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 8))) for _ in range(n))


def test_grams():
    codes = np.frombuffer("abcabcabd".encode("utf-32-le"), dtype=np.uint32)
    for q in (1, 2, 3, 5, 8, 9, 10):
        h = dc.gram_hashes(codes, q)
        grams = ["abcabcabd"[i : i + q] for i in range(max(0, 10 - q))]
        assert len(h) == len(grams) and len(set(h.tolist())) == len(set(grams))


@pytest.mark.parametrize("seed", range(4))
def test_finds_all_within_the_budget(seed):
    rnd = random.Random(seed)
    items = [(i, words(rnd, rnd.randint(6, 40))) for i in range(12)]
    index = dc.indexed(items)
    texts = [words(rnd, 60), "", None]
    for i, item in items:
        m = len(normal(item))
        for edits in (0, 1, int(0.1 * m) // 2, int(0.1 * m), int(0.1 * m) + 3):
            texts.append(words(rnd, rnd.randint(0, 30)) + " " + garbled(rnd, item, edits) + "\n\n" + words(rnd, rnd.randint(0, 30)))
    got = {(t, index.ids[i]): (a, b, e) for t, i, a, b, e in dc.occurrences(texts, index)}
    for t, text in enumerate(texts):
        for n, (i, item) in enumerate(items):
            fewest = distance(normal(item), normal(text or ""))
            if fewest <= index.edits[n]:
                a, b, e = got[(t, i)]
                assert e == fewest and distance(normal(item), normal(text[a:b])) == fewest
            else:
                assert (t, i) not in got


def test_case_and_white_space():
    index = dc.indexed([(7, "The quick  brown fox jumps over the lazy dog Again")])
    text = "x THE QUICK BROWN\n\tFOX jumps over the lazy dog again y"
    assert dc.occurrences([text], index) == [(0, 0, 2, len(text) - 2, 0)]


def test_twice_in_a_text():
    item = "abcdefghij klmnop qrstuv wxyz 0123456789"
    index = dc.indexed([(1, item)])
    found = dc.occurrences([f"{item} --- {item}"], index)
    assert [(a, b) for _, _, a, b, _ in found] == [(0, 40), (45, 85)]


def test_query_holds_every_exact_leak(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id, d.text.find(i.text)) for d in docs for i in items if i.text in d.text}
    got = dc.op5_decontamination(spark, sf).collect()
    assert exact and exact <= {(r.doc_id, r.item_id, r.start) for r in got}
    texts, wanted = {d.doc_id: d.text for d in docs}, {i.item_id: i.text for i in items}
    for r in got:
        assert r.edits <= 0.1 * len(wanted[r.item_id])
        assert (r.edits == 0) == (normal(texts[r.doc_id][r.start : r.end]) == normal(wanted[r.item_id]))
    kept = dc.without_leaks(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert {r.doc_id for r in kept.collect()} == set(texts) - {r.doc_id for r in got}


def test_odd_rows_and_blocks(spark, monkeypatch):
    item = "the quick brown fox jumps over the lazy dog"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "short"), (None, item + " again and again")], "item_id long, text string")
    rows = [(None, f"x {item}"), (1, None), (2, ""), (4, "w " * 300_000 + item), (4, "w " * 300_000 + item)]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, Clean boolean")
    want = sorted([(None, 1, 2), (None, 1, 2), *[(4, 1, 600_000)] * 4], key=str)
    for chars in (4_000_000, 10):
        monkeypatch.setattr(dc, "BLOCK_CHARS", chars)
        got = [(r.doc_id, r.item_id, r.start) for r in dc.leaks(docs, bench).collect()]
        assert sorted(got, key=str) == want
        kept = dc.without_leaks(docs, bench)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2}
    assert dc.leaks(docs, bench.limit(0)).count() == 0 and dc.leaks(docs.limit(0), bench).count() == 0
    assert dc.without_leaks(docs, bench.limit(0)).count() == 5
