import random

from stallwise.llm import substring_dedup as sd


def words(rnd, n):
    return [rnd.choice("bcdfgh") + "".join(rnd.choice("aeioulmnr") for _ in range(rnd.randint(2, 7))) for _ in range(n)]


def covered(rows, doc_id, text, passage):
    """Words of the passage that reported stretches of the document cover, of all its words."""
    at = text.index(passage)
    marks = [False] * len(text)
    for r in rows:
        if r.doc_id == doc_id:
            marks[r.start : r.end] = [True] * (r.end - r.start)
    inside, place = 0, at
    for w in passage.split():
        place = text.index(w, place)
        inside += all(marks[place : place + len(w)])
        place += len(w)
    return inside


def found(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, sd.stretches(sd.repeats(docs, **more))


def test_every_passage_of_over_fifty_words(spark):
    rnd = random.Random(1)
    rows, planted = [], []
    for p in range(40):
        passage = " ".join(words(rnd, 51 + p % 30))
        for _ in range(2 + p % 3):
            text = " ".join([*words(rnd, rnd.randint(0, 80)), passage, *words(rnd, rnd.randint(0, 80))])
            planted.append((len(rows), text, passage))
            rows.append((len(rows), text))
    clean = [(1000 + i, " ".join(words(rnd, rnd.randint(1, 300)))) for i in range(40)]
    short = " ".join(words(rnd, 14))
    clean += [(2000 + i, " ".join([*words(rnd, 60), short, *words(rnd, 60)])) for i in range(20)]
    _, out = found(spark, rows + clean)
    out = out.collect()
    for doc_id, text, passage in planted:
        n = len(passage.split())
        assert covered(out, doc_id, text, passage) >= n - 30
    assert all(r.doc_id < 1000 for r in out)
    by_group = {}
    for r in out:
        assert r.removed == (r.kept_in != r.doc_id)
        by_group.setdefault(r.group, set()).add(r.doc_id)
    texts = dict(rows)
    for r in out:
        assert r.n_words == len(texts[r.doc_id][r.start : r.end].split())
        if r.removed:
            assert " ".join(texts[r.doc_id][r.start : r.end].split()) in " ".join(texts[r.kept_in].split())


def test_paragraphs_follow_the_content():
    rnd = random.Random(2)
    passage = words(rnd, 400)
    one = sd._paragraphs(" ".join(passage), sd.WINDOW)
    other = sd._paragraphs("É x  y\n" + "\n".join(passage) + " z", sd.WINDOW)
    assert set(one[0].tolist()) <= set(other[0].tolist()) and set(one[1].tolist()) <= set(other[1].tolist())
    hashes = sd.mixed(sd.np.arange(500, dtype=sd.np.uint64))
    want = sorted({min(range(i, i + 16), key=lambda j: hashes[j]) for i in range(500 - 15)})
    assert sd._minima(hashes, 16).tolist() == want


def test_copies_and_edits(spark):
    rnd = random.Random(3)
    base = words(rnd, 300)
    edited = [w if i % 60 else "zzz" for i, w in enumerate(base)]
    rows = [(i, " ".join(base)) for i in range(30)] + [(50, " ".join(edited)), (None, " ".join(base)), (None, " ".join(base))]
    docs, out = found(spark, rows)
    got = out.collect()
    exact = [r for r in got if r.doc_id is not None and 0 < r.doc_id < 50]
    assert all(r.removed and r.kept_in == 0 for r in exact) and {r.doc_id for r in exact} == set(range(1, 30))
    assert sum(r.n_words for r in got if r.doc_id == 50 and r.removed) > 200
    assert {r.kept_in for r in got if r.doc_id is None} == {0}
    cut = {(r.doc_id, len((r.text or "").split())) for r in sd.without_repeats(docs, out).collect()}
    assert (0, 300) in cut and all(n < 60 for d, n in cut if d and d < 50)


def test_variants_are_joined_by_edit_distance(spark):
    rnd = random.Random(4)
    base = words(rnd, 200)
    rows = []
    for i in range(12):
        own = list(base)
        own[100] = f"w{i:07d}"
        rows.append((i, " ".join(own)))
    _, out = found(spark, rows)
    whole = [r for r in out.collect() if r.doc_id > 0]
    _, exact = found(spark, rows, similarity=1.0)
    assert sum(r.n_words for r in whole) > sum(r.n_words for r in exact.collect() if r.doc_id > 0)


def test_odd_rows(spark):
    rnd = random.Random(5)
    again = " ".join(words(rnd, 60))
    rows = [(1, None), (2, ""), (3, f"{again} x {again}"), (4, "w " * 300_000), (5, "w " * 200_000), (6, " ".join(words(rnd, 30_000)))]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, row string")
    out = sd.stretches(sd.repeats(docs))
    assert {r.doc_id for r in out.collect()} <= {4, 5}
    cut = sd.without_repeats(docs, out)
    assert cut.columns == docs.columns and cut.count() == 6
    assert sd.stretches(sd.repeats(docs.limit(0))).count() == 0


def test_query(spark, sf):
    out = sd.op1_substring_dedup(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    seen = {}
    for i, t in texts.items():
        seen.setdefault(t, []).append(i)
    copies = {i for ids in seen.values() if len(ids) > 1 for i in ids if len(texts[i].split()) > 60}
    assert copies <= {r.doc_id for r in out}
    for r in out:
        assert 0 <= r.start < r.end <= len(texts[r.doc_id])
