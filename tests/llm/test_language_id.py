import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from stallwise.llm import language_id as li

WORDS = {"aa": ["abab", "ab", "ba", "abba", "ab"], "bb": ["cdc", "cd", "dé", "cdc", "acd"]}


def grams(words, order):
    for w in words:
        s = li._PAD * (order - 1) + w + li._END
        for i in range(order - 1, len(s)):
            yield s[i - order + 1 : i + 1]


def kneser_ney(words, order, symbols):
    """Plain recursive definition."""
    counts = {order: Counter(grams(words, order))}
    for k in range(order - 1, 0, -1):
        left, raw = defaultdict(set), Counter()
        for g, n in counts[order].items():
            raw[g[order - k :]] += n
        for g in counts[k + 1]:
            left[g[1:]].add(g[0])
        counts[k] = {g: raw[g] if g[0] == li._PAD else len(x) for g, x in left.items()}
    discount = {}
    for k, c in counts.items():
        ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        discount[k] = ones / (ones + 2 * twos) if ones else 0.5

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / symbols
        of = [v for g, v in counts[k].items() if g[:-1] == gram[:-1]]
        if not of:
            return p(gram[1:])
        d = discount[k]
        return max(counts[k].get(gram, 0) - d, 0) / sum(of) + d * len(of) / sum(of) * p(gram[1:])

    return p


@pytest.mark.parametrize("order", [2, 3, 5])
def test_model_equals_the_definition(order):
    rows = [(lang, g, n) for lang, words in WORDS.items() for g, n in Counter(grams(words, order)).items()]
    model = li.model_of(pa.Table.from_pandas(pd.DataFrame(rows, columns=["lang", "gram", "n"])), order)
    alphabet = {c for words in WORDS.values() for w in words for c in w} | {li._END}
    tries = ["ab", "abab", "cd", "zzz", "acdé", "b", "xé"]
    got = model.losses(tries)
    assert (np.diff(model.grams.astype(object)) > 0).all()
    for i, lang in enumerate(model.languages):
        p = kneser_ney(WORDS[lang], order, len(alphabet) + 1)
        want = [-sum(math.log(p(g)) for g in grams([w], order)) for w in tries]
        assert np.allclose(got[:, i], want, rtol=1e-5)


def test_counts(spark):
    docs = spark.createDataFrame([("a", "Ab ab-cd 1x"), ("a", "ab"), ("b", None), ("b", "é")], "lang string, text string")
    got = {(r.lang, r.gram): r.n for r in li.gram_counts(docs, 3).collect()}
    want = Counter(("a", g) for g in grams(["ab", "ab", "cd", "x", "ab"], 3)) + Counter(("b", g) for g in grams(["é"], 3))
    assert got == dict(want)


def test_stretches(monkeypatch):
    monkeypatch.setattr(li, "_STRETCH", 5)
    text = "Abc def-ghi 123 jkl\nmnopqrstuvw xyz"
    assert [w for words in li._words(text) for w in words] == "abc def ghi jkl mnopqrstuvw xyz".split()


@pytest.fixture(scope="module")
def found(spark):
    rows = li.op6_language_id(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text").collect()
    return rows, {r.doc_id: r for r in docs}


def test_held_out_accuracy(found):
    rows, docs = found
    import zlib

    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_clean_documents_are_accepted(found):
    rows, docs = found
    assert sum(r.accepted for r in rows) >= 0.98 * len(rows)


def test_rejection_and_odd_rows(spark, sf):
    model = li.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    long = " ".join(r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").limit(300).collect())
    rows = [(1, None), (2, ""), (3, "123 ... ½ ²"), (None, long[:3000]), (5, "qzxj wvkq " * 300), (5, "Привет мир " * 50), (6, long * 3)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, language string")
    got = docs.select("doc_id", li.predicted(spark, model, docs.text).alias("p")).select("doc_id", "p.*").collect()
    assert [r.lang_pred for r in got][:4] == ["und", "und", "und", "en"]
    assert [r.accepted for r in got] == [False, False, False, True, False, False, True]
    kept = li.keep_accepted(docs, model)
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["6", "None"]
    assert li.keep_accepted(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, "b", None)], "doc_id long, text string, lang string")
    model = li.fit(docs)
    assert docs.select(li.predicted(spark, model, docs.text).alias("p")).select("p.lang_pred").distinct().collect() == [("und",)]


def test_lowest_counts_go_first(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    small = li.fit(docs, max_grams=3000)
    full = li.fit(docs)
    assert len(small.grams) < len(full.grams) and small.languages == full.languages


def test_a_model_beyond_memory_is_whole(spark, sf):
    """Past the bound of a model in memory no gram goes, and the tables give what the arrays give."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(150)
    extra = [(None, None, None), (-1, "", "en"), (-2, "½ 12", "fr"), (-3, "zzqx", None), (-4, "Ünï çø\u0301de", "de")]
    odd = spark.createDataFrame(extra, "doc_id long, text string, lang string")
    docs = docs.select("doc_id", "text", "lang").union(odd).union(odd).repartition(3).localCheckpoint()
    held, tables = li.fit(docs), li.fit(docs, in_memory=100)
    assert isinstance(held, li.Model) and isinstance(tables, li.TableModel) and tables.languages == held.languages
    model = held.grams.size
    assert tables.table.where("exists(log_p, x -> x IS NOT NULL)").count() == model > 100
    for a, b in ((held.mean, tables.mean), (held.spread, tables.spread), (held.limit, tables.limit)):
        assert np.allclose(a, b, rtol=1e-4)

    def rows(m):
        got = li.marked(docs, m, "p").select("doc_id", "p.*").collect()
        return sorted(([str(r.doc_id), r.lang_pred, r.symbols, r.accepted], r.score, r.entropy) for r in got)

    want, got = rows(held), rows(tables)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert np.allclose([r[1:] for r in got], [r[1:] for r in want], rtol=1e-4)
    assert li.keep_accepted(docs, tables).columns == docs.columns


def test_calibration_scores_each_text_once(spark, sf, monkeypatch):
    """One evaluation of the model in each written step: a second one takes another Python worker for each task."""
    written, plans = li.saved, {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(li, "saved", noted)
    li.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    assert plans["calibration"].count("ArrowEvalPython") == 1
