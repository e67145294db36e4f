import json
import sys
import uuid
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import shop
from stallwise.functions.constants import UNCLASSIFIED, UNDETERMINED
from stallwise.plans import enrichment as e
from stallwise.plans import topics
from stallwise.sources.layers import read_table
from stallwise.sources.schemas import CLASSIFICATION

# Batch functions defined here reach the Python workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def texts(spark, pairs):
    return spark.createDataFrame(
        [(k, 1, t) for k, t in pairs], f"order_id string, review_score int, {e.TEXT} string"
    )


def answer(key, category="ok", **more):
    return {
        "order_id": key, "category": category, "reason": "r", "severity": "alta",
        "about_deadline": False, "about_product": True, "about_service": False,
    } | more


def by_key(df):
    return {r.order_id: r for r in df.collect()}


def test_blank_text_is_spaces_only(spark):
    orders = shop.star(spark).fact_orders
    assert sorted(by_key(e.eligible(orders))) == ["o1", "o3"]  # a line break counts as text
    assert e.population(orders).first().population == 2


def test_sample_is_the_same_for_any_partitioning(spark):
    df = texts(spark, [(f"o{i}", "t") for i in range(300)]).withColumn("is_late", F.lit(True))
    picks = [sorted(by_key(e.seeded_sample(df.repartition(n), "order_id", 40))) for n in (1, 7)]
    assert picks[0] == picks[1] and len(picks[0]) == 40
    other = sorted(by_key(e.seeded_sample(df, "order_id", 40, seed=7)))
    assert other != picks[0]


def test_sample_filters_first(spark):
    orders = shop.star(spark).fact_orders
    assert e.review_sample(orders, size=2).count() == 2
    row = e.sample_coverage(e.review_sample(orders, size=1), orders).first()
    assert (row.sampled, row.population, row.coverage_pct) == (1, 2, 50.0)


def test_failing_lot_does_not_touch_the_others(spark):
    df = texts(spark, [(f"o{i:02d}", "o PRAZO" if i == 5 else "veio errado") for i in range(12)]).coalesce(1)

    def model(lot):
        if "o05" in set(lot["order_id"]):
            raise RuntimeError("call failed")
        return [answer(k) for k in lot["order_id"]]

    got = by_key(e.classify_lots(df, model, lot_size=4))
    assert len(got) == 12
    failed = [k for k, r in got.items() if r.category == UNCLASSIFIED]
    assert failed == ["o04", "o05", "o06", "o07"]
    assert got["o05"].about_deadline and not got["o05"].about_product
    assert got["o04"].about_product and got["o04"].severity == UNDETERMINED and not got["o04"].about_service
    row = e.failure_share(e.classify_lots(df, model, lot_size=4)).first()
    assert (row.total, row.unclassified, row.unclassified_pct) == (12, 4, 33.3)


def test_a_rerun_sends_only_what_is_missing(spark, tmp_path):
    df = texts(spark, [(f"o{i:03d}", "o PRAZO" if i == 5 else "t") for i in range(100)]).repartition(3)
    calls = tmp_path / "calls"
    calls.mkdir()

    def model(broken):
        def call(lot):
            (calls / uuid.uuid4().hex).write_text(" ".join(lot["order_id"]))
            if broken & set(lot["order_id"]):
                raise RuntimeError("call failed")
            return [answer(k) for k in lot["order_id"]]

        return call

    def sent():
        files = list(calls.iterdir())
        out = sorted(k for f in files for k in f.read_text().split())
        for f in files:
            f.write_text("")
        return out

    first = e.classify_missing(df, model({"o005"}), str(tmp_path), waves=4, lot_size=5)
    assert sent() == sorted(by_key(df))
    got = by_key(first)
    failed = sorted(k for k, r in got.items() if r.category == UNCLASSIFIED)
    assert len(got) == 100 and "o005" in failed and len(failed) <= 5 and got["o005"].about_deadline
    assert first.count() == 100 and sent() == []  # a second action calls nothing
    second = e.classify_missing(df.union(texts(spark, [("new", "t")])), model(set()), str(tmp_path), waves=3)
    assert sent() == sorted([*failed, "new"])
    assert {r.category for r in second.collect()} == {"ok"} and second.count() == 101
    part = e.classify_missing(df.where("order_id < 'o010'"), model(set()), str(tmp_path))
    assert part.count() == 10 and sent() == []
    assert e.classify_missing(df.limit(0), model(set()), str(tmp_path / "none")).count() == 0


def test_lots_keep_their_size_over_batches(spark):
    df = texts(spark, [(f"o{i}", "t") for i in range(1203)]).coalesce(1)
    sizes = e.classify_lots(df, lambda lot: [answer(k, str(len(lot))) for k in lot["order_id"]])
    counts = {int(r.category): r["count"] for r in sizes.groupBy("category").count().collect()}
    assert counts == {50: 1200, 3: 3}


def test_reply_with_unknown_category_missing_and_invented_rows(spark):
    df = texts(spark, [("a", "x"), ("b", "x"), ("c", "x")]).coalesce(1)

    def model(lot):
        return json.dumps({"classifications": [answer("a"), answer("b", "made_up"), answer("zz")]})

    got = by_key(e.classify_lots(df, model, categories=["ok"]))
    assert {k: r.category for k, r in got.items()} == {"a": "ok", "b": UNCLASSIFIED, "c": UNCLASSIFIED}


@pytest.mark.parametrize("bad", [{"about_product": "yes"}, {"severity": 3}])
def test_reply_off_contract_fails_the_lot(spark, bad):
    df = texts(spark, [("a", "x"), ("b", "x")]).coalesce(1)
    got = by_key(e.classify_lots(df, lambda lot: [answer("a"), answer("b", **bad)]))
    assert {r.category for r in got.values()} == {UNCLASSIFIED}


def test_missing_text_does_not_stop_a_failing_lot(spark):
    df = texts(spark, [("a", None), ("b", "PRAZO")]).coalesce(1)
    got = by_key(e.classify_lots(df, lambda lot: "no json"))
    assert {k: (r.category, r.about_deadline) for k, r in got.items()} == {
        "a": (UNCLASSIFIED, False), "b": (UNCLASSIFIED, True),
    }


def test_rare_words_reach_the_vocabulary(spark):
    df = texts(spark, [(f"o{i}", "alpha beta gamma delta " * 3 + ("unheard" if i == 7 else "")) for i in range(30)])
    fits = [topics.discover_topics(df, k=4, passes=2, min_documents=n).weights for n in (1, 2)]
    assert ["unheard" in {r.term for r in weights.collect()} for weights in fits] == [True, False]


def test_json_replies_become_rows(spark):
    good = json.dumps({"classifications": [answer("a"), answer("b")]})
    df = spark.createDataFrame([(good,), ("no json",), (None,)], "reply string")
    assert sorted(by_key(e.parse_replies(df, "reply"))) == ["a", "b"]


def test_keyword_classes(spark):
    taxonomy = {"late": ["atraso", "prazo", "demora"], "wrong": ["errado", "veio"]}
    df = texts(spark, [("a", "ATRASO no prazo, demora"), ("b", "veio errado, atraso"), ("c", "prazo e veio"), ("d", "?")])
    got = by_key(e.classify_by_keywords(df, taxonomy, deadline="late", product=["wrong"]))
    assert {k: (r.category, r.severity) for k, r in got.items()} == {
        "a": ("late", "alta"), "b": ("wrong", "media"), "c": ("late", "baixa"), "d": (UNCLASSIFIED, UNDETERMINED),
    }
    assert got["b"].about_deadline and got["b"].about_product and not got["a"].about_product


def test_enriched_fact_is_replaced_and_unique(spark, tmp_path):
    rows = [
        answer("order_1", "atraso_entrega"),
        answer("order_2", "produto_divergente", reason="Veio faltando item"),
        answer("order_3", "qualidade_produto"),
        answer("order_3", UNCLASSIFIED),
    ]
    df = spark.createDataFrame([tuple(r[f] for f in CLASSIFICATION.fieldNames()) for r in rows], CLASSIFICATION)
    for run in ("first", "second"):
        e.save_enriched(df, str(tmp_path), run)
    got = by_key(read_table(spark, str(tmp_path), e.ENRICHED_TABLE))
    assert sorted(got) == ["order_1", "order_2", "order_3"]
    assert got["order_2"].reason == "Veio faltando item" and got["order_3"].category == "qualidade_produto"
    assert {(r.run_id, r.is_fallback) for r in got.values()} == {("second", False)}
    assert all(r.classified_at for r in got.values())


def test_last_row_wins_by_the_given_order(spark):
    df = texts(spark, [("a", "t")]).select(
        "order_id", F.explode(F.array(F.lit("x"), F.lit("z"), F.lit("y"))).alias("category")
    )
    for f in CLASSIFICATION.fieldNames()[2:]:
        df = df.withColumn(f, F.lit(False) if f.startswith("about") else F.lit(""))
    assert e.enriched(df, "r", [F.desc("category")]).first().category == "z"


def test_enrich_runs_the_whole_chain(spark):
    orders = shop.star(spark).fact_orders
    fact = e.enrich(orders, lambda r: e.classify_by_keywords(r, {"c": ["first"]}), size=10, run_id="x")
    assert {k: r.is_fallback for k, r in by_key(fact).items()} == {"o1": False, "o3": True}


def test_topics_fill_the_taxonomy_contract(spark):
    words = ["atraso entrega demora prazo", "produto quebrado defeito peça", "suporte resposta atendimento email"]
    df = texts(spark, [(f"o{i}", words[i % 3]) for i in range(90)])
    model = topics.discover_topics(df, k=4, terms=3, passes=5)
    row = model.taxonomy(df).first()
    assert len(row.categories) == 4 and all(len(c.keywords) == 3 for c in row.categories)
    known = {c.category_id for c in row.categories}
    assigned = model.assign(df).collect()
    assert len(assigned) == 90 and {r.category for r in assigned} <= known
    with pytest.raises(ValueError):
        topics.discover_topics(df, k=9)


def test_a_pass_against_numpy(spark):
    """Shares of one pass, and what every pass keeps: each occurrence is divided whole, but for rounding."""
    import numpy as np

    rows = [(d, w, n) for d, text in enumerate(["a b c", "a a d", "b d e e", "f"]) for w, n in Counter(text.split()).items()]
    counts = spark.createDataFrame([(f"o{d}", w, n) for d, w, n in rows], "order_id string, term string, n long")
    first = topics.first_shares(counts, 4, 1)
    start = {(r.order_id, r.term): np.array([r[s] for s in topics.shares(4)], dtype=float) for r in first.collect()}
    got = {(r.order_id, r.term): r for r in topics.next_shares(first, 4, 6).collect()}
    total = sum(start.values())
    for d, w, n in rows:
        in_text = sum(v for (o, _), v in start.items() if o == f"o{d}") + topics.TEXT_PRIOR
        in_topic = (sum(v for (_, t), v in start.items() if t == w) + topics.TERM_PRIOR) / (total + topics.TERM_PRIOR * 6)
        want = np.floor(n * topics.PARTS * in_text * in_topic / sum(in_text * in_topic))
        found = np.array([got[f"o{d}", w][s] for s in topics.shares(4)])
        assert np.abs(found - want).max() <= 1 and n * topics.PARTS - 4 <= found.sum() <= n * topics.PARTS


def test_topics_find_groups_of_terms(spark):
    groups = ["kalo", "nesti", "puru", "wim"]
    rows = [(f"o{i}", " ".join(f"{groups[i % 4]}{'abcdefgh'[j]}" for j in range(i % 3, i % 3 + 5))) for i in range(120)]
    df = texts(spark, rows).repartition(5)
    model = topics.discover_topics(df, k=4, terms=4, passes=15, seed=3)
    again = topics.discover_topics(df.repartition(2), k=4, terms=4, passes=15, seed=3)
    assert model.categories() == again.categories()
    names = {r.order_id: r.category for r in model.assign(df).collect()}
    share = sum(Counter(names[f"o{i}"] for i in range(g, 120, 4)).most_common(1)[0][1] for g in range(4)) / 120
    assert share > 0.9
    plan = model.weights._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan


def test_frequent_terms_are_left_out(spark):
    df = texts(spark, [(f"o{i}", f"word und{'x' * (i + 1)} common") for i in range(10)])
    kept = {r.term for r in topics.known_terms(df, max_percent=50).collect()}
    assert "common" not in kept and "word" not in kept and len(kept) == 10
    assert topics.known_terms(df, max_percent=50, stop_words=["undx"]).count() == 9


def test_topics_by_cells_equal_the_passes(spark, monkeypatch):
    """Blocks, shards and packed rows of any size give the sums of the shares as the passes define them."""
    for name, value in {"SHARD": 3, "BLOCK": 2, "PACKED": 2, "TASK": 5, "CHUNK": 2}.items():
        monkeypatch.setattr(topics, name, value)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta"]
    texts = [(f"o{i % 9}", " ".join(words[(i * j) % 8] for j in range(1, 2 + i % 6))) for i in range(14)]
    texts += [(None, "alpha only nowhere"), (None, "beta"), ("blank", "")]
    df = spark.createDataFrame(texts, "order_id string, review_comment_message string").repartition(3)
    for passes in (0, 1, 4):
        worded = topics._worded(df)
        divided = topics.first_shares(topics._counts(worded), 4, 7).localCheckpoint()
        size = divided.select("term").distinct().count()
        for _ in range(passes):
            divided = topics.next_shares(divided, 4, size).localCheckpoint()
        want = divided.groupBy("term").agg(*[F.sum(s).alias(s) for s in topics.shares(4)])
        got = topics.discover_topics(df, k=4, seed=7, languages=(), passes=passes).weights
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
