import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import compare
import corpus_pipeline
from stallwise.llm import decontamination, simhash_near, token_blocks
from stallwise.llm.common import saved
from stallwise.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], sf), name))
    return out


def test_columns_and_rows(steps):
    docs, language, near, clean, mix, _ = steps
    assert all(s.columns == docs.columns for s in (language, near, clean, mix))
    assert language.count() >= 0.97 * docs.count()
    assert near.count() < language.count()


def test_no_copies_are_left(steps):
    _, language, near, *_ = steps
    texts = [r.text for r in near.select("text").collect()]
    assert len(set(texts)) == len(texts)
    groups = {r.doc_id: simhash_near.fingerprint(r.text) for r in language.select("doc_id", "text").collect()}
    linked = {i: {j for j, b in groups.items() if (a ^ b).bit_count() <= 3} for i, a in groups.items()}
    kept = {r.doc_id for r in near.select("doc_id").collect()}
    want, seen = set(), set()
    for i in sorted(groups):
        if i in seen:
            continue
        want.add(i)
        work = [i]
        while work:
            j = work.pop()
            if j not in seen:
                seen.add(j)
                work += linked[j] - seen
    assert kept == want


def test_no_leaks_are_left(spark, sf, steps):
    *_, near, clean, _, _ = steps
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(i in r.text for r in clean.select("text").collect() for i in items)
    leaks = decontamination.leaks(near, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert clean.count() == near.count() - leaks.select("doc_id").distinct().count()


def test_mix_takes_words_of_the_documents(steps):
    *_, clean, mix, _ = steps
    texts = {r.doc_id: r.text.split() for r in clean.collect()}
    for r in mix.collect():
        own = iter(texts[r.doc_id])
        assert all(w in own for w in r.text.split())


def test_tokens_hold_the_mix(steps):
    *_, mix, blocks = steps
    from tokenizers import Tokenizer

    plain = Tokenizer.from_str(token_blocks.tokenizer_json())
    plain.encode_special_tokens = True
    want = sorted((r.doc_id, (*plain.encode(r.text, add_special_tokens=False).ids, 0)) for r in mix.collect())
    assert sorted((r.doc_id, tuple(r.ids)) for r in token_blocks.documents_of(blocks).collect()) == want
    crc = {(r.doc_id, r.ids_crc32) for r in token_blocks.digests_of(blocks).collect()}
    assert crc == {(i, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in want}


def test_run_is_the_stages(spark, sf, steps):
    rows = corpus_pipeline.run(spark, sf)
    assert sorted(bytes(r.words) for r in rows.collect()) == sorted(bytes(r.words) for r in steps[-1].collect())
    assert corpus_pipeline.run(spark, sf).columns == steps[-1].columns


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    assert compare.difference(QUERIES[name](spark, sf), compare.database(sf), ORACLE_SQL[name]) is None


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, sf), "empty")
    assert docs.count() == 0
