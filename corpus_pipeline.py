"""Corpus pipeline: stages over the documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stallwise.llm import decontamination, language_id, simhash_near, source_mix, token_blocks
from stallwise.llm.common import saved, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words of a block of the mix: documents are cut at the ends of blocks only.
BLOCK_WORDS = 256
#: Characters whose distinct pieces are encoded once: workers hold the earlier stages' models, too.
ENCODED = 1 << 21


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the models, learned from the labelled documents, accept."""
    return language_id.keep_accepted(docs, language_id.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: three-word shingles, three bits or fewer."""
    return simhash_near.keep_one(docs, simhash_near.SHINGLE, simhash_near.RADIUS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for those taken once or more, another for those taken twice."""
    return source_mix.mixed(docs, BLOCK_WORDS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks of the mix, strings of special tokens spelled out: rows of the binary format, which ``token_blocks.documents_of`` reads back."""
    return token_blocks.blocks_of(docs, token_blocks.tokenizer_json(), special_as_text=True, together=ENCODED)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("source_mix", mix_sources),
    ("token_blocks", write_tokens),
]

#: No SQL can express the language models, fingerprints and tokens of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
