"""Substring dedup: paragraphs found by MinHash banding, verified by edit distance, clustered by components.

Passages that documents share begin and end anywhere, so paragraphs are cut by content, not by line feeds. Every
window of ``WINDOW`` shingles (of five words) has a MinHash: its shingle with the smallest hash. A paragraph
reaches from one window's minimum through the next different one. Its band key holds two rows: the MinHashes at
its two ends. Paragraphs that begin in a shared passage and end outside it share no key, so a passage that very
many documents hold makes no large bucket of unlike texts.

Recall: a passage of n words that two documents share word for word gives both the same paragraphs over n - 30
words of it at least, with the windows of 16 set here: every passage of over 50 words is caught. Passages with
edits are caught by the paragraphs between the edits, and by those whose inner words differ only.

1. Keys that two documents have are counted out; all other paragraphs are unique and go no further.
2. Paragraphs with the same key and the same words are one variant, however many documents hold it. Variants with
   the same key are compared by edit distance (similarity ``SIMILARITY`` or more), on their text.
3. Groups are connected components of variants. The smallest (document, place) of a group keeps it.
4. In each document, overlapping repeated paragraphs form runs. Runs of fewer than ``LEAST_WORDS`` words are left
   alone; of the others, what is kept elsewhere is marked as removed.

Words are split at ASCII white space, ASCII letters lowered. Null and short texts have no paragraphs. Rows with
the same id and text are one document. Repeats within one document only are left alone. Null ids are the last to
keep a group. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

from stallwise.llm.common import components, dropped, fresh, parts_of, saved, table
from stallwise.llm.hashing import mixed, powers, shingles, word_hashes

SHINGLE = 5
WINDOW = 16
LEAST_WORDS = 20
SIMILARITY = 0.8


def _minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of every window, each once, ascending."""
    if len(hashes) < window:
        return np.empty(0, dtype=np.int64)
    out, last = [], -1
    for at in range(0, len(hashes) - window + 1, 1 << 16):
        some = hashes[at : at + (1 << 16) + window - 1]
        views = np.lib.stride_tricks.sliding_window_view(some, window)
        places = np.unique(views.argmin(axis=1) + np.arange(len(views)) + at)
        out.append(places[places > last])
        last = int(places[-1])
    return np.concatenate(out)


def _paragraphs(text: str, window: int) -> tuple[np.ndarray, ...]:
    """(key, content, first word, word after the last, start, next start, end) of the paragraphs; the last three
    are code points, the next start that of the following paragraph."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    starts, ends, words = word_hashes(data)
    if len(words) < SHINGLE + window:
        return (np.empty(0, np.int64),) * 7
    hashes = shingles(words, SHINGLE)
    at = _minima(hashes, window)
    low, high = at[:-1], at[1:]
    stop = high + SHINGLE
    forward, back = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * forward[: len(words)], out=sums[1:])
    content = mixed((sums[stop] - sums[low]) * back[low])
    key = mixed(hashes[low] + mixed(hashes[high] + np.uint64(1)))
    before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return (
        key.view(np.int64), content.view(np.int64), low, stop, before[starts[low]], before[starts[high]], before[ends[stop - 1]]
    )


def paragraphs_of(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, doc_id, key, content, first, stop, start, next, end): a row per paragraph; row names the document."""
    text_hash = F.xxhash64(docs["text"])
    rows = docs.select(F.xxhash64(docs["doc_id"], text_hash).alias("row"), docs["doc_id"], docs["text"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["key", "content", "first", "stop", "start", "next", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            found = [_paragraphs(t.as_py() or "", window) for t in batch.column(2)]
            take = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            columns = [pa.array(np.concatenate([f[k] for f in found])) for k in range(7)] if found else []
            if found:
                columns = [c if k < 2 else c.cast(pa.int32()) for k, c in enumerate(columns)]
                heads = [batch.column(0).take(take), batch.column(1).take(take)]
                yield pa.RecordBatch.from_arrays(heads + columns, names=["row", "doc_id", *names])

    return rows.mapInArrow(
        run,
        f"row long, doc_id {kind}, key long, content long, first int, stop int, start int, next int, end int",
    )


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(variant, words): lowered words of the wanted paragraphs (variant, row, start, end), a space between."""
    places = wanted.groupBy("row").agg(F.collect_list(F.struct("variant", "start", "end")).alias("wanted"))
    texts = docs.select(F.xxhash64(docs["doc_id"], F.xxhash64(docs["text"])).alias("row"), docs["text"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            variants, words = [], []
            for text, places in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                for place in places.as_py():
                    variants.append(place["variant"])
                    words.append(" ".join(text[place["start"] : place["end"]].lower().split()))
            yield pa.RecordBatch.from_arrays([pa.array(variants, pa.int64()), pa.array(words, pa.string())], names=["variant", "words"])

    rows = texts.join(places, "row").select("text", "wanted")
    return rows.mapInArrow(run, "variant long, words string").dropDuplicates(["variant"])


def _similar(similarity: float):
    longer = F.greatest(F.length("x"), F.length("y"))
    most = F.floor(longer * (1 - similarity) + 1e-9)
    return (F.abs(F.length("x") - F.length("y")) <= most) & (F.levenshtein("x", "y") <= most)


def _linked(texts: DataFrame, similarity: float) -> DataFrame:
    """(node, component) of variants (key, variant, words) that are similar to another one of their key.

    Each variant is compared with the first one of its key, then with all of its key that this has not brought into
    the same group: the groups are those of all similar pairs, without all pairs of a large group.
    """
    first = texts.groupBy("key").agg(F.min("variant").alias("variant")).join(texts, ["key", "variant"])
    near = first.toDF("key_a", "a", "x").join(
        texts.toDF("key_b", "b", "y"), (F.col("key_a") == F.col("key_b")) & (F.col("a") != F.col("b")) & _similar(similarity)
    )
    links = saved(near.select("a", "b"), "variant-links")
    labels = components(links)
    marked = texts.join(labels, F.col("variant") == F.col("node"), "left")
    marked = saved(marked.select("key", "variant", "words", F.coalesce("component", "variant").alias("label")), "variant-labels")
    one, two = marked.toDF("key_a", "a", "x", "label_a"), marked.toDF("key_b", "b", "y", "label_b")
    apart = (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b"))
    more = one.join(two, (F.col("key_a") == F.col("key_b")) & apart & _similar(similarity))
    return components(links.union(more.select("a", "b")))


def repeats(docs: DataFrame, window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """(row, doc_id, key, content, first, stop, start, next, end, group, kept): paragraphs of groups that two
    documents hold. kept: (no_id, doc_id, row, first) of the occurrence that stays."""
    every = saved(paragraphs_of(docs, window), "all-paragraphs")
    shared = every.groupBy("key").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    # Written, so that the join has plain shuffles below, which Spark may split at a hot key.
    shared = saved(shared.where("low <> high").select(F.col("key").alias("shared")), "shared-keys")
    found = every.join(shared, every.key == shared.shared, "left_semi").withColumn("variant", F.xxhash64("key", "content"))
    found = saved(found, "paragraphs")
    dropped(every)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "first")
    variants = saved(
        found.groupBy("key", "variant").agg(
            F.min("row").alias("low"),
            F.max("row").alias("high"),
            F.min(place).alias("kept"),
            F.min(F.struct("row", "start", "end")).alias("at"),
        ),
        "variants",
    )
    several = variants.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    several = saved(variants.join(several, "key", "left_semi").select("key", "variant", "at"), "several")
    texts = _texts(docs, several.select("variant", "at.*"))
    texts = saved(several.select("key", "variant").join(texts, "variant"), "variant-texts")
    linked = _linked(texts.select("key", "variant", "words"), similarity).withColumnRenamed("node", "variant")
    grouped = variants.join(linked, "variant", "left").withColumn("group", F.coalesce("component", "variant"))
    groups = grouped.groupBy("group").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("kept").alias("kept"))
    groups = groups.where("low <> high").select("group", "kept")
    members = saved(grouped.select("variant", "group").join(groups, "group"), "groups")
    return found.join(members, "variant").drop("variant")


def stretches(found: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, row, start, end, n_words, removed, kept_in, group) of repeated paragraphs (``repeats``).

    A row per stretch of a run with the same fate: start and end are code points; kept_in is the document that
    keeps it (its own, where it isn't removed); group is the first paragraph's.
    """
    within = Window.partitionBy("row", "doc_id").orderBy("first", "stop")
    distinct = found.dropDuplicates(["row", "doc_id", "first", "stop"])
    stays = (F.col("kept.row") == F.col("row")) & (F.col("kept.first") == F.col("first"))
    rows = distinct.withColumns({"removed": ~stays, "kept_in": F.col("kept.doc_id")})
    rows = rows.withColumn("begins", F.coalesce(F.lag("stop").over(within) < F.col("first"), F.lit(True)).cast("int"))
    rows = rows.withColumn("run", F.sum("begins").over(within))
    of_run = Window.partitionBy("row", "doc_id", "run")
    rows = rows.withColumn("run_words", F.max("stop").over(of_run) - F.min("first").over(of_run))
    rows = rows.where(F.col("run_words") >= least_words)
    in_run = of_run.orderBy("first", "stop")
    same = F.lag("removed").over(in_run).eqNullSafe(F.col("removed")) & F.lag("kept_in").over(in_run).eqNullSafe(F.col("kept_in"))
    rows = rows.withColumn("turns", (~same | F.lag("first").over(in_run).isNull()).cast("int"))
    last = F.lead("first").over(in_run).isNull()
    rows = rows.withColumns(
        {
            "stretch": F.sum("turns").over(in_run),
            "upto": F.when(last, F.col("end")).otherwise(F.col("next")),
            "word_upto": F.when(last, F.col("stop")).otherwise(F.col("stop") - SHINGLE),
        }
    )
    return rows.groupBy("doc_id", "row", "run", "stretch").agg(
        F.min("start").cast("long").alias("start"),
        F.max("upto").cast("long").alias("end"),
        (F.max("word_upto") - F.min("first")).cast("long").alias("n_words"),
        F.first("removed").alias("removed"),
        F.first("kept_in").alias("kept_in"),
        F.min_by("group", "first").alias("group"),
    ).select("doc_id", "row", "start", "end", "n_words", "removed", "kept_in", "group")


def without_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with the removed stretches (``stretches``) cut from their texts."""
    row, spans = fresh(docs, "row", "spans")
    gone = found.where("removed").groupBy(F.col("row").alias(row)).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(spans))

    @pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, places in zip(texts, spans, strict=True):
            for place in reversed(places if places is not None else []):
                text = text[: place["start"]] + text[place["end"] :]
            out.append(text)
        return pd.Series(out, dtype=object)

    marked = docs.withColumn(row, F.xxhash64(docs["doc_id"], F.xxhash64(docs["text"])))
    return marked.join(gone, row, "left").withColumn("text", cut("text", spans)).select(*docs.columns)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stretches(repeats(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "start", "end", "n_words", "removed", "kept_in", F.col("group").alias("group_id"))
