"""Topic discovery over review texts: a factorisation of the term counts by joins and aggregates.

Each occurrence of a term in a text is divided among ``k`` topics (expectation maximisation). A pass reads the shares
of the last one, sums them by term and by text, and divides the occurrences anew in proportion to both sums. Shares
are whole millionths of an occurrence, so all sums are exact and do not depend on the order of rows or on lost tasks.
The first shares come from a hash of term and topic.

``first_shares`` and ``next_shares`` define a pass. The fit computes the same numbers without a table of shares: they
follow from the sums by term and by text. Terms are dealt to shards and texts to blocks, of bounded sizes, and the
occurrences lie packed in cells of one block and one shard. A pass brings each cell the sums of its block and its
shard, sums the new shares within the cell, and adds the cells' sums up by a shuffle. Nothing of the vocabulary's or
the texts' size is in one place, and a row of the counts costs a pass some 16 bytes of shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stallwise.operators.ranking import top_per_group
from stallwise.plans.enrichment import TEXT
from stallwise.session import written
from stallwise.sources.schemas import TAXONOMY

MIN_TOPICS, MAX_TOPICS = 4, 6
MIN_LETTERS = 3
#: Parts of an occurrence; what a text and a term have of every topic from the start, in such parts.
PARTS, TEXT_PRIOR, TERM_PRIOR = 1_000_000, 100_000, 10_000


#: Terms of a shard and texts of a block, on average; occurrences of a packed row and of a task; sums of a packed row.
SHARD, BLOCK, PACKED, TASK, CHUNK = 1 << 17, 1 << 14, 1 << 14, 1 << 20, 1 << 12
_TEXT, _TERM, _TOTAL = 0, 1, 2
_SUMS = "kind int, id int, first int, sums binary"


def tokens(text: Column) -> Column:
    """Runs of at least three letters, lower case, with repeats."""
    return F.filter(F.split(F.lower(text), r"\P{L}+"), lambda w: F.length(w) >= MIN_LETTERS)


def _worded(reviews: DataFrame) -> DataFrame:
    return reviews.select("order_id", tokens(F.col(TEXT)).alias("words"))


def _documents(worded: DataFrame) -> DataFrame:
    return worded.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("documents")
    )


def term_documents(reviews: DataFrame) -> DataFrame:
    """Texts per term, over all texts: what the vocabulary is made from."""
    return _documents(_worded(reviews))


def _counts(worded: DataFrame) -> DataFrame:
    """(order_id, term, n): occurrences of each term in each text."""
    words = worded.select("order_id", F.explode("words").alias("term"))
    return words.groupBy("order_id", "term").agg(F.count(F.lit(1)).alias("n"))


def _known(worded: DataFrame, min_documents: int, max_percent: int, stop_words: list[str]) -> DataFrame:
    """(term): terms of the vocabulary, by the number and the percentage of the texts that have them."""
    texts = worded.agg(F.count(F.lit(1))).scalar()
    often = (F.col("documents") >= min_documents) & (F.col("documents") * 100 <= texts * max_percent)
    found = _documents(worded).where(often).select("term")
    return found.where(~F.col("term").isin(stop_words)) if stop_words else found


def known_terms(
    reviews: DataFrame, min_documents: int = 1, max_percent: int = 100, stop_words: list[str] | None = None
) -> DataFrame:
    return _known(_worded(reviews), min_documents, max_percent, stop_words or [])


def shares(k: int) -> list[str]:
    return [f"share_{z}" for z in range(k)]


def first_shares(counts: DataFrame, k: int, seed: int) -> DataFrame:
    """Counts with a share for each topic that only the term, the topic and the seed decide."""
    weights = []
    for z in range(k):
        digest = F.md5(F.concat(F.lit(f"{seed} {z} "), "term"))
        weights.append(F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % 1000 + 1)
    return counts.select("order_id", "term", "n", *[(w * F.col("n")).alias(s) for w, s in zip(weights, shares(k))])


def _sums(divided: DataFrame, k: int, *keys: str) -> DataFrame:
    return divided.groupBy(*keys).agg(*[F.sum(s).alias(f"by_{keys[0]}_{s}") for s in shares(k)])


def next_shares(divided: DataFrame, k: int, terms: int) -> DataFrame:
    """One pass over occurrences divided among the topics; ``terms`` is the size of the vocabulary."""
    names = shares(k)
    totals = divided.agg(F.struct(*[F.sum(s).alias(s) for s in names])).scalar()
    rows = divided.select("order_id", "term", "n").join(_sums(divided, k, "term"), "term")
    rows = rows.join(_sums(divided, k, "order_id"), "order_id").withColumn("totals", totals)
    columns = {}
    for z, s in enumerate(names):
        in_text = (F.col(f"by_order_id_{s}") + TEXT_PRIOR).cast("double")
        in_topic = (F.col(f"by_term_{s}") + TERM_PRIOR).cast("double")
        columns[f"q{z}"] = in_text * (in_topic / (F.col(f"totals.{s}") + TERM_PRIOR * terms).cast("double"))
    rows = rows.withColumns(columns).withColumn("q", reduce(add, [F.col(f"q{z}") for z in range(k)]))
    parts = (F.col("n") * PARTS).cast("double")
    return rows.select(
        "order_id", "term", "n", *[F.floor(parts * (F.col(f"q{z}") / F.col("q"))).alias(s) for z, s in enumerate(names)]
    )


@dataclass(frozen=True)
class TopicModel:
    """``weights``: (term, share_0, share_1, ...), a table on the cluster."""

    weights: DataFrame
    k: int
    terms: int

    def leading_terms(self) -> DataFrame:
        """(topic, place, term): the terms with the largest weight in each topic, ties by the term."""
        listed = F.explode(F.array(*[F.struct(F.lit(z).alias("topic"), F.col(s).alias("w")) for z, s in enumerate(shares(self.k))]))
        rows = self.weights.select("term", listed.alias("t")).select("term", "t.topic", "t.w")
        best = top_per_group(rows, ["topic"], [F.desc("w"), F.asc("term")], self.terms)
        ordered = F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("w"), "term")))
        return best.groupBy("topic").agg(ordered.alias("t")).select("topic", F.posexplode("t.term").alias("place", "term"))

    def categories(self) -> list[dict]:
        """Topics as categories: at most six rows of ``terms`` keywords leave the cluster."""
        words = {}
        for row in self.leading_terms().orderBy("topic", "place").collect():
            words.setdefault(row.topic, []).append(row.term)
        return [
            {
                "category_id": f"topic_{topic}",
                "display_name": ", ".join(found[:3]),
                "description": "Texts about " + ", ".join(found),
                "keywords": found,
            }
            for topic, found in words.items()
        ]

    def taxonomy(self, df: DataFrame) -> DataFrame:
        """One row under the taxonomy contract."""
        found = self.categories()
        summary = f"{len(found)} topics; leading words: " + ", ".join(c["keywords"][0] for c in found)
        return df.sparkSession.createDataFrame([(found, summary)], TAXONOMY)

    def assign(self, reviews: DataFrame) -> DataFrame:
        """(order_id, category): the topic that the most of a text's known occurrences fall to, each divided by the
        weights of its term; ties and texts without a known term: the first topic."""
        names = shares(self.k)
        whole = reduce(add, [F.col(s) for s in names]).cast("double")
        parts = (F.col("n") * PARTS).cast("double")
        divided = [F.floor(parts * (F.col(s).cast("double") / whole)) for s in names]
        met = _counts(_worded(reviews)).join(self.weights, "term")
        summed = met.groupBy("order_id").agg(F.array(*[F.sum(d) for d in divided]).alias("sums"))
        place = F.coalesce(F.array_position("sums", F.array_max("sums")) - 1, F.lit(0))
        joined = reviews.select("order_id").join(summed, "order_id", "left")
        return joined.select("order_id", F.concat(F.lit("topic_"), place.cast("string")).alias("category"))


def discover_topics(
    reviews: DataFrame,
    k: int = 5,
    terms: int = 8,
    seed: int = 42,
    min_documents: int = 1,
    languages: tuple[str, ...] = ("portuguese",),
    passes: int = 20,
    max_percent: int = 100,
) -> TopicModel:
    """Fit ``k`` topics on all given texts.

    The vocabulary holds every term that at least ``min_documents`` texts and at most ``max_percent`` of them have, but
    the stop words of the ``languages``. Each pass is one job that starts from the written sums of the last.
    """
    if not MIN_TOPICS <= k <= MAX_TOPICS:
        raise ValueError(f"k must be {MIN_TOPICS}..{MAX_TOPICS}")
    stop_words = [w for language in languages for w in StopWordsRemover.loadDefaultStopWords(language)]
    worded = written(_worded(reviews), "topic-words")
    known = written(_known(worded, min_documents, max_percent, stop_words), "topic-terms")
    counts = written(_counts(worded).join(known, "term", "left_semi"), "topic-counts")
    cells = _cells(counts, k, seed)
    sums = cells.first_sums()
    for _ in range(passes):
        sums = cells.next_sums(sums)
    return TopicModel(written(cells.weights(sums, passes), "topic-weights"), k, terms)


def _dealt(df: DataFrame, key: str, parts: int, part: str, place: str) -> DataFrame:
    """A number of the part and the place in it, from 0, for each distinct key."""
    rows = df.withColumn(part, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    return rows.withColumn(place, F.row_number().over(W.partitionBy(part).orderBy(key)) - 1)


@dataclass(frozen=True)
class _Cells:
    """``rows``: (block, shard, texts, terms, n), places and occurrences packed in binary; ``vocabulary``: (term, shard,
    place, total, placed, share_0, ...), the term's first shares of one occurrence, ``placed`` if a text with an id has it;
    ``texts``: (block, place)."""

    rows: DataFrame
    vocabulary: DataFrame
    texts: DataFrame
    k: int
    size: int
    shards: int
    blocks: int
    tasks: int

    def first_sums(self) -> DataFrame:
        """(kind, id, first, sums) of the first shares: k sums for each place of a block or shard, and the totals.

        Texts without an id count for their terms here, and no more in the passes: a sum by text has no row for them.
        """
        names = shares(self.k)
        zero = [F.lit(0).cast("long").alias(s) for s in names]
        nothing = _packed_sums(self.texts.select(F.lit(_TEXT).alias("kind"), F.col("block").alias("id"), "place", *zero), self.k, self.tasks)
        key = F.lit(_TERM).alias("kind"), F.col("shard").alias("id"), "place"
        weights = _packed_sums(self.vocabulary.select(*key, *names), self.k, self.tasks)
        whole = self.vocabulary.select(*key, *[(F.col(s) * F.col("total")).alias(s) for s in names])
        totals = whole.groupBy(F.lit(_TOTAL).alias("kind"), F.lit(0).alias("id"), F.lit(0).alias("place")).agg(*[F.sum(s).alias(s) for s in names])
        by_term = _packed_sums(whole.unionByName(totals), self.k, self.tasks)
        by_text = self._summed(nothing.union(weights), None).where(F.col("kind") == _TEXT)
        return written(by_term.union(by_text), "topic-sums")

    def next_sums(self, sums: DataFrame) -> DataFrame:
        # k numbers.
        row = sums.where(F.col("kind") == _TOTAL).first()
        totals = np.frombuffer(row.sums, np.int64) if row else np.zeros(self.k, np.int64)
        return written(self._summed(sums, totals), "topic-sums")

    def _summed(self, sums: DataFrame, totals: np.ndarray | None) -> DataFrame:
        """Sums of the shares that follow from the given sums; without totals, of the first shares."""
        k, size = self.k, self.size
        everywhere = F.when(F.col("kind") == _TEXT, F.sequence(F.lit(0), F.lit(self.shards - 1)))
        everywhere = everywhere.otherwise(F.sequence(F.lit(0), F.lit(self.blocks - 1)))
        sent = sums.where(F.col("kind") != _TOTAL).withColumn("other", F.explode(everywhere))
        is_text, nothing = F.col("kind") == _TEXT, F.lit(None).cast("binary")
        sent = sent.select(
            F.when(is_text, F.col("id")).otherwise(F.col("other")).alias("block"),
            F.when(is_text, F.col("other")).otherwise(F.col("id")).alias("shard"),
            "kind",
            "first",
            F.col("sums").alias("a"),
            nothing.alias("b"),
            nothing.alias("c"),
        )
        # Rows come after the sums that they need.
        rows = self.rows.select("block", "shard", F.lit(_TOTAL).alias("kind"), F.lit(0).alias("first"), "texts", "terms", "n")
        dealt = sent.union(rows).repartition(self.tasks, "block", "shard").sortWithinPartitions("block", "shard", "kind", "first")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, given, new = None, {}, None
            for batch in batches:
                for i in range(batch.num_rows):
                    block, shard, kind, first = (batch.column(c)[i].as_py() for c in range(4))
                    if at != (block, shard):
                        if new is not None:
                            yield from _parts_of_cell(at, new, totals is None)
                        at, given, new = (block, shard), {_TEXT: [], _TERM: []}, None
                    a = np.frombuffer(batch.column(4)[i].as_buffer(), np.int64 if kind != _TOTAL else np.int32)
                    if kind != _TOTAL:
                        given[kind].append((first, a.reshape(-1, k)))
                        continue
                    if new is None:
                        known = {x: _whole(given[x], k) for x in given}
                        new = {x: np.zeros_like(known[x]) for x in known}
                    terms = np.frombuffer(batch.column(5)[i].as_buffer(), np.int32)
                    n = np.frombuffer(batch.column(6)[i].as_buffer(), np.int64)
                    found = _shares(known[_TEXT][a], known[_TERM][terms], n, totals, size)
                    for x, places in ((_TEXT, a), (_TERM, terms)):
                        # Added as whole numbers: floating-point sums of bincount are exact below 2**53 only.
                        order = np.argsort(places, kind="stable")
                        starts = np.flatnonzero(np.diff(places[order], prepend=-1))
                        new[x][places[order][starts]] += np.add.reduceat(found[order], starts, axis=0)
            if new is not None:
                yield from _parts_of_cell(at, new, totals is None)

        return _added(dealt.mapInArrow(run, _SUMS), k, self.tasks)

    def weights(self, sums: DataFrame, passes: int) -> DataFrame:
        """(term, share_0, ...) from the sums by term."""
        k, names = self.k, shares(self.k)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    values = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64).reshape(-1, k)
                    first = batch.column(1)[i].as_py()
                    places = np.arange(first, first + len(values), dtype=np.int32)
                    shard = np.full(len(values), batch.column(0)[i].as_py(), dtype=np.int32)
                    columns = [np.ascontiguousarray(values[:, z]) for z in range(k)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (shard, places, *columns)], names=["shard", "place", *names])

        schema = ", ".join(["shard int", "place int", *[f"{s} long" for s in names]])
        rows = sums.where(F.col("kind") == _TERM).select("id", "first", "sums").mapInArrow(run, schema)
        met = self.vocabulary.where("placed") if passes else self.vocabulary
        return met.select("term", "shard", "place").join(rows, ["shard", "place"]).select("term", *names)


def _cells(counts: DataFrame, k: int, seed: int) -> _Cells:
    """The counts (order_id, term, n) in cells."""
    terms = counts.groupBy("term").agg(F.sum("n").alias("total"), F.bool_or(F.col("order_id").isNotNull()).alias("placed"))
    terms = written(terms, "topic-terms")
    size = terms.count()
    shards = max(-(-size // SHARD), 1)
    one = first_shares(terms.select(F.lit(None).alias("order_id"), "term", F.lit(1).alias("n")), k, seed).drop("order_id", "n")
    vocabulary = written(_dealt(terms, "term", shards, "shard", "place").join(one, "term"), "topic-vocabulary")
    placed = counts.where(F.col("order_id").isNotNull())
    ids = written(placed.select("order_id").distinct(), "topic-ids")
    blocks = max(-(-ids.count() // BLOCK), 1)
    texts = written(_dealt(ids, "order_id", blocks, "block", "place"), "topic-texts")
    tasks = max(min(counts.count() // TASK + 1, shards * blocks), 1)
    rows = placed.join(vocabulary.select("term", "shard", F.col("place").alias("in_shard")), "term").join(texts, "order_id")
    rows = rows.select("block", "shard", F.col("place").alias("text"), F.col("in_shard").alias("of_term"), "n")
    rows = rows.repartition(tasks, "block", "shard").sortWithinPartitions("block", "shard")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, shard, text, term, n = (batch.column(c).to_numpy() for c in range(5))
            ends = np.flatnonzero((np.diff(block) != 0) | (np.diff(shard) != 0)) + 1
            for low, high in zip([0, *ends], [*ends, len(block)], strict=True):
                for start in range(low, high, PACKED):
                    part = slice(start, min(start + PACKED, high))
                    values = text[part].astype(np.int32), term[part].astype(np.int32), n[part].astype(np.int64)
                    columns = [pa.array([int(block[start])], pa.int32()), pa.array([int(shard[start])], pa.int32())]
                    columns += [pa.array([v.tobytes()], pa.binary()) for v in values]
                    yield pa.RecordBatch.from_arrays(columns, names=["block", "shard", "texts", "terms", "n"])

    packed = written(rows.mapInArrow(pack, "block int, shard int, texts binary, terms binary, n binary"), "topic-cells")
    return _Cells(packed, vocabulary, texts, k, size, shards, blocks, tasks)


def _shares(by_text: np.ndarray, by_term: np.ndarray, n: np.ndarray, totals: np.ndarray | None, size: int) -> np.ndarray:
    """Shares of occurrences: ``next_shares`` from the sums of each one's text and term; without totals, ``first_shares``."""
    if totals is None:
        return by_term * n[:, None]
    in_topic = (by_term + TERM_PRIOR).astype(float) / (totals + TERM_PRIOR * size).astype(float)
    q = (by_text + TEXT_PRIOR).astype(float) * in_topic
    whole = reduce(add, [q[:, z] for z in range(q.shape[1])])
    return np.floor((n * PARTS).astype(float)[:, None] * (q / whole[:, None])).astype(np.int64)


def _whole(chunks: list[tuple[int, np.ndarray]], k: int) -> np.ndarray:
    out = np.zeros((max((first + len(part) for first, part in chunks), default=0), k), np.int64)
    for first, part in chunks:
        out[first : first + len(part)] = part
    return out


def _sums_batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "id", "first", "sums"])


def _parts_of_cell(at: tuple[int, int], new: dict[int, np.ndarray], texts_only: bool) -> Iterator[pa.RecordBatch]:
    for kind, number in ((_TEXT, at[0]),) if texts_only else ((_TEXT, at[0]), (_TERM, at[1])):
        for first in range(0, len(new[kind]), CHUNK):
            yield _sums_batch([(kind, number, first, new[kind][first : first + CHUNK].tobytes())])
    if not texts_only:
        yield _sums_batch([(_TOTAL, 0, 0, new[_TERM].sum(axis=0).tobytes())])


def _added(parts: DataFrame, k: int, tasks: int) -> DataFrame:
    """Sums of the same kind, number and first place added up."""
    key = ["kind", "id", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                here = tuple(batch.column(c)[i].as_py() for c in range(3))
                values = np.frombuffer(batch.column(3)[i].as_buffer(), np.int64)
                if here == at:
                    held += values
                    continue
                if at is not None:
                    yield _sums_batch([(*at, held.tobytes())])
                at, held = here, values.copy()
        if at is not None:
            yield _sums_batch([(*at, held.tobytes())])

    return parts.repartition(tasks, *key).sortWithinPartitions(*key).mapInArrow(run, _SUMS)


def _packed_sums(rows: DataFrame, k: int, tasks: int) -> DataFrame:
    """(kind, id, place, share_0, ...) packed like sums: every place of a chunk is there, from its first one."""
    chunk = (F.col("place") - F.col("place") % CHUNK).cast("int").alias("first")
    rows = rows.select("kind", "id", chunk, "place", *[F.col(s).cast("long").alias(s) for s in shares(k)])
    rows = rows.repartition(tasks, "kind", "id", "first").sortWithinPartitions("kind", "id", "first", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            values = np.stack([batch.column(4 + z).to_numpy() for z in range(k)], axis=1).astype(np.int64)
            ends = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1 if len(keys) else []
            for low, high in zip([0, *ends], [*ends, len(keys)], strict=True):
                if low == high:
                    continue
                here = tuple(keys[low].tolist())
                if here != at and at is not None:
                    yield _sums_batch([(*at, np.concatenate(held).tobytes())])
                if here != at:
                    at, held = here, []
                held.append(values[low:high])
        if at is not None:
            yield _sums_batch([(*at, np.concatenate(held).tobytes())])

    return rows.mapInArrow(run, _SUMS)
