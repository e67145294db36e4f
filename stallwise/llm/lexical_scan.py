"""Ranked lexical search without a document index: the texts are scanned with an automaton of all query terms.

Terms are maximal runs of ASCII letters and digits and of anything beyond ASCII; only A-Z is lowered. Every term of
the items, between two blanks, goes into an Aho-Corasick automaton; in the texts each separator becomes a blank. So
the blanks guard the term's boundaries, the automaton runs over the bytes of a text once, and what it puts out are
the numbers of the terms, counted to tf. A second table maps each term to the items that hold it.

Two steps: the scan writes, for each document, the number of its terms and its counts of query terms; their sums are
the corpus statistics (N, L, df), over all documents. The scoring step reads the counts, maps them to items, and keeps
the best of each item within a task before the final ranking.

The automaton is broadcast, so the items are taken in blocks of at most ``BLOCK_CHARS`` characters of text (an item is
never split; a longer one is a block of its own); each block is one more scan. Items are small against the documents.

Nulls and empty texts have no term: such documents aren't counted and no item finds them; such items find nothing.
Equal scores are ranked by doc_id, null last. A repeated document is ranked as often as it occurs; each row of the
items is an item, so a repeated one has its rows repeated. Empty tables give an empty result; further columns of
either table are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stallwise.llm.common import parts_of, saved, table

TOP = 20
#: Characters of item texts whose terms make one automaton.
BLOCK_CHARS = 2_000_000
#: Additions of weights to scores, and scores, that a task holds at a time.
ADDITIONS = 1 << 21
#: What a byte is in the scan: itself, the small letter, or a blank.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Fixed values of the score: weights are thousandths, a term's share saturates with K1 = 1.2 and B = 0.25.
SCALE, TF_SCALE, K1_TENTHS, LENGTH_PERCENT = 1000, 1_000_000_000, 12, 25


def folded(text: bytes | None) -> bytes:
    return b" " + (text or b"").translate(_FOLDED) + b" "


def term_count(data: bytes) -> int:
    """Terms of a folded text."""
    blank = np.frombuffer(data, dtype=np.uint8) == 32
    return int(np.count_nonzero(blank[:-1] & ~blank[1:]))


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Bytes are handed over as characters below 256."""
    out = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        out.add_word(f" {term.decode('latin-1')} ", number)
    if terms:
        out.make_automaton()
    return out


def counts_of(machine: ahocorasick.Automaton, data: bytes) -> Counter:
    """Occurrences of the machine's terms in a folded text, by number."""
    return Counter(map(itemgetter(1), machine.iter(data.decode("latin-1")))) if len(machine) else Counter()


def scanned(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document: its number of terms, and the query terms it holds."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(known.value)
        for batch in parts_of(batches):
            n, found = [], []
            for text in batch.column(1):
                data = folded(text.as_py())
                n.append(term_count(data))
                found.append(counts_of(machine, data))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array([list(c) for c in found], pa.list_(pa.int32())),
                    pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Best:
    """The highest scores of each item among the rows seen: by score, then doc_id (null last)."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, dtype=np.int64)
        # item, score, no_id, doc_id
        self.rows = np.zeros((4, 0), dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        new = np.array([item, scores[doc, item], no_id[doc], ids[doc]])
        rows = np.concatenate([self.rows, new], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        starts = np.flatnonzero(np.diff(rows[0], prepend=-1))
        sizes = np.diff(starts, append=rows.shape[1])
        place = np.arange(rows.shape[1]) - np.repeat(starts, sizes)
        full = sizes >= self.top
        self.least[rows[0][starts[full]]] = rows[1][starts[full] + self.top - 1]
        self.rows = rows[:, place < self.top]


def _scores(
    n: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], stats: dict, postings: dict, at: int, to: int
) -> np.ndarray:
    """Scores of the documents at..to for every item."""
    held = np.array([len(t) for t in terms[at:to]])
    doc = np.repeat(np.arange(to - at), held)
    term, tf = np.concatenate(terms[at:to]), np.concatenate(tfs[at:to])
    length = 100 - LENGTH_PERCENT + LENGTH_PERCENT * n[at:to] * stats["n"] // stats["all"]
    share = TF_SCALE * tf // (SCALE * tf + K1_TENTHS * length[doc])
    value = stats["weights"][term] * share
    spread = postings["ends"][term] - postings["starts"][term]
    place = np.arange(spread.sum()) - np.repeat(np.cumsum(spread) - spread, spread)
    place += np.repeat(postings["starts"][term], spread)
    out = np.zeros((to - at) * postings["size"], dtype=np.int64)
    cell = np.repeat(doc, spread) * postings["size"] + postings["items"][place]
    np.add.at(out, cell, np.repeat(value, spread) * postings["times"][place])
    return out.reshape(to - at, postings["size"])


def scored(counts: DataFrame, stats: dict, postings: dict, top: int) -> DataFrame:
    """(item, score, no_id, doc_id): the best of each item (by number) within each task."""
    shared = counts.sparkSession.sparkContext.broadcast((stats, postings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats, postings = shared.value
        best = Best(postings["size"], top)
        spread = postings["ends"] - postings["starts"]
        for batch in parts_of(batches, 4096):
            no_id = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy()
            terms = [np.asarray(x.values) for x in batch.column(2)]
            tfs = [np.asarray(x.values) for x in batch.column(3)]
            work = np.cumsum([max(int(spread[t].sum()), postings["size"]) for t in terms])
            at = 0
            while at < len(terms):
                done = work[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(work, done + ADDITIONS)))
                best.add(_scores(n, terms, tfs, stats, postings, at, to), ids[at:to], no_id[at:to])
                at = to
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best.rows], names=["item", "score", "no_id", "doc_id"])

    return counts.where(F.size("terms") > 0).mapInArrow(run, "item long, score long, no_id long, doc_id long")


def _block(docs: DataFrame, items: list, top: int) -> DataFrame | None:
    """Ranks for the items (id, text) of one block."""
    spark = docs.sparkSession
    held = [Counter(folded(text).split()) for _, text in items]
    terms = sorted(set().union(*held))
    if not terms:
        return None
    counts = saved(scanned(docs, terms), "term-counts")
    size = counts.where("n > 0").agg(F.count("*").alias("n"), F.sum("n").alias("all")).first()
    # One row for each term of the block.
    found = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    weights = np.zeros(len(terms), dtype=np.int64)
    for row in found:
        weights[row.term] = math.floor(SCALE * math.log((2 * size.n + 2) / (2 * row.df + 1)))
    number = {term: i for i, term in enumerate(terms)}
    lists = sorted((number[t], i, times) for i, c in enumerate(held) for t, times in c.items())
    term, item, times = np.array(lists, dtype=np.int64).T
    postings = {
        "size": len(items),
        "items": item,
        "times": times,
        "starts": np.searchsorted(term, np.arange(len(terms))),
        "ends": np.searchsorted(term, np.arange(len(terms)), side="right"),
    }
    best = scored(counts, {"n": size.n, "all": size.all, "weights": weights}, postings, top)
    order = W.partitionBy("item").orderBy(F.desc("score"), "no_id", "doc_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, id_) for i, (id_, _) in enumerate(items)], "item long, item_id long")
    doc_id = F.when(F.col("no_id") == 0, F.col("doc_id")).alias("doc_id")
    return ranked.join(names, "item").select("item_id", "rank", doc_id, "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0."""
    rows = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("binary").alias("text"))
    rows = rows.where("length(text) > 0")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    out = []
    for number, blocks in _blocks(rows, total, block_chars):
        block = rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == number)
        found = _block(docs, [tuple(r) for r in block.collect()], top)
        if found is not None:
            out.append(found)
    if not out:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, out)


def _blocks(rows: DataFrame, total: int, block_chars: int) -> list[tuple[int, int]]:
    """(number, blocks) of each block of items by text hash, with so many that none with several texts is too large."""
    blocks = 1 if total <= block_chars else 2 * -(-total // block_chars)
    while blocks > 1:
        number = F.pmod(F.xxhash64("text"), F.lit(blocks))
        sizes = rows.groupBy(number.alias("number")).agg(
            F.sum(F.length("text")).alias("n"), F.countDistinct("text").alias("texts")
        )
        if not sizes.where((F.col("n") > block_chars) & (F.col("texts") > 1)).limit(1).count():
            break
        blocks *= 2
    return [(i, blocks) for i in range(blocks)]


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
lengths AS (SELECT doc_id, len(terms) AS n FROM split WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM split) GROUP BY ALL),
wanted AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, corpus GROUP BY term, docs),
scores AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), corpus
  GROUP BY ALL),
ranks AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 20
"""
