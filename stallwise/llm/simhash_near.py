"""SimHash near-duplicates through a segment-popcount embedding.

Fingerprint: ASCII letters lowered, words, shingles of words with repeats (fewer words than a shingle: the
whole sequence; none: fingerprint zero); a bit is 1 if over half the shingles' XXH64 values (seed 42) have it.

Near: a 64-bit fingerprint maps to the bit counts of its 32 two-bit segments. Two fingerprints that differ in
r bits have embeddings at a Manhattan distance of r at most. The segments are dealt to r // 2 + 1 parts (2 at
least), so in one part at least that distance is 1 or 0. Every fingerprint has a home cell per part (its counts there) and
probes that cell and those with one count raised by one; of any two within distance 1, one finds the other.
What meets in a cell is verified by the exact number of differing bits, within the join itself.

Only distinct fingerprints are joined, so copies in any number are one row; groups are connected components.

Null and blank texts have fingerprint zero and link like any other. Null ids get their group's id, too; a group
with null ids only has a null one. Repeated rows stay repeated. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.llm.common import components, fresh, saved, table

SHINGLE = 3
RADIUS = 3
SEGMENTS = 32
#: Shingles hashed at a time: bounds the memory that a very long text takes.
_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text as an unsigned 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    digest, n = xxhash.xxh64_intdigest, len(words) - shingle + 1
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _AT_ONCE):
        parts = [words[at + k : min(at + _AT_ONCE, n) + k] for k in range(shingle)]
        hashes = np.array([digest(b" ".join(s), 42) for s in zip(*parts)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every row of docs (doc_id, text); fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            fp = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fp)], names=["doc_id", "text_hash", "fp"]
            )

    rows = docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("text_hash"), docs["text"])
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def _counts(fp: Column, start: int, end: int) -> Column:
    """Bit counts of the two-bit segments from start to end, 16 at most, two bits each."""
    bits = F.shiftrightunsigned(fp, 2 * start).bitwiseAND(F.lit((1 << 2 * (end - start)) - 1))
    even = F.lit(0x55555555)
    return bits.bitwiseAND(even) + F.shiftrightunsigned(bits, 1).bitwiseAND(even)


def _cells(radius: int) -> list[tuple[Column, list[Column]]]:
    """Per part: the home cell of column fp, and the cells it probes (null where a count can't be raised)."""
    parts = max(2, radius // 2 + 1)
    bounds = [SEGMENTS * p // parts for p in range(parts + 1)]
    out = []
    for p, (start, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
        counts = _counts(F.col("fp"), start, end)
        raised = [
            F.when(F.shiftrightunsigned(counts, 2 * i).bitwiseAND(F.lit(3)) < 2, counts + F.lit(1 << 2 * i))
            for i in range(end - start)
        ]
        out.append((counts, [counts, *raised]))
    return out


def near_pairs(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) of all pairs of the distinct fingerprints (fp) that differ in 1 to radius bits, some repeated."""
    cells = _cells(radius)
    home = F.array(*[F.struct(F.lit(p).alias("part"), home.alias("cell")) for p, (home, _) in enumerate(cells)])
    probes = F.array(
        *[F.struct(F.lit(p).alias("part"), c.alias("cell")) for p, (_, all_) in enumerate(cells) for c in all_]
    )
    homes = distinct.select("fp", F.explode(home).alias("c")).select("c.*", F.col("fp").alias("a"))
    tries = distinct.select("fp", F.explode(probes).alias("c")).where("c.cell IS NOT NULL")
    tries = tries.select("c.*", F.col("fp").alias("b"))
    both = homes.alias("x").join(
        tries.alias("y"),
        (F.col("x.part") == F.col("y.part"))
        & (F.col("x.cell") == F.col("y.cell"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
        & (F.col("a") != F.col("b")),
    )
    return both.select("a", "b")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row: the group's smallest doc_id.

    root marks the group; component_id is its smallest doc_id.
    """
    fps = saved(fingerprints(docs, shingle), "fingerprints")
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(near_pairs(fps.select("fp").distinct(), radius))
    linked = found.join(firsts, found.node == firsts.fp).select("node", "component", "first")
    lowest = linked.groupBy("component").agg(F.min("first").alias("lowest"))
    linked = linked.join(lowest, "component").select(F.col("node").alias("fp"), "component", "lowest")
    groups = firsts.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("component", "fp").alias("root"),
        F.coalesce("lowest", "first").alias("component_id"),
    )
    # Written, so that this join has plain shuffles below, which Spark may split at a hot fingerprint.
    return fps.join(saved(groups, "near-groups"), "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """docs with one row of each near-duplicate group: the smallest doc_id (ties: the smallest text hash; equal
    rows: any one of them). A group with null ids only keeps a row, too."""
    groups = near_groups(docs, shingle, radius)
    kept = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("k"))
    # The same columns, none of them null, for the join and for equal rows: the texts are shuffled once.
    names = fresh(docs, "kept_none", "kept_id", "kept_hash")

    def keys(doc_id: Column, text_hash: Column) -> dict[str, Column]:
        return dict(zip(names, (doc_id.isNull(), F.coalesce(doc_id.cast("string"), F.lit("")), text_hash), strict=True))

    kept = kept.select(*[c.alias(n) for n, c in keys(F.col("k.doc_id"), F.col("k.text_hash")).items()]).distinct()
    marked = docs.withColumns(keys(docs["doc_id"], F.xxhash64(docs["text"])))
    return marked.join(kept, names, "left_semi").dropDuplicates(names).drop(*names)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
