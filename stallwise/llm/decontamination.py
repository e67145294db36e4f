"""Benchmark decontamination by the q-gram lemma: where documents hold benchmark items, give or take some edits.

Both sides are compared in lower case with every run of white space as one space. An item of m characters occurs
if a passage of the document is within k = floor(``EDITS`` * m) edits of it. Of the item's m - q + 1 q-grams at
least t = m - q + 1 - k * q then stand unchanged in the passage, on diagonals (place in the document minus place
in the item) that lie at most k apart.

1. The documents' q-grams are looked up among the items', by a bitmap and then exactly.
2. Hits are counted in bands of 2 (k + 1) diagonals, each overlapping the next by half, so that any k + 1 diagonals
   lie in one band. Bands with fewer than t hits can't hold an occurrence.
3. The others are verified by aligning the whole item within the band (any start and end in the document).

Items are the query set: their text is broadcast in blocks of at most ``BLOCK_CHARS`` characters, each block in
one pass over the documents; nothing of the documents is shuffled. A block is as many passes as the benchmark
needs, so a larger benchmark takes more passes, not more memory. For short items k is lowered until t is at least
one. Items with fewer than ``LEAST`` characters are no evidence of anything and are left out.

Null and blank texts hold nothing. Repeated items and documents each give their rows. Null ids are kept. Empty
tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stallwise.llm.common import fresh, table

Q = 8
EDITS = 0.1
LEAST = 24
BLOCK_CHARS = 4_000_000
#: Bits of a q-gram hash that the bitmap uses, and characters of documents looked up at a time.
_MAP_BITS = 24
_AT_ONCE = 1 << 20
#: Candidates aligned together.
_ALIGNED = 256
_BASE = 0x9E3779B97F4A7C15


def _lower_table() -> np.ndarray:
    """Lower case of each character of the basic plane that has one of a single character."""
    out = np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        low = chr(i).lower()
        if len(low) == 1:
            out[i] = ord(low)
    return out


def normal(text: str, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the text in normal form, and the place of each in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    basic = codes < len(lower)
    codes = np.where(basic, lower[np.where(basic, codes, 0)], codes)
    white = (codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 0xA0)
    kept = np.flatnonzero(~(white & np.concatenate([[False], white[:-1]]))) if len(codes) else np.empty(0, np.int64)
    return np.where(white, np.uint32(32), codes)[kept], kept


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of each run of q code points."""
    if len(codes) < q:
        return np.empty(0, dtype=np.uint64)
    if q == 1:
        return codes.astype(np.uint64) + np.uint64(1)
    first, second = q - q // 2, q // 2
    half = gram_hashes(codes, first)
    n, shift = len(codes) - q + 1, np.uint64(pow(_BASE, second, 1 << 64))
    rest = half if first == second else gram_hashes(codes, second)
    return half[:n] * shift + rest[first : first + n]


@dataclass
class Items:
    """Items of a block and an index of their q-grams."""

    ids: list
    texts: list[np.ndarray]
    edits: np.ndarray
    least: np.ndarray
    keys: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bitmap: np.ndarray
    lower: np.ndarray


def indexed(items: list[tuple], q: int = Q, edits: float = EDITS, least: int = LEAST) -> Items:
    """Index of (item_id, text) pairs."""
    lower = _lower_table()
    ids, texts, k_of, t_of, keys, item, place = [], [], [], [], [], [], []
    for item_id, text in items:
        codes, _ = normal(text or "", lower)
        m = len(codes)
        if m < max(least, q):
            continue
        k = min(int(edits * m), (m - q) // q)
        ids.append(item_id)
        texts.append(codes)
        k_of.append(k)
        t_of.append(m - q + 1 - k * q)
        hashes = gram_hashes(codes, q)
        keys.append(hashes)
        item.append(np.full(len(hashes), len(ids) - 1))
        place.append(np.arange(len(hashes)))
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.empty(0, kind)
    keys, item, place = join(keys, np.uint64), join(item, np.int64), join(place, np.int64)
    order = np.argsort(keys, kind="stable")
    bitmap = np.zeros(1 << _MAP_BITS, dtype=bool)
    bitmap[_slot(keys)] = True
    return Items(ids, texts, np.array(k_of, np.int64), np.array(t_of, np.int64), keys[order], item[order], place[order], bitmap, lower)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _MAP_BITS)


Candidate = tuple[np.ndarray, np.ndarray, int, int]


def aligned(candidates: list[Candidate]) -> list[tuple[int, int, int] | None]:
    """(start, end, edits) of each candidate's best occurrence with all diagonals in its band; None: too many edits.

    A candidate is (item, text, lowest diagonal, edits at most); its band has 2 (edits + 1) diagonals. All are
    aligned together, a character of the items at a time. Ties: the earliest end, then the latest start.
    """
    out = []
    for at in range(0, len(candidates), _ALIGNED):
        out += _aligned(candidates[at : at + _ALIGNED])
    return out


def _aligned(candidates: list[Candidate]) -> list[tuple[int, int, int] | None]:
    low = np.array([c[2] for c in candidates])[:, None]
    most = np.array([c[3] for c in candidates])
    widths, lengths = 2 * (most + 1), np.array([len(c[0]) for c in candidates])
    ends = np.array([len(c[1]) for c in candidates])[:, None]
    width, longest = int(widths.max()), int(lengths.max())
    items = np.full((len(candidates), longest), -1, dtype=np.int64)
    texts = np.full((len(candidates), width + longest), -2, dtype=np.int64)
    for n, (item, text, first, _) in enumerate(candidates):
        items[n, : len(item)] = item
        a, b = max(first, 0), min(first + width + longest, len(text))
        if a < b:
            texts[n, a - first : b - first] = text[a:b]
    place = low + np.arange(width + longest + 1)
    # Whether a character of the text is there, and whether the text reaches as far.
    there, reached = (place >= 0) & (place < ends), (place >= 0) & (place <= ends)
    steps = np.arange(width)
    banded = steps < widths[:, None]
    # A cell is edits * span + (place among the starts, later first), so the smaller cell is the better one.
    span = np.int64(width + 1)
    far = (longest + width + 1) * span
    cost = np.where(reached[:, :width] & banded, width - 1 - steps, far)
    for i in range(longest):
        same = texts[:, i : i + width] == items[:, i : i + 1]
        new = np.where(there[:, i : i + width], cost + np.where(same, 0, span), far)
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + span)
        new = np.minimum.accumulate(new - steps * span, axis=1) + steps * span
        new = np.where(reached[:, i + 1 : i + 1 + width] & banded, new, far)
        cost = np.where((lengths > i)[:, None], new, cost)
    best = (cost // span).argmin(axis=1)
    cell = cost[np.arange(len(candidates)), best]
    edits = cell // span
    starts = low[:, 0] + width - 1 - cell % span
    stops = low[:, 0] + best + lengths
    return [
        (int(a), int(b), int(e)) if e <= k else None for a, b, e, k in zip(starts, stops, edits, most, strict=True)
    ]


def occurrences(texts: list[str | None], items: Items, q: int = Q) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of the items in the texts; places are code points of the text."""
    out = []
    held, size = [], 0
    for i, text in enumerate(texts):
        if text and len(text) >= q:
            held.append(i)
            size += len(text)
        if held and (size >= _AT_ONCE or i == len(texts) - 1):
            out += _occurrences(held, [texts[i] for i in held], items, q)
            held, size = [], 0
    if held:
        out += _occurrences(held, [texts[i] for i in held], items, q)
    return out


def _occurrences(numbers: list[int], texts: list[str], items: Items, q: int) -> list[tuple]:
    forms = [normal(t, items.lower) for t in texts]
    lengths = np.array([len(codes) for codes, _ in forms])
    starts = np.cumsum(lengths) - lengths
    codes = np.concatenate([c for c, _ in forms])
    if len(codes) < q or not len(items.keys):
        return []
    hashes = gram_hashes(codes, q)
    hits = np.flatnonzero(items.bitmap[_slot(hashes)])
    left = np.searchsorted(items.keys, hashes[hits], side="left")
    many = np.searchsorted(items.keys, hashes[hits], side="right") - left
    hits, left, many = hits[many > 0], left[many > 0], many[many > 0]
    if not len(hits):
        return []
    # Each hit with each place of its q-gram in the items.
    ends = np.cumsum(many)
    posting = np.repeat(left - ends + many, many) + np.arange(ends[-1])
    place = np.repeat(hits, many)
    item = items.item[posting]
    diagonal = place - items.place[posting]
    # Hits of two documents can't share a band: the document counts, and q-grams across two of them are no hits.
    document = np.searchsorted(starts, place, side="right") - 1
    whole = place + q <= starts[document] + lengths[document]
    item, diagonal, document = item[whole], diagonal[whole], document[whole]
    step = items.edits[item] + 1
    offset = np.int64(1 << 20)
    band = (diagonal - starts[document]) // step + offset
    key = np.concatenate([band, band - 1])
    item, document = np.tile(item, 2), np.tile(document, 2)
    order = np.lexsort((key, item, document))
    key, item, document = key[order], item[order], document[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0) | (np.diff(item) != 0) | (np.diff(document) != 0)]))
    counts = np.diff(np.append(new, len(key)))
    kept = new[counts >= items.least[item[new]]]
    places = list(zip(document[kept].tolist(), item[kept].tolist(), (key[kept] - offset).tolist(), strict=True))
    bands = [(items.texts[i], forms[d][0], b * (int(items.edits[i]) + 1), int(items.edits[i])) for d, i, b in places]
    found: dict[tuple[int, int], dict[tuple[int, int], int]] = {}
    for (d, i, _), got in zip(places, aligned(bands), strict=True):
        if got:
            start, end, edits = got
            spans = found.setdefault((d, i), {})
            spans[(start, end)] = min(edits, spans.get((start, end), edits))
    out = []
    for (d, i), spans in found.items():
        # Of overlapping occurrences of an item, the one with the fewest edits.
        taken: list[tuple[int, int]] = []
        for (start, end), edits in sorted(spans.items(), key=lambda x: (x[1], x[0])):
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                at = forms[d][1]
                out.append((numbers[d], i, int(at[start]), int(at[end - 1]) + 1, edits))
    return sorted(out)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The items in lists of at most BLOCK_CHARS characters, or one item."""
    held, chars = [], 0
    # Read a partition at a time; the driver holds one block.
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        if held and chars + len(row.text) > BLOCK_CHARS:
            yield held
            held, chars = [], 0
        held.append((row.item_id, row.text))
        chars += len(row.text)
    if held:
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, edits): a row per occurrence of an item (item_id, text) in a document."""
    rows = docs.select(docs["doc_id"], docs["text"])
    doc_type = rows.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, item_id {item_type}, start long, end long, edits long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark):
        out = out.union(rows.mapInArrow(_search(docs.sparkSession, block), schema))
    return out


def _search(spark: SparkSession, block: list[tuple]):
    held = spark.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = indexed(held.value)
        id_type = pa.array([i for i, _ in held.value]).type
        for batch in batches:
            found = occurrences(batch.column(1).to_pylist(), items)
            doc, item, start, end, edits = zip(*found, strict=True) if found else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc, pa.int64())),
                    pa.array([items.ids[i] for i in item], id_type),
                    *(pa.array(x, pa.int64()) for x in (start, end, edits)),
                ],
                names=["doc_id", "item_id", "start", "end", "edits"],
            )

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold an item."""
    for block in _blocks(benchmark):
        (mark,) = fresh(docs, "clean")
        docs = docs.withColumn(mark, _clean(docs.sparkSession, block)(docs["text"])).where(F.col(mark)).drop(mark)
    return docs


def _clean(spark: SparkSession, block: list[tuple]):
    held = spark.sparkContext.broadcast(block)

    @pandas_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = indexed(held.value)
        for texts in batches:
            out = np.ones(len(texts), dtype=bool)
            out[[f[0] for f in occurrences(texts.tolist(), items)]] = False
            yield pd.Series(out)

    return run


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
