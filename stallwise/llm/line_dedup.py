"""Fuzzy line dedup: SimHash of normalised lines, joined on pigeonhole blocks, verified by edit similarity.

A line is what stands between line feeds. Normal form: lower case, digits as 0, every run of other characters
than letters and digits as one space, none at the ends; a line whose normal form is empty is never a repeat and
always kept. The SimHash has 64 bits; each word votes by its hash (once per occurrence).

Equal normal forms are one row from the start, however often they occur. Fingerprints that differ in ``RADIUS``
bits or fewer agree in one of ``BLOCKS`` blocks at least, and in one of as many parts of the other blocks' bits. Lines
are dealt by their blocks; a task sorts its lines by block and part, so no such pair is missed and a line is dealt
four times only. Lines are compared with the first line of each block and part first, then with all lines there that
this has not brought into the same group: the groups are the same, without all pairs of a large group. Pairs are
verified by the edit distance of the normal forms: similar if it is at most 1 - ``SIMILARITY`` of the longer one's
length; pairs whose lengths differ by more are no candidates. Groups are connected components; of each group the
occurrence with the smallest (document, line) is kept and the others go.

A line that thousands of documents hold is one row in the joins; where its many occurrences meet their group,
Spark may split the join. The text is read twice: once for the fingerprints, once for the lines in need of
verification only; a table of bits of fixed size keeps nearly all other lines out of the shuffle.

Null texts are documents without lines. Rows with the same id and text are one document; null ids are the
last. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.llm.common import components, dropped, parts_of, saved, table
from stallwise.llm.edits import distances
from stallwise.llm.hashing import mixed, word_hashes

RADIUS = 3
BLOCKS = 4
SIMILARITY = 0.8
#: Characters that are brought into normal form together; lines of over eight times as many are alone.
_TOGETHER = 1 << 18
#: Bits of the table that tells lines in need of verification from nearly all others.
_FILTER = 1 << 26
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_DIGIT = re.compile(r"\d")
_OTHER = re.compile(r"[\W_]+")


def normal(line: str) -> str:
    return _OTHER.sub(" ", _DIGIT.sub("0", line.lower())).strip()


@cache
def _plain() -> np.ndarray:
    """The normal form of each character below 0x10000, line feeds as they are. No character becomes two but ``İ``."""
    codes = (10 if c == 10 else ord(_OTHER.sub(" ", _DIGIT.sub("0", chr(c).lower()))[0]) for c in range(1 << 16))
    return np.fromiter(codes, dtype=np.uint32, count=1 << 16)


def normals(lines: list[str]) -> list[str]:
    """``normal`` of each line."""
    out: list[str] = []
    at = 0
    while at < len(lines):
        stop, size = at, 0
        while stop < len(lines) and size < _TOGETHER:
            size += len(lines[stop]) + 1
            stop += 1
        out += _normals(lines[at:stop]) if size < 8 * _TOGETHER else map(normal, lines[at:stop])
        at = stop
    return out


def _normals(lines: list[str]) -> list[str]:
    text = "\n".join(lines)
    if "İ" in text or "Σ" in text:
        # Their lower case is two characters, or depends on those beside them.
        text = text.lower()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    table = _plain()
    plain = table[np.minimum(codes, len(table) - 1)]
    if len(high := np.flatnonzero(codes >= len(table))):
        found, which = np.unique(codes[high], return_inverse=True)
        plain[high] = np.array([ord(normal(chr(c)) or " ") for c in found.tolist()], dtype=np.uint32)[which]
    held = (plain != 32) & (plain != 10)
    starts = np.flatnonzero(np.diff(held, prepend=False) & held)
    out = [""] * len(lines)
    if not len(starts):
        return out
    line = np.searchsorted(np.flatnonzero(plain == 10), starts)
    first = np.diff(line, prepend=-1) != 0
    # Of what is between two words, the last character stays: as a space, or a line feed between lines.
    before = starts[1:] - 1
    plain[before] = np.where(first[1:], 10, 32)
    held[before] = True
    forms = plain[held].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split("\n")
    for n, form in zip(line[first].tolist(), forms, strict=True):
        out[n] = form
    return out


def _majorities(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of runs of hashes of these sizes, the bits that over half of a run have.

    Votes of 64 bits are counted together: plane p of a count holds the bits of weight 2**p. Counts of a run are
    added in pairs until one is left.
    """
    planes, counts = [hashes], sizes
    while counts.max(initial=0) > 1:
        ends = np.cumsum(counts)
        place = np.arange(len(planes[0])) - np.repeat(ends - counts, counts)
        one = np.flatnonzero(place % 2 == 0)
        paired = one + 1 < np.repeat(ends, counts)[one]
        two, there = one + paired, np.where(paired, _ALL, np.uint64(0))
        carry, added = np.zeros(len(one), dtype=np.uint64), []
        for plane in planes:
            x, y = plane[one], plane[two] & there
            added.append(x ^ y ^ carry)
            carry = (x & y) | ((x ^ y) & carry)
        planes, counts = [*added, carry], (counts + 1) // 2
    half = (sizes // 2).astype(np.uint64)
    more, equal = np.zeros(len(sizes), dtype=np.uint64), np.full(len(sizes), _ALL)
    for weight in range(len(planes) - 1, -1, -1):
        bit = np.where(half >> np.uint64(weight) & np.uint64(1), _ALL, np.uint64(0))
        more |= equal & planes[weight] & ~bit
        equal &= ~(planes[weight] ^ bit)
    return more


def simhashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) of lines in normal form, none of them empty: a hash of the line and its SimHash."""
    data = np.frombuffer("\n".join(lines).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    starts, _, hashes = word_hashes(data)
    line_of_byte = np.flatnonzero(data == 10)
    line = np.searchsorted(line_of_byte, starts)
    first = np.flatnonzero(np.diff(line, prepend=-1))
    sizes = np.diff(np.append(first, len(line)))
    # The line's own hash: its words in order, summed with weights by place.
    place = np.arange(len(line)) - np.repeat(first, sizes)
    keys = np.add.reduceat(mixed(hashes + mixed(place.astype(np.uint64) + np.uint64(1))), first)
    return mixed(keys), _majorities(hashes, sizes)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line, key, fp, size, raw) of every line with a normal form, and the number of lines in
    ``n_lines``; size: characters of the normal form, raw: a hash of the line as it stands.

    Documents without such a line have one row with a null line.
    """
    rows = docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("text_hash"), docs["text"])
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            row, number, total, forms, raw = [], [], [], [], []
            bare, bare_total = [], []
            texts = [None if text is None else text.split("\n") for text in batch.column(2).to_pylist()]
            every = iter(normals([line for lines in texts if lines for line in lines]))
            for i, lines in enumerate(texts):
                lines = lines or []
                found = [(n, form) for n, form in zip(range(len(lines)), every) if form]
                if not found:
                    bare.append(i)
                    bare_total.append(len(lines))
                row += [i] * len(found)
                total += [len(lines)] * len(found)
                number += [n for n, _ in found]
                forms += [form for _, form in found]
                raw += [zlib.crc32(lines[n].encode("utf-8", "surrogatepass")) for n, _ in found]
            keys, fps = simhashes(forms) if forms else (np.empty(0, np.uint64),) * 2
            none = [None] * len(bare)
            take = pa.array(row + bare, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array(total + bare_total, pa.int64()),
                    pa.array(number + none, pa.int64()),
                    pa.array(keys.view(np.int64).tolist() + none, pa.int64()),
                    pa.array(fps.view(np.int64).tolist() + none, pa.int64()),
                    pa.array([len(f) for f in forms] + none, pa.int64()),
                    pa.array(raw + none, pa.int64()),
                ],
                names=["doc_id", "text_hash", "n_lines", "line", "key", "fp", "size", "raw"],
            )

    schema = f"doc_id {kind}, text_hash long, n_lines long, line long, key long, fp long, size long, raw long"
    return rows.mapInArrow(run, schema)


def _dealt(rows: DataFrame) -> DataFrame:
    """(block, key, fp, size, label) of (key, fp, size, label), dealt by block: a row for each of a line's blocks."""
    numbers = F.explode(F.array(*[F.lit(t) for t in range(BLOCKS)])).alias("t")
    rows = rows.select(numbers, "key", "fp", "size", "label")
    block = F.expr("(t << 16) | cast(shiftrightunsigned(fp, 16 * t) & 65535 as int)").alias("block")
    return rows.select(block, "key", "fp", "size", "label").repartition("block")


class _Cells:
    """Lines of whole blocks, sorted by block and part; cells are the lines that agree in both."""

    def __init__(self, batches: Iterator[pa.RecordBatch], radius: int, similarity: float) -> None:
        columns = [[] for _ in range(5)]
        for batch in batches:
            for held, column in zip(columns, batch.columns, strict=True):
                held.append(column.to_numpy())
        block, key, fp, size, label = (np.concatenate(c) if c else np.empty(0, np.int64) for c in columns)
        order = np.lexsort((key, block))
        self.block, self.key, self.size, self.label = block[order], key[order], size[order], label[order]
        self.fp = fp[order].view(np.uint64)
        self.radius, self.similarity = radius, similarity
        # The bits beside the block's own: the fingerprint, turned by the block's place.
        turn = (self.block >> 16).astype(np.uint64) * np.uint64(16)
        self.rest = (self.fp >> turn | self.fp << (np.uint64(64) - turn & np.uint64(63))) >> np.uint64(16)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether lines' fingerprints are near and their lengths allow them to be similar."""
        one, two = self.size[a], self.size[b]
        most = np.floor(np.maximum(one, two) * (1 - self.similarity) + 1e-9)
        unlike = self.key[a] != self.key[b]
        return unlike & (np.bitwise_count(self.fp[a] ^ self.fp[b]) <= self.radius) & (np.abs(one - two) <= most)

    def seen(self, a: np.ndarray, b: np.ndarray, part: int) -> np.ndarray:
        """Whether lines that agree here agree in an earlier block or part, too."""
        unlike, rest = self.fp[a] ^ self.fp[b], self.rest[a] ^ self.rest[b]
        out = np.zeros(len(a), dtype=bool)
        for t in range(BLOCKS - 1):
            out |= (self.block[a] >> 16 > t) & (unlike >> np.uint64(16 * t) & np.uint64(0xFFFF) == 0)
        for p in range(part):
            out |= rest >> np.uint64(12 * p) & np.uint64(0xFFF) == 0
        return out

    def sorted(self, by_label: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(part, lines, start, stop): lines in cells of several, by their keys or labels; each one's cell's bounds."""
        for part in range(4):
            bits = (self.rest >> np.uint64(12 * part) & np.uint64(0xFFF)).astype(np.int64)
            cell = self.block.astype(np.int64) << 12 | bits
            lines = np.lexsort((self.label, cell)) if by_label else np.argsort(cell, kind="stable")
            cell = cell[lines]
            first = np.flatnonzero(np.diff(cell, prepend=-1))
            many = np.diff(np.append(first, len(cell)))
            start, stop = np.repeat(first, many), np.repeat(first + many, many)
            yield part, lines, start, stop


def _first_pairs(dealt: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(a, b): near lines of which a is the first line of a block and part; b null: a is near to another line only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells(batches, radius, similarity)
        marked = np.zeros(len(cells.key), dtype=bool)
        for _, lines, start, stop in cells.sorted(False):
            at = np.flatnonzero(np.arange(len(lines)) > start)
            a, b = lines[start[at]], lines[at]
            near = cells.near(a, b)
            a, b = a[near], b[near]
            marked[a] = marked[b] = True
            yield pa.RecordBatch.from_arrays([pa.array(cells.key[a]), pa.array(cells.key[b])], names=["a", "b"])
            # Which of the others is near to any line of its cell?
            alone, step = np.flatnonzero(~marked[lines] & (stop - start > 1)), 1
            found = []
            while len(alone):
                for way in (step, -step):
                    some = alone[(alone + way >= start[alone]) & (alone + way < stop[alone])]
                    a, b = lines[some], lines[some + way]
                    near = cells.near(a, b)
                    found.append(a[near])
                    marked[a[near]] = True
                step += 1
                alone = alone[~marked[lines[alone]] & ((alone + step < stop[alone]) | (alone - step >= start[alone]))]
            keys = cells.key[np.concatenate(found)] if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.nulls(len(keys), pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _other_pairs(dealt: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(a, b): near lines that have different labels, each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells(batches, radius, similarity)
        for part, lines, start, stop in cells.sorted(True):
            # By label, a line meets what follows the last line of its own label.
            label = cells.label[lines]
            last = np.flatnonzero((np.diff(label, append=0) != 0) | (np.arange(len(lines)) + 1 == stop))
            ahead = last[np.searchsorted(last, np.arange(len(lines)))] + 1
            here = np.flatnonzero(ahead < stop)
            other = ahead[here]
            while len(here):
                a, b = lines[here], lines[other]
                near = cells.near(a, b)
                a, b = a[near], b[near]
                fresh = ~cells.seen(a, b, part)
                a, b = cells.key[a[fresh]], cells.key[b[fresh]]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                other = other + 1
                there = other < stop[here]
                here, other = here[there], other[there]

    return dealt.mapInArrow(run, "a long, b long")


def _bits(wanted: DataFrame) -> np.ndarray:
    """A table of ``_FILTER`` bits, as bytes, with those of the wanted lines' ``raw`` set."""
    place = F.col("raw").bitwiseAND(F.lit(_FILTER - 1))
    one = F.expr(f"shiftleft(1L, cast((raw & {_FILTER - 1}) & 63 as int))")
    rows = wanted.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    found = rows.toArrow()
    out = np.zeros(_FILTER // 64, dtype="<i8")
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def _forms(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, form) of the wanted lines (key, raw)."""
    bits = docs.sparkSession.sparkContext.broadcast(_bits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            lines = [line for text in batch.column(0).cast(pa.binary()).to_pylist() if text for line in text.split(b"\n")]
            places = np.fromiter(map(zlib.crc32, lines), dtype=np.int64, count=len(lines)) & (_FILTER - 1)
            some = np.flatnonzero(bits.value[places >> 3] >> (places & 7) & 1)
            forms = normals([lines[i].decode("utf-8", "surrogatepass") for i in some.tolist()])
            # Copies of a line go once.
            forms = list(dict.fromkeys(form for form in forms if form))
            keys = simhashes(forms)[0].view(np.int64) if forms else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(forms, pa.string())], names=["key", "form"])

    forms = docs.select(docs["text"]).mapInArrow(run, "key long, form string").dropDuplicates(["key"])
    return forms.join(wanted.select("key"), "key", "left_semi")


def line_groups(docs: DataFrame, lines: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """(key, group, kept) of the lines (``lines_of``) that occur twice or have a similar one.

    group: a key; kept: (no_id, doc_id, text_hash, line) of the occurrence that stays.
    """
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "line")
    distinct = lines.where("line IS NOT NULL").groupBy("key").agg(
        F.min("fp").alias("fp"), F.min("size").alias("size"), F.min("raw").alias("raw"), F.count("*").alias("n"), F.min(place).alias("first")
    )
    distinct = saved(distinct, "distinct-lines")
    dealt = _dealt(distinct.select("key", "fp", "size", F.col("key").alias("label")))
    first = saved(_first_pairs(dealt, radius, similarity), "line-pairs")
    near = first.select(F.explode(F.array("a", "b")).alias("key")).where("key IS NOT NULL").distinct()
    near = saved(distinct.select("key", "fp", "size", "raw").join(near, "key", "left_semi"), "near-lines")
    forms = saved(_forms(docs, near), "line-forms")

    def similar(pairs: DataFrame) -> DataFrame:
        both = pairs.join(forms.toDF("a", "x"), "a").join(forms.toDF("b", "y"), "b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                longer = np.array([max(len(one), len(two)) for one, two in zip(x, y, strict=True)], dtype=np.int64)
                most = np.floor(longer * (1 - similarity) + 1e-9).astype(np.int64)
                yield batch.select(["a", "b"]).filter(pa.array(distances(x, y, most.tolist()) >= 0))

        return saved(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "line-links")

    # Most links of a large group of near lines say nothing new: first each line with the first one of its blocks,
    # then only pairs that this hasn't brought together. The groups are those of all links.
    links = similar(first.where("b IS NOT NULL"))
    labels = components(links).toDF("key", "label")
    marked = near.join(labels, "key", "left").select("key", "fp", "size", F.coalesce("label", "key").alias("label"))
    others = saved(_other_pairs(_dealt(marked), radius, similarity), "line-pairs")
    more = similar(others)
    for done in (first, near, forms, others):
        dropped(done)
    found = components(links.union(more))
    linked = distinct.join(found.withColumnRenamed("node", "key"), "key", "left")
    linked = linked.select("key", "n", "first", F.coalesce("component", "key").alias("group"))
    kept = linked.groupBy("group").agg(F.min("first").alias("kept"), F.sum("n").alias("size"))
    return linked.select("key", "group").join(kept.where("size > 1"), "group").select("key", "group", "kept")


def repeated_lines(docs: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, n_lines, removed, kept_in): a row per document.

    removed: numbers of the lines that go, ascending; kept_in: for each, the id of the document that keeps the
    group's line.
    """
    lines = saved(lines_of(docs), "lines")
    groups = saved(line_groups(docs, lines, radius, similarity), "line-groups")
    places = lines.join(groups.select("key", "kept"), "key", "left")
    stays = (
        F.col("doc_id").eqNullSafe(F.col("kept.doc_id"))
        & (F.col("text_hash") == F.col("kept.text_hash"))
        & (F.col("line") == F.col("kept.line"))
    )
    gone = F.when(F.col("kept").isNotNull() & ~stays, F.struct("line", F.col("kept.doc_id").alias("in")))
    # A document's lines are one group: as long as its text.
    out = places.groupBy("doc_id", "text_hash").agg(F.max("n_lines").alias("n_lines"), F.sort_array(F.collect_set(gone)).alias("gone"))
    return out.select(
        "doc_id", "text_hash", "n_lines", F.col("gone.line").alias("removed"), F.col("gone.in").alias("kept_in")
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed", "kept_in"
    )
