"""Token-ID output: documents as Simple-8b words, in blocks that decode on their own.

Coding: 64-bit words, four bits of selector and sixty of data. A selector says how many ids a word holds and how
wide they are, from sixty of one bit to one of sixty; each word takes as many as fit. Values of over sixty bits
are escaped: selector 0 holds the value's place in the block's list of escapes.

File format: Parquet with a row per block. A block is whole documents, about 64 thousand ids:

| column | holds |
|:--|:--|
| shard, block | place: shards by ascending document id, blocks in writing order |
| first | ids of the shard before the block |
| n_ids | ids of the block |
| words, escapes | little-endian unsigned 64-bit integers |
| doc_ids | ids of the documents |
| offsets | where each document begins in the block, and last the block's end |

Rows are dealt by ranges of the document id, so a shard is one task's range whatever the source of its rows;
only the shards' totals (one row per partition) are summed up in one place.

Encoding: byte-level BPE splits texts before it merges, always before a space that a non-space follows. So texts
are cut there, and of some million characters at a time each distinct piece goes through the tokenizer once, or not
at all if the worker still has its ids from before: it keeps those of a bounded number of pieces, the frequent ones.
Tokenizers of any other kind encode whole texts. The strings of added tokens, such as ``<|endoftext|>``, are read as
these tokens, as the library does; with ``special_as_text`` those of special tokens are ordinary text, so a document
can't hold an end of its own.

Null texts count as empty and hold the end id only. Repeated rows and ids stay, by text; null ids come first. An
empty table gives no blocks.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stallwise.llm.common import saved, table

END_ID = 0
BLOCK_IDS = 1 << 16
#: Ids in a word and bits of each, by selector; selector 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = (60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
#: Characters of a text cut at a time, and characters encoded together.
_STRETCH = 1 << 20
TOGETHER = 1 << 23
#: Words, and what follows them, whose ids a Python worker keeps, and bytes of one.
KEPT_WORDS, KEPT_TAILS, KEPT_BYTES = 1 << 18, 1 << 15, 64
#: What having met a piece counts, as against the next time.
FADE = 0.98
#: Where a Python worker keeps its tokenizer between tasks.
_KEPT = "stallwise_worker_tokenizer"
_CUT = re.compile(r" (?=\S)")
_GLUED = re.compile(r" (?!\S)")
#: A word of Latin letters and what follows it: the tokenizer splits there, too.
_TAIL = r"(?s)^(?P<word>[A-Za-zÀ-ÖØ-öø-ɏ]+)(?P<tail>[!-@\[-`{-~].*)$"


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of unsigned 64-bit values."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    choice = np.full(n, 14, dtype=np.uint8)
    # A run that fits a narrower width fits the wider ones: each width that fits lowers the selector by one.
    for selector in range(13, 0, -1):
        count = int(COUNTS[selector])
        if count > n:
            break
        fits, run = values < np.uint64(1 << BITS[selector]), 1
        while run < count:
            step = min(run, count - run)
            fits = fits[:-step] & fits[step:]
            run += step
        if not fits.any():
            break
        choice[: len(fits)] -= fits
    choice[values >> np.uint64(60) != 0] = 0
    starts = _steps(COUNTS[choice])
    chosen = choice[starts]
    words = np.zeros(len(starts), dtype=np.uint64)
    for selector in range(1, 15):
        where = np.flatnonzero(chosen == selector)
        if len(where):
            first, held = starts[where], np.full(len(where), selector << 60, dtype=np.uint64)
            for k in range(int(COUNTS[selector])):
                held |= values[first + k] << np.uint64(k * BITS[selector])
            words[where] = held
    escaped = np.flatnonzero(chosen == 0)
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    return words, values[starts[escaped]]


def _steps(sizes: np.ndarray) -> np.ndarray:
    """The places 0, 0 + sizes[0] and so on, each as far behind the one before as that one's size."""
    n = len(sizes)
    # Where one, two, four ... steps lead; the last place leads to itself.
    leaps = [np.append(np.minimum(np.arange(n) + sizes, n), n)]
    for _ in range(5):
        leaps.append(leaps[-1][leaps[-1]])
    far, starts, at = memoryview(leaps.pop()), [], 0
    while at < n:
        starts.append(at)
        at = far[at]
    starts = np.array(starts, dtype=np.int64)
    for leap in reversed(leaps):
        starts = np.stack([starts, leap[starts]], axis=1).ravel()
    return starts[starts < n]


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The values that ``pack`` was given."""
    chosen = (words >> np.uint64(60)).astype(np.uint8)
    counts = COUNTS[chosen]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    starts = ends - counts
    for selector in range(1, 15):
        where = np.flatnonzero(chosen == selector)
        if len(where):
            first, held, bits = starts[where], words[where], BITS[selector]
            for k in range(int(COUNTS[selector])):
                out[first + k] = (held >> np.uint64(k * bits)) & np.uint64((1 << bits) - 1)
    where = np.flatnonzero(chosen == 0)
    out[starts[where]] = escapes[words[where].astype(np.int64)]
    return out


def _gathered(ids: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of ids that lie end to end, those with the given numbers, end to end, and their lengths."""
    many = lengths[numbers]
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    starts = (np.cumsum(lengths) - lengths)[numbers]
    places = np.repeat(starts - ends + many, many)
    places += np.arange(total)
    return ids[places], many


class Known:
    """Ids of ``most`` pieces that texts had most often and lately, of ``KEPT_BYTES`` at most each: these don't go
    through the tokenizer again and again."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.pieces, self.met = pa.array([], pa.string()), np.empty(0, np.float32)
        self.ids, self.lengths = np.empty(0, np.uint32), np.empty(0, np.int64)

    def of(
        self, pieces: pa.Array, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, end to end, and the number of each one's; ``encode`` gives them for new pieces."""
        at, count = pc.index_in(pieces, value_set=self.pieces), len(self.pieces)
        added = pieces.filter(pc.is_null(at))
        ids, lengths = encode(added.to_numpy(zero_copy_only=False).tolist())
        ids, lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        numbers = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        numbers[numbers < 0] = count + np.arange(len(added))
        met = np.append(self.met * np.float32(FADE), np.zeros(len(added), np.float32))
        met[numbers] += 1
        short = pc.less_equal(pc.binary_length(added), KEPT_BYTES).to_numpy(zero_copy_only=False)
        kept = np.append(np.arange(count), count + np.flatnonzero(short))
        if len(kept) > self.most:
            over = len(kept) - self.most
            kept = np.sort(kept[np.argpartition(met[kept], over)[over:]])
        self.pieces, self.met = pa.concat_arrays([self.pieces, added]).take(pa.array(kept)), met[kept]
        self.ids, self.lengths = _gathered(ids, lengths, kept)
        return _gathered(ids, lengths, numbers)


@dataclass(frozen=True)
class Definition:
    """A tokenizer as tasks get it: its JSON, whether texts may be cut into pieces, the ids that begin with a space,
    and the ids of added tokens that texts are cut around."""

    json: str
    by_pieces: bool
    spaced: np.ndarray
    special_as_text: bool
    added: dict[str, int]


def defined(tokenizer: str, special_as_text: bool = False) -> Definition:
    spec = json.loads(tokenizer)
    before = spec.get("pre_tokenizer") or {}
    by_pieces = (
        before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not spec.get("normalizer")
        and not any(
            re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]
        )
    )
    vocabulary = spec["model"].get("vocab") if by_pieces else {}
    spaced = np.zeros(max([0, *vocabulary.values(), *(t["id"] for t in spec["added_tokens"])]) + 1, dtype=bool)
    spaced[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
    added = {t["content"]: t["id"] for t in spec["added_tokens"] if not (special_as_text and t["special"])}
    return Definition(tokenizer, by_pieces, spaced, special_as_text, added)


class Encoder:
    """Ids of whole texts, as the tokenizer gives them when it adds no special tokens."""

    def __init__(self, definition: Definition) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition.json)
        self.tokenizer.encode_special_tokens = definition.special_as_text
        self.known = Known(KEPT_WORDS), Known(KEPT_TAILS)
        self._take(definition)

    def _take(self, definition: Definition) -> None:
        self.by_pieces, self.spaced, self.added = definition.by_pieces, definition.spaced, definition.added
        longest_first = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if longest_first else None

    @classmethod
    def of_worker(cls, definition: Definition) -> Encoder:
        """One tokenizer, and what it gave last, for all tasks that a Python worker runs: reading its vocabulary takes
        time and memory."""
        kept = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT))
        key = zlib.crc32(definition.json.encode()), len(definition.json), definition.special_as_text
        if getattr(kept, "key", None) != key:
            made = cls(definition)
            kept.key, kept.tokenizer, kept.known = key, made.tokenizer, made.known
        out = cls.__new__(cls)
        out.tokenizer, out.known = kept.tokenizer, kept.known
        out._take(definition)
        return out

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, each after a space, end to end, and the number of each one's."""
        cut = pc.extract_regex(pieces, _TAIL)
        words = pc.coalesce(pc.struct_field(cut, "word"), pieces).dictionary_encode()
        tails = pc.fill_null(pc.struct_field(cut, "tail"), "").dictionary_encode()
        ids, lengths = self.known[0].of(words.dictionary, self._joined)
        more, counts = self.known[1].of(tails.dictionary, self._of_tails)
        both = np.stack([words.indices.to_numpy(), tails.indices.to_numpy() + len(lengths)], axis=1).ravel()
        found, sizes = _gathered(np.concatenate([ids, more]), np.concatenate([lengths, counts]), both)
        return found, sizes[::2] + sizes[1::2]

    def _of_tails(self, tails: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A tail is clear of the word before it: behind a word of one id, its ids are all but the first."""
        ids, counts = self._joined([f"a{t}" for t in tails])
        return np.delete(ids, np.cumsum(counts) - counts), counts - 1

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_of_pieces``, without cutting.

        Many go through the tokenizer together: in pieces without another space, a token with a space is the first.
        """
        ids, lengths = [], []
        for at in range(0, len(pieces), 1 << 12):
            some = pieces[at : at + (1 << 12)]
            joined = " ".join(some)
            got = self._plain(f" {joined}")
            starts = np.flatnonzero(self.spaced[got])
            if joined.count(" ") == len(some) - 1 == len(starts) - 1:
                ids.append(got)
                lengths.append(np.diff(np.append(starts, len(got))))
            else:
                each = [self._plain(f" {p}") for p in some]
                ids += each
                lengths.append(np.array([len(x) for x in each]))
        return (np.concatenate(ids), np.concatenate(lengths)) if ids else (np.empty(0, np.uint32), np.empty(0, np.int64))

    def _cut(self, text: str) -> tuple[str, list[str]]:
        """The beginning of the text up to the first cut, and its other pieces, without their spaces."""
        head, at, out = None, 0, []
        while at <= len(text):
            end = _CUT.search(text, at + _STRETCH) if len(text) - at > _STRETCH else None
            stretch = text[at : end.start()] if end else text[at:]
            at = end.end() if end else len(text) + 1
            parts = _CUT.split(stretch) if _GLUED.search(stretch) else stretch.split(" ")
            if head is None:
                head = parts.pop(0)
            out += parts
        return head, out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_pieces:
            return [self._plain(t) for t in texts]
        if self.marks is None or not any(map(self.marks.search, texts)):
            return self._by_pieces(texts)
        # An added token ends what stands before it as a text's end does.
        cut = [self.marks.split(t) for t in texts]
        between = iter(self._by_pieces([part for parts in cut for part in parts[::2]]))
        out = []
        for parts in cut:
            ids = [next(between)]
            for token in parts[1::2]:
                ids += [np.array([self.added[token]], dtype=np.uint32), next(between)]
            out.append(np.concatenate(ids) if len(ids) > 1 else ids[0])
        return out

    def _by_pieces(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without added tokens."""
        # Texts whose every space is a cut are split together, the others one by one.
        glued = [bool(_GLUED.search(t)) for t in texts]
        split = pc.split_pattern(pa.array([None if g else t for t, g in zip(texts, glued, strict=True)], pa.string()), " ")
        ends = split.offsets.to_numpy()
        heads = [split.values[a].as_py() if b > a else "" for a, b in zip(ends, ends[1:], strict=False)]
        counts = np.maximum(np.diff(ends) - 1, 0)
        inner = np.ones(len(split.values), dtype=bool)
        inner[ends[:-1][np.diff(ends) > 0]] = False
        parts = [split.values.filter(pa.array(inner))]
        odd = []
        for i, text in enumerate(texts):
            if glued[i]:
                heads[i], pieces = self._cut(text)
                odd.append((i, len(pieces)))
                parts.append(pa.array(pieces, pa.string()))
        coded = pa.concat_arrays(parts).dictionary_encode()
        # Ids of all pieces in order: those of the texts split together, then those of the others.
        found, many = _gathered(*self._of_pieces(coded.dictionary), coded.indices.to_numpy())
        order = np.concatenate([np.flatnonzero(~np.array(glued)), [i for i, _ in odd]]).astype(np.int64)
        sizes = np.concatenate([counts[~np.array(glued)], [n for _, n in odd]]).astype(np.int64)
        bounds = np.cumsum(np.append(0, many))[np.cumsum(np.append(0, sizes))]
        out: list = [None] * len(texts)
        for i, a, b in zip(order.tolist(), bounds, bounds[1:], strict=False):
            out[i] = np.concatenate([self._plain(heads[i]), found[a:b]]) if heads[i] else found[a:b]
        return out


def _together(texts: Iterator, most: int) -> Iterator[list]:
    """(id, text) pairs in lists of about so many characters."""
    held, chars = [], 0
    for pair in texts:
        held.append(pair)
        chars += len(pair[1])
        if chars >= most:
            yield held
            held, chars = [], 0
    if held:
        yield held


def blocks_of(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None = END_ID,
    block_ids: int = BLOCK_IDS,
    special_as_text: bool = False,
    together: int = TOGETHER,
) -> DataFrame:
    """Blocks of docs (doc_id, text); tokenizer: its JSON; end_id: appended to each document (None: nothing is);
    special_as_text: the strings of special tokens are spelled out; together: characters whose distinct pieces are
    encoded once (fewer: less memory of a task, more work; the ids are the same)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    types = (
        f"shard int, block int, first long, n_ids long, words binary, escapes binary, "
        f"doc_ids array<{kind}>, offsets array<long>"
    )
    definition = defined(tokenizer, special_as_text)
    end = np.array([] if end_id is None else [end_id], dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder.of_worker(definition), TaskContext.get().partitionId()
        block = first = 0
        names: list = []
        held: list[np.ndarray] = []
        size, id_type = 0, None

        def block_row() -> pa.RecordBatch:
            ids = np.concatenate(held)
            words, escapes = pack(ids)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in held])])
            row = {
                "shard": pa.array([shard], pa.int32()),
                "block": pa.array([block], pa.int32()),
                "first": pa.array([first], pa.int64()),
                "n_ids": pa.array([len(ids)], pa.int64()),
                "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
                "escapes": pa.array([escapes.astype("<u8").tobytes()], pa.binary()),
                "doc_ids": pa.array([names], pa.list_(id_type)),
                "offsets": pa.array([offsets], pa.list_(pa.int64())),
            }
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            id_type = batch.column(0).type
            pairs = ((i.as_py(), t.as_py() or "") for i, t in zip(batch.column(0), batch.column(1), strict=True))
            for some in _together(pairs, together):
                pa.default_memory_pool().release_unused()
                for (doc_id, _), ids in zip(some, encoder.encode([t for _, t in some]), strict=True):
                    names.append(doc_id)
                    held.append(np.concatenate([ids, end]))
                    size += len(held[-1])
                    if size >= block_ids:
                        yield block_row()
                        block, first = block + 1, first + size
                        names, held, size = [], [], 0
        if held:
            yield block_row()

    rows = docs.select("doc_id", "text").repartitionByRange(F.asc_nulls_first("doc_id"))
    return rows.sortWithinPartitions(F.asc_nulls_first("doc_id"), "text").mapInArrow(run, types)


def _read(blocks: DataFrame, kind: str, each) -> DataFrame:
    """(shard, doc_id, before, n_tokens, each's value) of each document of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                shard, first, words, escapes, doc_ids, offsets = (batch.column(c)[at] for c in range(6))
                ids = unpack(np.frombuffer(words.as_py(), "<u8"), np.frombuffer(escapes.as_py(), "<u8"))
                ends = np.array(offsets.as_py(), dtype=np.int64)
                values = [each(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.as_py()] * len(values), pa.int32()),
                        doc_ids.values,
                        pa.array(first.as_py() + ends[:-1]),
                        pa.array(np.diff(ends)),
                        pa.array(values, pa.int64() if kind == "long" else pa.list_(pa.int64())),
                    ],
                    names=["shard", "doc_id", "before", "n_tokens", "value"],
                )

    doc_id = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    rows = blocks.select("shard", "first", "words", "escapes", "doc_ids", "offsets")
    read = rows.mapInArrow(run, f"shard int, doc_id {doc_id}, before long, n_tokens long, value {kind}")
    shards = blocks.groupBy("shard").agg(F.max(F.col("first") + F.col("n_ids")).alias("total"))
    # One row per partition of the writing job.
    ahead = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead"))
    start = (F.col("ahead") + F.col("before")).alias("start")
    return read.join(shards, "shard").select("doc_id", start, "n_tokens", "value")


def documents_of(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document; start counts the ids of all documents before it."""
    return _read(blocks, "array<long>", lambda ids: ids.astype(np.int64)).withColumnRenamed("value", "ids")


def digests_of(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document: CRC-32 of its ids as little-endian 32-bit integers."""
    digests = _read(blocks, "long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
    return digests.withColumnRenamed("value", "ids_crc32")


def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's definition; executors get the text, not the path."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def token_digests(docs: DataFrame) -> DataFrame:
    """The documents written as token blocks to the shared folder, and what the files hold of each."""
    return digests_of(saved(blocks_of(docs, tokenizer_json()), "tokens"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
