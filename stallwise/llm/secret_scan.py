"""Secret scan with a recursive decoding worklist.

Three kinds of secrets are searched in a text: assignments, access keys and hex strings (``KINDS``). Then the
text's layers are: URL escapes undone, Unicode escapes undone, and every base64 run decoded, decompressed as
often as it was compressed. A layer that is text goes to the worklist, is searched, and is unwrapped in turn,
until nothing new comes up. A layer already seen at the same place of the text isn't unwrapped again, so cycles
end. Every character of a layer knows the span of the original text it comes from (base64: the characters that
hold its bytes; compressed data: the whole run), so a secret in any layer is reported by original code points.

A compressed run that grows beyond ``LARGEST`` bytes is not unpacked further: the run itself is reported as kind
``packed``, so nothing goes unnoticed and memory stays bounded.

Null texts count as empty. Null ids, repeated rows and extra columns change nothing; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stallwise.llm.common import table

#: Fixed patterns: kind, expression, group that is measured and its least length. ASCII letters only.
KINDS = {
    "assign": (
        re.compile(
            r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        8,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    # Runs of 32 and more: the leftmost longest matches of [0-9a-f]+ that are long enough.
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
#: What a text without any of these, in lower case, can't match.
_ASSIGNED = ("password", "passwd", "secret", "token", "api_key", "apikey")
#: One layer's bytes at most.
LARGEST = 64 << 20
PACKED = "packed"
ORDER = {kind: i for i, kind in enumerate([*KINDS, PACKED])}

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|(?:%u[0-9A-Fa-f]{4})+|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})|&#(\d{1,7});"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|\\U([0-9A-Fa-f]{8})"
)
#: Ten bytes at least: the shortest packed form of a secret (32 equal hex digits); plain ones have 14 or more.
LEAST_RUN = 14
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{14,}")
#: A run over line breaks: what stands at a line's end, whole lines, and what stands at a line's start.
#: It begins at a run's first character and never gives one back, so each character is looked at once.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*+\r?\n[\x20\t>]*+[A-Za-z0-9+/_-]++)++")
_CHARACTERS = re.compile(r"[A-Za-z0-9+/_-]+")
#: Printable UTF-8 among other bytes.
_PRINTED = re.compile(
    rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){10,}"
)
#: Printable UTF-16 of either byte order, code points up to 255.
_WIDE = re.compile(rb"(?:[\t\n\r\x20-\x7e\xa0-\xff]\x00){9,}[\t\n\r\x20-\x7e\xa0-\xff]")
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
_URL_SAFE = str.maketrans("-_", "+/")

Span = tuple[str, int, int]


@dataclass
class Layer:
    """A decoded text and the original span of each of its characters (None: its own places)."""

    text: str
    start: np.ndarray | None = None
    end: np.ndarray | None = None

    def spans(self, a: int, b: int) -> tuple[int, int]:
        if self.start is None:
            return a, b
        return int(self.start[a:b].min()), int(self.end[a:b].max())

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        if self.start is None:
            at = np.arange(len(self.text))
            return at, at + 1
        return self.start, self.end


def found(text: str) -> list[Span]:
    """Secrets that stand in the text itself, kind after kind."""
    out = []
    for kind, (expression, group, least) in KINDS.items():
        if kind == "assign":
            lowered = text.lower()
            if not any(w in lowered for w in _ASSIGNED):
                continue
        out += [(kind, *m.span()) for m in expression.finditer(text) if m.end(group) - m.start(group) >= least]
    return out


def _replaced(layer: Layer, expression: re.Pattern, decode) -> Layer | None:
    """The layer with every match decoded; None if that changes nothing."""
    start, end = None, None
    texts, starts, ends, at = [], [], [], 0
    for m in expression.finditer(layer.text):
        new = decode(m)
        if new is None or new == m[0]:
            continue
        if start is None:
            start, end = layer.places()
        a, b = layer.spans(*m.span())
        texts += [layer.text[at : m.start()], new]
        starts += [start[at : m.start()], np.full(len(new), a)]
        ends += [end[at : m.start()], np.full(len(new), b)]
        at = m.end()
    if start is None:
        return None
    texts.append(layer.text[at:])
    return Layer("".join(texts), np.concatenate([*starts, start[at:]]), np.concatenate([*ends, end[at:]]))


def _url(m: re.Match) -> str | None:
    data = bytes.fromhex(m[0].replace("%", ""))
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _unicode(m: re.Match) -> str | None:
    number = m[1] or m[2] or m[4] or m[5]
    if m[3] is not None or number is not None:
        code = int(m[3]) if m[3] is not None else int(number, 16)
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    units = bytes.fromhex(m[0].replace("\\u", "").replace("%u", ""))
    try:
        return units.decode("utf-16-be")
    except UnicodeDecodeError:
        return None


class _TooLarge(Exception):
    pass


def _member(data: bytes, most: int) -> tuple[bytes, bytes, bool] | None:
    """The first member of compressed data unpacked, what follows it, and whether there is more than ``most`` bytes of
    it; None if the data isn't compressed."""
    if data[:2] == b"\x1f\x8b" or (data[:1] == b"\x78" and data[1:2] in b"\x01\x5e\x9c\xda"):
        reader = zlib.decompressobj(wbits=47)
        out = reader.decompress(data, most)
        return out, reader.unused_data, bool(reader.unconsumed_tail)
    if data[:3] == b"BZh":
        reader = bz2.BZ2Decompressor()
    elif data[:6] == b"\xfd7zXZ\x00":
        reader = lzma.LZMADecompressor(memlimit=LARGEST)
    elif data[:4] == b"\x28\xb5\x2f\xfd":
        reader = zstandard.ZstdDecompressor(max_window_size=LARGEST)
        with reader.stream_reader(data, read_across_frames=False) as stream:
            out = stream.read(most)
            # At a frame's end the next read would begin the following one.
            more = len(out) == most and bool(stream.read(1))
        if more:
            return out, b"", True
        # The reader doesn't say where the frame ends.
        frame = zstandard.ZstdDecompressor(max_window_size=LARGEST).decompressobj()
        frame.decompress(data)
        return out, frame.unused_data, False
    else:
        return None
    out = reader.decompress(data, most)
    return out, reader.unused_data if reader.eof else b"", not reader.eof and not reader.needs_input


_BROKEN = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)


def _unpacked(data: bytes) -> bytes | None:
    """Data decompressed once, all its members; None if it isn't compressed. What follows the last one is left."""
    out, size = [], 0
    while True:
        try:
            # One byte at least: zero would mean no limit.
            found_ = _member(data, max(LARGEST - size, 1))
        except _BROKEN:
            found_ = None
        if found_ is None:
            return b"".join(out) if out else None
        new, data, more = found_
        out.append(new)
        size += len(new)
        if more or size > LARGEST:
            raise _TooLarge
        data = data.lstrip(b"\0")


def _text_of(data: bytes) -> str | None:
    """Data as text; None unless it is UTF-8 and printable."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    printable = sum(c.isprintable() or c in "\t\n\r" for c in text)
    return text if text and printable >= 0.95 * len(text) else None


def _strings(data: bytes) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Printable stretches of the data, with the bytes at which each character begins and ends."""
    for m in _PRINTED.finditer(data):
        text = m[0].decode("utf-8")
        sizes = np.array([len(c.encode("utf-8")) for c in text])
        stop = np.cumsum(sizes) + m.start()
        yield text, stop - sizes, stop
    for m in _WIDE.finditer(data) if b"\0" in data else ():
        begin = np.arange(m.start(), m.end(), 2)
        yield m[0][::2].decode("latin-1"), begin, begin + 1


def _innermost(data: bytes) -> tuple[bytes, bool]:
    """Data decompressed as often as it was compressed, and whether it was."""
    packed = False
    while (inner := _unpacked(data)) is not None:
        data, packed = inner, True
    return data, packed


def _from_base64(layer: Layer, places: np.ndarray) -> tuple[list[Layer], list[tuple[int, int]]]:
    """The texts that the base64 characters at the given places of the layer hold, and the spans that are too large.

    A run that isn't one text may hold some: between other bytes, as when a word, path or name stands before or
    after it. Every phase of the characters is searched for printable stretches and for compressed data.
    """
    start, end = layer.places()
    start, end = start[places], end[places]
    characters = "".join(map(layer.text.__getitem__, places)) if len(places) != places[-1] + 1 - places[0] else (
        layer.text[places[0] : places[-1] + 1]
    )
    characters = characters.translate(_URL_SAFE)

    def plain(text: str, shift: int, begin: np.ndarray, stop: np.ndarray) -> Layer:
        first = shift + begin * 8 // 6
        last = shift + (stop * 8 + 5) // 6 - 1
        return Layer(text, start[first], end[last])

    def packed_text(text: str, first: int) -> Layer:
        return Layer(text, np.full(len(text), start[first:].min()), np.full(len(text), end[first:].max()))

    phases = []
    for shift in range(min(4, len(characters))):
        run = characters[shift:]
        run = run[: len(run) - (len(run) % 4 == 1)]
        try:
            data = base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        phases.append((shift, data))
        try:
            inner, packed = _innermost(data)
        except _TooLarge:
            return [], [(int(start[shift:].min()), int(end[shift:].max()))]
        text = _text_of(inner)
        if text is not None:
            if packed:
                return [packed_text(text, shift)], []
            sizes = np.array([len(c.encode("utf-8")) for c in text])
            stop = np.cumsum(sizes)
            return [plain(text, shift, stop - sizes, stop)], []
    out, large = [], []
    for shift, data in phases:
        out += [plain(string, shift, begin, stop) for string, begin, stop in _strings(data)]
        at = 0
        while m := _MAGIC.search(data, at):
            at = m.start() + 1
            first = shift + m.start() * 8 // 6
            try:
                inner, packed = _innermost(data[m.start() :])
            except _TooLarge:
                large.append((int(start[first:].min()), int(end[first:].max())))
                break
            if packed:
                text = _text_of(inner)
                texts = [text] if text is not None else [x[0] for x in _strings(inner)]
                out += [packed_text(t, first) for t in texts]
    return out, large


def _runs(text: str) -> Iterator[np.ndarray]:
    """Places of the characters of every run of base64 characters: on a line, and over line breaks."""
    for m in _BASE64.finditer(text):
        yield np.arange(*m.span())
    for m in _WRAPPED.finditer(text) if "\n" in text else ():
        places = np.concatenate([np.arange(*x.span()) for x in _CHARACTERS.finditer(text, *m.span())])
        if len(places) >= LEAST_RUN:
            yield places


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Secrets of the text itself, and all secrets with those of every layer, by place in the text."""
    base = found(text)
    spans, work, seen = set(base), [Layer(text)], set()
    while work:
        layer = work.pop()
        inner = []
        if "%" in layer.text:
            inner.append(_replaced(layer, _URL, _url))
        if "\\" in layer.text or "&#" in layer.text or "%u" in layer.text:
            inner.append(_replaced(layer, _UNICODE, _unicode))
        for places in _runs(layer.text):
            decoded, large = _from_base64(layer, places)
            inner += decoded
            spans |= {(PACKED, *span) for span in large}
        for new in inner:
            if new is None or not new.text:
                continue
            mark = hashlib.blake2b(new.text.encode("utf-8", "surrogatepass"), digest_size=16)
            mark.update(np.ascontiguousarray(new.start).tobytes())
            if mark.digest() not in seen:
                seen.add(mark.digest())
                spans |= {(kind, *new.spans(a, b)) for kind, a, b in found(new.text)}
                work.append(new)
    place = lambda s: (s[1], ORDER[s[0]], s[2])
    return sorted(base, key=place), sorted(spans, key=place)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def scanned(text: Column) -> Column:
    """Struct of the base counts, the base list's SHA-256 and the list of all spans."""

    @pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                base, spans = scan(t or "")
                kinds = [kind for kind, _, _ in base]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((*[kinds.count(k) for k in KINDS], digest, listed(spans)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run(text)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", scanned(F.col("text")).alias("s")).select("doc_id", "s.*")
