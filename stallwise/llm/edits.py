"""Edit distances (Levenshtein, by code points) of many pairs of texts at a time.

Columns of the table of distances are kept as bits: a word holds the differences of 64 rows (Myers, Hyyrö). Pairs of
like length go through it together, in a band as wide as the largest distance that counts. What both texts begin or
end with doesn't change their distance: that is left out, and the same end is added to both to fill the last word.
"""

from __future__ import annotations

import numpy as np

_WORD = 64
#: Words of a column up to which pairs go together, and words of all columns of pairs that go together.
_SHORT = 64
_TOGETHER = 1 << 14
_ONE, _TOP, _ALL = np.uint64(1), np.uint64(63), np.uint64(0xFFFFFFFFFFFFFFFF)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _core(x: str, y: str) -> tuple[np.ndarray, np.ndarray]:
    """The texts without what both begin and end with, the longer first."""
    a, b = (_codes(x), _codes(y)) if len(x) >= len(y) else (_codes(y), _codes(x))
    n = len(b)
    unlike = np.flatnonzero(a[:n] != b)
    head = int(unlike[0]) if len(unlike) else n
    a, b = a[head:], b[head:]
    n = len(b)
    unlike = np.flatnonzero(a[len(a) - n :] != b)
    tail = n - 1 - int(unlike[-1]) if len(unlike) else n
    return a[: len(a) - tail], b[: n - tail]


def _alone(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """The distance of one pair, or a number over ``most``: a column is one whole number."""
    places: dict[int, int] = {}
    for i, code in enumerate(a.tolist()):
        places.setdefault(code, []).append(i)
    full = (1 << len(a)) - 1
    at = {}
    for code, found in places.items():
        bits = np.zeros(len(a), dtype=np.uint8)
        bits[found] = 1
        at[code] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    up, down, last, score = full, 0, 1 << (len(a) - 1), len(a)
    left = len(b)
    for code in b.tolist():
        eq = at.get(code, 0)
        zero = (((eq & up) + up) ^ up) | eq | down
        more, less = down | (full & ~(zero | up)), up & zero
        score += bool(more & last) - bool(less & last)
        left -= 1
        if score - left > most:
            return score
        more, less = (more << 1) | 1, less << 1
        up, down = (less | ~(zero | more)) & full, more & zero & full
    return score


def _together(pairs: list[tuple[np.ndarray, np.ndarray]], words: int, most: int) -> np.ndarray:
    """The distances of pairs whose longer texts fill the same number of words; where over ``most``, a number over it."""
    n, rows = len(pairs), words * _WORD
    long, short = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    fill = rows - long
    columns = short + fill
    width = int(columns.max())
    # Codes are numbered within each pair; 0 is for codes that the longer text lacks, 1 for the added end.
    number = np.repeat(np.arange(n), long)
    coded = (number << 21) | np.concatenate([a for a, _ in pairs])
    known, which = np.unique(coded, return_inverse=True)
    ahead = np.searchsorted(known, np.arange(n + 1) << 21)
    symbols = int(np.diff(ahead).max(initial=0)) + 2
    masks = np.zeros((words, symbols, n), dtype=np.uint64)
    place = np.arange(len(coded)) - np.repeat(np.cumsum(long) - long, long)
    np.bitwise_or.at(masks, (place // _WORD, which - ahead[number] + 2, number), _ONE << (place % _WORD).astype(np.uint64))
    for i in np.flatnonzero(fill).tolist():
        masks[words - 1, 1, i] = _ALL << np.uint64(_WORD - fill[i])
    owner = np.repeat(np.arange(n), short)
    coded = (owner << 21) | np.concatenate([b for _, b in pairs])
    where = np.minimum(np.searchsorted(known, coded), max(len(known) - 1, 0))
    found = np.where(known[where] == coded, where - ahead[owner] + 2, 0) if len(known) else np.zeros(len(coded), np.int64)
    texts = np.ones((width, n), dtype=np.int64)
    texts[np.arange(len(coded)) - np.repeat(np.cumsum(short) - short, short), owner] = found
    # The texts' rows and columns of the masks, by pair.
    pair = np.arange(n)
    up = np.full((words, n), _ALL, dtype=np.uint64)
    down = np.zeros((words, n), dtype=np.uint64)
    high = min(words - 1, most // _WORD)
    bottom = np.full(n, (high + 1) * _WORD, dtype=np.int64)
    out = np.full(n, most + 1, dtype=np.int64)
    # Where a pair stands among those that can still be near enough; -1: nowhere.
    alive = np.arange(n)
    ends = np.argsort(columns, kind="stable")
    ended = columns[ends]
    for column in range(width):
        if high < words - 1 and (column + most) // _WORD > high:
            high += 1
            bottom += _WORD
        low = max(0, column - most) // _WORD
        eqs = masks[low : high + 1, texts[column], pair]
        # What comes in from above: one more than in the column before.
        more_in, less_in = np.full(len(pair), _ONE), np.zeros(len(pair), dtype=np.uint64)
        for w in range(low, high + 1):
            eq, above, below = eqs[w - low], up[w], down[w]
            with_less = eq | less_in
            zero = (((with_less & above) + above) ^ above) | with_less | below
            more, less = below | ~(zero | above), above & zero
            more_out, less_out = more >> _TOP, less >> _TOP
            more, less = (more << _ONE) | more_in, (less << _ONE) | less_in
            up[w], down[w] = less | ~(zero | more), more & zero
            more_in, less_in = more_out, less_out
        bottom += more_in.astype(np.int64) - less_in.astype(np.int64)
        if high == words - 1:
            a, b = np.searchsorted(ended, [column + 1, column + 2])
            here = ends[a:b]
            here = here[alive[here] >= 0]
            out[here] = bottom[alive[here]]
        if column % _WORD == _WORD - 1:
            # The least distance of the column bounds the last one from below; between two words' ends, the distances
            # fall by a step a row at most.
            upper, least = bottom, bottom
            for w in range(high, low - 1, -1):
                lower = upper
                upper = lower - np.bitwise_count(up[w]).astype(np.int64) + np.bitwise_count(down[w])
                least = np.minimum(least, (lower + upper - _WORD) // 2)
            stays = least <= most
            if 4 * np.count_nonzero(stays) < 3 * len(stays):
                if not stays.any():
                    break
                alive[alive >= 0] = np.where(stays, np.cumsum(stays) - 1, -1)
                masks, texts, up, down, bottom = (x[..., stays] for x in (masks, texts, up, down, bottom))
                pair = np.arange(len(bottom))
    return out


def distances(x: list[str], y: list[str], most: list[int]) -> np.ndarray:
    """The edit distance of each pair of texts, or -1 if it is over the pair's ``most``."""
    out = np.full(len(x), -1, dtype=np.int64)
    groups: dict[int, list] = {}
    for i, (one, two, limit) in enumerate(zip(x, y, most, strict=True)):
        if abs(len(one) - len(two)) > limit:
            continue
        a, b = _core(one, two)
        limit = min(limit, len(a))  # no distance is longer
        if not len(b):
            out[i] = len(a)
        else:
            groups.setdefault(-(-len(a) // _WORD), []).append((limit, i, a, b))
    for words, found in groups.items():
        # Most similar pairs are nearer than they must be: a narrow band first, the whole one for the others.
        found = _measured(words, [(limit // 4, limit, i, a, b) for limit, i, a, b in found], out)
        _measured(words, [(limit, limit, i, a, b) for _, limit, i, a, b in found], out)
    return out


def _measured(words: int, found: list[tuple], out: np.ndarray) -> list[tuple]:
    """Put the distances up to each pair's limit (its first item) into ``out``; the pairs over it."""
    found.sort(key=lambda f: f[0])
    size, rest = max(1, _TOGETHER // words), []
    for at in range(0, len(found), size):
        some = found[at : at + size]
        if words > _SHORT or len(some) < 5 * words + 20:
            got = [_alone(a, b, limit) for limit, _, _, a, b in some]
        else:
            got = _together([(a, b) for *_, a, b in some], words, some[-1][0])
        for pair, distance in zip(some, got, strict=True):
            if distance <= pair[0]:
                out[pair[2]] = distance
            else:
                rest.append(pair)
    return rest
