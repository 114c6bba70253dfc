"""The texts of a batch as flat arrays: bytes, offsets, character classes, tokens and their hashes.

Nothing here knows Spark. Tasks call these helpers on slices of an Arrow batch, so memory follows the
slice and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from unicodedata import category

import numpy as np
import pyarrow as pa
import regex
from tokenizers.pre_tokenizers import ByteLevel

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
SLICE_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and where each begins (one offset more than texts). NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``limit`` bytes together; a longer text comes alone."""
    if batch.num_rows == 0:
        return
    _, offsets = flat(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point, as the ``tokenizers`` library has it.

    ``regex`` and Python may know another Unicode version than that library; where the two
    disagree about a character the library is asked.
    """
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    at = np.array(points)
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, text):
            table[at[found.start() : found.end()]] = kind
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    major = {"L": LETTER, "N": NUMBER}
    for c in points:
        if table[c] < OTHER and major.get(category(chr(c))[0]) != table[c]:
            one = [kind for kind, before in ((LETTER, "a"), (NUMBER, "1")) if len(split(before + chr(c))) == 1]
            table[c] = one[0] if one else OTHER
    return table


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8, and the byte each begins at."""
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    points = raw[at].astype(np.int32)
    lead = raw[at]
    for low, high, mask, more in ((0xC0, 0xDF, 0x1F, 1), (0xE0, 0xEF, 0x0F, 2), (0xF0, 0xFF, 0x07, 3)):
        which = np.flatnonzero((lead >= low) & (lead <= high))
        if len(which):
            value = points[which] & mask
            for k in range(1, more + 1):
                value = (value << 6) | (raw[at[which] + k] & 0x3F)
            points[which] = value
    return points, at


def classes(raw: np.ndarray) -> np.ndarray:
    """Class of every byte: that of its character."""
    table = class_table()
    out = table[:256][raw]
    wide = np.flatnonzero(raw >= 0xC0)
    if len(wide):
        lead = raw[wide]
        for low, high, mask, more in ((0xC0, 0xDF, 0x1F, 1), (0xE0, 0xEF, 0x0F, 2), (0xF0, 0xFF, 0x07, 3)):
            at = wide[(lead >= low) & (lead <= high)]
            value = (raw[at] & mask).astype(np.int32)
            for k in range(1, more + 1):
                value = (value << 6) | (raw[at + k] & 0x3F)
            kind = table[value]
            for k in range(more + 1):
                out[at + k] = kind
    return out


def _spread(values: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A random-looking number for each value at its place. A sum of them has no algebra that texts could be built against, unlike powers of a base."""
    return mix(values.astype(np.uint64) + place.astype(np.uint64) * np.uint64(0x1000003D1) + np.uint64(1))


def token_hashes(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each token; tokens lie on end and none is empty."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    total = np.add.reduceat(_spread(raw, np.arange(len(raw)) - np.repeat(starts, lengths)), starts)
    return mix(total ^ (lengths.astype(np.uint64) << np.uint64(40)))


def equal_ranges(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray, at_once: int = 1 << 22) -> np.ndarray:
    """Whether the bytes ``a[a_starts[i] …]`` and ``b[b_starts[i] …]`` are the same over ``lengths[i]``; about ``at_once`` bytes, or one range, at a time."""
    out = np.ones(len(lengths), bool)
    some = np.flatnonzero(lengths)
    ends = np.cumsum(lengths[some])
    begin = 0
    while begin < len(some):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + at_once, side="right")))
        part = some[begin:end]
        size = lengths[part]
        differ = a[ragged_index(a_starts[part], size)] != b[ragged_index(b_starts[part], size)]
        out[part] = ~np.logical_or.reduceat(differ, bounds(size)[:-1])
        begin = end
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * _MULTIPLIER
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ragged_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all ranges ``starts[i] … starts[i] + lengths[i]``, on end."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def bounds(lengths: np.ndarray) -> np.ndarray:
    """Offsets, one more than lengths."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every run of bytes other than space and U+0009 to U+000D."""
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    inside = ~blank
    first = inside.copy()
    first[1:] &= blank[:-1]
    edge = offsets[:-1][offsets[:-1] < len(raw)]
    first[edge] |= inside[edge]
    last = inside.copy()
    last[:-1] &= blank[1:]
    edge = offsets[1:][offsets[1:] > 0] - 1
    last[edge] |= inside[edge]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    return starts, lengths, np.searchsorted(offsets, starts, side="right") - 1


def spread_hashes(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Like :func:`token_hashes` for tokens with gaps between them."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    at = ragged_index(starts, lengths)
    place = at - np.repeat(starts, lengths)
    total = np.add.reduceat(_spread(raw[at], place), bounds(lengths)[:-1])
    return mix(total ^ (lengths.astype(np.uint64) << np.uint64(40)))


_grown: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """At least ``n`` powers of ``base`` modulo 2 ** 64; each worker keeps one table per base, as long as it ever needed."""
    table = _grown.get(base)
    if table is None or len(table) < n:
        table = np.full(max(1, -(-n // (1 << 20))) << 20, base, np.uint64)
        table[0] = 1
        _grown[base] = table = np.multiply.accumulate(table)
    return table


def powers(n: int) -> np.ndarray:
    """Powers of a fixed base, ``n`` at least."""
    return _powers_of(_BASE, n)


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Sums of value times power of the base, up to each position, modulo 2 ** 64."""
    power = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[: len(values)], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the values of each range, wherever it stands."""
    inverse = _powers_of(pow(_BASE, -1, 1 << 64), len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
