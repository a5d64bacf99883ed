"""Vectorised 64-bit hashes of words and bytes over Arrow string batches.

Words are `[^\\x20\\x09-\\x0D]+`. A word's hash is a polynomial over a random byte
table modulo 2**64 with a final mix, so it depends on the word alone.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 18
_rng = np.random.Generator(np.random.PCG64(20240117))
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE[[9, 10, 11, 12, 13, 32]] = 0
_LOWERED = _TABLE.copy()
_LOWERED[65:91] = _TABLE[97:123]
_PLAIN = _TABLE.copy()
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 0
#: Code points of scripts that set no blanks between words (fixed values): Thai and Lao, Tibetan, Myanmar, Khmer, kana, Han.
UNSPACED = [(0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3347F)]
#: Kinds of characters: between words, of words, of words that are cut into pairs, of none (they join what is around them).
BETWEEN, WORD, PAIRED, NONE = range(4)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, SEGMENT + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def _cuts(data: np.ndarray, offsets: np.ndarray):
    """Segments of about SEGMENT bytes that end at a row's end or after white space."""
    a, n = 0, len(data)
    if n <= SEGMENT:
        if n:
            yield 0, n
        return
    is_end = np.zeros(n + 1, bool)
    is_end[1:] = _TABLE[data] == 0
    is_end[offsets] = True
    ends = np.flatnonzero(is_end)
    while a < n:
        i = np.searchsorted(ends, a + SEGMENT, "right") - 1
        b = int(ends[i]) if ends[i] > a else int(ends[i + 1])  # one word longer than a segment
        yield a, b
        a = b


@cache
def _kinds() -> np.ndarray:
    """The kind of each code point, by its Unicode category."""
    by_category = {"L": WORD, "M": WORD, "N": WORD}
    kinds = np.array([NONE if (c := unicodedata.category(chr(i))) == "Cf" else by_category.get(c[0], BETWEEN) for i in range(0x110000)], np.uint8)
    for a, b in UNSPACED:
        part = kinds[a : b + 1]
        part[part == WORD] = PAIRED
    return kinds


def spaced(text: str) -> str:
    """The text with one form for equivalent characters, a blank for every character between words, and the words of unspaced scripts as pairs of neighbours."""
    points = np.frombuffer(unicodedata.normalize("NFKC", text).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[points]
    points, kinds = points[kinds != NONE], kinds[kinds != NONE]
    if not len(points):
        return ""
    paired = kinds == PAIRED
    before, after = np.concatenate(([False], paired[:-1])), np.concatenate((paired[1:], [False]))
    following = np.concatenate((points[1:], [32])).astype(np.uint32)
    # three places a character: itself, its neighbour, a blank; the last of several stands only in the pair before
    out = np.zeros((len(points), 4), np.uint32)
    out[:, 1] = np.where(kinds == BETWEEN, 32, points)
    out[paired & ~before, 0] = 32
    out[paired & after, 2] = following[paired & after]
    out[paired, 3] = 32
    out[paired & before & ~after] = 0
    return out[out != 0].tobytes().decode("utf-32-le", "surrogatepass")


def plain_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row, and their number.

    Words are runs of letters, digits and marks by their Unicode category; in scripts that
    set no blanks, each pair of neighbouring characters is one. Format characters (soft
    hyphens, joiners) don't count. Text of ASCII alone, which has none of this, is hashed as it is.
    """
    data, offsets = text_bytes(column)
    foreign = np.concatenate(([0], np.cumsum(data >= 128)))
    if foreign[-1]:
        raw = data.tobytes()
        rows = [raw[a:b] if foreign[a] == foreign[b] else spaced(raw[a:b].decode("utf-8", "replace")).encode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        data, offsets = np.frombuffer(b"".join(rows), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
    return word_hashes(data, offsets, table=_PLAIN)


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in order, and the number of words of each row; A-Z count as a-z unless `table` says else."""
    table, out = (_LOWERED if table is None else table), []
    counts = np.zeros(len(offsets) - 1, np.int64)
    for a, b in _cuts(data, offsets):
        value = table[data[a:b]]
        solid = value != 0
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        lo, hi = np.searchsorted(offsets, a, "left"), np.searchsorted(offsets, b, "left")
        rows = offsets[lo:hi] - a
        first[rows] = solid[rows]
        starts = np.flatnonzero(first)
        i = max(0, lo - 1)
        edges = np.clip(offsets[i : hi + 1] - a, 0, b - a)
        counts[i : i + len(edges) - 1] += np.diff(np.searchsorted(starts, edges))
        if len(starts):
            forward, back = powers(b - a)
            value *= forward[: b - a]
            out.append(mix(np.add.reduceat(value, starts) * back[starts]))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every n-word shingle in order and their number in each row; a row of fewer words has its whole sequence as one."""
    short = (counts > 0) & (counts < n)
    sizes = np.where(short, 1, np.maximum(counts - n + 1, 0))
    ends = np.cumsum(counts)
    begins, at = ends - counts, np.cumsum(sizes) - sizes
    first = np.repeat(begins - at, sizes) + np.arange(sizes.sum())
    last = np.repeat(ends, sizes)
    h = np.zeros(len(first), np.uint64)
    for k in range(n):
        there = first + k < last
        add = words[np.minimum(first + k, len(words) - 1)] if len(words) else np.zeros(0, np.uint64)
        h = mix(h * np.uint64(_BASE) + np.where(there, add, np.uint64(k + 1)))
    return h, sizes


def map_texts(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of one text column of a batch."""
    return text_bytes(batch.column(batch.schema.get_field_index(column)))


def sorted_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order and how often each occurs."""
    keys = np.sort(keys)
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys)))
