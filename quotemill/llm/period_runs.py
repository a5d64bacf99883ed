"""Runs of repeated words: stretches that repeat one period at least four times.

A run is a stretch of consecutive words with smallest period q and at least
max(6, 4 * q) words that no neighbouring word extends. Periods up to `SHORT` are found by
scanning every lag. Above, scale j looks for periods of (w, 2 * w], w = 2 ** (j - 1), by
minimizers: of each w neighbouring shingles of k = 2 * w words the one with the least hash.
Inside a run of four periods two windows a period apart hold the same shingles, so their
minima repeat at the period's distance; a shingle is at least a period long, so it comes
back nowhere nearer, and neighbours in the order of (hash, position) are that pair. Each
pair seeds the comparison of the words that lie a period apart, to both sides, which
decides the run exactly. Only a collision of 64-bit hashes could hide one.

Words are `[^\\x20\\x09-\\x0D]+` and compared byte for byte. A null or empty text has no
words, no runs and an empty collapsed text; texts are read whole, however long, and a task
holds about 2 MB of text or one text at a time; repeated rows are judged each for itself;
runs with one start or length are all told, in order of start and period; other columns
may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import slices
from .textcore import mix, text_bytes

#: Periods that are scanned lag by lag.
SHORT = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(column: pa.Array) -> list[list[bytes]]:
    """The words of each text; bytes.split cuts at exactly 0x20 and 0x09 to 0x0D."""
    data, offsets = text_bytes(column)
    raw = data.tobytes()
    return [raw[a:b].split() for a, b in zip(offsets[:-1], offsets[1:])]


def word_ids(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each different word, and the offsets of the texts."""
    seen, n = {}, count()
    ids = [seen.setdefault(w, i) for words in texts for w, i in zip(words, n)]
    return np.array(ids, np.int64), np.concatenate(([0], np.cumsum([len(w) for w in texts]))).astype(np.int64)


def _short_runs(ids: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Starts and lengths of the stretches of each period up to SHORT."""
    for q in range(1, min(SHORT, len(ids) - 1) + 1):
        same = np.zeros(len(ids) - q + 2, bool)
        same[1:-1] = (ids[:-q] == ids[q:]) & (left[:-q] > q)  # the word a period on is of the same text
        edges = np.flatnonzero(same[1:] != same[:-1])
        start, size = edges[::2], edges[1::2] - edges[::2] + q
        long = size >= max(6, 4 * q)
        yield start[long], size[long], q


def _sliding(values: np.ndarray, w: int, ufunc: np.ufunc, fill: int) -> np.ndarray:
    """ufunc over values[i : i + w] of each i, by running results from both ends of blocks of w."""
    n = len(values)
    padded = np.full(-(-n // w) * w + w, fill, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, w)
    ahead = ufunc.accumulate(blocks, axis=1).ravel()
    back = ufunc.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(back[:n], ahead[w - 1 : w - 1 + n])


def minimizers(hashes: np.ndarray, left: np.ndarray, w: int, k: int) -> np.ndarray:
    """Positions whose shingle hash is the least of some w neighbours; windows lie inside a text."""
    least = _sliding(hashes, w, np.minimum, 2**64 - 1)
    least[left < w + k - 1] = 0
    # the greatest minimum of the windows over a position: the position's hash where it is one of them
    most = _sliding(np.concatenate((np.zeros(w - 1, np.uint64), least)), w, np.maximum, 0)[: len(hashes)]
    return np.flatnonzero((most == hashes) & (left >= k))


def _seeds(hashes: np.ndarray, left: np.ndarray, w: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, period): all words of [from, to) equal those a period on, but for hash collisions."""
    at = minimizers(hashes, left, w, k)
    at = at[np.lexsort((at, hashes[at]))]
    gap = np.diff(at)
    pair = (hashes[at[1:]] == hashes[at[:-1]]) & (gap > w) & (gap <= k) & (left[at[:-1]] >= k + gap)
    start, gap = at[:-1][pair], gap[pair]
    order = np.lexsort((start, gap))
    start, gap = start[order], gap[order]
    first = np.ones(len(start), bool)
    first[1:] = (gap[1:] != gap[:-1]) | (start[1:] > start[:-1] + k)
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(start))[: len(heads)] - 1
    return start[heads], start[tails] + k, gap[heads]


def _extend(ids: np.ndarray, lo: int, hi: int, a: int, b: int, q: int) -> tuple[int, int]:
    """The widest [a, b) around the given one, within [lo, hi), whose words equal those q on."""
    while a > lo:
        c = max(lo, a - q)
        other = np.flatnonzero(ids[c:a] != ids[c + q : a + q])
        a = c if not len(other) else c + int(other[-1]) + 1
        if len(other):
            break
    while b < hi - q:
        c = min(hi - q, b + q)
        other = np.flatnonzero(ids[b:c] != ids[b + q : c + q])
        b = c if not len(other) else b + int(other[0])
        if len(other):
            break
    return a, b


def find_runs(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, in that order; `offsets` cut `ids` into texts."""
    sizes = np.diff(offsets)
    end = np.repeat(offsets[1:], sizes)
    found = [np.stack((start, size, np.full(len(start), q)), axis=1) for start, size, q in _short_runs(ids, end - np.arange(len(ids)))]
    hashes, at = mix(ids.astype(np.uint64) + _ODD), np.arange(len(ids))
    left, length = end - at, np.repeat(sizes, sizes)
    step = 1
    while True:
        k = step * 2
        if step >= SHORT:
            fits = length >= 4 * (step + 1)
            hashes, at, left, length = hashes[fits], at[fits], left[fits], length[fits]
        if not len(at):
            break
        # shingles of 2 * step words from two of half the size
        after = np.zeros(len(hashes), np.uint64)
        after[:-step] = hashes[step:]
        hashes = mix(hashes * _ODD + after)
        if step >= SHORT:
            usable = np.where(left >= k, hashes, np.uint64(2**64 - 1))
            rows = []
            for a, b, q in zip(*_seeds(usable, left, step, k)):
                a, b, q = int(at[a]), int(at[b - 1]) + 1, int(q)
                hi = int(end[a])
                lo = int(offsets[np.searchsorted(offsets, a, "right") - 1])
                if not np.array_equal(ids[a:b], ids[a + q : b + q]):
                    continue
                a, b = _extend(ids, lo, hi, a, b, q)
                if b - a + q >= 4 * q:
                    rows.append((a, b - a + q, q))
            found.append(np.array(rows, np.int64).reshape(-1, 3))
        step = k
    rows = np.concatenate(found).astype(np.int64) if found else np.zeros((0, 3), np.int64)
    # one stretch under several periods: the smallest is its period
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[keep]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    text = np.searchsorted(offsets, rows[:, 0], "right") - 1
    return np.column_stack((text, rows[:, 0] - offsets[text], rows[:, 1:]))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        for part in slices(batch):
            texts = words_of(part.column(1))
            ids, offsets = word_ids(texts)
            runs = find_runs(ids, offsets)
            change = np.zeros(len(ids) + 1, np.int64)
            begin = offsets[runs[:, 0]] + runs[:, 1]
            np.add.at(change, begin + runs[:, 3], 1)
            np.add.at(change, begin + runs[:, 2], -1)
            kept = np.cumsum(change[:-1]) == 0
            hit = set(runs[:, 0].tolist())
            out = [b" ".join([w for w, k in zip(words, kept[offsets[i] : offsets[i + 1]].tolist()) if k] if i in hit else words) for i, words in enumerate(texts)]
            edges = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(struct))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(edges), spans), pa.array(out, pa.binary()).view(pa.string())], names=["row", "runs", "collapsed"])


def collapse_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of `docs` as `row`, their `runs` (start, length, period) and the text `collapsed`: words joined by blanks, without those behind a run's first period."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(_judge, f"row {rows.schema['row'].dataType.simpleString()}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            out = []
            for name, words in zip(part.column(0).to_pylist(), words_of(part.column(1))):
                h, n = 1 if name is None else zlib.crc32(str(name).encode()), len(words)
                if h % 10 == 0 and n:
                    g = h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    words[a:] = (words[a : a + p] * (1 + (n - a) // p))[: n - a]
                out.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary()).view(pa.string())], names=["doc_id", "text"])


def plant_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, its words joined by blanks; with h the crc32 of the decimal id, one in ten texts (10 divides h) repeats a stretch to its end. A null id changes nothing."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_plant, "doc_id long, text string")


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, some of them planted: their number, the longest, and digests of all runs and of the collapsed text."""
    found = collapse_runs(plant_runs(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select(F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("_best"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("_best.s"), F.col("_best.n"), -F.col("_best.p")
    return rows.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.expr("1000 * _best.n DIV -_best.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
