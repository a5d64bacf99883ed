"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are TF-IDF passages over their own vocabulary, with the exact document
frequencies of its words in the whole corpus. A randomised SVD, its products summed over partitions,
gives a latent space. An item of over PASSAGE words is cut into overlapping passages of 64 words;
documents are cut into windows of words, as long as the passages of a length class, and searched
by cosine with the passages in that space, taken against the passage's own cosine there. The
gate follows from `similar` and the lengths (see `gates`), with `cosine` as its upper limit.
Candidates are then compared word by word with the whole item: the longest common subsequence,
and that of the item's answer (what follows the last "Answer:", else its last fifth). A copy
spread thin by other text between its words can lie below the gate in every window.

A match has lcs >= `accept`, or lcs >= `similar` and the answer found. Words are runs of
letters, digits and marks of the lower-cased text, by Unicode; scripts without blanks (Han,
kana, Thai and others) count each pair of neighbouring characters as a word; quotes, dashes and
other signs only part words. A null or empty text, or an item without
words, matches nothing; an item of one or two words matches wherever its words stand in
order and pass the gate. Repeated rows match alike, and of windows with an equal longest
subsequence the first is given. Texts and items are read whole, however long; only the
named columns are read, so others may have any name; empty tables give an empty result.
The benchmark goes to the workers in blocks of about `block` passages; each takes two
passes of its own over the documents, one for its words' frequencies, one for the search.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays, shared
from .textcore import plain_words, sorted_counts

DF_BITS = 14
STRIDE = 8
#: Longest passage; longer items are cut into passages of 64 words, each half over the next.
PASSAGE, CUT = 90, 64
#: Words of a window (a power of 2 of strides) by the largest number of words of a passage.
WINDOWS = ((22, 16), (45, 32), (PASSAGE, 64))
#: Least rank of the latent space; it grows with the root of the number of passages.
LATENT = 40
#: Part of the expected cosine of a copy that the gate asks for: its words' idf differ.
SLACK = 0.8
CELLS = 1 << 22
#: All but the characters of scripts without blanks.
UNSPACED = r"[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"


def _normal(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return plain_words(pc.utf8_lower(pc.fill_null(column, "")))


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - DF_BITS)).astype(np.int64)


def corpus_idf(docs: DataFrame, vocabulary: np.ndarray, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """idf over all documents of every word of the sorted vocabulary, and of 2**DF_BITS buckets of all other words.

    Other words only lengthen a window: those that share a bucket seem more frequent than
    they are, which lets more windows through the gate, never fewer.
    """
    held, size = docs.sparkSession.sparkContext.broadcast(vocabulary), len(vocabulary)  # of a block of items

    def count(batches):
        total = np.zeros(size + (1 << DF_BITS) + 1, np.int64)
        for batch in batches:
            for part in arrays.slices(batch):
                words, counts = _normal(part.column(0))
                found = np.searchsorted(held.value, words)
                known = np.append(held.value, 0)[found] == words if size else np.zeros(len(words), bool)
                keys = np.repeat(np.arange(len(counts)), counts) * len(total) + np.where(known & (found < size), found, size + _bucket(words))
                total += np.bincount(sorted_counts(keys)[0] % len(total), minlength=len(total))
                total[-1] += len(counts)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["word", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + (1 << DF_BITS) + 1)
    out[rows.column("word").to_numpy()] = rows.column("n").to_numpy()
    idf = (np.log((1 + out[-1]) / (1 + out[:-1])) + 0.1).astype(np.float32)
    return idf[:size], idf[size:]


@dataclass
class Index:
    """A block of the benchmark: its words, their latent vectors, and the items."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray
    latent: np.ndarray
    items: np.ndarray
    idf: np.ndarray
    other_idf: np.ndarray
    lengths: np.ndarray
    item_of: np.ndarray


def _passages(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and their number in the passages of all items, and each passage's item."""
    starts, sizes, owner = [], [], []
    for i, (b, n) in enumerate(zip(np.cumsum(counts).tolist(), counts.tolist())):
        own = [0] if n <= PASSAGE else [*range(0, n - CUT, CUT // 2), n - CUT]
        if n:
            starts += [b - n + k for k in own]
            sizes += [min(n, CUT) if n > PASSAGE else n] * len(own)
            owner += [i] * len(own)
    sizes = np.array(sizes, np.int64)
    at = np.repeat(np.array(starts, np.int64) - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return words[at], sizes, np.array(owner, np.int64)


def gates(lengths: np.ndarray, width: int, similar: float, cosine: float) -> np.ndarray:
    """Least cosine by a passage's length: what a copy with a share `similar` of its words has, at the worst place between strides."""
    apart = np.abs(lengths - width)
    overlap = np.maximum(np.minimum(lengths, width) - np.maximum(STRIDE - apart, 0) // 2, 1)
    return np.minimum(cosine, SLACK * similar * overlap / np.sqrt(lengths * width)).astype(np.float32)


def _rows(words: np.ndarray, counts: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray):
    """TF-IDF rows of length 1 over a sorted vocabulary: (features, values)."""
    for one in np.split(words, np.cumsum(counts)[:-1]) if len(counts) else []:
        terms, n = sorted_counts(one)
        at = np.searchsorted(vocabulary, terms)
        x = n * idf[at]
        yield at, (x / max(float(np.sqrt((x * x).sum())), 1e-9)).astype(np.float32)


def latent_space(items: DataFrame, vocabulary: np.ndarray, idf: np.ndarray, rank: int = LATENT, seed: int = 3) -> np.ndarray:
    """Right singular vectors (words x rank) of the passages' TF-IDF matrix by a randomised SVD; partitions sum the products."""
    m = len(vocabulary)
    width = min(rank + 16, m)
    probe = np.random.default_rng(seed).standard_normal((m, width)).astype(np.float32)

    def products(right: np.ndarray, gram: bool) -> np.ndarray:
        def multiply(batches):
            total: dict[int, np.ndarray] = {}
            inner = np.zeros((width, width))
            for batch in batches:
                for at, x in _rows(*_passages(*_normal(batch.column(0)))[:2], vocabulary, idf):
                    y = x @ right[at]
                    if gram:
                        inner += np.outer(y, y)
                    else:
                        for k, v in zip(at.tolist(), x.tolist()):
                            total[k] = total.get(k, 0) + v * y.astype(np.float64)
            found = list(enumerate(inner)) if gram else sorted(total.items())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([v.tolist() for _, v in found], pa.list_(pa.float64()))], names=["feature", "y"])

        rows = items.select("text").mapInArrow(multiply, "feature long, y array<double>")
        if width <= 64:
            summed = rows.groupBy("feature").agg(F.array(*[F.sum(F.col("y")[k]) for k in range(width)]).alias("y")).toArrow()
        else:
            summed = rows.groupBy(F.pmod("feature", F.lit(64))).applyInArrow(_add, "feature long, y array<double>").toArrow()
        out = np.zeros((width if gram else m, width))
        out[summed.column("feature").to_numpy()] = np.array(summed.column("y").to_pylist()).reshape(summed.num_rows, width)
        return out

    basis, _ = np.linalg.qr(products(probe, False))
    values, vectors = np.linalg.eigh(products(basis.astype(np.float32), True))
    keep = np.argsort(-values)[:rank]
    return (basis @ vectors[:, keep[values[keep] > 1e-9]]).astype(np.float32)


def _add(table: pa.Table) -> pa.Table:
    features, at = np.unique(table.column("feature").to_numpy(), return_inverse=True)
    values = table.column("y").combine_chunks().flatten().to_numpy().reshape(len(at), -1)
    total = np.zeros((len(features), values.shape[1]))
    np.add.at(total, at, values)
    return pa.table({"feature": features, "y": pa.array(total.tolist(), pa.list_(pa.float64()))})


def build_index(items: DataFrame, docs: DataFrame) -> Index:
    """The index of one block of items (item_id, text), weighed by the words' frequencies in `docs` (text)."""
    rows = items.orderBy("item_id", "text").toArrow()
    words, counts = _normal(rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string()))
    each = np.split(words, np.cumsum(counts)[:-1]) if len(counts) else []
    answers = []
    for text, own in zip(rows.column("text").to_pylist(), each):
        _, mark, tail = (text or "").lower().rpartition("answer:")
        found = plain_words(pa.array([tail]))[0] if mark else np.zeros(0, np.uint64)
        answers.append(found if len(found) else own[len(own) - max(1, len(own) // 5) :])
    vocabulary, _ = sorted_counts(words)
    idf, other = corpus_idf(docs, vocabulary)
    cut, lengths, item_of = _passages(words, counts)
    rank = max(LATENT, round(4 * len(lengths) ** 0.5))
    latent = latent_space(items, vocabulary, idf, rank) if len(vocabulary) else np.zeros((0, 1), np.float32)
    vectors = np.array([x @ latent[at] for at, x in _rows(cut, lengths, vocabulary, idf)], np.float32).reshape(len(lengths), latent.shape[1])
    # a passage's own text has the value 1: what the space leaves out of it is left out of both sides
    scaled = vectors / np.maximum((vectors * vectors).sum(axis=1, keepdims=True), 1e-9)
    weighted = np.vstack((latent * idf[:, None], np.zeros((1, latent.shape[1])))).astype(np.float32)
    return Index(rows.column("item_id").to_pylist(), each, answers, vocabulary, weighted, scaled, idf, other, lengths, item_of)


def lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Longest common subsequence of two word sequences, bit-parallel over `a`."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b.tolist():
        hit = row & masks.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _hits(index: Index, windows: np.ndarray, passages: np.ndarray, gate: np.ndarray):
    """(window, item, cosine) of the windows that pass the gate of a passage of the item, in order of the windows."""
    step, found = max(1, CELLS // len(windows)), []
    for k in range(0, len(passages), step):
        some, least = passages[k : k + step], gate[k : k + step]
        cosines = windows @ index.items[some].T
        w, p = np.nonzero(cosines >= least)
        found.append((w, index.item_of[some[p]], cosines[w, p]))
    w, item, value = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((-value, item, w))
    w, item, value = w[order], item[order], value[order]
    first = np.ones(len(w), bool)
    first[1:] = (w[1:] != w[:-1]) | (item[1:] != item[:-1])
    return zip(w[first].tolist(), item[first].tolist(), value[first].tolist())


def _search(index: Index, words: np.ndarray, counts: np.ndarray, cosine: float, similar: float, accept: float):
    """(row, item, cosine, lcs, answer lcs, first word) of the matches in a batch, the best of each row and item."""
    n_blocks = -(-counts // STRIDE)
    ends, first_block = np.cumsum(counts), np.cumsum(n_blocks) - n_blocks
    row_of = np.repeat(np.arange(len(counts)), n_blocks)
    start = (ends - counts)[row_of] + (np.arange(len(row_of)) - first_block[row_of]) * STRIDE
    if not len(start):
        return
    at = np.minimum(np.searchsorted(index.vocabulary, words), len(index.vocabulary) - 1)
    at = np.where(index.vocabulary[at] == words, at, len(index.vocabulary))  # the last row is of zeros
    inside = np.arange(STRIDE) < np.minimum(STRIDE, ends[row_of] - start)[:, None]
    placed = np.where(inside, np.append(at, 0)[np.minimum(start[:, None] + np.arange(STRIDE), len(at))], len(index.vocabulary))
    blocks = index.latent[placed[:, 0]]
    for k in range(1, STRIDE):
        blocks += index.latent[placed[:, k]]
    weights = np.add.reduceat(np.where(at < len(index.idf), np.append(index.idf, 0)[at], index.other_idf[_bucket(words)]) ** 2, start)
    best: dict[tuple[int, int], tuple] = {}
    seen: dict[tuple[int, int], int] = {}
    stamps, stamp = np.zeros(len(index.vocabulary) + 1, np.int64), 0
    own = [np.searchsorted(index.vocabulary, w) for w in index.words]
    sums, norms, have, low = blocks, weights.astype(np.float32), 1, 0
    for most, width in WINDOWS:
        while have < width // STRIDE:  # windows of twice as many blocks, each within its row
            if have < len(start):
                same = (row_of[have:] == row_of[:-have]).astype(np.float32)
                sums, norms = sums.copy(), norms.copy()
                sums[:-have] += sums[have:] * same[:, None]
                norms[:-have] += norms[have:] * same
            have *= 2
        passages = np.flatnonzero((index.lengths > low) & (index.lengths <= most))
        low = most
        if not len(passages):
            continue
        for w, item, value in _hits(index, sums / np.sqrt(np.maximum(norms, 1e-9))[:, None], passages, gates(index.lengths[passages], width, similar, cosine)):
            row, a = int(row_of[w]), int(start[w])
            wide, lo, hi = len(index.words[item]), int(ends[row] - counts[row]), int(ends[row])
            if a <= seen.get((row, item), -1):
                continue
            # a copy around any window that starts in the next half item lies within these words
            seen[row, item] = a + wide // 2
            left, right = max(lo, a - wide), min(hi, a + wide // 2 + width + wide)
            stamp += 1
            stamps[at[left:right]] = stamp
            if (stamps[own[item]] == stamp).sum() < min(accept, similar) * wide:  # no longer subsequence than words in common
                continue
            lcs = lcs_length(index.words[item], words[left:right]) / wide
            answer = lcs_length(index.answers[item], words[left:right]) / len(index.answers[item])
            if (lcs >= accept or lcs >= similar and answer >= 0.8) and ((row, item) not in best or best[row, item][1] < lcs):
                best[row, item] = (value, lcs, answer, a - lo)
    for (row, item), found in sorted(best.items()):
        yield row, index.ids[item], *found


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.4, similar: float = 0.5, accept: float = 0.7, block: int = 5000, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, text_key (hash of the text), item_id, cosine, lcs, answer and word (where the window starts) of every match."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    held = F.coalesce("text", F.lit(""))
    n_words = F.size(F.split(held, r"[^\p{L}\p{M}\p{N}]+")) + F.length(F.regexp_replace(held, UNSPACED, ""))
    passages = items.agg(F.coalesce(F.sum(F.greatest(F.lit(1), F.ceil(n_words / (CUT // 2)) - 1)), F.lit(0))).first()[0]
    blocks = max(1, -(-passages // block))
    dealt = shared.keep(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")), "items")
    rows, out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text")), None
    for k in range(blocks):
        held = spark.sparkContext.broadcast(build_index(dealt.where(F.col("block") == k), rows))  # of about `block` passages

        def search(batches, held=held):
            for batch in batches:
                for part in arrays.slices(batch, limit=1 << 20):
                    found = list(_search(held.value, *_normal(part.column(2)), cosine, similar, accept)) if len(held.value.vocabulary) else []
                    if found:
                        cols = list(zip(*found))
                        yield pa.RecordBatch.from_arrays([*[part.column(k).take(pa.array(cols[0])) for k in (0, 1)], pa.array(cols[1], pa.int64()), *[pa.array(c, pa.float64()) for c in cols[2:5]], pa.array(cols[5], pa.int64())], names=["doc_id", "text_key", "item_id", "cosine", "lcs", "answer", "word"])

        one = rows.mapInArrow(search, "doc_id long, text_key long, item_id long, cosine double, lcs double, answer double, word long")
        out = one if out is None else out.unionByName(one)
    return out


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages found in documents."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_key")
