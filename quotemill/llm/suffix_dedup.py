"""Removal of 400-byte strings that start elsewhere too, by suffix order.

Every 400-byte window has an anchor: of its first 200 positions, the one whose 8 bytes
hash least (the leftmost of equal ones). Equal windows have their anchors at the same
place, so the windows of one anchor need only be compared with those of anchors that
are followed by the same 200 bytes (the key). Steps:

1. give each anchor its key and the hash of its context, the bytes of all its windows;
   anchors with a key of their own repeat nothing; equal contexts of a key are counted
   before anything is dealt by key;
2. cut each context at the anchor into blocks of 50 bytes and build the suffix array of
   the blocks (`suffix_groups`) for some keys together; a context that occurs twice or
   more stands there twice. Neighbours in the order that share seven blocks form a run: a
   window holds at least seven. Inside a run the bytes beside the blocks are ordered too,
   and what neighbours have in common on both sides tells which windows occur twice;
3. join the repeated windows to their documents and cut them out.

A key with over `heavy` different contexts is split by a deeper prefix until none is left:
its windows are halved by where they start, and each half is keyed by all the bytes that
its windows share.

With `passage` the same is done for runs of that many words, lower-cased, which must occur
in two rows of different id or text: `repeats` tells the rows that have one. Nothing is
removed for that. Words are `[^\\x20\\x09-\\x0D]+`, as 32 bits of their hash.

Texts count as UTF-8 bytes, whole however long, null as none; null ids are ids like others;
repeated rows repeat each other's windows; only `doc_id` and `text` are read, so other
columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays, shared
from .suffix_groups import suffix_array
from .textcore import map_texts, mix, powers, text_bytes, word_hashes

#: Bytes of contexts that are sorted together, and contexts of a key before it is split.
BIN_BYTES, HEAVY = 3 << 20, 4000
#: Units of a text whose windows are hashed together.
CHUNK = 1 << 18
#: Words of a passage that the query tells the repeats of.
PASSAGE = 51


@dataclass(frozen=True)
class Windows:
    """Windows of `length` units, anchored in their first `span`, cut into blocks; a unit is a number of bytes."""

    length: int
    span: int
    block: int
    unit: int = 1
    across: bool = False  # only what occurs in different rows counts

    @property
    def need(self) -> int:
        """Blocks that every window holds."""
        return (self.length - self.block + 1) // self.block

    def cut(self, data, first: int, last: int):
        return data[first * self.unit : last * self.unit]


BYTES = Windows(400, 200, 50)


def words_of(n: int) -> Windows:
    """Windows of n words (12 at least); two thirds for the anchor, as words are fewer and tell more than bytes."""
    return Windows(n, n * 2 // 3, n // 8, 4, True)


def _flat(part: pa.RecordBatch, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Units of all texts of a slice, one after another, and where each text starts and ends."""
    if w.unit == 1:
        return text_bytes(part.column(part.schema.get_field_index("text")))
    words, counts = word_hashes(*map_texts(part))
    return (words >> np.uint64(32)).astype(np.uint32), np.concatenate(([0], np.cumsum(counts)))


def _units(batch: pa.RecordBatch, w: Windows):
    """Slices of a batch, each with its texts as bytes of units."""
    for part in arrays.slices(batch):
        units, offsets = _flat(part, w)
        raw, ends = memoryview(units.tobytes()), (offsets * w.unit).tolist()
        yield part, [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _chunks(offsets: np.ndarray, limit: int):
    """Ranges of at most `limit` units that hold whole texts, or parts of longer ones, which start anew in a range."""
    a = 0
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if end - a > limit and start > a:
            yield a, start
            a = start
        while end - a > limit:
            yield a, a + limit
            a += limit
    if offsets[-1] > a:
        yield a, int(offsets[-1])


def anchors(units: np.ndarray, offsets: np.ndarray, w: Windows = BYTES, limit: int = CHUNK):
    """Anchors of the windows of all texts, a chunk at a time: where they are, their first and last windows, and the hashes of their keys and contexts."""
    gram = 8 // w.unit  # units whose bytes are hashed together
    for start, end in _chunks(offsets, limit):
        data = units[start : end + w.length]
        low, high = np.clip(offsets[:-1], start, end) - start, np.clip(offsets[1:] - w.length + 1, start, end) - start
        windows = np.maximum(high - low, 0)
        valid = np.repeat(low - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        if not len(valid):
            continue
        n = len(data) - gram + 1
        grams = np.empty(n, np.uint64)
        for k in range(gram):  # from each k-th unit on they lie side by side
            at = data[k : k + (len(data) - k) // gram * gram]
            grams[k::gram] = at.view(np.uint64)
        grams = mix(grams)
        value = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        windows = int(valid[-1]) + 1
        padded = np.full(-(-(windows + w.span - 1) // w.span) * w.span, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:n] = value[: len(padded)]
        rows = padded.reshape(-1, w.span)
        ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()[:windows]
        behind = np.minimum.accumulate(rows, axis=1).ravel()[w.span - 1 : w.span - 1 + windows]
        of = (np.minimum(ahead, behind)[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        at, low, high = of[first], valid[first], valid[np.append(first[1:], len(of)) - 1]
        # sums of hashes times powers; a difference of two over the power at its start is a hash of what is between
        power, inverse = powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(grams * power[:n], out=sums[1:])

        def hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return mix((sums[b - gram + 1] - sums[a]) * inverse[a])

        where = ((at - low + 1) * w.length + at - high).astype(np.uint64)  # tells contexts of the same bytes apart
        yield at + start, low + start, high + start, hashes(at, at + w.length - w.span).view(np.int64), mix(hashes(low, high + w.length) + where).view(np.int64)


ANCHORS = "id long, row long, key long, context long, pos int, back int, near int"


def _digest(data, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(data, seed) - (1 << 63)


def _batch(columns, schema: str) -> pa.RecordBatch:
    """Columns of plain values as a batch."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*[x.split() for x in schema.split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names))


def _rows_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    return _batch(list(zip(*rows)) if rows else [()] * len(schema.split(", ")), schema)


def _anchors_of(docs: DataFrame, w: Windows) -> DataFrame:
    """Anchors of all rows: `back` and `near` are how far before the anchor its first and last window start."""

    def find(batches):
        for batch in batches:
            for part in arrays.slices(batch):
                ids, rows = (part.column(k).to_numpy() for k in (0, 1))
                units, offsets = _flat(part, w)
                for at, first, last, key, context in anchors(units, offsets, w):
                    text = np.searchsorted(offsets, at, "right") - 1
                    yield _batch([ids[text], rows[text], key, context, (at - offsets[text]).astype(np.int32), (at - first).astype(np.int32), (at - last).astype(np.int32)], ANCHORS)

    return docs.select("id", "row", "text").mapInArrow(find, ANCHORS)


def _orders(group: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of `group` and the bytes `beside`, and how many bytes each has in common with the one before it (-1 across groups)."""
    wide = np.zeros((len(group), -(-beside.shape[1] // 8) * 8), np.uint8)
    wide[:, : beside.shape[1]] = beside
    order = np.lexsort([*wide.view(">u8").astype(np.uint64).T[::-1], group])
    differ = beside[order[1:]] != beside[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), beside.shape[1])
    common[group[order[1:]] != group[order[:-1]]] = -1
    return order, np.concatenate(([-1], common))


def _classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """A number for each member, the same for those of a group with the same `depth` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def _repeated(n: list[int], owners: list[int], back: np.ndarray, near: np.ndarray, data: list[bytes], w: Windows = BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(member, offset before the anchor) of the windows that occur twice, ascending."""
    codes: dict[bytes, int] = {}
    flat: list[int] = []
    block = w.block * w.unit
    for piece, b in zip(data, back.tolist()):
        phase = b % w.block * w.unit
        flat += [codes.setdefault(piece[k : k + block], len(codes)) for k in range(phase, len(piece) - block + 1, block)]
    sizes = np.array([len(piece) // w.unit for piece in data])
    lo, blocks = -(back // w.block), (sizes - back) // w.block + back // w.block
    # a context that occurs twice or more stands there twice
    times = np.minimum(n, 2)
    copies = np.repeat(np.arange(len(data)), times)
    by = np.arange(len(copies))
    if w.across:  # the second copy stands for another row
        by = np.array(owners, np.int64)[copies] ^ (by - np.repeat(np.cumsum(times) - times, times))
    many = blocks[copies]
    copy = np.repeat(np.arange(len(copies)), many)
    inside = np.arange(len(copy)) - np.repeat(np.cumsum(many) - many, many)
    symbols = np.array(flat, np.int64)[(np.cumsum(blocks) - blocks)[copies][copy] + inside]
    # no window that occurs twice holds a block that occurs once: strings end there, and need enough blocks
    often = np.bincount(symbols, minlength=1)[symbols] > 1
    string = np.cumsum(np.diff(copy, prepend=-1).astype(bool) | np.diff(often, prepend=True)) - 1
    kept = np.flatnonzero(often & (np.bincount(string, minlength=1)[string] >= w.need))
    if not len(kept):
        return kept, kept
    string = np.cumsum(np.diff(string[kept], prepend=-1).astype(bool)) - 1
    # terminators are all different and below every block; the last one is the smallest
    slot, ends = np.arange(len(kept)) + string, np.flatnonzero(np.diff(string, append=-1))
    whole = np.empty(len(kept) + len(ends), np.int64)
    whole[slot], whole[slot[ends] + 1] = symbols[kept] + len(ends) + 1, np.arange(1, len(ends) + 1)
    owner, place = np.zeros(len(whole), np.int64), np.zeros(len(whole), np.int64)
    owner[slot], place[slot] = copy[kept], (lo[copies][copy] + inside)[kept]
    order = np.array(suffix_array([*whole.tolist(), 0])[1:], np.int64)
    ahead = np.concatenate((whole, -np.arange(1, w.need + 1)))
    alike = np.ones(max(len(order) - 1, 0), bool)
    for t in range(w.need):
        alike &= ahead[order[1:] + t] == ahead[order[:-1] + t]
    # runs of neighbours with the same blocks
    run = np.cumsum(np.concatenate(([True], ~alike)))
    taken = np.concatenate((alike, [False])) | np.concatenate(([False], alike))
    at, run = order[taken], run[taken]
    string, at = owner[at], place[at]
    member = copies[string]
    least, most = np.maximum(0, near[member] + w.block * at), np.minimum(w.block - 1, back[member] + w.block * at)
    some = least <= most
    string, member, at, run, least, most = string[some], member[some], at[some], run[some], least[some], most[some]
    if not len(member):
        return member, at
    group, of = run * (4 * w.length) + at + 2 * w.length, by[string]
    buffer = np.frombuffer(b"".join(data), np.uint8)
    starts = np.cumsum([0, *map(len, data[:-1])])[member] + (back[member] + w.block * at) * w.unit
    tail = w.length - w.need * w.block
    before = buffer[np.maximum(starts[:, None] - np.arange(1, (w.block - 1) * w.unit + 1), 0)]
    behind = buffer[np.minimum(starts[:, None] + w.need * block + np.arange(tail * w.unit), len(buffer) - 1)]
    left, right = _orders(group, before), _orders(group, behind)
    found = np.zeros(len(data) * w.length, bool)
    for s in range(w.block):  # windows that begin s units before the blocks
        fits = np.flatnonzero((least <= s) & (s <= most))
        if not len(fits):
            continue
        both = (_classes(*left, s * w.unit) * (len(group) + 1) + _classes(*right, (tail - s) * w.unit))[fits]
        rank = np.argsort(both)
        fits, new = fits[rank], np.concatenate(([True], both[rank[1:]] != both[rank[:-1]]))
        first = np.flatnonzero(new)
        apart = np.minimum.reduceat(of[fits], first) != np.maximum.reduceat(of[fits], first)
        twice = fits[apart[np.cumsum(new) - 1]]
        found[member[twice] * w.length + s - w.block * at[twice]] = True
    found = np.flatnonzero(found)
    return found // w.length, found % w.length


SPANS = "key long, context long, back int, near int"
PIECES = "key long, context long, n long, owner long, back int, near int, data binary"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _compare(pieces: DataFrame, w: Windows) -> DataFrame:
    """Repeated windows of `pieces`, each context once but for repeated rows, as runs of offsets."""
    pieces = pieces.select(*_names(PIECES))
    pieces = pieces.repartition(shared.partitions(pieces.sparkSession), "key").sortWithinPartitions("key", "context")

    def bins(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and held[-1][:2] == row[:2]:
                    continue  # a repeated row gives its contexts twice
                if size > BIN_BYTES and held[-1][0] != row[0]:
                    yield held
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
        if held:
            yield held

    def compare(batches):
        for held in bins(batches):
            key, context, n, owner, back, near, data = zip(*held)
            member, offset = _repeated(n, owner, np.array(back), np.array(near), data, w)
            if not len(member):
                continue
            first = np.flatnonzero(np.concatenate(([True], (member[1:] != member[:-1]) | (offset[1:] != offset[:-1] + 1))))
            last = np.append(first[1:], len(member)) - 1
            of = member[first]
            yield _batch([np.array(key)[of], np.array(context)[of], offset[last].astype(np.int32), offset[first].astype(np.int32)], SPANS)

    return pieces.mapInArrow(compare, SPANS)


def _cut(docs: DataFrame, contexts: DataFrame, w: Windows) -> DataFrame:
    """The bytes of contexts (key, context, n, one), read where each first occurs."""
    asked = F.struct("key", "context", "n", F.col("one.row").alias("owner"), "one.pos", "one.back", "one.near")
    wanted = contexts.groupBy("one.id", "one.row").agg(F.collect_list(asked).alias("wanted"))
    texts = docs.select("id", "row", "text").join(wanted.hint("merge"), ["id", "row"])

    def cut(batches):
        for batch in batches:
            for part, texts in _units(batch, w):
                rows = []
                for data, asked in zip(texts, part.column(1).to_pylist()):
                    rows += [(x["key"], x["context"], x["n"], x["owner"], x["back"], x["near"], bytes(w.cut(data, x["pos"] - x["back"], x["pos"] - x["near"] + w.length))) for x in asked]
                yield _rows_batch(rows, PIECES)

    return texts.select("text", "wanted").mapInArrow(cut, PIECES)


DEEP = "parent long, origin long, lo int, hi int, " + PIECES


def _halved(pieces: DataFrame, w: Windows) -> DataFrame:
    """Both halves of each piece's windows, which start `lo` to `hi` units before the anchor, keyed by what all windows of a half share."""

    def halve(batches):
        for batch in batches:
            rows = []
            for parent, origin, lo, hi, _, _, n, owner, back, near, data in zip(*[c.to_pylist() for c in batch.columns]):
                middle = (lo + hi + 1) // 2
                for a, b in ((lo, middle - 1), (middle, hi)):
                    last, first = max(near, a), min(back, b)
                    if last <= first:
                        core, part = w.cut(data, back - a, back - b + w.length), w.cut(data, back - first, back - last + w.length)
                        rows.append((parent, origin, a, b, _digest(core, 1 + a * w.span + b), _digest(part, 1 + first * w.span + last), n, owner, first, last, part))
            yield _rows_batch(rows, DEEP)

    return pieces.select(*_names(DEEP)).mapInArrow(halve, DEEP)


def _split(pieces: DataFrame, heavy: int, w: Windows) -> DataFrame:
    """Repeated windows of pieces whose keys have too many contexts for one task."""
    now = pieces.dropDuplicates(["key", "context"]).withColumns({"parent": F.col("key"), "origin": F.col("context"), "lo": F.lit(0), "hi": F.lit(w.span - 1)})
    apart = (F.max("n") > 1) | (F.min("owner") != F.max("owner"))
    n = (F.when(apart, 2).otherwise(1) if w.across else F.sum("n")).cast("long").alias("n")
    out = None
    while True:
        now = shared.keep(_halved(now, w), "deeper")
        whole = now.groupBy("key", "context").agg(n, F.first(F.struct("owner", "back", "near", "data")).alias("one")).select("key", "context", "n", "one.*")
        sizes = now.groupBy("key", "context").agg(n).groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("contexts"))
        sizes = shared.keep(sizes.where("n > 1"), "sizes")
        light = whole.join(sizes.where(F.col("contexts") <= heavy).select("key"), "key", "left_semi")
        spans = _compare(light, w).join(now.select("key", "context", "parent", "origin"), ["key", "context"])
        spans = shared.keep(spans.select(F.col("parent").alias("key"), F.col("origin").alias("context"), "back", "near"), "spans")
        out = spans if out is None else out.unionByName(spans)
        many = sizes.where(F.col("contexts") > heavy).select("key")
        if many.isEmpty():
            return out
        now = now.join(many, "key", "left_semi")


def repeated_windows(docs: DataFrame, heavy: int = HEAVY, w: Windows = BYTES) -> DataFrame:
    """(id, row, spans): for each row with repeated windows, the units they cover (begin, end), not yet merged.

    Joins of what grows with the rows are by sorted shuffles at every size.
    """
    with shared.temporary(docs.sparkSession):
        found = shared.keep(_anchors_of(docs, w), "anchors")
        keys = shared.keep(found.groupBy("key").count().where("count > 1").select("key"), "keys")
        several = shared.keep(found.join(keys.hint("merge"), "key", "left_semi"), "shared-anchors")
        n = F.when(F.min("row") != F.max("row"), 2).otherwise(1).cast("long") if w.across else F.count("*")
        contexts = several.groupBy("key", "context").agg(n.alias("n"), F.min(F.struct("id", "row", "pos", "back", "near")).alias("one"))
        contexts = shared.keep(contexts, "contexts")
        many = shared.keep(contexts.groupBy("key").count().where(F.col("count") > heavy).select("key"), "heavy-keys")
        pieces = _cut(docs, contexts, w)
        if many.isEmpty():
            spans = _compare(pieces, w)
        else:
            pieces = shared.keep(pieces, "pieces")  # the texts are dealt once
            spans = _compare(pieces.join(many, "key", "left_anti"), w).unionByName(_split(pieces.join(many, "key", "left_semi"), heavy, w))
        spans = shared.keep(spans, "spans")
        placed = several.select("id", "row", "key", "context", "pos").join(spans.hint("merge"), ["key", "context"])
        covered = placed.select("id", "row", (F.col("pos") - F.col("back")).alias("begin"), (F.col("pos") - F.col("near") + w.length).alias("end"))
        return shared.keep(covered.groupBy("id", "row").agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "repeated", lasting=True)


def _merged(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((x["begin"], x["end"]) for x in spans or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def cut_repeats(docs: DataFrame, heavy: int = HEAVY, doc_id: str = "doc_id", text: str = "text", passage: int | None = None) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes and spans (maximal removed runs) of every row, with `passage` also repeats."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # rows with the same id and text are the same to every step, others differ in id or hash
    rows = rows.withColumns({"id": F.coalesce("doc_id", F.lit(0)), "row": F.xxhash64("doc_id", "text")})
    told = repeated_windows(rows, heavy)
    if passage:
        marked = repeated_windows(rows, heavy, words_of(passage)).select("id", "row", F.lit(True).alias("repeats"))
        told = told.join(marked.hint("merge"), ["id", "row"], "full")
    else:
        told = told.withColumn("repeats", F.lit(False))
    joined = rows.select("id", "row", "doc_id", F.col("text").cast("binary").alias("text")).join(told.hint("merge"), ["id", "row"], "left").select("doc_id", "text", "spans", F.coalesce("repeats", F.lit(False)).alias("repeats"))

    def cut(batches):
        for batch in batches:
            ids, kept, sizes, runs = batch.column(0), [], [], []
            for value, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                data, merged, at, parts = memoryview(value.as_buffer()), _merged(spans), 0, []
                for a, b in merged:
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                kept.append(b"".join(parts))
                sizes.append(len(data))
                runs.append([{"begin": a, "end": b} for a, b in merged])
            kinds = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(runs, kinds), batch.column(3)], names=["doc_id", "kept", "n_bytes", "spans", "repeats"])

    out = joined.mapInArrow(cut, "doc_id long, kept binary, n_bytes long, spans array<struct<begin:int,end:int>>, repeats boolean")
    return out if passage else out.drop("repeats")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document stays, and whether it has over 50 words in a row that another has too."""
    done = cut_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), passage=PASSAGE)
    kept = F.col("kept")
    return done.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length(kept)).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"), "repeats")


