"""Token ids as Arrow files of equal-length sequences.

A shard is a pair of Arrow IPC files. `ids-N.arrow` has record batches with two
fixed-size-list columns, `input_ids` (uint16, or uint32 for large vocabularies) and
`mask` (boolean, false on the padding of the last sequence), uncompressed, so that a
memory map gives any sequence without a copy. `docs-N.arrow` has a row for each
document: `doc_id`, `start` (its first id within the shard) and `n_tokens`.

Shards follow the order of doc_id; documents run on across sequences, not across
shards. A null or empty text has the end id alone; a null doc_id sorts first; rows
that repeat a doc_id are each encoded, in the order of their texts; texts are encoded
whole, however long; only the id and the text are read, so other columns may have any
name; an empty table gives no files.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays, shared

SEQUENCE = 2048
BATCH = 64
_CACHE_WORDS = 600_000
#: Begins with the mark, so that a search skips from mark to mark.
_STOP = re.compile(rb"[.,](?<=[a-z][.,])(?=[\x20\x09-\x0D]|$)")
_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of a text by a tokenizer that drops white space and case, so words can be encoded apart and remembered.

    A point or comma between an ASCII letter and white space is a word of its own, as it
    is to such a tokenizer. New words of letters alone are encoded many at a time and told
    apart by the vocabulary's mark of a word's end, others one by one.
    """

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.known = Tokenizer.from_file(path), np.dtype(f"<u{width}"), {}
        ending = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if ending:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[k for t, k in vocabulary.items() if t.endswith(ending)]] = True

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        # special tokens keep their case
        split = [_STOP.sub(rb" \g<0>", t if b"<|" in t else t.lower()).split() for t in texts]
        out = list(map(self._joined, split))
        late = [k for k, ids in enumerate(out) if ids is None]
        if late:
            if len(self.known) > _CACHE_WORDS:
                self.known.clear()
            new = sorted(set().union(*(split[k] for k in late)).difference(self.known))
            for k in range(0, len(new), 4096):
                self._learn(new[k : k + 4096])
            for k in late:
                out[k] = self._joined(split[k])
        return out

    def _joined(self, words: list[bytes]) -> bytes | None:
        """Ids of the words; None where one isn't known yet."""
        try:
            return b"".join(list(map(self.known.__getitem__, words)))
        except KeyError:
            return None

    def _learn(self, words: list[bytes]) -> None:
        texts = {w: w.decode() for w in words}
        plain = [w for w, t in texts.items() if t.isalpha()] if self.ends is not None else []
        if plain:  # one token that ends a word for each
            ids = np.array(self.tokenizer.encode(" ".join([texts[w] for w in plain]), add_special_tokens=False).ids, self.dtype)
            stops = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
            if len(stops) == len(plain):
                raw, start = ids.tobytes(), 0
                for w, stop in zip(plain, stops.tolist()):
                    self.known[w] = raw[start:stop]
                    start = stop
        rest = [w for w in words if w not in self.known]
        for w, e in zip(rest, self.tokenizer.encode_batch([texts[w] for w in rest], add_special_tokens=False)):
            self.known[w] = np.array(e.ids, self.dtype).tobytes()


def id_width(tokenizer: str) -> int:
    """Bytes of an id: 2 where the vocabulary allows, else 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4


def _encoder(path: str, width: int) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path, width)
    return _encoders[path]


def _schemas(width: int, length: int) -> tuple[pa.Schema, pa.Schema]:
    ids = pa.uint16() if width == 2 else pa.uint32()
    return (
        pa.schema([("input_ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))]),
        pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]),
    )


class _ShardWriter:
    """Packs ids into sequences; holds one record batch at a time."""

    def __init__(self, sink, width: int, length: int):
        self.schema, self.dtype, self.length = _schemas(width, length)[0], np.dtype(f"<u{width}"), length
        self.out, self.held, self.size, self.sequences = pa.ipc.new_file(sink, self.schema), [], 0, 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= BATCH * self.length * self.dtype.itemsize:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        raw, row = b"".join(self.held), self.length * self.dtype.itemsize
        for at in range(0, len(raw) if last else len(raw) // (BATCH * row) * BATCH * row, BATCH * row):
            part = np.frombuffer(raw[at : at + BATCH * row], self.dtype)
            rows = -(-len(part) // self.length)
            full = np.zeros(rows * self.length, self.dtype)
            full[: len(part)] = part
            mask = pa.array(np.arange(len(full)) < len(part))
            self.out.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(full), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)], schema=self.schema))
            self.sequences += rows
        self.held = [] if last else [raw[len(raw) // (BATCH * row) * BATCH * row :]]
        self.size = sum(map(len, self.held))

    def close(self) -> int:
        self._flush(True)
        self.out.close()
        return self.sequences


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, length: int = SEQUENCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, append `end_id`, write the shards to `path`; the manifest has a row for each shard."""
    spark, width = docs.sparkSession, id_width(tokenizer)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = texts.repartitionByRange(shared.partitions(spark), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def write(batches):
        shard = TaskContext.get().partitionId()
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        encode, end = _encoder(tokenizer, width), int(end_id).to_bytes(width, "little")
        said = {}

        def ids(sink):
            writer, ordinals, sizes = _ShardWriter(sink, width, length), [], []
            for batch in (b for some in ([first], batches) for b in some):
                ordinals.append(batch.column(0))
                for part in arrays.slices(batch, limit=1 << 20):
                    for one in encode(part.column(1).cast(pa.large_binary()).to_pylist()):
                        writer.add(one := one + end)
                        sizes.append(len(one) // width)
            said.update(n_sequences=writer.close(), n_docs=len(sizes), n_tokens=sum(sizes), ordinals=ordinals, sizes=np.array(sizes, np.int64))

        shared.write_atomic(path, f"ids-{shard:06d}.arrow", ids)

        def rows(sink):
            starts = np.cumsum(said["sizes"]) - said["sizes"]
            schema = _schemas(width, length)[1]
            with pa.ipc.new_file(sink, schema) as out:
                out.write_table(pa.table([pa.chunked_array(said["ordinals"]).cast(pa.int64()), pa.array(starts), pa.array(said["sizes"])], schema=schema), max_chunksize=65536)

        shared.write_atomic(path, f"docs-{shard:06d}.arrow", rows)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32())} | {k: pa.array([said[k]], pa.int64()) for k in ("n_docs", "n_tokens", "n_sequences")})

    return shared.keep(dealt.mapInArrow(write, "shard int, n_docs long, n_tokens long, n_sequences long"), "token-manifest")


def read_token_files(manifest: DataFrame, path: str) -> DataFrame:
    """From the files: each document's place in the whole stream, its ids' number and their CRC-32."""
    spark = manifest.sparkSession
    shards = sorted(manifest.select("shard", "n_tokens").collect())  # a row for each file
    starts = accumulate((n for _, n in shards), initial=0)
    listed = spark.createDataFrame([(s, b) for (s, _), b in zip(shards, starts)], "shard int, base long")

    def read(batches):
        for batch in batches:
            for shard, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = pa.ipc.open_file(shared.memory_map(f"{path}/docs-{shard:06d}.arrow")).read_all()
                yield _checksums(pa.ipc.open_file(shared.memory_map(f"{path}/ids-{shard:06d}.arrow")), rows, base)

    return listed.repartition(max(1, len(shards)), "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _checksums(file, rows: pa.Table, base: int) -> pa.RecordBatch:
    left, crcs, held, k = 0, [], np.zeros(0, np.uint32), -1
    batches = iter(range(file.num_record_batches))
    for size in rows.column("n_tokens").to_numpy():
        crc, left = 0, int(size)
        while left:
            if not len(held):
                batch = file.get_batch(next(batches))
                held = batch.column(0).flatten().to_numpy()[batch.column(1).flatten().to_numpy(zero_copy_only=False)].astype("<u4")
            crc, part = zlib.crc32(held[:left].tobytes(), crc), min(left, len(held))
            held, left = held[part:], left - part
        crcs.append(crc)
    starts = rows.column("start").to_numpy() + base
    return pa.RecordBatch.from_arrays([rows.column("doc_id").combine_chunks() if rows.num_rows else pa.array([], pa.int64()), pa.array(starts, pa.int64()), rows.column("n_tokens").combine_chunks(), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def sequence(path: str, shard: int, k: int, length_batch: int = BATCH) -> tuple[pa.Array, pa.Array]:
    """Ids and mask of sequence `k` of a shard, straight from the memory map."""
    file = pa.ipc.open_file(shared.memory_map(f"{path}/ids-{shard:06d}.arrow"))
    batch = file.get_batch(k // length_batch)
    return batch.column(0)[k % length_batch].values, batch.column(1)[k % length_batch].values


def token_index(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files and read them back: doc_id, start, n_tokens, ids_crc32."""
    path = shared.new_path(spark, "tokens")
    return read_token_files(write_token_files(docs, path, tokenizer), path)


def default_tokenizer() -> str:
    """The public 49k word vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    return token_index(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
