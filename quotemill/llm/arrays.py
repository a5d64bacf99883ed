"""Sorted arrays: compact blobs for shuffles, and memory-mapped files in the shared folder."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from . import shared

#: Hashes that a task holds before it sorts and counts them.
FLUSH = 1 << 20


def pack(values: np.ndarray) -> bytes:
    """A sorted uint64 array, or any uint32 array, as compressed byte planes (of differences for uint64)."""
    if values.dtype == np.uint64 and len(values):
        values = np.concatenate((values[:1], np.diff(values)))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    """The array that `pack` was given."""
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    values = np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(dtype).ravel()
    return np.cumsum(values, dtype=np.uint64) if np.dtype(dtype) == np.uint64 else values


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Union of sorted (key, count) runs; counts of equal keys add up."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], (np.add.reduceat(count, first) if len(first) else count)


def shard_blobs(keys: np.ndarray, counts: np.ndarray, shards: np.ndarray):
    """(shard, keys, counts) of each shard present; `shards` ascends with the sorted keys."""
    edges = np.flatnonzero(np.diff(shards)) + 1
    for a, b in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(shards)]))):
        if b > a:
            yield int(shards[a]), pack(keys[a:b]), pack(counts[a:b].astype(np.uint32))


BLOBS = "shard int, keys binary, counts binary"


def blob_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    shard, keys, counts = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], names=["shard", "keys", "counts"])


def merge_blobs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Merge the blobs of one shard."""
    return merge([unpack(x, np.uint64) for x in table.column("keys").to_pylist()], [unpack(x, np.uint32) for x in table.column("counts").to_pylist()])


def write_arrays(uri: str, name: str, *arrays: np.ndarray) -> None:
    """Arrays of one length, one after another, behind their length."""

    def write(sink):
        sink.write(np.int64(len(arrays[0])).tobytes())
        for x in arrays:
            sink.write(np.ascontiguousarray(x).tobytes())

    shared.write_atomic(uri, name, write)


def map_arrays(uri: str, *dtypes) -> list[np.ndarray]:
    """The arrays of a file, memory-mapped."""
    buffer = shared.memory_map(uri)
    n, at, out = int(np.frombuffer(buffer, np.int64, 1)[0]), 8, []
    for d in dtypes:
        out.append(np.frombuffer(buffer, d, n, at))
        at += n * np.dtype(d).itemsize
    return out


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 2 << 20):
    """Runs of rows of `batch` with about `limit` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]))
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)
