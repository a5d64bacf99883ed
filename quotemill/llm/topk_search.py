"""Exact top-k search by distributed histogram selection.

Vectors become whole numbers, floor(scale * x), and a score is an inner product, so every
score is a whole number and each query's k-th best score one of finitely many values. Each
round scores all vectors against all queries and counts the scores of each query in the
bins of its interval; the sums over all tasks tell the bin of the k-th best, which is the
next round's interval, until bins are one wide. A last pass lists the scores that reach
that value; of equal scores the smaller ids win. A task tells of a query's histogram only
the upper bins that hold its own k best, and lists only its own k best of the last pass:
nothing below can be among the k best of all. So what is shuffled does not grow with the
scores, nor with ties.

Queries lie in files of BLOCK vectors in the shared folder, in the order of a round-robin
deal; tasks map one at a time and score it against CHUNK bytes of vectors, so neither side
is ever held whole or broadcast. The own row of a query is searched like others (for k + 1
best) and taken out at the end.

Vectors that are null or have a null or non-finite component, and rows with a null id,
take no part. Only vectors of one length are compared; a vector without components scores
0. Repeated rows are separate vectors: each is a query, and finds the others. Components
count as at most 2**52 and scores as below 2**62 in size. Other columns may have any
name; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shared

#: Bins of a query's histogram, queries of a file, bytes of vectors a task scores at once, vectors of one product.
BINS, BLOCK, CHUNK, SLICE = 1024, 512, 32 << 20, 4096
_COMPONENT, _SCORE = 1 << 52, (1 << 62) - 1


def whole_vectors(ids: pa.Array, vectors: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the vectors that take part, of one length each."""
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().fill_null(math.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    there = vectors.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
    good = there & (bad[ends] == bad[ends - sizes])
    names = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for d in np.unique(sizes[good]):
        rows = np.flatnonzero(good & (sizes == d))
        values = flat[(ends - sizes)[rows][:, None] + np.arange(d)]
        yield names[rows], np.clip(np.floor(scale * values), -_COMPONENT, _COMPONENT).astype(np.int64)


def scores(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where all partial sums are whole numbers below 2**53."""
    d = vectors.shape[1]
    most = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(d, 1)
    if most < 1 << 53:
        return (vectors.astype(np.float64) @ queries.astype(np.float64).T).astype(np.int64)
    if most < _SCORE:
        return vectors @ queries.T
    return np.clip(vectors.astype(object) @ queries.astype(object).T, -_SCORE, _SCORE).astype(np.int64) if d else np.zeros((len(vectors), len(queries)), np.int64)


def _read(uri: str) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Queries of a file by their length: positions, ids and matrix."""
    out, at = {}, 0
    with pa.ipc.open_file(shared.memory_map(uri)) as file:
        for k in range(file.num_record_batches):
            batch = file.get_batch(k)
            n = batch.num_rows
            out[batch.column(1)[0].as_py()] = (np.arange(at, at + n), batch.column(0).to_numpy(), batch.column(2).flatten().to_numpy().reshape(n, -1))
            at += n
    return out


def _chunks(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of one length and about CHUNK bytes."""
    held: dict[int, list] = {}
    for batch in batches:
        for ids, matrix in whole_vectors(batch.column(0), batch.column(1), scale):
            parts = held.setdefault(matrix.shape[1], [])
            parts.append((ids, matrix))
            if sum(m.nbytes + i.nbytes for i, m in parts) >= CHUNK:
                yield np.concatenate([i for i, _ in parts]), np.concatenate([m for _, m in parts])
                parts.clear()
    for parts in held.values():
        if parts:
            yield np.concatenate([i for i, _ in parts]), np.concatenate([m for _, m in parts])


def _best_bins(hist: np.ndarray, k: int | np.ndarray) -> np.ndarray:
    """For each row the bin where the counts from the top reach k; 0 where they never do."""
    upper = np.cumsum(hist[:, ::-1], axis=1)
    reached = upper >= np.reshape(k, (-1, 1))
    return np.where(reached[:, -1], hist.shape[1] - 1 - np.argmax(reached, axis=1), 0)


def _histogram(matrix: np.ndarray, queries: np.ndarray, lo: np.ndarray, width: int, k: int, bins: int = BINS) -> np.ndarray:
    """Counts of each query's scores in `bins` bins of `width` from `lo` on; bins below a query's own k best may lack scores."""
    hist = np.zeros((len(queries), bins), np.int64)
    floor, top = lo.copy(), lo + min(bins * width - 1, 2 * _SCORE)
    for a in range(0, len(matrix), SLICE):
        found = scores(matrix[a : a + SLICE], queries)
        row, query = np.nonzero((found >= floor) & (found <= top))
        at = (found[row, query] - lo[query]) // width
        hist += np.bincount(query * bins + at, minlength=hist.size).reshape(hist.shape)
        floor = np.maximum(floor, lo + _best_bins(hist, k) * width)
    return hist


def _count(files: str, state: str, blocks: int, width: int, bins: int, k: int, scale: float):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, matrix in _chunks(batches, scale):
            for block in range(blocks):
                held = _read(f"{files}/{block}").get(matrix.shape[1])
                if held is None:
                    continue
                at, _, queries = held
                lo = _state(f"{state}/{block}")[0][at]
                hist = _histogram(matrix, queries, lo, width, k, bins)
                hist[np.arange(bins) < _best_bins(hist, k)[:, None]] = 0
                pos, cell = np.nonzero(hist)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pos), block, np.int32)), pa.array(at[pos].astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(hist[pos, cell])], names=["block", "pos", "bin", "n"])

    return count


def _write_state(uri: str, block: int, *arrays: np.ndarray) -> None:
    def write(sink):
        for x in arrays:
            sink.write(np.ascontiguousarray(x, np.int64).tobytes())

    shared.write_atomic(uri, str(block), write)


def _state(uri: str) -> np.ndarray:
    """Rows: the least score of each query's interval, and how many of its best are still sought in it."""
    return np.frombuffer(shared.memory_map(uri), np.int64).reshape(2, -1)


def _refine(state: str, after: str, width: int, bins: int):
    def refine(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        lo, need = _state(f"{state}/{block}").copy()
        hist = np.zeros((len(lo), bins), np.int64)
        hist[table.column("pos").to_numpy(), table.column("bin").to_numpy()] = table.column("n").to_numpy()
        total = hist.sum(axis=1)
        at = _best_bins(hist, np.maximum(1, np.minimum(need, total)))
        above = np.where(np.arange(bins) > at[:, None], hist, 0).sum(axis=1)
        _write_state(after, block, lo + at * width, need - above)
        return pa.table({"block": pa.array([block], pa.int32())})

    return refine


def _list(files: str, state: str, blocks: int, k: int, scale: float):
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, matrix in _chunks(batches, scale):
            for block in range(blocks):
                held = _read(f"{files}/{block}").get(matrix.shape[1])
                if held is None:
                    continue
                at, names, queries = held
                least = _state(f"{state}/{block}")[0][at]
                parts = []
                for a in range(0, len(matrix), SLICE):
                    found = scores(matrix[a : a + SLICE], queries)
                    row, query = np.nonzero(found >= least)
                    parts.append((query, found[row, query], ids[a + row]))
                query, score, name = (np.concatenate(x) for x in zip(*parts))
                order = np.lexsort((name, -score, query))
                query, score, name = query[order], score[order], name[order]
                first = np.searchsorted(query, query)
                best = np.arange(len(query)) - first < k
                query, score, name = query[best], score[best], name[best]
                own = np.array([int(scores(q[None], q[None])[0, 0]) for q in queries], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(query), block, np.int32)), pa.array(at[query].astype(np.int32)), pa.array(names[query]), pa.array(own[query]), pa.array(name), pa.array(score)], names=["block", "pos", "query_id", "own", "vec_id", "score"])

    return listed


def exact_top_k(rows: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding", bins: int = BINS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the k best of all other rows for each row where `queries` holds."""
    spark = rows.sparkSession
    vectors = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("query"))

    def norms(batches):
        for batch in batches:
            for ids, matrix in whole_vectors(batch.column(0), batch.column(1), scale):
                yield pa.RecordBatch.from_arrays([pa.array([float(np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1)).max())]), pa.array([len(ids)])], names=["norm", "n"])

    with shared.temporary(spark):
        longest = vectors.mapInArrow(norms, "norm double, n long").agg(F.coalesce(F.max("norm"), F.lit(0.0))).first()[0]
        asked = vectors.where("query").select("id", "vector")
        blocks = -(-asked.count() // block)
        if not blocks:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        files, state = shared.new_path(spark, "top-k-queries"), shared.new_path(spark, "top-k-state")

        def write_block(batches):
            block, by_size = TaskContext.get().partitionId(), {}
            for batch in batches:
                for ids, matrix in whole_vectors(batch.column(0), batch.column(1), scale):
                    by_size.setdefault(matrix.shape[1], []).append((ids, matrix))
            held = [(d, np.concatenate([i for i, _ in p]), np.concatenate([m for _, m in p])) for d, p in by_size.items()]
            schema = pa.schema([("id", pa.int64()), ("size", pa.int32()), ("vector", pa.list_(pa.int64()))])

            def write(sink):
                with pa.ipc.new_file(sink, schema) as out:
                    for d, ids, matrix in held:
                        offsets = np.arange(len(ids) + 1, dtype=np.int32) * d
                        out.write_batch(pa.record_batch([pa.array(ids), pa.array(np.full(len(ids), d, np.int32)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(matrix.ravel()))], schema=schema))

            shared.write_atomic(files, str(block), write)
            bound = np.concatenate([np.ceil(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)) * longest * (1 + 1e-9)) + 1 for _, _, m in held]) if held else np.zeros(0)
            bound = np.minimum(bound, _SCORE).astype(np.int64)
            _write_state(state, block, -bound, np.full(len(bound), k + 1, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([int(bound.max(initial=0))])], names=["bound"])

        bound = asked.repartition(blocks).mapInArrow(write_block, "bound long").agg(F.max("bound")).first()[0] or 0
        width = 1
        while width * bins < 2 * bound + 1:
            width *= bins
        candidates = vectors.select("id", "vector")
        while width:
            after = shared.new_path(spark, "top-k-state")
            counted = candidates.mapInArrow(_count(files, state, blocks, width, bins, k + 1, scale), "block int, pos int, bin int, n long")
            summed = counted.groupBy("block", "pos", "bin").agg(F.sum("n").alias("n"))
            summed.groupBy("block").applyInArrow(_refine(state, after, width, bins), "block int").write.format("noop").mode("overwrite").save()
            state, width = after, width // bins
        reached = candidates.mapInArrow(_list(files, state, blocks, k + 1, scale), "block int, pos int, query_id long, own long, vec_id long, score long")
        of = W.partitionBy("block", "pos")
        ranked = reached.withColumn("n", F.row_number().over(of.orderBy(F.desc("score"), "vec_id")))
        mine = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own")), F.col("n"))).over(of)
        ranked = ranked.where(F.col("n") <= k + 1).withColumn("mine", F.coalesce(mine, F.lit(k + 2)))
        rank = F.when(F.col("n") > F.col("mine"), F.col("n") - 1).otherwise(F.col("n")).cast("int").alias("rank")
        best = ranked.where("n <> mine").select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
        return shared.keep(best, "top-k", lasting=True)


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all embeddings for each whose id is divisible by 50."""
    return exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH vectors AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM vectors q JOIN vectors c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM scored) WHERE n <= 5
"""
