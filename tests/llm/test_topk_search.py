"""Top-k search against sorting all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import topk_search
from quotemill.llm.topk_search import exact_top_k

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=5, scale=256):
    """(query_id, rank, vec_id, score) of all queries, in Python's whole numbers."""
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(good):
        if i % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(good) if m != n and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def vectors(seed, n=400, d=8):
    rng = random.Random(seed)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(d)]) for k in range(n)]
    rows += [(n + k, rows[7][1]) for k in range(60)]  # ties
    rows += [rows[100], rows[100], rows[3], (150, [0.5] * d), (None, [0.1] * d), (n + 70, None), (n + 71, [None] + [0.1] * (d - 1)), (n + 72, [math.nan] * d), (650, [math.inf] * d)]
    rows += [(700, [0.5, 0.5]), (701, [0.25, -1.0]), (750, []), (751, []), (800, [1.0])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bins,block,k", [(1024, 512, 5), (4, 3, 5), (16, 5, 1), (64, 2, 40)])
def test_search_equals_sorting(spark, bins, block, k):
    rows = vectors(bins)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = exact_top_k(df, F.col("vec_id") % 50 == 0, k=k, bins=bins, block=block)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, k)


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(k * 25, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 5, 6]) for _ in range(6)]) for k in range(60)]
    got = exact_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    big = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [-1e300, 0.0])], SCHEMA)
    assert [tuple(r)[2:] for r in exact_top_k(big, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, (1 << 62) - 1), (2, 1 - (1 << 62))]


def test_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame(vectors(1), SCHEMA)
    assert exact_top_k(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0
    assert exact_top_k(df, F.lit(False)).count() == 0
    more = df.withColumns({c: F.lit("mine") for c in ("id", "vector", "query", "block", "pos", "score", "rank", "n", "own")})
    told = lambda x: sorted(tuple(r) for r in exact_top_k(x, F.col("vec_id") % 50 == 0).collect())
    assert told(more) == told(df)


def test_tasks_tell_only_what_can_be_best():
    rng = np.random.default_rng(1)
    matrix, queries = rng.integers(-200, 200, (900, 8)), rng.integers(-200, 200, (6, 8))
    lo, width = np.full(6, -400_000), 1024
    full = topk_search._histogram(matrix, queries, lo, width, 10**9)
    few = topk_search._histogram(matrix, queries, lo, width, 6)
    assert full.sum() == 900 * 6
    at = topk_search._best_bins(full, 6)
    for q in range(6):
        assert full[q, at[q] :].sum() >= 6 > full[q, at[q] + 1 :].sum()
        assert (few[q, at[q] :] == full[q, at[q] :]).all()
