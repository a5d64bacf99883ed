"""Runs against a search over every period and start."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quotemill.llm import period_runs
from quotemill.llm.period_runs import collapse_runs, find_runs, minimizers

from .data import corpus, documents


def brute(words):
    """Stretches that repeat with period q and can't be extended, of at least max(6, 4 * q) words, under their smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, size, q) for (s, size), q in found.items())


def of(texts):
    ids, offsets = period_runs.word_ids([[w.encode() for w in t] for t in texts])
    rows = find_runs(ids, offsets).tolist()
    return [[tuple(r[1:]) for r in rows if r[0] == k] for k in range(len(texts))]


def planted(rng, n, alphabet):
    words = [rng.choice(alphabet) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(n), 1 + rng.randrange(max(1, n // 4))
        b = min(n, a + p * rng.randrange(2, 9) + rng.randrange(p))
        for i in range(a, b):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_every_period(seed):
    rng = random.Random(seed)
    texts = [planted(rng, rng.choice([1, 5, 6, 40, 90, 300, 700]), "abcdefgh"[: rng.choice([1, 2, 3, 8])]) for _ in range(30)]
    # periods around each scale's ends, with and without a word to spare
    for q in (8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 65, 100):
        for extra in (-1, 0, 1):
            base = [f"{q}x{i}" for i in range(q)]
            texts.append(["p", *(base * 5)[: 4 * q + extra], "s"])
    # a run of runs: the block repeats, and has runs inside
    block = ["a"] * 7 + ["b", "c"] * 6 + list("defgh")
    texts += [block * 5, [], ["one"], (["a"] * 9 + ["b"] * 9) * 6]
    assert of(texts) == [brute(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("ab"), min_size=1, max_size=40), st.integers(1, 6)), max_size=6))
def test_runs_of_repeated_blocks(parts):
    words = [w for block, times in parts for w in block * times]
    assert of([words, ["x"], words]) == [brute(words), [], brute(words)]


def test_minimizers_are_window_minima():
    rng = np.random.default_rng(3)
    hashes, w, k = rng.integers(1, 60, 200, dtype=np.uint64), 9, 4
    left = np.concatenate((np.arange(120, 0, -1), np.arange(80, 0, -1)))
    want = set()
    for i in range(200):
        if left[i] >= w + k - 1:
            window = hashes[i : i + w]
            want |= {i + int(j) for j in np.flatnonzero(window == window.min())}
    assert set(minimizers(hashes, left, w, k).tolist()) == want


def test_seeds_of_long_periods_come_from_minimizers(monkeypatch):
    words = [f"w{i}" for i in range(50)] * 4
    assert of([words]) == [[(0, 200, 50)]]
    monkeypatch.setattr(period_runs, "minimizers", lambda h, left, w, k: np.zeros(0, np.int64))
    assert of([words]) == [[]]


def contract(doc_id, text):
    """The query's row, from its definition."""
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_equals_brute_force(spark, tmp_path):
    rows = [r for r in corpus(n=150) if len(r[1] or "") < 9000]
    rng = random.Random(1)
    rows += [(1000 + k, " ".join(planted(rng, 200, ["ä", "b", "日本", "d e"])), "en", "s", 1) for k in range(40)]
    rows += [(2000, "a\x0bb\x1cc d\x85e " * 9, "en", "s", 1), (2001, "A a " * 8, None, None, None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = period_runs.op11_period_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    told = [tuple(r) for r in got.collect()]
    key = lambda r: str(r)
    assert sorted(told, key=key) == sorted((contract(r[0], r[1]) for r in rows), key=key)
    assert sum(r[1] > 0 for r in told) > 15


def test_collapse_keeps_any_columns_and_long_texts(spark):
    long = " ".join(["to be or not"] * 60_000)
    docs = spark.createDataFrame([(1, long, "x"), (2, None, None), (3, "a b", "y")], "row long, text string, runs string")
    found = {r["row"]["row"]: (r["row"]["runs"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in collapse_runs(docs).collect()}
    assert found == {1: ("x", [(0, 240_000, 4)], "to be or not"), 2: (None, [], ""), 3: ("y", [], "a b")}
    assert collapse_runs(docs.where("row > 9")).count() == 0
