import collections
import cProfile
import hashlib
import pstats
import random

import numpy as np
import pyarrow as pa
import pytest

from quotemill.llm import suffix_dedup
from quotemill.llm.suffix_groups import suffix_array

from .data import SCHEMA, corpus, documents


def test_suffix_array_equals_sorting():
    for seed in range(400):
        rng = random.Random(seed)
        text = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(texts):
    seen = collections.Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), sum(g and not p for g, p in zip(gone, [0, *gone])), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("heavy", [4000, 2, 1])
def test_removal_equals_brute_force(spark, heavy):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    rows = [r for r in corpus(n=12) if len(r[1] or "") < 9000]
    base, parts = text(1500), [text(n) for n in (399, 400, 401, 700)]
    texts = [base, base]
    for k in range(14):  # near copies, shared passages at various places, overlaps
        edited = list(base)
        for _ in range(rng.choice([1, 3])):
            edited[rng.randrange(len(edited))] = "#"
        texts.append("".join(edited) if k % 2 else text(rng.randrange(300)) + rng.choice(parts) + text(rng.randrange(300)) + rng.choice(parts))
    texts += ["a" * 1200, "ab" * 500, text(200) + "a" * 450, parts[0] * 3, text(50) + parts[3][:420] + text(9) + parts[3][100:], "é" * 300]
    rows += [(100 + k, t, "en", "s", 1) for k, t in enumerate(texts)] + [(100, texts[0], "en", "s", 1)]
    want = brute([(r[1] or "").encode() for r in rows])
    done = suffix_dedup.cut_repeats(documents(spark, rows), heavy=heavy, passage=20).collect()
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in done)
    assert got == collections.Counter((r[0], *w) for r, w in zip(rows, want))


@pytest.mark.parametrize("heavy", [4000, 1])
def test_passages_equal_brute_force(spark, heavy):
    rng = random.Random(6)
    words = lambda n: [f"w{rng.randrange(40000)}" for _ in range(n)]
    parts = [words(n) for n in (50, 51, 52, 80)]
    texts = [[*words(rng.randrange(90)), *rng.choice(parts), *words(rng.randrange(90))] for _ in range(24)]
    texts += [parts[1][:50] + words(30), words(20) + parts[1][1:], words(200), ["x"] * 300, ["x"] * 51, ["y"] * 300]
    inside = words(70)
    texts.append(inside + words(5) + inside)  # twice in one document only
    rows = [(k, " \n"[k % 2].join(t).title() if k % 3 else " ".join(t), "en", "s", 1) for k, t in enumerate(texts)] + [(70, None, "en", "s", 1), (71, "", "en", "s", 1)]
    rows += [rows[26], rows[26]]  # a repeated row is the same document
    seen = collections.defaultdict(set)
    for r in rows:
        w = (r[1] or "").lower().split()
        for k in range(len(w) - 50):
            seen[tuple(w[k : k + 51])].add((r[0], r[1]))
    want = {d for ds in seen.values() if len(ds) > 1 for d, _ in ds}
    got = suffix_dedup.cut_repeats(documents(spark, rows), heavy=heavy, passage=51).select("doc_id", "repeats").collect()
    assert len(got) == len(rows) and {r.doc_id for r in got if r.repeats} == want and len(want) > 15


def test_the_order_decides(monkeypatch):
    """Without the suffix order no repeat is found; with it just the shared windows are."""
    rng = random.Random(9)
    text = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    middle = text(450)
    data = [text(40) + middle + text(109), text(75) + middle + text(74), text(599), text(599)]
    back, near = np.array([40 + 25, 75 + 25, 100, 100]), np.array([0, 0, 0, 0])
    member, offset = suffix_dedup._repeated([1, 1, 1, 2], [0, 1, 2, 3], back, near, data)
    # windows inside the shared 450 bytes start 25 bytes before the anchor or up to 25 after; offsets after it are none of this anchor's
    assert {m: sorted(offset[member == m].tolist()) for m in (0, 1, 3)} == {0: list(range(26)), 1: list(range(26)), 3: list(range(101))}
    assert 2 not in member
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text: [len(text) - 1, *range(len(text) - 1)])
    member, _ = suffix_dedup._repeated([1, 1, 1, 2], [0, 1, 2, 3], back, near, data)
    assert not len(member)


class Frame:
    """Hands the function of `mapInArrow` back."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):  # noqa: N802
        return function


@pytest.mark.parametrize("windows", [suffix_dedup.BYTES, suffix_dedup.words_of(51)])
def test_anchors_are_hashed_by_the_batch(windows):
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(rng.randrange(900))) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(range(300), pa.int64()), pa.array(texts)], names=["id", "row", "text"])
    find, profile = suffix_dedup._anchors_of(Frame(), windows), cProfile.Profile()
    made = profile.runcall(lambda: sum(b.num_rows for b in find([batch])))
    assert made > 5000 and pstats.Stats(profile).total_calls < made / 2  # some calls a batch, none an anchor


def test_long_texts_are_anchored_in_parts():
    rng = random.Random(12)
    texts = [bytes(rng.randrange(97, 123) for _ in range(n)) for n in (0, 399, 400, 5000, 3000, 0, 1700)]
    texts += [texts[3], b"\0" * 1500, b"\0" * 900]
    units, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = b"".join(texts)
    for limit in (1 << 18, 2000, 450, 37):
        keys, contexts, covered = {}, {}, []
        for at, first, last, key, context in suffix_dedup.anchors(units, offsets, limit=limit):
            for a, b, c, k, h in zip(*(x.tolist() for x in (at, first, last, key, context))):
                assert b <= c <= a < b + 200
                assert keys.setdefault(k, whole[a : a + 200]) == whole[a : a + 200]
                assert contexts.setdefault(h, (a - b, a - c, whole[b : c + 400])) == (a - b, a - c, whole[b : c + 400])
                covered += range(b, c + 1)
        assert len(set(keys.values())) == len(keys) and len(set(contexts.values())) == len(contexts)
        assert covered == [i for a, b in zip(offsets[:-1], offsets[1:]) for i in range(a, b - 399)]


def test_blocks_that_occur_once_are_not_sorted(monkeypatch):
    rng = random.Random(13)
    text = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    sizes, sort = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda x: sizes.append(len(x)) or sort(x))
    key, back, near = text(200), np.full(40, 199), np.zeros(40, np.int64)
    data = [text(199) + key + text(200) for _ in range(40)]
    member, _ = suffix_dedup._repeated([1] * 40, list(range(40)), back, near, data)
    assert not len(member) and not sizes
    data[7] = data[3]
    member, _ = suffix_dedup._repeated([1] * 40, list(range(40)), back, near, data)
    assert set(member.tolist()) == {3, 7} and sizes == [25]  # two strings of eleven blocks, their ends and the last symbol


def test_empty(spark):
    assert suffix_dedup.cut_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
