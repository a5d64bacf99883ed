"""The manifest against a plain fold over lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quotemill.llm import merkle_manifest
from quotemill.llm.merkle_manifest import build_manifest, climb

from .data import corpus, documents


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes, fanout=16):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def walk(tree, i, start, fanout=16):
    """What `start` in place i folds to, and the siblings on its way."""
    proof, h = [], start
    for level in tree[:-1]:
        a = i // fanout * fanout
        run = list(level[a : a + fanout])
        proof += run[: i - a] + run[i - a + 1 :]
        run[i - a] = h
        h, i = sha(*run), i // fanout
    return h, proof


def brute(rows, fanout=16):
    made = []
    for doc_id, text, lang, source, n_chars in rows:
        head = [field(x) for x in (doc_id, source, lang, n_chars)]
        changed = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            changed = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        made.append((doc_id, source, sha(*head, field(text)), sha(*head, field(changed))))
    sources = sorted({m[1] for m in made}, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted((m for m in made if m[1] == s), key=lambda m: (m[0] is not None, m[0] or 0, m[2])) for s in sources}
    trees = {s: levels([m[2] for m in ordered[s]], fanout) for s in sources}
    top = levels([trees[s][-1][0] for s in sources], fanout)
    out = []
    for k, s in enumerate(sources):
        for i, (doc_id, _, leaf, start) in enumerate(ordered[s]):
            half, proof = walk(trees[s], i, start, fanout)
            folded, more = walk(top, k, half, fanout)
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], sha(*proof, *more), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def query(spark, tmp_path, rows):
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle_manifest.op13_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_query_equals_a_plain_fold(spark, tmp_path):
    rows = [r for r in corpus(n=300) if len(r[1] or "") < 9000]
    rows += [(1000 + k, f"Text {k} ÄÖ", "de", "one" if k < 17 else f"s{k}", k) for k in range(60)]  # 17 leaves; lone leaves
    rows += [(2000, "A", None, "é", 1), (2001, "B", "en", "z", None), (None, "C", None, None, None), (2002, None, "en", "", 0), (2002, "Other", "en", "src1", 0)]
    got = query(spark, tmp_path, rows)
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("rows", [[], [(5, "Alone", "en", "s", 5)], [(10, "ABC", "en", "s", 3), (3, "ABC", "en", None, 3)], [(k, "T", "en", "s", 1) for k in range(16)]])
def test_small_trees(spark, tmp_path, rows):
    assert query(spark, tmp_path, rows) == brute(rows)


def test_upper_nodes_are_stored_in_copies(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "COPY", 8)
    rows = spark.range(300).select("id", F.when(F.col("id") < 200, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("leaf"))
    manifest = build_manifest(rows, "id", "source", ["id"], fanout=4)
    sizes = [r["count"] for r in manifest.nodes.groupBy("tree", "level", "idx").count().collect()]
    assert max(sizes) == 37 and min(sizes) == 1  # the root has 300 leaves
    found = climb(manifest, F.col("leaf"), ["id"]).collect()
    assert len(found) == 300 and all(r["root"] == r["folded_root"] for r in found) and len({r["root"] for r in found}) == 1
    trees = {s: [sha(str(k)) for k in range(300) if (k < 200) == (s == "hot") and (s == "hot" or s == f"s{k % 9}")] for s in ["hot", *[f"s{k}" for k in range(9)]]}
    assert found[0]["root"].hex() == levels([levels(trees[s], 4)[-1][0] for s in sorted(trees)], 4)[-1][0]
    one = {r["id"]: r for r in found}[77]
    half, proof = walk(levels(trees["hot"], 4), 77, sha("77"), 4)
    _, more = walk(levels([levels(trees[s], 4)[-1][0] for s in sorted(trees)], 4), 0, half, 4)
    assert one["proof"].hex() == "".join(proof + more)
