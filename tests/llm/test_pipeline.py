import collections
import zlib

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from quotemill.llm import source_mix, token_files

from .data import corpus, documents


def test_stages_one_by_one(spark, tmp_path):
    rows = corpus(n=60)
    benchmark = [(1, " ".join(f"bench{k}" for k in range(30)))]
    leaked = rows[9][1] + " and " + benchmark[0][1]
    rows += [(None, leaked, "en", "src1", 1), (9, leaked, "en", "src1", 1), (70, "other " * 8 + "words here", "en", "src0", 1), (70, rows[11][1] + " x", "en", "src0", 1)]
    rows += [(300, rows[5][1] + " " + benchmark[0][1], "en", "src1", 1), (301, rows[7][1] + " tail", "en", "src1", 1)]
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages, sf = dict(corpus_pipeline.STAGES), str(tmp_path)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "mixing sources", "token files"]
    first = stages["language ID"](spark, docs, sf)
    assert first.columns == docs.columns
    kept = {r.doc_id for r in first.collect()}
    assert not kept & {r[0] for r in rows if not any(c.isalpha() for c in r[1] or "")}
    assert {r[0] for r in rows[:60]} <= kept
    second = stages["n-gram Jaccard join"](spark, docs, sf).collect()
    assert second and set(second[0].asDict()) == set(docs.columns)
    ids = [r.doc_id for r in second]
    assert ids.count(70) == 1  # of its two texts one is a near copy of document 11
    assert ids.count(1) == 1 and 64 not in ids and 3 in ids  # repeated rows, and a copy of document 3
    third = collections.Counter((r.doc_id, r.text) for r in stages["benchmark decontamination"](spark, docs, sf).collect())
    leaks = {(None, leaked), (9, leaked), (300, rows[-2][1])}
    assert third == collections.Counter((r[0], r[1]) for r in rows if (r[0], r[1]) not in leaks)
    clashing = docs.withColumns({c: F.lit("mine") for c in ("row", "id", "text_key", "score", "component", "lang_pred")})
    for name in ("language ID", "n-gram Jaccard join", "benchmark decontamination", "mixing sources"):
        more, plain = stages[name](spark, clashing, sf), stages[name](spark, docs, sf)
        assert more.columns == clashing.columns and more.where("score <> 'mine' or id <> 'mine'").count() == 0
        assert more.count() == plain.count()
    fourth = stages["mixing sources"](spark, docs, sf)
    digest = source_mix.mix_digest(*source_mix.mix_sources(docs)).collect()
    assert fourth.count() == sum(r.copies for r in digest) and fourth.columns == docs.columns
    final = corpus_pipeline.run(spark, sf).collect()
    assert final and 300 not in {r.doc_id for r in final}
    encode = token_files.WordEncoder(token_files.default_tokenizer(), 2)
    may = collections.defaultdict(set)
    for r in rows:
        ids = np.append(np.frombuffer(encode([(r[1] or "").encode()])[0], "<u2"), 1).astype("<u4")
        may[r[0]] |= {(len(ids), zlib.crc32(ids.tobytes()))} if r[1] != leaked else set()
    assert all((r.n_tokens, r.ids_crc32) in may[r.doc_id] for r in final)
    starts = sorted((r.start, r.n_tokens) for r in final)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents(spark, [(1, "", "en", "s", 0)]).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
