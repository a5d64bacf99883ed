import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import shared, source_mix, token_files, url_filter

from .data import SCHEMA, corpus, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_mix_meets_targets(spark):
    rows = corpus()
    got = source_mix.mix_digest(*source_mix.mix_sources(documents(spark, rows), block=64), 64).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, open_ = {}, set(order)
    left = sum(sizes.values())
    while open_:  # reshare until none is above its cap
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 3 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    by_id = {r[0]: r for r in rows}
    taken = collections.Counter()
    for r in got:
        source = by_id[r.doc_id][3]
        assert r.size == len(WORD.findall(by_id[r.doc_id][1] or "")) and r.source_size == sizes[source]
        assert r.target == pytest.approx(target[source]) and 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)
    again = source_mix.mix_digest(*source_mix.mix_sources(documents(spark, rows).repartition(3), block=64), 64).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents_and_schedule(spark):
    docs = documents(spark).selectExpr("*", "1 AS copies", "2 AS size", "3 AS row_hash", "4 AS block")
    out = source_mix.mixed_documents(docs, block=64)
    assert out.columns == docs.columns and out.count() > 0
    pieces, slots = source_mix.mix_sources(docs, block=64)
    rows = slots.collect()
    assert len({r.slot for r in rows}) == len(rows)
    assert source_mix.mix_digest(*source_mix.mix_sources(spark.createDataFrame([], SCHEMA))).count() == 0
    assert source_mix.mixed_documents(spark.createDataFrame([(1, "", "en", "a", 0)], SCHEMA)).count() == 1


def test_url_rules_and_terms(spark):
    urls = ["http://A.Com/x", "http://com", "https://example.com/en/1", "http://www.example.com/en/9?q=1", "http://b.net/es/", "https://my-casino.net/", "https://casinos.net/", "http://cheap.net/free?x", "http://x.org/free-free", None, "", "nohost", "ftp://u.org#frag"]
    df = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()}
    assert got[0] == ("a.com", "/x", "com/", "allow") and got[1] == ("com", "", None, "allow")
    assert got[2][2:] == ("example.com/en/", "block") and got[3] == ("www.example.com", "/en/9", "www.example.com/en/", "allow")
    assert got[4][2:] == ("net/es/", "block") and got[5][2:] == (None, "block") and got[6][3] == "allow"
    assert got[7][3] == "block" and got[8][3] == "allow"
    assert got[9] == ("", "", None, "allow") == got[10] == got[11] and got[12][:2] == ("u.org", "")
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_token_round_trip(spark):
    from tokenizers import Tokenizer

    rows = corpus() + [(-1, "Don't STOP now ΣΙΣ é <|endoftext|>x 12,5\n\n !", "en", "s", 1)]
    rows = [(i, t, "x") for i, t, *_ in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    path = shared.new_path(spark, "t")
    manifest = token_files.write_token_files(docs, path, token_files.default_tokenizer(), length=128)
    got = token_files.read_token_files(manifest, path).collect()
    encode = Tokenizer.from_file(token_files.default_tokenizer()).encode
    start, want, stream = 0, [], []
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        stream.append(ids)
    key = lambda r: (r[1], r[2])
    assert sorted(map(tuple, got), key=key) == want
    first = manifest.orderBy("shard").first()
    ids, mask = token_files.sequence(path, first.shard, 0)
    flat = [x for s in stream for x in s]
    assert ids.to_pylist()[: sum(mask.to_pylist())] == flat[: min(128, first.n_tokens)] and len(ids) == 128
    empty = token_files.token_index(spark, docs.limit(0), token_files.default_tokenizer())
    assert empty.count() == 0


def test_mixed_rows_have_the_words_of_the_digest_source_by_source(spark):
    """Rows that stand in two sources are told apart by their source."""
    rows = [(k, " ".join(["w"] * (20 + k % 60)), "en", "a", 1) for k in range(700)]
    rows += [(k, " ".join(["w"] * (20 + k % 60)), "en", "c", 1) for k in range(100)] + [(5, "w w", "en", None, 1), (5, "w w", "en", None, 1)]
    docs = documents(spark, rows)
    digest = source_mix.mix_digest(*source_mix.mix_sources(docs), carry=("source",))
    words = F.sum(F.col("size") * F.col("copies")).alias("n")
    want = {r.source: r.n for r in digest.groupBy("source").agg(words).collect()}
    got = {r.source: r.n for r in source_mix.mixed_documents(docs).groupBy("source").agg(F.sum(source_mix.word_count(F.col("text"))).alias("n")).collect()}
    assert got == want and len(want) == 3
    targets = {r.source: r.target for r in source_mix.source_targets(docs.select("source", source_mix.word_count(F.col("text")).alias("size"))).collect()}
    assert all(abs(got[s] - targets[s]) < 1200 for s in targets)


def test_word_encoder_equals_the_tokenizer_with_a_small_memory(monkeypatch):
    """Marks at odd places, new words in any batch, and a memory that is emptied again and again."""
    from tokenizers import Tokenizer

    from quotemill.llm import token_files as T

    monkeypatch.setattr(T, "_CACHE_WORDS", 3)
    texts = ["", " ", "a.\n", "a.b. c,", "A. B, é. x,\ty q. ", ".", "a..", "a.,", "one two, three.", "one two four", "one"]
    whole = Tokenizer.from_file(T.default_tokenizer())
    encode = T.WordEncoder(T.default_tokenizer(), 2)
    for k in range(0, len(texts), 2):
        got = encode([t.encode() for t in texts[k : k + 2]])
        want = [whole.encode(t, add_special_tokens=False).ids for t in texts[k : k + 2]]
        assert [[int.from_bytes(g[i : i + 2], "little") for i in range(0, len(g), 2)] for g in got] == want
