"""Extra columns with the names that operators use inside change no result; ties have one."""

import pytest
from pyspark.sql import functions as F

from quotemill.llm import decontaminate, divergence, jaccard_join, language_id, license_scan, ngram_model, source_mix, suffix_dedup, token_files, url_filter

from .data import corpus, documents

NAMES = "row id no hash key n size node block token slot ord epoch score lang_pred spans licence path found position text_key component word words bucket item_id cosine rule verdict host _hash _no copies taken target begin upto rn n_words kept lo hi".split()
ITEM = " ".join(f"bench{k}" for k in range(30))


def scan(docs):
    return license_scan.scan(docs.withColumn("path", F.concat("source", F.lit("/a"))))


RUNS = {
    "op1": lambda d: ngram_model.score(d, ngram_model.train(d)),
    "op2": lambda d: url_filter.judge_urls(d.withColumn("url", F.concat(F.lit("http://a.net/es/"), "text"))).select("doc_id", "host", "path", "rule", "verdict"),
    "op3": lambda d: language_id.identify(d, language_id.train(d)).select("doc_id", "lang_pred", "score"),
    "op4": lambda d: source_mix.mix_digest(*source_mix.mix_sources(d)),
    "op4 rows": lambda d: source_mix.mixed_documents(d).select("doc_id", "text"),
    "op5": lambda d: divergence.quality(d, divergence.language_references(d)),
    "op6": lambda d: decontaminate.find_leaks(d, d.sparkSession.createDataFrame([(1, ITEM), (2, ITEM), (3, None)], "item_id long, text string")),
    "op7": lambda d: suffix_dedup.cut_repeats(d, passage=20),
    "op8": lambda d: jaccard_join.near_duplicates(d, links=True),
    "op9": scan,
    "op10": lambda d: token_files.token_index(d.sparkSession, d, token_files.default_tokenizer()),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_extra_columns_do_no_harm(spark, name):
    rows = [r for r in corpus(n=24) if len(r[1] or "") < 9000]
    rows += [(80, "more text " + ITEM, "en", "src1", 1), (81, rows[5][1], "en", None, 1)]
    docs = documents(spark, rows)
    plain = RUNS[name](docs)
    more = RUNS[name](docs.withColumns({c: F.lit("mine") for c in NAMES}))
    columns = [c for c in plain.columns if c in more.columns]
    assert columns == plain.columns
    told = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())
    got = told(plain)
    assert got and got == told(more)
