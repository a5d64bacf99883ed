"""The corpus pipeline: documents to token files, in five stages.

Each stage takes what the one before kept, as a table in the shared folder. Language ID
drops texts that are `und` or whose language is unsure; of each group of near duplicates
the row with the smallest id stays; documents with a benchmark passage go; the mix takes
each document as often as its source's target asks; the last stage writes token files and
gives their index.

Rows are told apart by id and text together: rows with one id and different texts are
judged each for itself, a row that repeats both is a copy of the other. A null id is an id
like others, and the last of its group to stay. A null or empty text has no language, so
the first stage drops it; given to a later stage it is a duplicate of nothing, leaks
nothing and has only an end token. Of equal copies any one stays, as they are the same;
texts are read whole, however long. Other columns are carried along whatever their names.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import shared
from quotemill.llm.decontaminate import find_leaks
from quotemill.llm.jaccard_join import near_duplicates
from quotemill.llm.language_id import identify, in_fold, train
from quotemill.llm.source_mix import mixed_documents
from quotemill.llm.token_files import default_tokenizer, token_index

#: Least score of a language that is kept.
LEAST_SCORE = 0.35
#: What tells rows apart.
KEY = ["id", "no_id", "text_key"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Add KEY, which joins null ids too, to rows with doc_id and text_key."""
    return rows.select("*", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"))


def _packed(docs: DataFrame) -> DataFrame:
    """Rows of `docs` as one column, with KEY."""
    text_key = F.xxhash64("text").alias("text_key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return _keyed(docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), text_key)).drop("doc_id")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a sure language; without any label to learn from, those with a letter."""
    model = train(docs.where(~in_fold("doc_id")).select("text", "lang"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = identify(docs.select(row, "text"), model)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("row.*")


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component; texts without words stay."""
    named = _keyed(near_duplicates(docs))
    linked = named.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("no_id", "id", "text_key")).alias("one"))
    keep = shared.keep(linked.select("one.id", "one.no_id", "one.text_key"), "kept")
    packed = _packed(docs)
    # rows that repeat id and text are the same document
    once = packed.join(keep, KEY, "left_semi").groupBy(*KEY).agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    alone = named.where("component IS NULL").select(*KEY).distinct()
    return once.select("row").unionByName(packed.join(alone, KEY, "left_semi").select("row")).select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    leaks = _keyed(find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", "text_key")).select(*KEY).distinct()
    return _packed(docs).join(shared.keep(leaks, "leaks"), KEY, "left_anti").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the token files, in ascending doc_id order."""
    return token_index(spark, docs, default_tokenizer())


STAGES = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("token files", token_stage),
]

#: SQL can express neither the models nor the schedule: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
