"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; runs of characters that are no letters become one blank. N-grams of
one to three code points are hashed to 2**15 features; a feature weighs
log(1 + count) * idf, and rows have length 1. The idf covers every training row. The
weights are fitted by follow-the-regularised-leader with an elastic net on a bounded
sample: of each language's different texts with a letter, those with the least hash, and
no more than `sample` of all languages together. Their features are made where the texts
lie. Every fifth text of a language sets the temperature of the probabilities.

A text that is null or has no letter is `und` with score 0, as is every text where nothing
was learned. Languages are the values of the training labels, MAX_LANGUAGES at most (more
are refused); one language alone gets score 1; of languages with equal scores the first in
order is taken. Texts are read whole, however long: they are looked at in pieces, and the
n-grams across two pieces count like any. Repeated rows weigh in the idf as often as they
occur and are drawn once; an empty table gives an empty result. Columns named `lang_pred`
and `score` are replaced, all others are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 15
DIM = 1 << BITS
MAX_LANGUAGES = 256
PIECE = 1 << 20
_letters: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(1 << 16)]))
    out = _letters[0][np.minimum(codes, 0xFFFF)]
    for k in np.flatnonzero(codes > 0xFFFF):
        out[k] = chr(codes[k]).isalpha()
    return out


def features(text: str | None, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and their counts; none where it has no letter."""
    text = (text or "").lower()
    found, tail, before, lettered = np.zeros(DIM, np.int64), np.zeros(0, np.uint32), False, False
    for at in range(0, len(text), piece):
        codes = np.frombuffer(text[at : at + piece].encode("utf-32-le", "surrogatepass"), np.uint32)
        solid = _is_letter(codes)
        lettered = lettered or bool(solid.any())
        # of a run without letters the first stands, as a blank, if a letter is before it
        new = np.where(solid, codes, 32)[solid | np.concatenate(([before], solid[:-1]))]
        before = bool(solid[-1])
        ends = ([32] if at == 0 else [], [32] if at + piece >= len(text) else [])
        codes = np.concatenate((tail, ends[0], new, ends[1])).astype(np.uint32)
        for n in (1, 2, 3):
            first = max(0, len(tail) - n + 1)  # those before were counted with the last piece
            m = len(codes) - n + 1 - first
            if m > 0:
                h = np.full(m, n, np.uint32)
                for k in range(n):
                    h = (h ^ codes[first + k : first + k + m]) * np.uint32(0x9E3779B1)
                    h ^= h >> np.uint32(15)
                found += np.bincount(h >> np.uint32(32 - BITS), minlength=DIM)
        tail = codes[-2:]
    at = np.flatnonzero(found) if lettered else np.zeros(0, np.int64)
    return at, found[at]


def _weigh(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[at]
    return (x / max(np.sqrt((x * x).sum()), 1e-12)).astype(np.float32)


def in_fold(doc_id: str, fold: int = 4, remainder: int = 2) -> Column:
    """crc32 of the id as text, modulo `fold`, is `remainder`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % fold == remainder


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """How many rows have each feature; the last entry counts the rows. Of fixed size."""

    def count(batches):
        total = np.zeros(DIM + 1, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total[features(value.as_py())[0]] += 1
                total[DIM] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["feature", "n"])

    rows = texts.mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    out = np.zeros(DIM + 1, np.int64)
    for r in rows.toArrow().to_pylist():
        out[r["feature"]] = r["n"]
    return out


def _probabilities(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list, labels: np.ndarray, n_labels: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, seed: int = 7) -> np.ndarray:
    """Weights (features x labels) of follow-the-regularised-leader over sparse rows (features, values)."""
    z, n = np.zeros((DIM, n_labels), np.float32), np.zeros((DIM, n_labels), np.float32)
    weight = lambda z, n: np.where(np.abs(z) <= l1, 0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2)).astype(np.float32)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, x = rows[k]
            zs, ns = z[at], n[at]
            w = weight(zs, ns)
            error = _probabilities(x @ w)
            error[labels[k]] -= 1
            g = x[:, None] * error[None, :]
            n[at] = ns + g * g
            z[at] = zs + g - (np.sqrt(n[at]) - np.sqrt(ns)) / alpha * w
    return weight(z, n)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section."""
    loss = lambda t: -np.log(_probabilities(logits / np.exp(t))[np.arange(len(labels)), labels] + 1e-12).mean()
    lo, hi = np.log(0.02), np.log(20)
    for _ in range(40):
        a, b = hi - 0.618 * (hi - lo), lo + 0.618 * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


class Model:
    """Languages, idf, weights and temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.languages, self.idf, self.weights, self.temperature = languages, idf, weights, temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        at, counts = features(text)
        if not len(at) or not self.languages:
            return "und", 0.0
        p = _probabilities(_weigh(at, counts, self.idf) @ self.weights[at] / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def train(docs: DataFrame, sample: int = 6000, lang: str = "lang", text: str = "text") -> Model:
    """Learn from all rows with a language: statistics over all, weights from a sample of at most `sample` rows (one a language at least)."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.col("lang").isNotNull())
    key = F.xxhash64("text", F.lit(11))
    lettered = rows.where(F.col("text").rlike(r"\p{L}"))
    counted = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()  # a row for each language
    languages = sorted(r["lang"] for r in counted)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    frequencies = document_frequencies(rows.select("text"))
    idf = np.log((1 + frequencies[DIM]) / (1 + frequencies[:DIM])).astype(np.float32) + np.float32(1)
    if not languages:
        return Model([], idf, np.zeros((DIM, 0), np.float32), 1.0)
    each = max(1, sample // len(languages))
    different = {r["lang"]: r["n"] for r in lettered.groupBy("lang").agg(F.countDistinct(key).alias("n")).collect()}  # a row for each language
    # twice as many as wanted are drawn on average; of those the first are taken
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, 2 * each / max(1, different.get(k, 0)))))])[F.col("lang")]
    drawn = lettered.withColumn("key", F.shiftrightunsigned(key, 11) / float(1 << 53)).where(F.col("key") < share)
    drawn = drawn.groupBy("lang", "key").agg(F.min("text").alias("text"))
    drawn = drawn.withColumn("_n", F.row_number().over(W.partitionBy("lang").orderBy("key"))).where(F.col("_n") <= each)

    def featured(batches):
        for batch in batches:
            found = [features(v.as_py()) for v in batch.column(2)]
            lists = [pa.array([x[k] for x in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["lang", "key", "at", "counts"])

    def fit(table: pa.Table) -> pa.Table:
        known, table = {k: i for i, k in enumerate(languages)}, table.sort_by([("key", "ascending"), ("lang", "ascending")])
        fitted, checked, seen = [], [], [0] * len(languages)
        for lang, at, counts in zip(table.column("lang").to_pylist(), table.column("at"), table.column("counts")):
            at, counts = at.values.to_numpy().astype(np.int64), counts.values.to_numpy()
            if len(at):  # every fifth of a language is kept for the temperature
                seen[known[lang]] += 1
                (fitted if seen[known[lang]] % 5 else checked).append(((at, _weigh(at, counts, idf)), known[lang]))
        weights = fit_ftrl([r for r, _ in fitted], np.array([k for _, k in fitted], int), len(languages))
        warm = 1.0
        if checked and len(languages) > 1:
            warm = fit_temperature(np.array([x @ weights[at] for (at, x), _ in checked]), np.array([k for _, k in checked]))
        return pa.table({"weights": [weights.tobytes()], "temperature": [warm]})

    drawn = drawn.select("lang", "key", "text").mapInArrow(featured, "lang string, key double, at array<int>, counts array<int>")
    fitted = drawn.groupBy(F.lit(1).alias("all")).applyInArrow(lambda t: fit(t), "weights binary, temperature double").collect()
    if not fitted:
        return Model(languages, idf, np.zeros((DIM, len(languages)), np.float32), 1.0)
    return Model(languages, idf, np.frombuffer(fitted[0]["weights"], np.float32).reshape(DIM, len(languages)), fitted[0]["temperature"])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # features x languages, of fixed size

    def predict(batches):
        for batch in batches:
            said = [held.value.predict(v.as_py()) for v in batch.column(batch.schema.get_field_index(text))]
            columns = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] not in ("lang_pred", "score")]
            names = [n for n in batch.schema.names if n not in ("lang_pred", "score")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([p for p, _ in said], pa.string()), pa.array([s for _, s in said], pa.float64())], names=[*names, "lang_pred", "score"])

    kept = docs.drop("lang_pred", "score")
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(predict, schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(~in_fold("doc_id")).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", in_fold("doc_id").alias("held_out"), "lang_pred", "score")
