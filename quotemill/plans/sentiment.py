"""A sentiment classifier fitted on labelled texts, for `score_sentiment`.

Words and pairs of words are hashed into a vector of fixed width, scaled to length 1, and a
multinomial logistic regression with a ridge penalty is fitted by distributed gradient
steps: each step is one tree aggregate over the labelled rows, of which the driver sees the
sum of the gradients (width times labels numbers) and no row. A part of the texts, chosen
by their checksum so that copies stay together, is kept from the fit; on it one aggregate
over a grid of temperatures finds the one with the least log loss, which turns scores into
probabilities. Scoring broadcasts the weights, whose size the width fixes, and stays in the
JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.topk import sentiment_label

_WORDS, _GRAMS, _COUNTS, _FEATURES, _LABEL = (f"_sentiment_{c}" for c in ("words", "grams", "counts", "features", "label"))
_RAW, _PROBABILITY, _PREDICTION = (f"_sentiment_{c}" for c in ("raw", "probability", "prediction"))
_MADE = (_WORDS, _GRAMS, _COUNTS, _FEATURES, _RAW, _PROBABILITY, _PREDICTION)
#: Temperatures that are tried: 2 ** (k / 4).
TEMPERATURES = [2 ** (k / 4) for k in range(-12, 13)]


def words_of(text: Column) -> Column:
    """Lower-case words of letters and digits; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def grams(text: Column) -> Column:
    """The words, then each pair of neighbours."""
    return _with_pairs(words_of(text))


def _with_pairs(words: Column) -> Column:
    more = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(words, F.zip_with(F.slice(words, 1, more), F.slice(words, 2, more), lambda a, b: F.concat(a, F.lit(" "), b)))


def _features(df: DataFrame, text: Column, width: int) -> DataFrame:
    rows = df.withColumn(_WORDS, words_of(text))  # a column of its own: the pairs read it four times
    counted = HashingTF(numFeatures=width, binary=True, inputCol=_GRAMS, outputCol=_COUNTS).transform(rows.withColumn(_GRAMS, _with_pairs(F.col(_WORDS))))
    return Normalizer(inputCol=_COUNTS, outputCol=_FEATURES).transform(counted)


@dataclass(frozen=True)
class SentimentModel:
    """Labels in the order of the weights, the weights, and the temperature of the scores."""

    labels: list[str]
    weights: LogisticRegressionModel
    width: int
    temperature: float = 1.0

    def score(self, df: DataFrame, text: Column, label: str = "sentiment", confidence: str | None = None) -> DataFrame:
        """Add the label of each text, and its probability if asked for; a text without words is neutral, with probability null."""
        rows = self.weights.transform(_features(df, text, self.width))
        scores = F.transform(vector_to_array(_RAW), lambda x: x / self.temperature)
        top = F.array_max(scores)
        sure = 1 / F.aggregate(scores, F.lit(0.0), lambda a, x: a + F.exp(x - top))
        worded = F.size(_WORDS) > 0
        names = F.array(*map(F.lit, self.labels))
        out = {label: F.when(worded, F.element_at(names, F.col(_PREDICTION).cast("int") + 1)).otherwise("neutral")}
        if confidence is not None:
            out[confidence] = F.when(worded, sure)
        return rows.withColumns(out).drop(*_MADE)


def fit_sentiment(labelled: DataFrame, text: str = "text", label: str = "sentiment", width: int = 1 << 16, penalty: float = 1e-4, steps: int = 60) -> SentimentModel:
    """Fit on all rows of `labelled` with a label; other labels than positive and negative count as neutral.

    Rows with a null label are left out. Every tenth text by its checksum serves the
    temperature alone. At least two labels are needed.
    """
    rows = labelled.where(F.col(label).isNotNull()).select(F.coalesce(F.col(text), F.lit("")).alias("text"), sentiment_label(label).alias("label"))
    rows = rows.withColumn("kept", F.crc32(F.encode("text", "UTF-8")) % 10 == 0)
    # texts are read and hashed once; the labels, the fit and the temperature read what is kept of them
    rows = _features(rows, F.col("text"), width).select("kept", "label", _FEATURES).persist()
    try:
        labels = sorted(r.label for r in rows.where("NOT kept").select("label").distinct().collect())  # three at most
        if len(labels) < 2:
            raise ValueError(f"a classifier needs texts of two labels or more, not of {labels}")
        known = rows.where(F.col("label").isin(labels)).withColumn(_LABEL, F.array_position(F.array(*map(F.lit, labels)), F.col("label")).cast("double") - 1)
        steps_of = LogisticRegression(family="multinomial", featuresCol=_FEATURES, labelCol=_LABEL, rawPredictionCol=_RAW, probabilityCol=_PROBABILITY, predictionCol=_PREDICTION, regParam=penalty, maxIter=steps, standardization=False)
        weights = steps_of.fit(known.where("NOT kept"))
        losses = _losses(weights, known.where("kept"))
    finally:
        rows.unpersist()
    best = min((x, t) for x, t in zip(losses, TEMPERATURES))[1] if losses[0] is not None else 1.0
    return SentimentModel(labels, weights, width, best)


def _losses(weights: LogisticRegressionModel, rows: DataFrame):
    """Mean log loss at each temperature; null without rows."""
    scores = vector_to_array(_RAW)
    own = F.element_at(scores, F.col(_LABEL).cast("int") + 1)

    def loss(t: float) -> Column:
        top = F.array_max(scores)
        return F.avg((top - own) / t + F.log(F.aggregate(scores, F.lit(0.0), lambda a, x: a + F.exp((x - top) / t))))

    return weights.transform(rows).agg(*[loss(t).alias(f"t{k}") for k, t in enumerate(TEMPERATURES)]).first()
