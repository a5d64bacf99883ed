"""The fitted sentiment classifier on headlines whose mood is known, and on odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from quotemill.plans import news
from quotemill.plans.sentiment import TEMPERATURES, fit_sentiment, grams

MOODS = {"positive": ["soars", "record profit", "raises outlook"], "negative": ["plunges", "deep loss", "cuts outlook"], "neutral": ["meets analysts", "names director", "opens office"]}
OTHERS = ["Acme", "Globex", "shares", "quarter", "today", "on", "Tuesday", "board", "market", "Europe", "unit"]


def headlines(n, seed):
    """Texts with one phrase of their mood among others; "outlook" alone says nothing, its pair does."""
    rng, out = random.Random(seed), []
    for k in range(n):
        mood = rng.choice(list(MOODS))
        words = rng.sample(OTHERS, 5)
        words.insert(rng.randrange(6), rng.choice(MOODS[mood]))
        out.append((k, " ".join(words), mood))
    return out


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, t, m.upper() + " ") for k, t, m in headlines(600, 1)] + [(-1, None, "positive"), (-2, "", "negative"), (-3, "soars", None), (-4, "opens office", "mixed")]
    return fit_sentiment(spark.createDataFrame(rows, "k long, text string, sentiment string").coalesce(2), width=1 << 12, steps=25)


def test_held_out_accuracy(spark, model):
    assert model.labels == ["negative", "neutral", "positive"] and model.temperature in TEMPERATURES
    unseen = spark.createDataFrame(headlines(300, 2), "k long, text string, mood string").coalesce(2)
    told = model.score(unseen, F.col("text"), confidence="sure").agg(F.avg((F.col("mood") == F.col("sentiment")).cast("double")).alias("right"), F.avg("sure").alias("sure"), F.min("sure").alias("low")).first()
    assert told.right >= 0.95 and 1 / 3 <= told.low and abs(told.sure - told.right) < 0.1


def test_headlines_through_the_model(spark, model):
    rows = [("1", "Acme soars today", None), ("2", " ", "Globex unit plunges"), ("3", None, None), ("4", "...", ""), ("5", "soars " * 20000, None), ("6", "Acme soars today", None)]
    df = spark.createDataFrame(rows, "features string, title string, summary string")
    out = news.score_sentiment(df, model)
    assert out.columns == [*df.columns, "sentiment"]
    assert [r.sentiment for r in out.orderBy("features").collect()] == ["positive", "negative", "neutral", "neutral", "positive", "positive"]
    assert news.score_sentiment(df.where("false"), model).collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_one_label_is_refused(spark):
    for rows in ([], [("a", "positive"), ("b", "positive")]):
        with pytest.raises(ValueError):
            fit_sentiment(spark.createDataFrame(rows, "text string, sentiment string"))


def test_grams(spark):
    held = spark.createDataFrame([("Ätna's peak",), ("one",), ("",), (None,)], "t string").select(grams(F.col("t")).alias("g")).collect()
    assert [r.g for r in held] == [["ätna", "s", "peak", "ätna s", "s peak"], ["one"], [], []]


def test_fit_reads_each_text_once(spark):
    """The words of a labelled text are made once, for the labels, the steps and the temperature together."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(text):
        seen.add(1)
        return text

    rows = spark.createDataFrame([(f"{'good fine' if k % 2 else 'bad poor'} thing {k}", "positive" if k % 2 else "negative") for k in range(60)], "text string, sentiment string")
    fit_sentiment(rows.withColumn("text", told.asNondeterministic()("text")), width=1 << 8, steps=5)
    assert seen.value == 60
