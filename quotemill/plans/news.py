"""News jobs: publishers and weights, silver news, headlines with sentiment."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.calendar import window_bounds
from ..functions.columns import DEFAULT_WEIGHT, PUBLISHER_DOMAINS, base_domain, blank_to_null, headline_text, norm_publisher, publisher_domain, rank_to_weight
from ..operators.aggregations import conditional_counts, publisher_domain_mode
from ..operators.joins import anti_new_publishers, join_news_dims, join_rank
from ..operators.merges import purge_before, refresh_window
from ..operators.windows import dedupe_latest_headline, surrogate_ids
from ..sources.readers import scan_trailing_30d, table_exists
from ..sources.sinks import sink_news_day
from ..sources.versions import load, snapshot
from .prices import Paths
from .sentiment import SentimentModel

#: Words of the default scorer.
POSITIVE = ["beat", "beats", "gain", "gains", "growth", "profit", "record", "rise", "rises", "strong", "surge", "upgrade", "win", "wins"]
NEGATIVE = ["cut", "cuts", "decline", "drop", "drops", "fall", "falls", "fraud", "lawsuit", "loss", "losses", "miss", "misses", "weak", "downgrade"]


def word_list_label(text: Column, positive: list[str] = POSITIVE, negative: list[str] = NEGATIVE) -> Column:
    """positive, negative or neutral, by which list has more words in the text."""
    words = F.split(F.lower(text), r"[^a-z]+")
    count = lambda listed: F.size(F.filter(words, lambda w: w.isin(listed)))
    return F.when(count(positive) > count(negative), "positive").when(count(positive) < count(negative), "negative").otherwise("neutral")


def score_sentiment(headlines: DataFrame, scorer_factory=None, batch_size: int = 32) -> DataFrame:
    """Add `sentiment` from title or summary.

    Without a factory the word lists decide, in column expressions. A `SentimentModel`
    (`fit_sentiment`) labels them in the JVM. Any other factory is called once per worker and
    gives a function from a list of texts to labels; texts go to it in batches.
    """
    text = headline_text("title", "summary")
    if isinstance(scorer_factory, SentimentModel):
        return scorer_factory.score(headlines, text)
    if scorer_factory is None:
        return headlines.withColumn("sentiment", word_list_label(text))

    @F.pandas_udf("string")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = scorer_factory()
        for part in parts:
            texts, labels = part.tolist(), []
            for at in range(0, len(texts), batch_size):
                labels += [str(x).lower() for x in scorer(texts[at : at + batch_size])]
            yield pd.Series(labels, dtype=object)

    return headlines.withColumn("sentiment", score(text))


def silver_news_rows(news: DataFrame, assets: DataFrame, publishers: DataFrame) -> DataFrame:
    """News with asset and publisher ids."""
    joined = join_news_dims(news.drop("asset_id"), assets, publishers)
    return joined.select(*[f.name for f in schemas.SILVER_NEWS.fields])


def silver_news(spark: SparkSession, paths: Paths, as_of: date) -> DataFrame:
    """Write a day's news and give its counts."""
    news = load(spark, paths.table("bronze", "news")).where(F.col("query_date") == F.lit(as_of))
    rows = silver_news_rows(news, load(spark, paths.table("silver", "assets")), load(spark, paths.table("silver", "publishers")))
    sink_news_day(rows, paths.table("silver", "news"), as_of)
    return conditional_counts(rows, ["asset_id", "publisher_id"])


def overrides_table(spark: SparkSession, more: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """Known domains by normalized name (publisher_name_norm, override_domain).

    `more` (publisher_name, publisher_domain) wins over the built-in ones. Its names and
    domains may be as people write them: names are trimmed and lower-cased, domains cut to
    their base. Rows without either are left out; of several rows of a name the last by
    `order` stays, without an order the greatest domain. A table without these two columns
    changes nothing.
    """
    rows = spark.createDataFrame(list(PUBLISHER_DOMAINS.items()), "publisher_name_norm string, override_domain string")
    rows = rows.withColumn("override_domain", base_domain("override_domain"))
    if more is None or not {"publisher_name", "publisher_domain"} <= set(more.columns):
        return rows
    own = more.select(norm_publisher("publisher_name").alias("publisher_name_norm"), base_domain("publisher_domain").alias("_domain"), (F.col(order) if order else F.lit(0)).alias("_at"))
    own = own.where("publisher_name_norm <> '' AND _domain <> ''").groupBy("publisher_name_norm").agg(F.max(F.struct("_at", "_domain"))["_domain"].alias("override_domain"))
    return rows.join(own, "publisher_name_norm", "left_anti").unionByName(own)


def load_overrides(spark: SparkSession, path: str | None) -> DataFrame:
    """The overrides with those of a CSV file with a header; later lines win. Without a path, or where nothing is there, the built-in ones."""
    if not path or not table_exists(spark, path):
        return overrides_table(spark)
    lines = spark.read.csv(path, header=True).withColumn("_line", F.monotonically_increasing_id())
    return overrides_table(spark, lines, "_line")


def publishers_upsert(news: DataFrame, existing: DataFrame, ranks: DataFrame, overrides: DataFrame, now: datetime, default_weight: float = DEFAULT_WEIGHT, refresh_days: int = 30) -> DataFrame:
    """Register new publishers with ids, domains and weights; refresh weights unset or older than 30 days.

    A known domain stays, else the day's most frequent one or the name's fills it. A
    domain without a rank gets the default weight and is labelled so, on refresh too.
    """
    stamp = F.lit(now).cast("timestamp")
    observed = publisher_domain_mode(news) if "domain" in news.columns else None
    named = lambda df: df.join(overrides, "publisher_name_norm", "left").withColumn("_named", publisher_domain("publisher_name", "override_domain")).drop("override_domain")

    def with_domain(df: DataFrame) -> DataFrame:
        rows = named(df)
        if observed is None:
            return rows.withColumn("_domain", blank_to_null("_named"))
        seen = observed.withColumnRenamed("publisher_domain", "_seen")
        return rows.join(seen, "publisher_name_norm", "left").withColumn("_domain", F.coalesce(blank_to_null("_seen"), blank_to_null("_named"))).drop("_seen")

    fresh = surrogate_ids(anti_new_publishers(news, existing), existing, "publisher_id", ["publisher_name_norm"])
    fresh = fresh.select("publisher_id", "publisher_name", "publisher_name_norm", stamp.alias("ingested_ts"))
    # new rows have neither domain nor weight, so both kinds are filled by the same joins
    rows = with_domain(existing.unionByName(fresh, allowMissingColumns=True))
    rows = rows.withColumn("publisher_domain", F.coalesce(blank_to_null("publisher_domain"), "_domain", F.lit(""))).drop("_named", "_domain")
    stale = F.col("weight_updated_ts").isNull() | (F.col("weight_updated_ts") < F.lit(now - timedelta(days=refresh_days)).cast("timestamp")) | F.col("publisher_weight").isNull()
    weight, source = rank_to_weight("rank", default_weight)
    rows = join_rank(rows, ranks).withColumn("_stale", stale)
    rows = rows.withColumns({
        "publisher_weight": F.when(F.col("_stale"), weight).otherwise(F.col("publisher_weight")),
        "weight_source": F.when(F.col("_stale"), source).otherwise(F.col("weight_source")),
        "weight_updated_ts": F.when(F.col("_stale"), stamp).otherwise(F.col("weight_updated_ts")),
    })
    return rows.select(*[f.name for f in schemas.PUBLISHERS.fields])


def headline_window(news: DataFrame, stored: DataFrame | None, as_of: date, scorer=None, ts: str = "query_date") -> DataFrame:
    """Stored headlines not older than the 30-day window, with the window rebuilt, deduplicated and scored."""
    start, end = window_bounds(as_of, 30)
    fresh = score_sentiment(dedupe_latest_headline(news, ["query_date", "title"]), scorer)
    if stored is None:
        return fresh
    return refresh_window(purge_before(stored, ts, start), fresh, ts, start, end)


def gold_headlines(spark: SparkSession, paths: Paths, as_of: date, scorer=None) -> None:
    """Purge, rebuild the last 30 days, and commit the next version; the purge takes place without new rows too."""
    table = snapshot(spark, paths.table("gold", "headlines"))
    stored = table.read() if table.exists() else None
    news = scan_trailing_30d(spark, paths.table("silver", "news"), as_of).drop("date")
    table.replace(headline_window(news, stored, as_of, scorer))
