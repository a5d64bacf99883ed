"""The driver's tables in the shape of market tables, as DataFrames and as SQL."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import deal_series

AS_OF = date(2024, 1, 30)
NOW = datetime(2024, 2, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily prices of suppliers from lineitem; unique per asset and date."""
    rows = deal_series(table(spark, d, "lineitem"), "l_suppkey").groupBy(F.col("l_suppkey").alias("asset_id"), F.col("l_shipdate").cast("date").alias("trade_date"))
    out = rows.agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"), F.sum("l_quantity").cast("long").alias("volume"))
    return out.select("asset_id", F.concat(F.lit("S"), "asset_id").alias("symbol"), "trade_date", F.col("low").alias("open"), "high", "low", F.col("high").alias("close"), "volume")


DAILY = """daily AS (SELECT l_suppkey AS asset_id, 'S' || l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS trade_date, min(l_extendedprice) AS open, max(l_extendedprice) AS high,
 min(l_extendedprice) AS low, max(l_extendedprice) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume FROM lineitem GROUP BY 1, 2, 3)"""

_W = "PARTITION BY asset_id ORDER BY trade_date"
FACTORS = (
    DAILY
    + f""", f1 AS (SELECT *, close * volume AS dollar_volume, close / nullif(lag(close, 1) OVER w, 0) - 1 AS returns_1d, close / nullif(lag(close, 5) OVER w, 0) - 1 AS returns_5d,
 close / nullif(lag(close, 21) OVER w, 0) - 1 AS returns_21d, lag(close, 21) OVER w / nullif(lag(close, 252) OVER w, 0) - 1 AS momentum_12_1,
 max(close) OVER ({_W} ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS high_52w, avg(close) OVER ({_W} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS sma_50,
 avg(close) OVER ({_W} ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS sma_200 FROM daily WINDOW w AS ({_W})),
 gold AS (SELECT *, stddev_samp(returns_1d) OVER ({_W} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) * sqrt(252) AS realized_vol_21d, (high_52w - close) / nullif(high_52w, 0) AS pct_below_52w_high,
 close / nullif(sma_50, 0) - 1 AS dist_sma_50, close / nullif(sma_200, 0) - 1 AS dist_sma_200 FROM f1),
 slice AS (SELECT * FROM gold WHERE trade_date = (SELECT max(trade_date) FROM gold))"""
)


def bars(spark: SparkSession, d: str) -> DataFrame:
    """Intraday bars of users from events."""
    v = F.col("value")
    return table(spark, d, "events").select(
        F.col("user_id").alias("asset_id"), F.concat(F.lit("U"), "user_id").alias("symbol"), F.col("ts").alias("timestamp"), v.alias("open"), (v * 1.01).alias("high"), (v * 0.99).alias("low"),
        v.alias("close"), F.get_json_object("props", "$.k").cast("long").alias("volume"), F.lit(1).cast("long").alias("trade_count"), v.alias("vwap"), "event_id",
    )


BARS = """bars AS (SELECT user_id AS asset_id, 'U' || user_id AS symbol, ts AS timestamp, value AS open, value * 1.01 AS high, value * 0.99 AS low, value AS close,
 CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume, CAST(1 AS BIGINT) AS trade_count, value AS vwap, event_id FROM events)"""


def assets(spark: SparkSession, d: str) -> DataFrame:
    """Assets from customers; symbols need normalizing."""
    return table(spark, d, "customer").select(F.col("c_custkey").alias("asset_id"), F.concat(F.lit(" u"), "c_custkey", F.lit(" ")).alias("symbol"), F.col("c_name").alias("name"), (F.col("c_acctbal") > 0).alias("is_active"), F.concat(F.lit("id-"), "c_custkey").alias("source_id"))


ASSETS = "assets AS (SELECT c_custkey AS asset_id, ' u' || c_custkey || ' ' AS symbol, c_name AS name, c_acctbal > 0 AS is_active, 'id-' || c_custkey AS source_id FROM customer)"


def publishers(spark: SparkSession, d: str) -> DataFrame:
    """Publishers from nations; weight by a rank of 10 ** (key % 7), every seventh without."""
    from ..functions.columns import rank_to_weight

    rank = F.when(F.col("n_nationkey") % 7 > 0, F.pow(F.lit(10), F.col("n_nationkey") % 7).cast("long"))
    rows = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("publisher_id"), F.col("n_name").alias("publisher_name"), F.lower("n_name").alias("publisher_name_norm"), F.concat(F.lower(F.replace("n_name", F.lit(" "), F.lit("-"))), F.lit(".com")).alias("publisher_domain"), rank.alias("rank"))
    weight, source = rank_to_weight("rank")
    return rows.withColumns({"publisher_weight": weight, "weight_source": source})


PUBLISHERS = """publishers AS (SELECT *, CASE WHEN rank > 0 THEN least(1.0, greatest(0.05, 1 - log10(rank) / 6)) ELSE 0.05 END AS publisher_weight, CASE WHEN rank > 0 THEN 'tranco' ELSE 'default' END AS weight_source FROM
 (SELECT CAST(n_nationkey AS BIGINT) AS publisher_id, n_name AS publisher_name, lower(n_name) AS publisher_name_norm, lower(replace(n_name, ' ', '-')) || '.com' AS publisher_domain,
 CASE WHEN n_nationkey % 7 > 0 THEN CAST(pow(10, n_nationkey % 7) AS BIGINT) END AS rank FROM nation))"""


def news(spark: SparkSession, d: str) -> DataFrame:
    """Stories from documents: exact copies share their title; publisher by id."""
    rows = table(spark, d, "documents").join(table(spark, d, "nation").select((F.col("n_nationkey")).cast("long").alias("_p"), F.upper("n_name").alias("publisher")), F.col("doc_id") % 25 == F.col("_p"), "left")
    day = F.date_add(F.lit(date(2024, 1, 1)), (F.col("doc_id") % 30).cast("int"))
    return rows.select(
        "doc_id", F.col("source").alias("symbol"), F.lit(None).cast("string").alias("uuid"), F.lit(" ").alias("link"), F.col("text").alias("title"), "publisher", F.col("_p").alias("publisher_id"),
        day.cast("timestamp").alias("provider_publish_time"), F.lit("STORY").alias("type"), F.lit(None).cast("string").alias("summary"), day.alias("query_date"), F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("ingested_ts"),
    )


NEWS = """news AS (SELECT doc_id, source AS symbol, CAST(NULL AS VARCHAR) AS uuid, ' ' AS link, text AS title, upper(n_name) AS publisher, CAST(n_nationkey AS BIGINT) AS publisher_id,
 CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS query_date, doc_id AS ingested FROM documents LEFT JOIN nation ON doc_id % 25 = n_nationkey)"""


def views(spark: SparkSession, d: str) -> DataFrame:
    """Daily views of users from events."""
    rows = table(spark, d, "events").groupBy(F.col("user_id").alias("asset_id"), F.col("ts").cast("date").alias("view_date")).agg(F.count("*").alias("views"))
    return rows.withColumns({"granularity": F.lit("daily"), "ingested_ts": F.col("view_date").cast("timestamp")})


VIEWS = "views AS (SELECT user_id AS asset_id, CAST(ts AS DATE) AS view_date, 'daily' AS granularity, count(*) AS views FROM events GROUP BY 1, 2)"


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs from orders; every seventh customer's have no end."""
    start = F.col("o_orderdate").cast("timestamp")
    seconds = F.col("o_orderkey") % 3600
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("job_name"), F.when(F.col("o_orderstatus") == "F", "FAILURE").when(F.col("o_orderstatus") == "O", "SUCCESS").otherwise("STARTED").alias("status"),
        start.alias("start_time"), F.when(F.col("o_custkey") % 7 > 0, F.timestamp_seconds(F.unix_seconds(start) + seconds)).alias("end_time"), F.when(F.col("o_orderstatus") == "P", "pending").otherwise(" ").alias("error_message"),
        F.timestamp_seconds(F.unix_seconds(start) + 86400).alias("logged_ts"), F.when(F.col("o_custkey") % 7 > 0, seconds.cast("double")).alias("duration_seconds"),
    )


RUNS = """runs AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS job_name, CASE o_orderstatus WHEN 'F' THEN 'FAILURE' WHEN 'O' THEN 'SUCCESS' ELSE 'STARTED' END AS status,
 o_orderdate AS start_time, CASE WHEN o_custkey % 7 > 0 THEN o_orderdate + to_seconds(CAST(o_orderkey % 3600 AS INTEGER)) END AS end_time, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE ' ' END AS error_message,
 o_orderdate + to_seconds(86400) AS logged_ts, CASE WHEN o_custkey % 7 > 0 THEN CAST(o_orderkey % 3600 AS DOUBLE) END AS duration_seconds FROM orders)"""


def materializations(spark: SparkSession, d: str) -> DataFrame:
    """Materialization events from events: the reported key depends on the id."""
    key = F.when(F.col("event_id") % 3 == 0, '"row_count"').when(F.col("event_id") % 3 == 1, '"rows_inserted"').otherwise('"deleted_count"')
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("run_id"), F.lit("daily").alias("job_name"), F.col("event_type").alias("asset_key"), F.col("ts").alias("event_ts"), F.replace("props", F.lit('"k"'), key).alias("metadata_json"))


MATERIALIZATIONS = """mats AS (SELECT CAST(user_id AS VARCHAR) AS run_id, 'daily' AS job_name, event_type AS asset_key, ts AS event_ts, event_id % 3 AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


def constituents(spark: SparkSession, d: str) -> DataFrame:
    """Constituents from parts, with the names of the landed file."""
    return table(spark, d, "part").select(F.concat(F.lit("u"), "p_partkey").alias("Symbol"), F.col("p_name").alias("Security"), F.col("p_brand").alias("GICS Sector"), F.col("p_type").alias("Founded"))


CONSTITUENTS = "constituents AS (SELECT 'U' || p_partkey AS symbol, p_name AS security, p_brand AS gics_sector, p_type AS founded FROM part)"


def hosts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", r"^[^:]+://([^/?#]*)", 1).alias("host"))


HOSTS = "hosts AS (SELECT page_id, regexp_extract(url, '^[^:]+://([^/?#]*)', 1) AS host FROM pages)"


def ranks(spark: SparkSession, d: str) -> DataFrame:
    """Domain ranks from page hosts."""
    return hosts(spark, d).select(F.col("page_id").alias("rank"), F.col("host").alias("domain"))


RANKS = "ranks AS (SELECT page_id AS rank, host AS domain FROM hosts)"


def headlines(spark: SparkSession, d: str) -> DataFrame:
    """Labelled headlines from events: the label from the type, the publisher from the id."""
    label = F.when(F.col("event_type").isin("purchase", "signup"), "positive").when(F.col("event_type") == "error", "negative").otherwise("neutral")
    return table(spark, d, "events").select(F.col("user_id").alias("asset_id"), F.concat(F.lit("U"), "user_id").alias("symbol"), F.col("event_id").cast("string").alias("uuid"), (F.col("event_id") % 25).alias("publisher_id"), F.col("ts").cast("timestamp").alias("provider_publish_time"), label.alias("sentiment"))


HEADLINES = """headlines AS (SELECT user_id AS asset_id, 'U' || user_id AS symbol, CAST(event_id AS VARCHAR) AS uuid, event_id % 25 AS publisher_id, ts AS provider_publish_time,
 CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive' WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END AS sentiment FROM events)"""
