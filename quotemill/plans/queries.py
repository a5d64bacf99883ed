"""One query per operator over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import calendar as cal
from ..functions import columns as C
from ..operators import aggregations as A
from ..operators import filters as P
from ..operators import joins as J
from ..operators import merges as M
from ..operators import topk as K
from ..operators import windows as V
from ..sources import readers as R
from ..sources import sinks as S
from ..sources.scratch import scratch_path
from ..sources.versions import load
from . import activity, news, prices, quality, runlog, state
from . import adapters as X
from . import assets as AS
from .sentiment import fit_sentiment

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: Averages of prices: whole cents over up to 200 rows can lie on a rounding border, which this shift avoids.
SHIFT = 0.00003
_SHIFTED = ("sma_50", "sma_200")


def rounded(column: str):
    """Column rounded for comparison."""
    return (F.round(F.col(column) + SHIFT, 3) if column in _SHIFTED else F.round(F.col(column), 3 if column in ("dollar_volume", "high_52w") else 6)).alias(column)


def rounded_sql(column: str) -> str:
    """The same in SQL."""
    return f"round({column} + {SHIFT:.5f}, 3) AS {column}" if column in _SHIFTED else f"round({column}, {3 if column in ('dollar_volume', 'high_52w') else 6}) AS {column}"


D1, D15, D30 = date(2024, 1, 1), date(2024, 1, 15), date(2024, 1, 30)


def query(name: str, sql: str | None = None, with_: tuple[str, ...] = ()):
    """Register a function (spark, sf_dir) -> DataFrame; `with_` are the SQL's common tables."""

    def register(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = ("WITH " + ", ".join(with_) + " " if with_ else "") + sql
        return f

    return register


def one(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


# --- 2.1 sources ---------------------------------------------------------------------------------

_PRICE_COLS = ("event_id", "symbol", "close", "volume")


def _silver_root(spark, d: str) -> str:
    """Bars written as daily partitions."""
    root = scratch_path(spark, "silver-prices")
    S.sink_replace_day(X.bars(spark, d), root)
    return root


@query("scan_day_range", "SELECT event_id, symbol, close, volume FROM bars WHERE timestamp >= TIMESTAMP '2024-01-15' AND timestamp < TIMESTAMP '2024-01-16'", (X.BARS,))
def _(spark, d):
    return R.scan_day_range(spark, _silver_root(spark, d), D15).select(*_PRICE_COLS)


@query("scan_silver_day", "SELECT event_id, symbol, close, volume FROM bars WHERE CAST(timestamp AS DATE) = DATE '2024-01-15'", (X.BARS,))
def _(spark, d):
    return R.scan_silver_day(spark, _silver_root(spark, d), D15).select(*_PRICE_COLS)


@query("scan_month", "SELECT event_id, symbol, close, volume FROM bars WHERE timestamp >= TIMESTAMP '2024-01-01' AND timestamp < TIMESTAMP '2024-02-01'", (X.BARS,))
def _(spark, d):
    return R.scan_month(spark, _silver_root(spark, d), D15).select(*_PRICE_COLS)


@query("scan_active_bars", "SELECT event_id, symbol, close, volume FROM bars WHERE symbol IN (SELECT upper(trim(symbol)) FROM assets WHERE is_active)", (X.BARS, X.ASSETS))
def _(spark, d):
    return R.scan_active_bars(X.bars(spark, d), X.assets(spark, d)).select(*_PRICE_COLS)


@query("scan_trailing_30d", "SELECT doc_id, symbol, query_date FROM news WHERE query_date BETWEEN DATE '2024-01-15' - 29 AND DATE '2024-01-15'", (X.NEWS,))
def _(spark, d):
    root = scratch_path(spark, "news")
    X.news(spark, d).withColumn("date", F.col("query_date")).write.partitionBy("date").parquet(root)
    return R.scan_trailing_30d(spark, root, D15).select("doc_id", "symbol", "query_date")


@query("scan_trailing_59d", "SELECT asset_id, view_date, views FROM views WHERE view_date BETWEEN DATE '2024-01-20' - 58 AND DATE '2024-01-20'", (X.VIEWS,))
def _(spark, d):
    root = scratch_path(spark, "pageviews")
    X.views(spark, d).write.parquet(root)
    return R.scan_trailing_59d(spark, root, date(2024, 1, 20)).select("asset_id", "view_date", "views")


@query("view_prices_compact", "SELECT symbol, count(*) AS bars, max(close) AS top FROM bars GROUP BY symbol", (X.BARS,))
def _(spark, d):
    root = scratch_path(spark, "compact")
    S.sink_compact_month(X.bars(spark, d), root)
    R.view_prices_compact(spark, root)
    return spark.sql("SELECT symbol, count(*) AS bars, max(close) AS top FROM silver_prices_compact GROUP BY symbol")


@query("view_news", "SELECT symbol, count(*) AS stories FROM news GROUP BY symbol", (X.NEWS,))
def _(spark, d):
    root = scratch_path(spark, "news")
    X.news(spark, d).withColumn("date", F.col("query_date")).write.partitionBy("date").parquet(root)
    R.view_news(spark, root)
    return spark.sql("SELECT symbol, count(*) AS stories FROM silver_news GROUP BY symbol")


@query("view_pageviews", "SELECT asset_id, CAST(sum(views) AS BIGINT) AS views FROM views GROUP BY asset_id", (X.VIEWS,))
def _(spark, d):
    root = scratch_path(spark, "pageviews")
    X.views(spark, d).write.parquet(root)
    R.view_pageviews(spark, root, aliases=("pageviews_before",))
    return spark.sql("SELECT asset_id, sum(views) AS views FROM pageviews_before GROUP BY asset_id")


@query("scan_rank_csv", "SELECT rank, domain FROM ranks", (X.HOSTS, X.RANKS))
def _(spark, d):
    path = scratch_path(spark, "ranks")
    X.ranks(spark, d).select("rank", "domain").write.csv(path)
    return R.scan_rank_csv(spark, path)


_SNAP = "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem WHERE CAST(l_shipdate AS DATE) = (SELECT {} FROM lineitem) GROUP BY ALL"


@query("snapshot_as_of", _SNAP.format("max(CAST(l_shipdate AS DATE)) FILTER (CAST(l_shipdate AS DATE) <= DATE '1996-03-03')"))
def _(spark, d):
    rows = X.table(spark, d, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    return R.snapshot_as_of(rows, date(1996, 3, 3), "day").groupBy("l_orderkey", "l_linenumber", "day").agg(F.count("*").alias("n"))


@query("snapshot_latest", _SNAP.format("max(CAST(l_shipdate AS DATE))"))
def _(spark, d):
    rows = X.table(spark, d, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    return R.snapshot_latest(rows, "day").groupBy("l_orderkey", "l_linenumber", "day").agg(F.count("*").alias("n"))


@query("ingest_bars", "SELECT symbol, count(*) AS bars FROM bars GROUP BY symbol", (X.BARS,))
def _(spark, d):
    raw = X.bars(spark, d).withColumn("symbol", F.lower("symbol"))
    return R.ingest_bars(raw).where("ingested_ts IS NOT NULL").groupBy("symbol").agg(F.count("*").alias("bars"))


@query("ingest_news_json", "SELECT 'U' || user_id AS symbol, CAST(event_id AS VARCHAR) AS uuid, event_type AS title, CAST(to_timestamp(epoch(ts)::BIGINT) AT TIME ZONE 'UTC' AS DATE) AS published FROM events")
def _(spark, d):
    story = F.struct(F.col("event_id").cast("string").alias("uuid"), F.col("event_type").alias("title"), F.rint(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("providerPublishTime"))  # feeds give whole seconds, the nearest
    raw = X.table(spark, d, "events").groupBy(F.concat(F.lit("u"), "user_id").alias("symbol"), F.col("ts").cast("date")).agg(F.to_json(F.collect_list(story)).alias("payload"))
    return R.ingest_news_json(raw, query_date=D15).select("symbol", "uuid", "title", F.col("provider_publish_time").cast("date").alias("published"))


@query("ingest_pageviews_json", "SELECT 'U' || asset_id AS symbol, CASE WHEN asset_id % 2 = 0 THEN 'own' ELSE 'A' || asset_id END AS article, 'en.wikipedia.org' AS project, views, '20240115' AS view_date FROM views WHERE view_date = DATE '2024-01-15'", (X.VIEWS,))
def _(spark, d):
    item = F.array(F.struct(F.when(F.col("asset_id") % 2 == 0, "own").otherwise("").alias("article"), F.lit("2024011500").alias("timestamp"), "views"))
    raw = X.views(spark, d).where(F.col("view_date") == F.lit(D15)).select(F.concat(F.lit("U"), "asset_id").alias("symbol"), F.lit("x").alias("company_name"), F.concat(F.lit("A"), "asset_id").alias("article"), F.to_json(item).alias("payload"))
    return R.ingest_pageviews_json(raw, D15).select("symbol", "article", "project", "views", "view_date")


@query("ingest_title_bindings", "SELECT symbol, title FROM (SELECT 'P' || (p_partkey % 100) AS symbol, replace(p_name, ' ', '_') AS title, row_number() OVER (PARTITION BY p_partkey % 100 ORDER BY p_partkey DESC) AS k FROM part) WHERE k = 1")
def _(spark, d):
    url = F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.replace("p_name", F.lit(" "), F.lit("%20")))
    raw = X.table(spark, d, "part").select(F.concat(F.lit(" p"), F.col("p_partkey") % 100).alias("ticker"), url.alias("article"), F.col("p_partkey").alias("seq"))
    return R.ingest_title_bindings(raw)


@query("ingest_assets", "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name FROM supplier")
def _(spark, d):
    return R.ingest_assets(X.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))).where("ingested_ts IS NOT NULL").select("id", "name")


@query("schema_probe", "SELECT count(*) AS rows, 'ingested_ts,nothing' AS missing FROM bars", (X.BARS,))
def _(spark, d):
    rows = X.bars(spark, d)
    missing = R.schema_probe(rows, {"asset_id", "ingested_ts", "nothing"})
    return rows.agg(F.count("*").alias("rows")).select("rows", F.lit(",".join(missing)).alias("missing"))


@query("table_exists", "SELECT count(*) AS rows, true AS there, false AS missing_there FROM region")
def _(spark, d):
    rows = X.table(spark, d, "region")
    return rows.agg(F.count("*").alias("rows")).select("rows", F.lit(R.table_exists(spark, f"{d}/region.parquet")).alias("there"), F.lit(R.table_exists(spark, f"{d}/nothing.parquet")).alias("missing_there"))


# --- 2.2 sinks and mutation -----------------------------------------------------------------------


@query("sink_replace_day", "SELECT symbol, CAST(timestamp AS DATE) AS day, count(*) AS bars, round(sum(close), 4) AS total FROM bars WHERE NOT (CAST(timestamp AS DATE) = DATE '2024-01-15' AND asset_id % 2 = 0) GROUP BY 1, 2", (X.BARS,))
def _(spark, d):
    root = _silver_root(spark, d)
    S.sink_replace_day(X.bars(spark, d).where((F.col("timestamp").cast("date") == F.lit(D15)) & (F.col("asset_id") % 2 == 1)), root)
    return load(spark, root).groupBy("symbol", F.col("timestamp").cast("date").alias("day")).agg(F.count("*").alias("bars"), F.round(F.sum("close"), 4).alias("total"))


@query("sink_bronze_symbol_day", "SELECT symbol, CAST(timestamp AS DATE) AS day, count(*) AS bars FROM bars GROUP BY 1, 2", (X.BARS,))
def _(spark, d):
    root, rows = scratch_path(spark, "bronze"), X.bars(spark, d).withColumn("date", F.col("timestamp").cast("date"))
    S.sink_bronze_symbol_day(rows, root)
    S.sink_bronze_symbol_day(rows.where("asset_id % 2 = 0"), root)
    return spark.read.parquet(root).groupBy("symbol", F.col("date").cast("date").alias("day")).agg(F.count("*").alias("bars"))


@query("sink_compact_month", "SELECT symbol, CAST(year(timestamp) AS INTEGER) AS year, strftime(timestamp, '%m') AS month, count(*) AS bars FROM bars GROUP BY 1, 2, 3", (X.BARS,))
def _(spark, d):
    root = scratch_path(spark, "compact")
    S.sink_compact_month(X.bars(spark, d), root)
    rows = spark.read.parquet(root)
    return rows.groupBy("symbol", F.col("year").cast("int").alias("year"), F.lpad(F.col("month").cast("string"), 2, "0").alias("month")).agg(F.count("*").alias("bars"))


@query("sink_news_day", "SELECT symbol, count(*) AS stories FROM news WHERE query_date = DATE '2024-01-15' GROUP BY symbol", (X.NEWS,))
def _(spark, d):
    root = scratch_path(spark, "news")
    rows = X.news(spark, d)
    S.sink_news_day(rows.where(F.col("query_date") == F.lit(D1)), root, D1)
    S.sink_news_day(rows.where(F.col("query_date") == F.lit(D15)), root, D15)
    return R.scan_silver_day(spark, root, D15).groupBy("symbol").agg(F.count("*").alias("stories"))


_KEEP = "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 2 DESC, event_id DESC) AS k FROM events) WHERE k = 1"


@query("sink_merge_keep_last", _KEEP)
def _(spark, d):
    path, rows = scratch_path(spark, "merge"), X.table(spark, d, "events").select("user_id", "event_type", "event_id")
    S.sink_merge_keep_last(rows.where("event_id % 2 = 0"), path, ["user_id", "event_type"], "event_id")
    return S.sink_merge_keep_last(rows.where("event_id % 2 = 1"), path, ["user_id", "event_type"], "event_id")


@query("merge_keep_last", _KEEP)
def _(spark, d):
    rows = X.table(spark, d, "events").select("user_id", "event_type", "event_id")
    return M.merge_keep_last(rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1"), ["user_id", "event_type"], "event_id")


@query("replace_date_slice", "SELECT CAST(date_trunc('month', trade_date) AS DATE) AS month, count(*) AS n, round(sum(close), 2) AS total FROM daily WHERE NOT (date_trunc('month', trade_date) = DATE '1998-03-01' AND asset_id % 2 = 0) GROUP BY 1", (X.DAILY,))
def _(spark, d):
    """All of `daily` in slices of a month, one of them replaced."""
    root, rows = scratch_path(spark, "gold"), X.daily(spark, d).withColumn("month", F.trunc("trade_date", "MM"))
    rows.repartition("month").write.partitionBy("month").parquet(root)
    S.replace_date_slice(rows.where("asset_id % 2 = 1"), root, date(1998, 3, 1), "month")
    return spark.read.parquet(root).groupBy(F.col("month").cast("date").alias("month")).agg(F.count("*").alias("n"), F.round(F.sum("close"), 2).alias("total"))


@query("purge_before", "SELECT asset_id, view_date, views FROM views WHERE view_date >= DATE '2024-01-15'", (X.VIEWS,))
def _(spark, d):
    return M.purge_before(X.views(spark, d), "view_date", D15).select("asset_id", "view_date", "views")


@query("refresh_window", "SELECT asset_id, view_date, CASE WHEN view_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' THEN views * 2 ELSE views END AS views FROM views", (X.VIEWS,))
def _(spark, d):
    rows = X.views(spark, d).select("asset_id", "view_date", "views")
    start, end = date(2024, 1, 10), date(2024, 1, 20)
    return M.refresh_window(rows, P.filter_date_range(rows, "view_date", start, end).withColumn("views", F.col("views") * 2), "view_date", start, end)


@query("update_from", "SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL AND c_custkey % 2 = 0 THEN s_acctbal ELSE c_acctbal END AS c_acctbal FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def _(spark, d):
    source = X.table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return M.update_from(X.table(spark, d, "customer").select("c_custkey", "c_acctbal"), source, ["c_custkey"], ["c_acctbal"], F.col("c_custkey") % 2 == 0)


@query("update_correlated", "SELECT c_custkey, s_acctbal AS c_acctbal FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def _(spark, d):
    source = X.table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return M.update_correlated(X.table(spark, d, "customer").select("c_custkey", "c_acctbal"), source, ["c_custkey"], "c_acctbal")


@query("replace_table", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def _(spark, d):
    path, rows = scratch_path(spark, "table"), X.table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    S.replace_table(rows, path)
    S.replace_table(rows.where("n_regionkey = 1").drop("n_regionkey"), path)
    return load(spark, path)


@query("add_column_if_missing", "SELECT p_partkey, p_size, CAST(NULL AS DOUBLE) AS score, FALSE AS flag FROM part")
def _(spark, d):
    rows = C.add_column_if_missing(X.table(spark, d, "part").select("p_partkey", "p_size"), "p_size", "int")
    return C.add_column_if_missing(C.add_column_if_missing(rows, "score", "double"), "flag", "boolean", False)


@query("append_log", "SELECT job_name, 2 * count(*) AS n FROM runs GROUP BY job_name", (X.RUNS,))
def _(spark, d):
    path, rows = scratch_path(spark, "log"), X.runs(spark, d)
    S.append_log(rows, path)
    S.append_log(rows, path)
    return spark.read.parquet(path).groupBy("job_name").agg(F.count("*").alias("n"))


@query("append_once", "SELECT job_name, count(*) AS n FROM runs GROUP BY job_name", (X.RUNS,))
def _(spark, d):
    """Two batches, each appended again by a repeated run."""
    path, rows = scratch_path(spark, "log"), X.runs(spark, d)
    failed = F.col("status") == "FAILURE"
    for batch, part in (("failed", rows.where(failed)), ("others", rows.where(~failed))):
        for _attempt in range(2):
            S.append_once(part, path, batch)
    return S.read_log(spark, path, rows.schema).groupBy("job_name").agg(F.count("*").alias("n"))


@query("replace_run_rows", "SELECT run_id, CASE WHEN status = 'FAILURE' THEN 'AGAIN' ELSE status END AS status FROM runs", (X.RUNS,))
def _(spark, d):
    rows = X.runs(spark, d).select("run_id", "status")
    return M.replace_run_rows(rows, rows.where("status = 'FAILURE'").withColumn("status", F.lit("AGAIN")))


@query("dedupe_run_check", "SELECT run_id, job_name AS check_name, CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END AS v FROM runs", (X.RUNS,))
def _(spark, d):
    rows = X.runs(spark, d).select("run_id", F.col("job_name").alias("check_name"), "status")
    return M.dedupe_run_check(rows.select("run_id", "check_name", F.lit(0).alias("v")), rows.where("status = 'SUCCESS'").select("run_id", "check_name", F.lit(1).alias("v")))


@query("sink_counts", "SELECT greatest(n - o, 0) AS rows_inserted, greatest(o - n, 0) AS rows_deleted FROM (SELECT count(*) FILTER (o_orderstatus = 'F') AS o, count(*) AS n FROM orders)")
def _(spark, d):
    rows = X.table(spark, d, "orders")
    return M.sink_counts(rows.where("o_orderstatus = 'F'"), rows)


# --- 2.3 projections and filters ------------------------------------------------------------------


@query("rename_known", "SELECT p_partkey AS asset_id, p_name AS name FROM part")
def _(spark, d):
    return P.rename_known(X.table(spark, d, "part").select("p_partkey", "p_name"), {"p_partkey": "asset_id", "p_name": "name", "absent": "x"})


@query("reorder_columns", "SELECT l_shipdate IS NULL AS missing, l_suppkey, l_orderkey FROM lineitem")
def _(spark, d):
    rows = X.table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", F.col("l_shipdate").isNull().alias("missing"))
    return P.reorder_columns(rows, ["missing", "absent", "l_suppkey"])


@query("filter_active", "SELECT asset_id, symbol FROM assets WHERE is_active AND trim(symbol) <> ''", (X.ASSETS,))
def _(spark, d):
    return P.filter_active(X.assets(spark, d)).select("asset_id", "symbol")


@query("filter_not_null_set", "SELECT event_id FROM bars WHERE symbol = 'U7' AND open IS NOT NULL AND close IS NOT NULL", (X.BARS,))
def _(spark, d):
    return P.filter_not_null_set(X.bars(spark, d), ["open", "high", "low", "close"], "u7").select("event_id")


@query("filter_date_range", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01'")
def _(spark, d):
    return P.filter_date_range(X.table(spark, d, "orders"), "o_orderdate", date(1995, 1, 1), date(1996, 1, 1)).select("o_orderkey")


@query("filter_in_list", "SELECT run_id, status FROM runs WHERE status IN ('FAILURE', 'STARTED')", (X.RUNS,))
def _(spark, d):
    return P.filter_in_list(X.runs(spark, d), "status", ["FAILURE", "STARTED"]).select("run_id", "status")


@query("filter_failure_or_message", "SELECT run_id, status FROM runs WHERE status = 'FAILURE' OR trim(error_message) <> ''", (X.RUNS,))
def _(spark, d):
    return P.filter_failure_or_message(X.runs(spark, d)).select("run_id", "status")


@query("latest_slice", "SELECT asset_id, trade_date, close FROM daily WHERE trade_date = (SELECT max(trade_date) FROM daily)", (X.DAILY,))
def _(spark, d):
    return P.latest_slice(X.daily(spark, d)).select("asset_id", "trade_date", "close")


@query("horizon_filter", "SELECT symbol, trade_date, close FROM (SELECT *, max(trade_date) OVER (PARTITION BY symbol) AS newest FROM daily) WHERE trade_date >= newest - 366", (X.DAILY,))
def _(spark, d):
    return P.horizon_filter(X.daily(spark, d), "1Y").select("symbol", "trade_date", "close")


@query("trailing_30d_by_coalesced_ts", "SELECT run_id FROM runs WHERE coalesce(end_time, logged_ts) >= TIMESTAMP '1998-06-01' - INTERVAL 30 DAY", (X.RUNS,))
def _(spark, d):
    from datetime import datetime

    return P.trailing_30d_by_coalesced_ts(X.runs(spark, d), datetime(1998, 6, 1)).select("run_id")


# --- 2.4 joins --------------------------------------------------------------------------------------

_IDS = "ids AS (SELECT upper(trim(symbol)) AS symbol, min(asset_id) AS asset_id FROM assets WHERE is_active AND trim(symbol) <> '' GROUP BY 1)"


@query("join_bars_assets", "SELECT event_id, bars.symbol, ids.asset_id FROM bars JOIN ids ON upper(trim(bars.symbol)) = ids.symbol", (X.BARS, X.ASSETS, _IDS))
def _(spark, d):
    return J.join_bars_assets(X.bars(spark, d), X.assets(spark, d)).select("event_id", "symbol", "asset_id")


@query("dedupe_active_assets", "SELECT symbol, asset_id FROM ids", (X.ASSETS, _IDS))
def _(spark, d):
    return A.dedupe_active_assets(X.assets(spark, d))


@query("join_news_dims", "SELECT doc_id, n.symbol, c_custkey AS asset_id, p.publisher_id FROM news n LEFT JOIN customer ON upper(n.symbol) = 'SRC' || c_custkey LEFT JOIN publishers p ON lower(trim(n.publisher)) = p.publisher_name_norm", (X.NEWS, X.PUBLISHERS))
def _(spark, d):
    assets = X.table(spark, d, "customer").select(F.col("c_custkey").alias("asset_id"), F.concat(F.lit("src"), "c_custkey").alias("symbol"))
    return J.join_news_dims(X.news(spark, d).drop("publisher_id"), assets, X.publishers(spark, d)).select("doc_id", "symbol", "asset_id", "publisher_id")


_FALLBACK = "rows AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'u' || o_custkey ELSE 'none' END AS symbol, c_name AS company_name FROM orders JOIN customer ON o_custkey = c_custkey), named AS (SELECT asset_id, upper(trim(symbol)) AS symbol, lower(trim(name)) AS name FROM assets)"


@query("join_fallback", "SELECT o_orderkey, coalesce(a.asset_id, b.asset_id) AS asset_id FROM rows r LEFT JOIN named a ON upper(r.symbol) = a.symbol LEFT JOIN named b ON a.asset_id IS NULL AND lower(trim(r.company_name)) = b.name", (X.ASSETS, _FALLBACK))
def _(spark, d):
    orders, customer = X.table(spark, d, "orders"), X.table(spark, d, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("u"), "o_custkey")).otherwise("none").alias("symbol"), F.col("c_name").alias("company_name"))
    return J.join_fallback(rows, X.assets(spark, d)).select("o_orderkey", "asset_id")


@query("join_final_features", "SELECT asset_id, trade_date, close, round(sma_50 + 0.00003, 3) AS sma_50 FROM gold", (X.FACTORS,))
def _(spark, d):
    rows = X.daily(spark, d)
    return J.join_final_features(rows, V.sma_50(rows).drop("close")).select("asset_id", "trade_date", "close", rounded("sma_50"))


_WEIGHTED = """w7 AS (SELECT asset_id, round(sum(CASE sentiment WHEN 'positive' THEN 1 WHEN 'neutral' THEN 0 WHEN 'negative' THEN -1 END * publisher_weight) / nullif(sum(publisher_weight), 0), 6) AS sentiment_score
 FROM headlines JOIN publishers USING (publisher_id) WHERE publisher_weight > 0 AND provider_publish_time >= TIMESTAMP '2024-01-09' AND provider_publish_time < TIMESTAMP '2024-01-16' GROUP BY 1)"""


@query("weighted_sentiment_7d", "SELECT * FROM w7", (X.HEADLINES, X.PUBLISHERS, _WEIGHTED))
def _(spark, d):
    return A.weighted_sentiment_7d(X.headlines(spark, d), X.publishers(spark, d), D15).select("asset_id", F.round("sentiment_score", 6).alias("sentiment_score"))


@query("join_sentiment", "SELECT v.asset_id, view_date, sentiment_score FROM views v LEFT JOIN w7 ON v.asset_id = w7.asset_id", (X.HEADLINES, X.PUBLISHERS, _WEIGHTED, X.VIEWS))
def _(spark, d):
    scores = A.weighted_sentiment_7d(X.headlines(spark, d), X.publishers(spark, d), D15)
    return J.join_sentiment(X.views(spark, d), scores).select("asset_id", "view_date", F.round("sentiment_score", 6).alias("sentiment_score"))


@query("join_publisher_weight", "SELECT uuid, round(publisher_weight, 6) AS publisher_weight FROM headlines JOIN publishers USING (publisher_id)", (X.HEADLINES, X.PUBLISHERS))
def _(spark, d):
    return J.join_publisher_weight(X.headlines(spark, d), X.publishers(spark, d)).select("uuid", F.round("publisher_weight", 6).alias("publisher_weight"))


@query("semi_target_assets", "SELECT event_id, asset_id FROM bars WHERE asset_id IN (SELECT asset_id FROM assets WHERE is_active)", (X.BARS, X.ASSETS))
def _(spark, d):
    return J.semi_target_assets(X.bars(spark, d), P.filter_active(X.assets(spark, d))).select("event_id", "asset_id")


_MISSING = "missing AS (SELECT DISTINCT upper(trim(symbol)) AS symbol FROM assets WHERE is_active AND upper(trim(symbol)) NOT IN (SELECT symbol FROM bars))"


@query("anti_missing_symbols", "SELECT symbol FROM missing", (X.BARS, X.ASSETS, _MISSING))
def _(spark, d):
    return J.anti_missing_symbols(P.filter_active(X.assets(spark, d)), X.bars(spark, d))


@query("anti_new_publishers", "SELECT DISTINCT publisher AS publisher_name, lower(publisher) AS publisher_name_norm FROM news WHERE publisher IS NOT NULL AND lower(publisher) NOT IN (SELECT publisher_name_norm FROM publishers WHERE publisher_id < 10)", (X.NEWS, X.PUBLISHERS))
def _(spark, d):
    return J.anti_new_publishers(X.news(spark, d), X.publishers(spark, d).where("publisher_id < 10"))


@query("merge_diff", "SELECT count(*) FILTER (c_custkey % 5 = 0) AS inserted, count(*) FILTER (c_custkey % 5 = 1) AS updated, count(*) FILTER (c_custkey % 5 = 2) AS deleted FROM customer")
def _(spark, d):
    rows = X.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    changed = F.when(F.col("c_custkey") % 5 == 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    return J.merge_diff(rows.where("c_custkey % 5 <> 0"), rows.where("c_custkey % 5 <> 2").withColumn("c_acctbal", changed), ["c_custkey", "c_name"])


@query("join_symbols_names", "SELECT DISTINCT b.symbol, name FROM bars b LEFT JOIN assets a ON b.symbol = upper(trim(a.symbol))", (X.BARS, X.ASSETS))
def _(spark, d):
    return J.join_symbols_names(X.bars(spark, d), X.assets(spark, d))


@query("join_sp500_assets", "SELECT security, c.symbol, asset_id FROM constituents c LEFT JOIN assets a ON c.symbol = upper(trim(a.symbol))", (X.CONSTITUENTS, X.ASSETS))
def _(spark, d):
    rows = P.rename_known(X.constituents(spark, d), AS.CONSTITUENT_NAMES).withColumn("symbol", F.upper("symbol"))
    return J.join_sp500_assets(rows, X.assets(spark, d)).select("security", "symbol", "asset_id")


_BASE = f"""CASE WHEN len(ls) >= 3 AND list_aggregate(ls[-2:], 'string_agg', '.') IN ({", ".join(f"'{x}'" for x in C.TWO_PART_SUFFIXES)})
 THEN list_aggregate(ls[-3:], 'string_agg', '.') ELSE list_aggregate(ls[-2:], 'string_agg', '.') END"""
_BASES = f"bases AS (SELECT page_id, {_BASE} AS base FROM (SELECT page_id, list_filter(string_split(regexp_replace(lower(trim(host)), '^www\\.', ''), '.'), lambda x: x <> '') AS ls FROM hosts))"


@query("base_domain", "SELECT page_id, base FROM bases", (X.HOSTS, _BASES))
def _(spark, d):
    return X.hosts(spark, d).select("page_id", C.base_domain("host").alias("base"))


@query("join_rank", "SELECT p.page_id, p.base AS publisher_domain, r.rank FROM bases p LEFT JOIN (SELECT base, max(page_id) AS rank FROM bases GROUP BY base) r ON p.base = r.base", (X.HOSTS, _BASES))
def _(spark, d):
    rows = X.hosts(spark, d).select("page_id", C.base_domain("host").alias("publisher_domain"))
    return J.join_rank(rows, X.ranks(spark, d)).select("page_id", "publisher_domain", "rank")


@query("null_safe_update_join", "SELECT uuid, CASE WHEN asset_id % 2 = 0 THEN 'scored' ELSE sentiment END AS sentiment FROM headlines", (X.HEADLINES,))
def _(spark, d):
    rows = X.headlines(spark, d).withColumns({"link": F.lit(None).cast("string"), "title": F.lit(""), "ingested_ts": F.col("provider_publish_time")})
    scores = rows.where("asset_id % 2 = 0").withColumns({"link": F.lit(""), "sentiment": F.lit("scored")})
    return J.null_safe_update_join(rows, scores).select("uuid", "sentiment")


# --- 2.5 aggregations -------------------------------------------------------------------------------

_OHLC = """SELECT asset_id, symbol, CAST(timestamp AS DATE) AS trade_date, arg_min(open, timestamp) AS open, max(high) AS high, min(low) AS low, arg_max(close, timestamp) AS close, CAST(sum(volume) AS BIGINT) AS volume,
 CAST(sum(trade_count) AS BIGINT) AS trade_count, round(sum(vwap * volume) / nullif(sum(volume), 0), 6) AS vwap FROM bars GROUP BY 1, 2, 3"""


@query("daily_ohlc", _OHLC, (X.BARS,))
def _(spark, d):
    return A.daily_ohlc(X.bars(spark, d)).withColumn("vwap", F.round("vwap", 6))


@query("vwap", "SELECT l_suppkey, round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 4) AS vwap FROM lineitem GROUP BY 1")
def _(spark, d):
    return X.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(A.vwap("l_extendedprice", "l_quantity"), 4).alias("vwap"))


@query("publisher_domain_mode", "SELECT publisher_name_norm, publisher_domain FROM (SELECT *, row_number() OVER (PARTITION BY publisher_name_norm ORDER BY n DESC, publisher_domain) AS k FROM (SELECT 'p' || page_id % 20 AS publisher_name_norm, host AS publisher_domain, count(*) AS n FROM hosts WHERE host <> '' GROUP BY 1, 2)) WHERE k = 1", (X.HOSTS,))
def _(spark, d):
    return A.publisher_domain_mode(X.hosts(spark, d).select(F.concat(F.lit(" P"), F.col("page_id") % 20).alias("publisher"), F.col("host").alias("domain")))


@query("distinct_symbols", "SELECT DISTINCT upper(trim(symbol)) AS symbol FROM assets", (X.ASSETS,))
def _(spark, d):
    return A.distinct_symbols(X.assets(spark, d))


@query("count_distinct_assets", "SELECT count(DISTINCT asset_id) AS n_assets FROM views", (X.VIEWS,))
def _(spark, d):
    return A.count_distinct_assets(X.views(spark, d))


@query("conditional_counts", "SELECT count(*) AS row_count, count(*) FILTER (end_time IS NULL) AS missing_end_time, count(*) FILTER (status IS NULL) AS missing_status FROM runs", (X.RUNS,))
def _(spark, d):
    return A.conditional_counts(X.runs(spark, d), ["end_time", "status"])


@query("excess_duplicates", "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def _(spark, d):
    return A.excess_duplicates(X.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_profile", "SELECT count(*) AS rows, count(*) FILTER (end_time IS NULL) AS null_end_time, count(*) FILTER (trim(error_message) = '') AS null_error_message, round(count(*) FILTER (end_time IS NULL) / count(*), 6) AS share_end_time, round(count(*) FILTER (trim(error_message) = '') / count(*), 6) AS share_error_message, round(greatest(count(*) FILTER (end_time IS NULL), count(*) FILTER (trim(error_message) = '')) / count(*), 6) AS max_share FROM runs", (X.RUNS,))
def _(spark, d):
    rows = A.null_profile(X.runs(spark, d), ["end_time", "error_message"], ("error_message",))
    return rows.withColumns({c: F.round(c, 6) for c in rows.columns if "share" in c})


@query("range_violations", "SELECT count(*) FILTER (l_quantity > 45 OR l_discount > 0.08) AS violations FROM lineitem")
def _(spark, d):
    return A.range_violations(X.table(spark, d, "lineitem"), [F.col("l_quantity") > 45, F.col("l_discount") > 0.08])


def _gold(spark, d) -> DataFrame:
    return prices.price_factors(X.daily(spark, d))


def _slice(spark, d) -> DataFrame:
    """Factors of the newest day, which a scan of one column tells."""
    newest = X.table(spark, d, "lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]
    return state.day_factors(X.daily(spark, d), newest)


@query("market_breadth", "SELECT trade_date IS NULL AS x, round(avg(CASE WHEN returns_1d > 0 THEN 100.0 ELSE 0 END), 6) AS pct_up, round(avg(CASE WHEN close > sma_50 THEN 100.0 WHEN close <= sma_50 THEN 0 END), 6) AS pct_above_sma_50, round(avg(CASE WHEN close > sma_200 THEN 100.0 WHEN close <= sma_200 THEN 0 END), 6) AS pct_above_sma_200, count(*) AS universe FROM slice WHERE returns_1d IS NOT NULL GROUP BY 1", (X.FACTORS,))
def _(spark, d):
    return A.market_breadth(_slice(spark, d)).select(F.lit(False).alias("x"), *[F.round(c, 6).alias(c) for c in ("pct_up", "pct_above_sma_50", "pct_above_sma_200")], "universe")


@query("concentration_impact", "SELECT round(sum(CASE WHEN symbol IN ('S1', 'S2', 'S3', 'S5', 'S8') THEN abs(returns_1d * dollar_volume) ELSE 0 END) / nullif(sum(abs(returns_1d * dollar_volume)), 0), 6) AS impact_share FROM gold WHERE dollar_volume > 0", (X.FACTORS,))
def _(spark, d):
    return A.concentration_impact(_gold(spark, d), {"S1", "S2", "S3", "S5", "S8"}).select(F.round("impact_share", 6).alias("impact_share"))


@query("series_extents", "SELECT symbol, round(lo - greatest((hi - lo) * 0.06, 0.01), 6) AS domain_low, round(hi + greatest((hi - lo) * 0.06, 0.01), 6) AS domain_high FROM (SELECT symbol, least(min(low), min(sma_50)) AS lo, greatest(max(high), max(sma_50)) AS hi FROM (SELECT symbol, low, CAST(NULL AS DOUBLE) AS x, sma_50, high FROM gold) GROUP BY symbol)", (X.FACTORS,))
def _(spark, d):
    out = A.series_extents(V.sma_50(X.daily(spark, d)), ["low", "high", "sma_50"], 0.06, 0.01, "symbol")
    return out.select("symbol", F.round("domain_low", 6).alias("domain_low"), F.round("domain_high", 6).alias("domain_high"))


_ROLLED = """rolled AS (SELECT run_id, job_name, asset_key, count(*) AS assets_materialized_count, CAST(sum(k) FILTER (kind = 0) AS BIGINT) AS row_count, CAST(coalesce(sum(k) FILTER (kind = 1), 0) AS BIGINT) AS rows_inserted,
 CAST(0 AS BIGINT) AS rows_updated, CAST(coalesce(sum(k) FILTER (kind = 2), 0) AS BIGINT) AS rows_deleted FROM mats GROUP BY 1, 2, 3)"""
_RUNS_ROLLED = "per_run AS (SELECT run_id, job_name, CAST(sum(assets_materialized_count) AS BIGINT) AS assets_materialized_count, CAST(sum(row_count) AS BIGINT) AS row_count, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted, CAST(sum(rows_updated) AS BIGINT) AS rows_updated, CAST(sum(rows_deleted) AS BIGINT) AS rows_deleted FROM rolled GROUP BY 1, 2)"


@query("asset_metrics_rollup", "SELECT * FROM rolled", (X.MATERIALIZATIONS, _ROLLED))
def _(spark, d):
    return A.asset_metrics_rollup(X.materializations(spark, d))


@query("run_metrics_rollup", "SELECT * FROM per_run", (X.MATERIALIZATIONS, _ROLLED, _RUNS_ROLLED))
def _(spark, d):
    return A.run_metrics_rollup(A.asset_metrics_rollup(X.materializations(spark, d)))


def _event_runs(spark, d) -> DataFrame:
    stamp = F.lit(None).cast("timestamp")
    return X.table(spark, d, "events").select(F.col("user_id").cast("string").alias("run_id")).distinct().select("run_id", F.lit("daily").alias("job_name"), F.lit("SUCCESS").alias("status"), stamp.alias("start_time"), stamp.alias("end_time"))


@query("run_duration", "SELECT run_id, round(epoch(max(event_ts)) - epoch(min(event_ts)), 3) AS duration_seconds FROM mats GROUP BY run_id", (X.MATERIALIZATIONS,))
def _(spark, d):
    return A.run_duration(X.materializations(spark, d), _event_runs(spark, d)).select("run_id", F.round("duration_seconds", 3).alias("duration_seconds"))


# --- 2.6 windows ------------------------------------------------------------------------------------


def _factor(name: str, f, *cols: str):
    @query(name, f"SELECT asset_id, trade_date, {', '.join(map(rounded_sql, cols))} FROM gold", (X.FACTORS,))
    def run(spark, d):
        return f(X.daily(spark, d)).select("asset_id", "trade_date", *map(rounded, cols))


_factor("returns_1d_5d_21d", V.returns_1d_5d_21d, "returns_1d", "returns_5d", "returns_21d")
_factor("momentum_12_1", V.momentum_12_1, "momentum_12_1")
_factor("high_52w", V.high_52w, "high_52w")
_factor("pct_below_52w_high", V.pct_below_52w_high, "pct_below_52w_high")
_factor("sma_50", V.sma_50, "sma_50")
_factor("sma_200", V.sma_200, "sma_200")
_factor("dist_sma", lambda df: V.dist_sma(V.dist_sma(df, 50), 200), "dist_sma_50", "dist_sma_200")
_factor("realized_vol_21d", V.realized_vol_21d, "realized_vol_21d")

_ROLLING = "rolling AS (SELECT asset_id, view_date AS activity_date, views, avg(views) OVER (PARTITION BY asset_id ORDER BY view_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS views_30d_avg FROM views)"


@query("rolling_views_30", "SELECT asset_id, activity_date, views, round(views_30d_avg, 6) AS views_30d_avg, round(views / nullif(views_30d_avg, 0), 6) AS views_vs_30d_avg FROM rolling", (X.VIEWS, _ROLLING))
def _(spark, d):
    rows = V.rolling_views_30(X.views(spark, d).withColumnRenamed("view_date", "activity_date"))
    return rows.select("asset_id", "activity_date", "views", F.round("views_30d_avg", 6).alias("views_30d_avg"), F.round("views_vs_30d_avg", 6).alias("views_vs_30d_avg"))


_DEDUPED = "deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY upper(symbol), CASE WHEN trim(title) <> '' THEN title ELSE '' END ORDER BY ingested DESC) AS k FROM news) WHERE k = 1)"


@query("dedupe_latest_headline", "SELECT doc_id, symbol FROM deduped", (X.NEWS, _DEDUPED))
def _(spark, d):
    return V.dedupe_latest_headline(X.news(spark, d), ["doc_id"]).select("doc_id", "symbol")


@query("rolling_vol_full_window", f"SELECT asset_id, trade_date, CASE WHEN count(returns_1d) OVER w = 21 THEN round(realized_vol_21d, 6) END AS rolling_vol FROM gold WINDOW w AS ({X._W} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)", (X.FACTORS,))
def _(spark, d):
    return V.rolling_vol_full_window(X.daily(spark, d)).select("asset_id", "trade_date", F.round("rolling_vol", 6).alias("rolling_vol"))


@query("cumulative_return", f"SELECT asset_id, trade_date, round((product(1 + returns_1d) OVER ({X._W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1), 4) + 0.0 AS cumulative_return FROM gold WHERE returns_1d IS NOT NULL", (X.FACTORS,))
def _(spark, d):
    return V.cumulative_return(V.returns_1d_5d_21d(X.daily(spark, d))).select("asset_id", "trade_date", (F.round("cumulative_return", 4) + 0.0).alias("cumulative_return"))


@query("drawdown", f"SELECT asset_id, trade_date, round((close / nullif(max(close) OVER ({X._W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - 1) * 100, 6) AS drawdown FROM daily", (X.DAILY,))
def _(spark, d):
    return V.drawdown(X.daily(spark, d)).select("asset_id", "trade_date", F.round("drawdown", 6).alias("drawdown"))


_DELTA = f"last AS (SELECT *, round((close / nullif(coalesce(lag(close) OVER ({X._W}), open), 0) - 1) * 100, 6) AS delta_pct, row_number() OVER (PARTITION BY asset_id ORDER BY trade_date DESC) AS k FROM gold)"


@query("previous_close_delta", "SELECT asset_id, trade_date, delta_pct FROM last WHERE k = 1", (X.FACTORS, _DELTA))
def _(spark, d):
    return V.previous_close_delta(X.daily(spark, d)).select("asset_id", "trade_date", F.round("delta_pct", 6).alias("delta_pct"))


@query("symbol_snapshot", "SELECT symbol, trade_date, close, delta_pct, round(returns_5d, 6) AS returns_5d, round(returns_21d, 6) AS returns_21d, round(realized_vol_21d, 6) AS realized_vol_21d FROM last WHERE k = 1", (X.FACTORS, _DELTA))
def _(spark, d):
    rows = prices.symbol_snapshot(_gold(spark, d))
    return rows.select("symbol", "trade_date", "close", *[F.round(c, 6).alias(c) for c in ("delta_pct", "returns_5d", "returns_21d", "realized_vol_21d")])


@query("surrogate_ids", "SELECT c_name, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name, c_custkey) AS asset_id FROM customer")
def _(spark, d):
    existing = X.table(spark, d, "supplier").select(F.col("s_suppkey").alias("asset_id"))
    return V.surrogate_ids(X.table(spark, d, "customer").select("c_name", "c_custkey"), existing, "asset_id", ["c_name", "c_custkey"]).select("c_name", "asset_id")


@query("zscore", "SELECT asset_id, trade_date, round(CASE WHEN coalesce(stddev_pop(close) OVER w, 0) = 0 THEN 0 ELSE (close - avg(close) OVER w) / stddev_pop(close) OVER w END, 6) AS z_close FROM daily WINDOW w AS (PARTITION BY trade_date)", (X.DAILY,))
def _(spark, d):
    return V.zscore(X.daily(spark, d), ["close"]).select("asset_id", "trade_date", F.round("z_close", 6).alias("z_close"))


# --- 2.7 top-k --------------------------------------------------------------------------------------

_GAINERS = "(SELECT symbol, round(returns_1d, 6) AS returns_1d, 'gainer' AS side FROM slice WHERE returns_1d > 0 ORDER BY slice.returns_1d DESC, symbol LIMIT 5) UNION ALL (SELECT symbol, round(returns_1d, 6) AS returns_1d, 'loser' AS side FROM slice WHERE returns_1d < 0 ORDER BY slice.returns_1d, symbol LIMIT 5)"


@query("top_gainers_losers", _GAINERS, (X.FACTORS,))
def top_gainers_losers(spark, d):
    return K.top_gainers_losers(_slice(spark, d)).select("symbol", F.round("returns_1d", 6).alias("returns_1d"), "side")


_RANKED = "SELECT trade_date, symbol, round(returns_1d, 6) AS returns_1d, '{side}' AS side FROM (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY returns_1d {order} NULLS LAST, symbol) AS n FROM gold) WHERE n <= 5 AND returns_1d {sign} 0"


@query("top_gainers_losers_by_date", _RANKED.format(side="gainer", order="DESC", sign=">") + " UNION ALL " + _RANKED.format(side="loser", order="ASC", sign="<"), (X.FACTORS,))
def _(spark, d):
    return K.top_gainers_losers_by_date(V.returns_1d_5d_21d(X.daily(spark, d))).select("trade_date", "symbol", F.round("returns_1d", 6).alias("returns_1d"), "side")


@query("risky_bets", "(SELECT symbol, 'hot' AS bucket FROM slice WHERE realized_vol_21d IS NOT NULL AND returns_21d > 0 ORDER BY returns_21d DESC, symbol LIMIT 6) UNION ALL (SELECT symbol, 'crash' AS bucket FROM slice WHERE realized_vol_21d IS NOT NULL AND returns_21d < 0 ORDER BY returns_21d, symbol LIMIT 6) UNION ALL (SELECT symbol, 'sleepy' AS bucket FROM slice WHERE realized_vol_21d IS NOT NULL ORDER BY realized_vol_21d, symbol LIMIT 6)", (X.FACTORS,))
def _(spark, d):
    return K.risky_bets(_slice(spark, d)).select("symbol", "bucket")


@query("underrated", "SELECT symbol, round(score, 6) AS score FROM (SELECT symbol, CASE WHEN coalesce(stddev_pop(momentum_12_1) OVER (), 0) = 0 THEN 0 ELSE (momentum_12_1 - avg(momentum_12_1) OVER ()) / stddev_pop(momentum_12_1) OVER () END + CASE WHEN coalesce(stddev_pop(pct_below_52w_high) OVER (), 0) = 0 THEN 0 ELSE (pct_below_52w_high - avg(pct_below_52w_high) OVER ()) / stddev_pop(pct_below_52w_high) OVER () END AS score FROM slice WHERE momentum_12_1 IS NOT NULL AND pct_below_52w_high IS NOT NULL) ORDER BY 2 DESC, 1 LIMIT 6", (X.FACTORS,))
def _(spark, d):
    return K.underrated(_slice(spark, d)).select("symbol", F.round("score", 6).alias("score"))


@query("sentiment_movers", "SELECT symbol, round(CASE WHEN max(abs(sentiment_score)) OVER () <= 1.5 THEN sentiment_score * 100 ELSE sentiment_score END, 4) AS shown_score FROM (SELECT 'U' || asset_id AS symbol, sentiment_score FROM w7 ORDER BY sentiment_score DESC, symbol LIMIT 5)", (X.HEADLINES, X.PUBLISHERS, _WEIGHTED))
def _(spark, d):
    scores = A.weighted_sentiment_7d(X.headlines(spark, d), X.publishers(spark, d), D15).select(F.concat(F.lit("U"), "asset_id").alias("symbol"), F.round("sentiment_score", 6).alias("sentiment_score"))
    return K.sentiment_movers(scores).select("symbol", F.round("shown_score", 4).alias("shown_score"))


@query("recent_headlines", "SELECT uuid, sentiment FROM headlines WHERE symbol = 'U7' ORDER BY provider_publish_time DESC NULLS LAST, uuid LIMIT 50", (X.HEADLINES,))
def _(spark, d):
    return K.recent_headlines(X.headlines(spark, d), "u7").select("uuid", "sentiment")


@query("recent_rows", "SELECT run_id, status FROM runs WHERE status = 'FAILURE' ORDER BY coalesce(end_time, logged_ts) DESC NULLS LAST, run_id LIMIT 100", (X.RUNS,))
def _(spark, d):
    return K.recent_rows(X.runs(spark, d), 100, F.col("status") == "FAILURE").select("run_id", "status")


@query("missing_symbol_sample", "SELECT (SELECT count(*) FROM missing) AS missing_count, (SELECT string_agg(symbol, ',' ORDER BY symbol) FROM (SELECT symbol FROM missing ORDER BY symbol LIMIT 25)) AS sample", (X.BARS, X.ASSETS, _MISSING))
def _(spark, d):
    return K.missing_symbol_sample(J.anti_missing_symbols(P.filter_active(X.assets(spark, d)), X.bars(spark, d))).select("missing_count", F.array_join("sample", ",").alias("sample"))


@query("duration_trend", "SELECT run_id, round(duration_seconds / 60, 6) AS duration_minutes FROM runs WHERE job_name = '1-URGENT' ORDER BY start_time DESC NULLS LAST, run_id LIMIT 100", (X.RUNS,))
def _(spark, d):
    return K.duration_trend(X.runs(spark, d), "1-URGENT").select("run_id", F.round("duration_minutes", 6).alias("duration_minutes"))


# --- 2.8 set operations -----------------------------------------------------------------------------


@query("union_history_today", "SELECT asset_id, trade_date, close FROM daily WHERE trade_date >= DATE '1997-06-02' - 400 AND trade_date <= DATE '1997-06-02'", (X.DAILY,))
def _(spark, d):
    rows, day = X.daily(spark, d), date(1997, 6, 2)
    return M.union_history_today(rows.select("asset_id", "trade_date", "close"), rows.where(F.col("trade_date") == F.lit(day)), day).select("asset_id", "trade_date", "close")


@query("union_jobs", "SELECT DISTINCT job_name FROM runs UNION SELECT 'nightly'", (X.RUNS,))
def _(spark, d):
    return M.union_jobs(["nightly", "1-URGENT"], X.runs(spark, d))


@query("symbol_set_precedence", "SELECT upper(trim(symbol)) AS symbol, asset_id % 3 <> 0 AS is_active FROM assets WHERE asset_id % 2 = 0 OR asset_id % 3 = 0", (X.ASSETS,))
def _(spark, d):
    rows = X.assets(spark, d)
    return M.symbol_set_precedence(rows.where("asset_id % 2 = 0"), rows.where("asset_id % 3 = 0"))


# --- 2.9 column logic -------------------------------------------------------------------------------


@query("norm_symbol", "SELECT asset_id, upper(trim(symbol)) AS symbol FROM assets", (X.ASSETS,))
def _(spark, d):
    return X.assets(spark, d).select("asset_id", C.norm_symbol("symbol").alias("symbol"))


@query("norm_publisher", "SELECT doc_id, coalesce(lower(trim(publisher)), '') AS name FROM news", (X.NEWS,))
def _(spark, d):
    return X.news(spark, d).select("doc_id", C.norm_publisher("publisher").alias("name"))


@query("publisher_domain", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'known.com' WHEN page_id % 3 = 1 THEN base ELSE '' END AS domain FROM bases", (X.HOSTS, _BASES))
def _(spark, d):
    name = F.when(F.col("page_id") % 3 == 2, F.concat("host", F.lit(" news"))).otherwise(F.col("host"))
    return X.hosts(spark, d).select("page_id", C.publisher_domain(name, F.when(F.col("page_id") % 3 == 0, "known.com")).alias("domain"))


@query("rank_to_weight", "SELECT publisher_id, round(publisher_weight, 6) AS publisher_weight, weight_source FROM publishers", (X.PUBLISHERS,))
def _(spark, d):
    return X.publishers(spark, d).select("publisher_id", F.round("publisher_weight", 6).alias("publisher_weight"), "weight_source")


@query("sentiment_value", "SELECT uuid, CASE sentiment WHEN 'positive' THEN 1.0::DOUBLE WHEN 'neutral' THEN 0.0 WHEN 'negative' THEN -1.0 END AS v FROM headlines", (X.HEADLINES,))
def _(spark, d):
    return X.headlines(spark, d).select("uuid", C.sentiment_value("sentiment").alias("v"))


@query("headline_text", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND trim(text) <> '' THEN text WHEN trim(lang) <> '' THEN lang ELSE '' END AS headline FROM documents")
def _(spark, d):
    return X.table(spark, d, "documents").select("doc_id", C.headline_text(F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(" "), "lang").alias("headline"))


@query("dedupe_key", "SELECT doc_id, upper(symbol) || '::' || CASE WHEN trim(title) <> '' THEN title ELSE '' END AS key FROM news", (X.NEWS,))
def _(spark, d):
    return X.news(spark, d).select("doc_id", C.dedupe_key("symbol", "uuid", "link", "title").alias("key"))


@query("article_from_name", "SELECT p_partkey, replace(p_name, ' ', '_') AS article FROM part")
def _(spark, d):
    ending = F.element_at(F.array(*map(F.lit, [" Class A Common Stock", " common stock", " Class b", " Ordinary Shares", " ADS"])), (F.col("p_partkey") % 5 + 1).cast("int"))
    return X.table(spark, d, "part").select("p_partkey", C.article_from_name(F.concat("p_name", ending)).alias("article"))


@query("article_title", "SELECT p_partkey, replace(p_name, ' ', '_') || '+_''s' AS title FROM part")
def _(spark, d):
    return X.table(spark, d, "part").select("p_partkey", C.article_title(F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("%20")), F.lit("+ %27s "))).alias("title"))


@query("article_choice", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN replace(p_type, ' ', '_') ELSE replace(p_name, ' ', '_') END AS article FROM part")
def _(spark, d):
    return X.table(spark, d, "part").select("p_partkey", C.article_choice(F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(" "), "p_name").alias("article"))


@query("parse_view_date", "SELECT event_id, CASE WHEN event_id % 3 = 2 THEN DATE '2024-01-15' ELSE CAST(ts AS DATE) END AS view_date FROM events")
def _(spark, d):
    day = F.col("ts").cast("date")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format(day, "yyyyMMdd")).when(F.col("event_id") % 3 == 1, F.date_format(day, "yyyy-MM-dd")).otherwise("soon")
    return X.table(spark, d, "events").select("event_id", C.parse_view_date(text, D15).alias("view_date"))


@query("epoch_to_ts", "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at FROM events")
def _(spark, d):
    return X.table(spark, d, "events").select("event_id", F.date_format(C.epoch_to_ts(F.unix_seconds(F.col("ts").cast("timestamp"))), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("dollar_volume", "SELECT asset_id, trade_date, round(close * volume, 4) AS dollar_volume FROM daily", (X.DAILY,))
def _(spark, d):
    return X.daily(spark, d).select("asset_id", "trade_date", F.round(C.dollar_volume("close", "volume"), 4).alias("dollar_volume"))


@query("candle_body", "SELECT l_orderkey, l_linenumber, round(least(l_extendedprice, l_quantity * 1000), 4) AS body_low, round(greatest(l_extendedprice, l_quantity * 1000), 4) AS body_high, CASE WHEN l_quantity * 1000 >= l_extendedprice THEN 'up' ELSE 'down' END AS direction FROM lineitem")
def _(spark, d):
    rows = X.table(spark, d, "lineitem").withColumn("b", C.candle_body("l_extendedprice", F.col("l_quantity") * 1000))
    return rows.select("l_orderkey", "l_linenumber", F.round("b.body_low", 4).alias("body_low"), F.round("b.body_high", 4).alias("body_high"), "b.direction")


@query("symbol_label", "SELECT asset_id, CASE WHEN asset_id % 2 = 0 THEN upper(trim(symbol)) || ' - ' || name ELSE upper(trim(symbol)) END AS label FROM assets", (X.ASSETS,))
def _(spark, d):
    return X.assets(spark, d).select("asset_id", C.symbol_label(C.norm_symbol("symbol"), F.when(F.col("asset_id") % 2 == 0, F.col("name")).otherwise(" ")).alias("label"))


@query("pct_scale", "SELECT asset_id, trade_date, round(returns_1d * 100, 6) AS returns_pct FROM gold", (X.FACTORS,))
def _(spark, d):
    return V.returns_1d_5d_21d(X.daily(spark, d)).select("asset_id", "trade_date", F.round(C.pct_scale("returns_1d"), 6).alias("returns_pct"))


@query("details_json", """SELECT s_suppkey, '{"name":"' || s_name || '","key":' || s_suppkey || '}' AS details FROM supplier""")
def _(spark, d):
    return X.table(spark, d, "supplier").select("s_suppkey", C.details_json(name=F.col("s_name"), key=F.col("s_suppkey")).alias("details"))


@query("metadata_int", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN k WHEN 1 THEN NULL ELSE k END AS v FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)")
def _(spark, d):
    k = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"row_count": {"value": '), k, F.lit("}}"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"row_count": true, "n": '), k, F.lit(".5}"))).otherwise(F.concat(F.lit('{"row_count": 1.5, "n": '), k, F.lit(".0}")))
    return X.table(spark, d, "events").select("event_id", C.metadata_int(text, "row_count", "n").alias("v"))


@query("check_id", "SELECT count(*) AS rows, count(*) AS ids FROM events")
def _(spark, d):
    return X.table(spark, d, "events").withColumn("check_id", C.check_id()).agg(F.count("*").alias("rows"), F.countDistinct("check_id").alias("ids"))


# --- 2.10 calendar ----------------------------------------------------------------------------------


@query("is_trading_day", "SELECT o_orderkey, dayofweek(o_orderdate) NOT IN (0, 6) AND CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 97 = 0) AS is_trading_day FROM orders")
def _(spark, d):
    orders = X.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return cal.is_trading_day(orders, "date", orders.where("o_orderkey % 97 = 0").select("date")).select("o_orderkey", "is_trading_day")


@query("previous_trading_day", "SELECT o_orderkey, CAST(CASE dayofweek(o_orderdate) WHEN 1 THEN CAST(o_orderdate AS DATE) - 3 WHEN 0 THEN CAST(o_orderdate AS DATE) - 2 ELSE CAST(o_orderdate AS DATE) - 1 END AS DATE) AS previous_trading_day FROM orders")
def _(spark, d):
    orders = X.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return cal.previous_trading_day(orders).select("o_orderkey", "previous_trading_day")


@query("month_start", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders")
def _(spark, d):
    return X.table(spark, d, "orders").select("o_orderkey", cal.month_start("o_orderdate").alias("month"))


@query("window_bounds", "SELECT count(*) AS n, min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events WHERE ts >= DATE '2024-01-15' - 6 AND ts < DATE '2024-01-16'")
def _(spark, d):
    start, end = cal.window_bounds(D15, 7)
    rows = P.filter_date_range(X.table(spark, d, "events").withColumn("day", F.col("ts").cast("date")), "day", start, end)
    return rows.agg(F.count("*").alias("n"), F.min("day").alias("first"), F.max("day").alias("last"))


# --- 2.11 jobs --------------------------------------------------------------------------------------

_GOLD_COLS = ["close", "dollar_volume", "returns_1d", "returns_21d", "realized_vol_21d", "momentum_12_1", "pct_below_52w_high", "sma_50", "sma_200", "dist_sma_50", "dist_sma_200"]


def _paths(spark) -> prices.Paths:
    return prices.Paths(scratch_path(spark, "layers"))


@query("silver_prices", "SELECT event_id, bars.symbol, ids.asset_id FROM bars JOIN ids ON bars.symbol = ids.symbol WHERE CAST(timestamp AS DATE) = DATE '2024-01-15'", (X.BARS, X.ASSETS, _IDS))
def _(spark, d):
    paths = _paths(spark)
    S.sink_replace_day(X.bars(spark, d).drop("asset_id"), paths.table("bronze", "bars"))
    X.assets(spark, d).write.parquet(paths.table("silver", "assets"))
    prices.silver_prices(spark, paths, D15)
    return load(spark, paths.table("silver", "prices")).select("event_id", "symbol", "asset_id")


@query("compact_prices", "SELECT symbol, count(*) AS bars, max(timestamp) IS NULL AS none FROM bars WHERE timestamp < TIMESTAMP '2024-02-01' GROUP BY symbol", (X.BARS,))
def _(spark, d):
    paths = _paths(spark)
    S.sink_replace_day(X.bars(spark, d), paths.table("silver", "prices"))
    prices.compact_prices(spark, paths, D1)
    rows = R.view_prices_compact(spark, paths.table("silver", "prices_compact"))
    return rows.groupBy("symbol").agg(F.count("*").alias("bars"), F.max("timestamp").isNull().alias("none"))


@query("gold_prices_backfill", f"SELECT asset_id, trade_date, {', '.join(map(rounded_sql, _GOLD_COLS))} FROM gold", (X.FACTORS,))
def _(spark, d):
    # closes of a day tie, so the adapter reduces each day to one bar first
    bars = X.daily(spark, d).select("asset_id", "symbol", F.col("trade_date").cast("timestamp").alias("timestamp"), "open", "high", "low", "close", "volume", F.lit(1).cast("long").alias("trade_count"), F.col("close").alias("vwap"))
    return prices.gold_prices_backfill(bars).select("asset_id", "trade_date", *map(rounded, _GOLD_COLS))


@query("gold_prices_incremental", """SELECT asset_id, trade_date, close, round(returns_1d, 6) AS returns_1d, round(sma_50 + 0.00003, 3) AS sma_50, round(realized_vol_21d, 6) AS realized_vol_21d FROM (
 SELECT *, stddev_samp(returns_1d) OVER (PARTITION BY asset_id ORDER BY trade_date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) * sqrt(252) AS realized_vol_21d FROM (
 SELECT *, close / nullif(lag(close) OVER w, 0) - 1 AS returns_1d, avg(close) OVER (PARTITION BY asset_id ORDER BY trade_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS sma_50
 FROM daily WHERE trade_date BETWEEN DATE '1997-06-02' - 400 AND DATE '1997-06-02' WINDOW w AS (PARTITION BY asset_id ORDER BY trade_date))) WHERE trade_date = DATE '1997-06-02'""", (X.DAILY,))
def _(spark, d):
    paths, day = _paths(spark), date(1997, 6, 2)
    rows = X.daily(spark, d)
    gold = rows.select("asset_id", "symbol", "trade_date", "close").where(F.col("trade_date") < F.lit(day))
    for f in schemas.GOLD_PRICES.fields:
        gold = C.add_column_if_missing(gold, f.name, f.dataType)
    gold.where(F.col("trade_date") >= F.lit(day - timedelta(days=420))).repartition("trade_date").write.partitionBy("trade_date").parquet(paths.table("gold", "prices"))
    bars = rows.where(F.col("trade_date") == F.lit(day)).withColumns({"timestamp": F.col("trade_date").cast("timestamp"), "trade_count": F.lit(1).cast("long"), "vwap": F.col("close")})
    S.sink_replace_day(bars.drop("trade_date"), paths.table("silver", "prices"))
    rows.select("asset_id", "symbol").distinct().withColumn("is_active", F.lit(True)).write.parquet(paths.table("silver", "assets"))
    prices.gold_prices_incremental(spark, paths, day)
    out = spark.read.schema(schemas.GOLD_PRICES).parquet(paths.table("gold", "prices")).where(F.col("trade_date") == F.lit(day))
    return out.select("asset_id", "trade_date", "close", *map(rounded, ("returns_1d", "sma_50", "realized_vol_21d")))


@query("gold_prices_state", f"SELECT asset_id, trade_date, {', '.join(map(rounded_sql, _GOLD_COLS))} FROM gold WHERE trade_date = DATE '1997-06-02'", (X.FACTORS,))
def _(spark, d):
    """One day's factors from the state that all days before it give."""
    rows, day = X.daily(spark, d), date(1997, 6, 2)
    kept = state.build_state(rows.where(F.col("trade_date") < F.lit(day)), day - timedelta(days=1))
    return state.state_factors(rows.where(F.col("trade_date") == F.lit(day)), kept).select("asset_id", "trade_date", *map(rounded, _GOLD_COLS))


@query("backfill_momentum", "SELECT asset_id, trade_date, round(CASE WHEN asset_id % 2 = 0 THEN 9 ELSE momentum_12_1 END, 6) AS momentum_12_1 FROM gold", (X.FACTORS,))
def _(spark, d):
    rows = X.daily(spark, d).withColumn("momentum_12_1", F.when(F.col("asset_id") % 2 == 0, 9.0))
    return prices.backfill_momentum(rows).select("asset_id", "trade_date", F.round("momentum_12_1", 6).alias("momentum_12_1"))


@query("backfill_pct_high", "SELECT asset_id, trade_date, round(pct_below_52w_high, 6) AS pct_below_52w_high FROM gold", (X.FACTORS,))
def _(spark, d):
    rows = X.daily(spark, d).withColumn("pct_below_52w_high", F.lit(9.0))
    return prices.backfill_pct_high(rows).select("asset_id", "trade_date", F.round("pct_below_52w_high", 6).alias("pct_below_52w_high"))


@query("silver_news", "SELECT count(*) AS row_count, count(*) FILTER (c_custkey IS NULL) AS missing_asset_id, count(*) FILTER (p.publisher_id IS NULL) AS missing_publisher_id FROM news n LEFT JOIN customer ON upper(n.symbol) = 'SRC' || c_custkey LEFT JOIN publishers p ON lower(trim(n.publisher)) = p.publisher_name_norm WHERE query_date = DATE '2024-01-15'", (X.NEWS, X.PUBLISHERS))
def _(spark, d):
    paths = _paths(spark)
    X.news(spark, d).drop("publisher_id").write.parquet(paths.table("bronze", "news"))
    X.table(spark, d, "customer").select(F.col("c_custkey").alias("asset_id"), F.concat(F.lit("src"), "c_custkey").alias("symbol")).write.parquet(paths.table("silver", "assets"))
    X.publishers(spark, d).write.parquet(paths.table("silver", "publishers"))
    return news.silver_news(spark, paths, D15)


@query("publisher_overrides", "SELECT publisher_name_norm, arg_max(override_domain, seq) AS override_domain FROM (SELECT lower(trim(n_name)) AS publisher_name_norm, lower(replace(n_name, ' ', '-')) || '.com' AS override_domain, 0 AS seq FROM nation UNION ALL SELECT lower(r_name), lower(replace(r_name, ' ', '-')) || '.co.uk', 1 FROM region UNION ALL SELECT lower(n_name), lower(replace(n_name, ' ', '')) || '.org', 2 AS seq FROM nation WHERE n_nationkey % 3 = 0) GROUP BY 1")
def _(spark, d):
    """Overrides as people write them: blanks around names, hosts with labels in front, names twice."""
    nation, region = X.table(spark, d, "nation"), X.table(spark, d, "region")
    dashed = lambda c: F.replace(c, F.lit(" "), F.lit("-"))
    raw = nation.select(F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("publisher_name"), F.concat(F.lit("WWW.News."), dashed("n_name"), F.lit(".com ")).alias("publisher_domain"), F.lit(0).alias("at"))
    raw = raw.unionByName(region.select(F.col("r_name").alias("publisher_name"), F.concat(F.lit("a.b."), dashed("r_name"), F.lit(".co.uk")).alias("publisher_domain"), F.lit(1).alias("at")))
    raw = raw.unionByName(nation.where("n_nationkey % 3 = 0").select(F.lower("n_name").alias("publisher_name"), F.concat(F.replace("n_name", F.lit(" ")), F.lit(".org")).alias("publisher_domain"), F.lit(2).alias("at")))
    blank = raw.limit(1).withColumns({"publisher_domain": F.lit(" "), "at": F.lit(9)})
    known = news.overrides_table(spark).select("publisher_name_norm")
    return news.overrides_table(spark, raw.unionByName(blank), "at").join(known, "publisher_name_norm", "left_anti").select("publisher_name_norm", "override_domain")


@query("publishers_upsert", "SELECT publisher_name_norm, publisher_id, publisher_domain, round(publisher_weight, 6) AS publisher_weight, weight_source FROM (SELECT publisher_name_norm, CASE WHEN publisher_id < 10 THEN publisher_id ELSE 9 + row_number() OVER (PARTITION BY publisher_id < 10 ORDER BY publisher_name_norm) END AS publisher_id, CASE WHEN publisher_id < 10 THEN publisher_domain ELSE '' END AS publisher_domain, CASE WHEN publisher_id < 10 THEN publisher_weight ELSE 0.05 END AS publisher_weight, CASE WHEN publisher_id < 10 THEN weight_source ELSE 'default' END AS weight_source FROM publishers)", (X.PUBLISHERS,))
def _(spark, d):
    every = X.publishers(spark, d)
    stamp = F.lit(None).cast("timestamp")
    existing = every.where("publisher_id < 10").withColumns({"ingested_ts": stamp, "weight_updated_ts": stamp}).drop("rank")
    listed = every.where("rank > 0").select("rank", F.col("publisher_domain").alias("domain"))
    fresh = every.select(F.col("publisher_name").alias("publisher"))
    out = news.publishers_upsert(fresh, existing, listed, news.overrides_table(spark), X.NOW)
    return out.select("publisher_name_norm", "publisher_id", "publisher_domain", F.round("publisher_weight", 6).alias("publisher_weight"), "weight_source")


_LISTS = "words AS (SELECT *, list_filter(regexp_split_to_array(lower(CASE WHEN trim(title) <> '' THEN title ELSE '' END), '[^a-z]+'), lambda x: x IN ({})) AS pos, list_filter(regexp_split_to_array(lower(CASE WHEN trim(title) <> '' THEN title ELSE '' END), '[^a-z]+'), lambda x: x IN ({})) AS neg FROM {{}})".format(*[", ".join(f"'{w}'" for w in x) for x in (news.POSITIVE, news.NEGATIVE)])
_LABEL = "CASE WHEN len(pos) > len(neg) THEN 'positive' WHEN len(pos) < len(neg) THEN 'negative' ELSE 'neutral' END AS sentiment"


@query("gold_headlines", f"SELECT doc_id, symbol, {_LABEL} FROM words", (X.NEWS.replace("news AS", "news0 AS"), "news AS (SELECT * FROM news0 WHERE query_date BETWEEN DATE '2024-01-30' - 29 AND DATE '2024-01-30')", _DEDUPED, _LISTS.format("deduped")))
def _(spark, d):
    paths = _paths(spark)
    X.news(spark, d).withColumn("date", F.col("query_date")).write.partitionBy("date").parquet(paths.table("silver", "news"))
    news.gold_headlines(spark, paths, D30)
    return load(spark, paths.table("gold", "headlines")).select("doc_id", "symbol", "sentiment")


@query("score_sentiment", f"SELECT doc_id, {_LABEL} FROM words", (X.NEWS, _LISTS.format("news")))
def _(spark, d):
    return news.score_sentiment(X.news(spark, d)).select("doc_id", "sentiment")


@query("score_sentiment_model", "SELECT doc_id, CASE WHEN length(CASE WHEN trim(title) <> '' THEN title ELSE '' END) % 2 = 1 THEN 'positive' ELSE 'negative' END AS sentiment FROM news", (X.NEWS,))
def _(spark, d):
    """The path of a model: here a scorer that looks at the length."""

    def factory():
        return lambda texts: ["POSITIVE" if len(t) % 2 else "NEGATIVE" for t in texts]

    return news.score_sentiment(X.news(spark, d), factory).select("doc_id", "sentiment")


def rated(spark, d) -> DataFrame:
    """Documents with labels as texts of a mood: toxic ones negative, else those of quality positive, else neutral."""
    mood = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    labels = X.table(spark, d, "labels").where("toxic IS NOT NULL OR quality IS NOT NULL").select("doc_id", mood.alias("sentiment"))
    return X.table(spark, d, "documents").select("doc_id", "text").join(labels, "doc_id")


@query("score_sentiment_fitted")
def _(spark, d):
    """A classifier of the labelled documents scores all; those whose id's checksum leaves 2 of 4 are held out of the fit."""
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2
    model = fit_sentiment(rated(spark, d).where(~held))
    rows = X.table(spark, d, "documents").select("doc_id", held.alias("held_out"), "text")
    return model.score(rows, F.col("text"), confidence="confidence").select("doc_id", "held_out", "sentiment", F.round("confidence", 4).alias("confidence"))


@query("silver_pageviews", "SELECT asset_id, view_date, CAST(sum(views) AS BIGINT) AS views FROM views JOIN customer ON asset_id = c_custkey WHERE view_date = DATE '2024-01-15' GROUP BY 1, 2", (X.VIEWS,))
def _(spark, d):
    paths = _paths(spark)
    raw = X.views(spark, d).select(F.concat(F.lit("u"), "asset_id").alias("symbol"), F.lit("none").alias("company_name"), F.date_format("view_date", "yyyyMMdd").alias("view_date"), "granularity", "views", "ingested_ts")
    raw.write.parquet(paths.table("bronze", "pageviews"))
    X.assets(spark, d).write.parquet(paths.table("silver", "assets"))
    activity.silver_pageviews(spark, paths, D15)
    return load(spark, paths.table("silver", "pageviews")).where("asset_id IS NOT NULL").select("asset_id", "view_date", "views")


@query("gold_activity", "SELECT asset_id, activity_date, views, round(views_30d_avg, 6) AS views_30d_avg, round(views / nullif(views_30d_avg, 0), 6) AS views_vs_30d_avg FROM rolling WHERE activity_date BETWEEN DATE '2024-01-30' - 29 AND DATE '2024-01-30'", (X.VIEWS, _ROLLING))
def _(spark, d):
    paths = _paths(spark)
    X.views(spark, d).write.parquet(paths.table("silver", "pageviews"))
    activity.gold_activity(spark, paths, D30)
    activity.gold_activity(spark, paths, D30)
    out = load(spark, paths.table("gold", "activity"))
    return out.select("asset_id", "activity_date", "views", F.round("views_30d_avg", 6).alias("views_30d_avg"), F.round("views_vs_30d_avg", 6).alias("views_vs_30d_avg"))


def _old_assets(spark, d) -> DataFrame:
    rows = X.assets(spark, d).where("asset_id % 2 = 0").withColumn("article_title", F.lit("old"))
    return rows


@query("assets_upsert", "SELECT source_id, CASE WHEN asset_id % 2 = 0 THEN asset_id ELSE (SELECT max(asset_id) FROM assets WHERE asset_id % 2 = 0) + row_number() OVER (PARTITION BY asset_id % 2 ORDER BY symbol, source_id) END AS asset_id, CASE WHEN asset_id % 2 = 0 THEN is_active ELSE FALSE END AS is_active, asset_id IN (SELECT p_partkey FROM part) AS is_sp500, CASE WHEN asset_id % 2 = 0 THEN 'old' END AS article_title FROM assets", (X.ASSETS,))
def _(spark, d):
    snapshot = X.assets(spark, d).select(F.col("source_id").alias("id"), "symbol", "name")
    members = P.rename_known(X.constituents(spark, d), AS.CONSTITUENT_NAMES)
    out = AS.assets_upsert(snapshot, _old_assets(spark, d), members, None)
    return out.select("source_id", "asset_id", "is_active", "is_sp500", "article_title")


@query("asset_history_init", "SELECT asset_id, CAST(NULL AS VARCHAR) AS change_type FROM assets WHERE FALSE", (X.ASSETS,))
def _(spark, d):
    return AS.asset_history_init(spark).join(X.assets(spark, d).select("asset_id"), "asset_id", "left_semi").select("asset_id", "change_type")


_WANTED = "wanted AS (SELECT *, CASE WHEN asset_id % 3 = 0 THEN FALSE WHEN asset_id % 2 = 0 THEN TRUE END AS want FROM assets)"


@query("asset_status_updates", "SELECT asset_id, CASE WHEN want THEN 'activated' ELSE 'deactivated' END AS change_type, is_active AS previous_is_active, want AS new_is_active FROM wanted WHERE want IS NOT NULL AND want <> is_active UNION ALL SELECT asset_id, 'snapshot', NULL, want FROM wanted WHERE want IS NOT NULL AND want <> is_active", (X.ASSETS, _WANTED))
def _(spark, d):
    rows = X.assets(spark, d)
    _, history = AS.asset_status_updates(rows, rows.where("asset_id % 2 = 0"), rows.where("asset_id % 3 = 0"), X.NOW)
    return history.select("asset_id", "change_type", "previous_is_active", "new_is_active")


@query("sp500_reference", "SELECT asset_id, asset_id IN (SELECT p_partkey FROM part) AS is_sp500 FROM assets", (X.ASSETS,))
def _(spark, d):
    _, flagged = AS.sp500_reference(X.constituents(spark, d), X.assets(spark, d))
    return flagged.select("asset_id", "is_sp500")


@query("pipeline_run_log", "SELECT r.run_id, round(d.s, 3) AS duration_seconds, r.assets_materialized_count, row_count, rows_inserted, rows_updated, rows_deleted FROM per_run r JOIN (SELECT run_id, epoch(max(event_ts)) - epoch(min(event_ts)) AS s FROM mats GROUP BY 1) d ON r.run_id = d.run_id", (X.MATERIALIZATIONS, _ROLLED, _RUNS_ROLLED))
def _(spark, d):
    log, _ = runlog.pipeline_run_log(X.materializations(spark, d), _event_runs(spark, d), X.NOW)
    return log.select("run_id", F.round("duration_seconds", 3).alias("duration_seconds"), "assets_materialized_count", "row_count", "rows_inserted", "rows_updated", "rows_deleted")


# --- 2.12 checks ------------------------------------------------------------------------------------

RUN = quality.RunInfo("run", "job", "2024-01-15", X.NOW)


def check_tables(spark, d: str) -> dict:
    """The tables that the checks read, from the driver's."""
    stamp = F.lit(X.NOW).cast("timestamp")
    listed = P.rename_known(X.constituents(spark, d), AS.CONSTITUENT_NAMES).withColumn("symbol", F.upper("symbol"))
    bars = X.bars(spark, d).withColumn("ingested_ts", stamp)
    gold = _gold(spark, d).withColumns({"trade_count": F.lit(1).cast("long"), "vwap": F.col("close")})
    return {
        "spark": spark, "assets": X.assets(spark, d), "silver_prices": bars, "prices": bars, "gold_prices": gold, "silver_news": X.news(spark, d).withColumn("asset_id", F.col("doc_id")),
        "silver_pageviews": X.views(spark, d), "constituents": J.join_sp500_assets(listed, X.assets(spark, d)), "ranks": X.ranks(spark, d),
    }


_STATUS = "SELECT '{name}' AS check_name, '{severity}' AS severity, CASE WHEN measured > {threshold} THEN 'FAIL' ELSE 'PASS' END AS status, round(CAST(measured AS DOUBLE), 6) AS measured_value, CAST({threshold} AS DOUBLE) AS threshold_value FROM ({body})"
_LEAST = "SELECT '{name}' AS check_name, '{severity}' AS severity, CASE WHEN measured < {threshold} THEN 'FAIL' ELSE 'PASS' END AS status, round(CAST(measured AS DOUBLE), 6) AS measured_value, CAST({threshold} AS DOUBLE) AS threshold_value FROM ({body})"
_EXCESS = "SELECT coalesce(sum(n - 1), 0) AS measured FROM (SELECT count(*) AS n FROM {} GROUP BY {} HAVING count(*) > 1)"
_PRICE_RULES = "open < 0 OR high < 0 OR low < 0 OR close < 0 OR volume < 0 OR high < low OR open > high OR open < low OR close > high OR close < low"

_CHECK_SQL = {
    "dq_silver_assets_active_symbol_uniqueness": (_STATUS, "RED", 0, _EXCESS.format("(SELECT * FROM assets WHERE is_active)", "upper(trim(symbol))"), (X.ASSETS,)),
    "dq_silver_prices_partition_exists": (_LEAST, "RED", 1, "SELECT count(*) AS measured FROM bars", (X.BARS,)),
    "dq_silver_prices_uniqueness_asset_id_timestamp": (_STATUS, "RED", 0, _EXCESS.format("bars", "asset_id, timestamp"), (X.BARS,)),
    "dq_silver_prices_null_thresholds": (_STATUS, "RED", 0, "SELECT count(*) FILTER (volume IS NULL OR close IS NULL) / count(*) AS measured FROM bars", (X.BARS,)),
    "dq_silver_prices_ranges": (_STATUS, "RED", 0, f"SELECT count(*) FILTER ({_PRICE_RULES} OR vwap < 0) AS measured FROM bars", (X.BARS,)),
    "dq_gold_prices_uniqueness_asset_id_trade_date": (_STATUS, "RED", 0, _EXCESS.format("daily", "asset_id, trade_date"), (X.DAILY,)),
    "dq_gold_prices_core_null_thresholds": (_STATUS, "RED", 0, "SELECT count(*) FILTER (volume IS NULL OR close IS NULL) / count(*) AS measured FROM daily", (X.DAILY,)),
    "dq_gold_prices_ranges": (_STATUS, "RED", 0, f"SELECT count(*) FILTER ({_PRICE_RULES} OR dollar_volume < 0 OR realized_vol_21d < 0) AS measured FROM gold", (X.FACTORS,)),
    "dq_silver_news_partition_exists": (_LEAST, "YELLOW", 1, "SELECT count(*) AS measured FROM news", (X.NEWS,)),
    "dq_silver_news_uniqueness_symbol_story_publish_time": (_STATUS, "RED", 0, _EXCESS.format("news", "upper(trim(symbol)), ' ', query_date"), (X.NEWS,)),
    "dq_silver_news_null_threshold_title_or_link": (_STATUS, "YELLOW", 0, "SELECT count(*) FILTER ((title IS NULL OR trim(title) = '') AND (link IS NULL OR trim(link) = '')) / count(*) AS measured FROM news", (X.NEWS,)),
    "dq_silver_wikipedia_partition_exists": (_LEAST, "YELLOW", 1, "SELECT count(*) AS measured FROM views", (X.VIEWS,)),
    "dq_silver_wikipedia_uniqueness_asset_id_view_date_granularity": (_STATUS, "RED", 0, _EXCESS.format("views", "asset_id, view_date, granularity"), (X.VIEWS,)),
    "dq_silver_wikipedia_null_threshold_asset_id": (_STATUS, "YELLOW", 0.25, "SELECT count(*) FILTER (asset_id IS NULL) / count(*) AS measured FROM views", (X.VIEWS,)),
    "dq_silver_wikipedia_range_views_non_negative": (_STATUS, "RED", 0, "SELECT count(*) FILTER (views < 0) AS measured FROM views", (X.VIEWS,)),
    "dq_silver_ref_sp500_uniqueness_symbol": (_STATUS, "YELLOW", 0, _EXCESS.format("constituents", "upper(trim(symbol))"), (X.CONSTITUENTS,)),
    "dq_silver_ref_sp500_null_thresholds": (_STATUS, "YELLOW", 0.25, "SELECT count(*) FILTER (asset_id IS NULL) / count(*) AS measured FROM constituents c LEFT JOIN assets a ON c.symbol = upper(trim(a.symbol))", (X.CONSTITUENTS, X.ASSETS)),
    "dq_bronze_tranco_snapshot_exists": (_LEAST, "YELLOW", 1, "SELECT count(*) AS measured FROM ranks", (X.HOSTS, X.RANKS)),
    "dq_bronze_tranco_schema_rank_domain": (_LEAST, "YELLOW", 1, "SELECT count(*) AS measured FROM (SELECT * FROM ranks LIMIT 1)", (X.HOSTS, X.RANKS)),
    "dq_bronze_tranco_uniqueness_rank_and_domain": (_STATUS, "YELLOW", 0, f"SELECT (SELECT measured FROM ({_EXCESS.format('ranks', 'rank')})) + (SELECT measured FROM ({_EXCESS.format('ranks', 'lower(trim(domain))')})) AS measured", (X.HOSTS, X.RANKS)),
    "dq_bronze_tranco_ranges": (_STATUS, "YELLOW", 0, "SELECT count(*) FILTER (rank < 1 OR rank > 1000000 OR trim(domain) = '') AS measured FROM ranks", (X.HOSTS, X.RANKS)),
    "dq_silver_assets_uniqueness_asset_id_and_symbol": (_STATUS, "RED", 0, f"SELECT (SELECT measured FROM ({_EXCESS.format('assets', 'asset_id')})) + (SELECT measured FROM ({_EXCESS.format('assets', 'upper(trim(symbol))')})) AS measured", (X.ASSETS,)),
    "dq_silver_assets_null_thresholds": (_STATUS, "RED", 0, "SELECT count(*) FILTER (asset_id IS NULL OR is_active IS NULL) / count(*) AS measured FROM assets", (X.ASSETS,)),
    "dq_daily_prices_missing_partition": (_LEAST, "YELLOW", 1, "SELECT count(*) AS measured FROM bars", (X.BARS,)),
    "dq_daily_news_missing_partition": (_LEAST, "YELLOW", 1, "SELECT count(*) AS measured FROM news", (X.NEWS,)),
    "dq_wikipedia_activity_missing_partition": (_LEAST, "YELLOW", 1, "SELECT count(*) AS measured FROM views", (X.VIEWS,)),
    "prices_active_symbol_coverage": (_STATUS, "RED", 0, "SELECT count(*) AS measured FROM missing", (X.BARS, X.ASSETS, _MISSING)),
    "wikipedia_assets_with_views_min_count": (_LEAST, "YELLOW", 400, "SELECT count(DISTINCT asset_id) AS measured FROM views", (X.VIEWS,)),
    "daily_news_partition_row_count": (_LEAST, "YELLOW", 1, "SELECT count(*) AS measured FROM news", (X.NEWS,)),
}


def _check(name: str):
    found = _CHECK_SQL.get(name)
    sql = None if found is None else found[0].format(name=name, severity=found[1], threshold=found[2], body=found[3])

    @query(name, sql, found[4] if found else ())
    def run(spark, d):
        row = quality.CHECKS[name](check_tables(spark, d), RUN, {})
        return row.select("check_name", "severity", "status", F.round("measured_value", 6).alias("measured_value"), "threshold_value")


for _name in _CHECK_SQL:
    _check(_name)

#: Checks of what tables there are and of their columns: name, severity, measured, threshold, the table, its SQL. The query gives its rows as well.
_SHAPE_CHECKS = [
    ("dq_silver_prices_schema_required_columns", "RED", 0.0, 0.0, "silver_prices", "bars", (X.BARS,)),
    ("dq_silver_prices_schema_range_columns", "YELLOW", 0.0, 0.0, "silver_prices", "bars", (X.BARS,)),
    ("dq_gold_prices_table_exists", "RED", 1.0, 1.0, "gold_prices", "daily", (X.DAILY,)),
    ("dq_gold_prices_schema_required_columns", "RED", 0.0, 0.0, "gold_prices", "daily", (X.DAILY,)),
    ("dq_gold_prices_schema_range_columns", "YELLOW", 0.0, 0.0, "gold_prices", "daily", (X.DAILY,)),
    ("dq_silver_news_schema_required_columns", "RED", 0.0, 0.0, "silver_news", "news", (X.NEWS,)),
    ("dq_silver_wikipedia_schema_required_columns", "RED", 0.0, 0.0, "silver_pageviews", "views", (X.VIEWS,)),
    ("dq_silver_ref_sp500_table_exists", "YELLOW", 1.0, 1.0, "constituents", "constituents", (X.CONSTITUENTS,)),
    ("dq_silver_ref_sp500_schema_required_columns", "YELLOW", 0.0, 0.0, "constituents", "constituents", (X.CONSTITUENTS,)),
    ("dq_silver_assets_table_exists", "RED", 1.0, 1.0, "assets", "assets", (X.ASSETS,)),
    ("dq_silver_assets_schema_required_columns", "RED", 0.0, 0.0, "assets", "assets", (X.ASSETS,)),
]


def _double(value: float | None) -> str:
    return f"CAST({'NULL' if value is None else value} AS DOUBLE)"


def _shape_sql(name: str, severity: str, measured: float | None, threshold: float | None, table: str) -> str:
    return f"SELECT '{name}' AS check_name, '{severity}' AS severity, 'PASS' AS status, {_double(measured)} AS measured_value, {_double(threshold)} AS threshold_value, count(*) AS n_rows FROM {table}"


def _shape_check(name: str, severity: str, measured: float | None, threshold: float | None, table: str, sql_table: str, with_: tuple[str, ...]):
    @query(name, _shape_sql(name, severity, measured, threshold, sql_table), with_)
    def run(spark, d):
        tables = check_tables(spark, d)
        row = quality.CHECKS[name](tables, RUN, {}).select("check_name", "severity", "status", "measured_value", "threshold_value")
        return row.join(F.broadcast(tables[table].agg(F.count("*").alias("n_rows"))))


for _shape in _SHAPE_CHECKS:
    _shape_check(*_shape)


@query("dq_active_symbols_source_silver_assets_readable", "SELECT 'dq_active_symbols_source_silver_assets_readable' AS check_name, 'RED' AS severity, CASE WHEN n < 1 THEN 'WARN' ELSE 'PASS' END AS status, CAST(n AS DOUBLE) AS measured_value, CAST(1 AS DOUBLE) AS threshold_value FROM (SELECT count(*) FILTER (is_active AND trim(symbol) <> '') AS n FROM assets)", (X.ASSETS,))
def _(spark, d):
    return quality.CHECKS["dq_active_symbols_source_silver_assets_readable"](check_tables(spark, d), RUN, {}).select("check_name", "severity", "status", "measured_value", "threshold_value")


@query("dq_severity", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'YELLOW' WHEN 1 THEN CASE WHEN o_custkey % 2 = 0 THEN 'YELLOW' ELSE 'RED' END WHEN 2 THEN 'YELLOW' ELSE 'RED' END AS severity FROM orders")
def _(spark, d):
    name = F.element_at(F.array(*map(F.lit, ["dq_daily_news", "dq_silver_prices_null_thresholds", "dq_bronze_tranco_ranges", "dq_gold_prices_ranges"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return X.table(spark, d, "orders").select("o_orderkey", quality.dq_severity(name, F.when(F.col("o_custkey") % 2 == 0, 0.5)).alias("severity"))


@query("freshness_severity", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'YELLOW' ELSE 'RED' END AS severity FROM orders")
def _(spark, d):
    name = F.when(F.col("o_orderkey") % 2 == 0, "daily_news_partition_row_count").otherwise("prices_active_symbol_coverage")
    return X.table(spark, d, "orders").select("o_orderkey", quality.freshness_severity(name).alias("severity"))


def _suite_sql() -> tuple[str, tuple[str, ...]]:
    """The suite's rows: those of the single checks, but for the missing rank list."""
    parts, tables = [], {}
    for name in quality.CHECKS:
        if name.startswith("dq_bronze_tranco_"):
            measured = 0.0 if name.endswith("_exists") else None
            parts.append(f"SELECT '{name}' AS check_name, 'YELLOW' AS severity, 'FAIL' AS status, {_double(measured)} AS measured_value")
            continue
        if name in _CHECK_SQL:
            sql, severity, threshold, body, with_ = _CHECK_SQL[name]
            one_row = sql.format(name=name, severity=severity, threshold=threshold, body=body)
        elif found := next((x for x in _SHAPE_CHECKS if x[0] == name), None):
            one_row, with_ = _shape_sql(*found[:4], found[5]), found[6]
        else:
            continue
        parts.append(f"SELECT check_name, severity, status, measured_value FROM ({one_row})")
        tables |= dict.fromkeys(with_)
    last = "dq_active_symbols_source_silver_assets_readable"
    parts.append(f"SELECT '{last}', 'RED', CASE WHEN n < 1 THEN 'WARN' ELSE 'PASS' END, CAST(n AS DOUBLE) FROM (SELECT count(*) FILTER (is_active AND trim(symbol) <> '') AS n FROM assets)")
    return " UNION ALL ".join(parts), tuple(t for t in tables if not any(t in x for x in tables if x != t))  # some hold others


@query("check_isolation", *_suite_sql())
def _(spark, d):
    """Every check, with one table missing: its checks fail or are skipped, the others run."""
    tables = check_tables(spark, d)
    del tables["ranks"]
    out = quality.check_isolation(list(quality.CHECKS), tables, RUN)
    return out.select("check_name", "severity", "status", F.round("measured_value", 6).alias("measured_value"))


@query("write_dq_log", """SELECT 'dq_daily_prices' AS check_name, 'YELLOW' AS severity, 'FAIL' AS status, CAST(count(*) AS DOUBLE) AS measured_value, '{"table":"orders","error_name":"ValueError","error_message":"bad"}' AS details_json FROM orders""")
def _(spark, d):
    path = scratch_path(spark, "dq-log")
    rows = X.table(spark, d, "orders").count()
    quality.write_dq_log(spark, path, "dq_daily_prices", "YELLOW", "FAIL", RUN, float(rows), 0.0, {"table": "orders"}, ValueError("bad"))
    return spark.read.parquet(path).select("check_name", "severity", "status", "measured_value", "details_json")
