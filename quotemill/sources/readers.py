"""Readers of the layered tables and of landed payloads."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.calendar import window_bounds
from ..functions.columns import article_title, epoch_to_ts, norm_symbol
from ..operators.aggregations import dedupe_active_assets
from .versions import snapshot


def scan_day_range(spark: SparkSession, root: str, as_of: date, ts: str = "timestamp", day: str = "date") -> DataFrame:
    """One day's partition, and of it the rows of [day, day + 1)."""
    table = snapshot(spark, root)
    return day_range(table.read(as_of, as_of + timedelta(days=1)) if table.by == day else table.read(), as_of, ts, day)


def day_range(df: DataFrame, as_of: date, ts: str, day: str | None = None) -> DataFrame:
    rows = df if day is None or day not in df.columns else df.where(F.col(day) == F.lit(as_of))
    return rows.where((F.col(ts) >= F.lit(as_of)) & (F.col(ts) < F.lit(as_of + timedelta(days=1))))


def scan_active_bars(bars: DataFrame, assets: DataFrame) -> DataFrame:
    """Bars of active symbols only."""
    active = dedupe_active_assets(assets).select(F.col("symbol").alias("_symbol"))
    return bars.join(active, norm_symbol("symbol") == F.col("_symbol"), "left_semi")


def scan_silver_day(spark: SparkSession, root: str, as_of: date, day: str = "date") -> DataFrame:
    return snapshot(spark, root).between(day, as_of, as_of + timedelta(days=1))


def scan_month(spark: SparkSession, root: str, month: date, day: str = "date") -> DataFrame:
    """All days of the month."""
    first = month.replace(day=1)
    return snapshot(spark, root).between(day, first, (first + timedelta(days=32)).replace(day=1))


def scan_trailing(df: DataFrame, as_of: date, days: int, day: str) -> DataFrame:
    """Rows of [as_of - (days - 1), as_of]."""
    start, end = window_bounds(as_of, days)
    return df.where((F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end)))


def scan_trailing_30d(spark: SparkSession, root: str, as_of: date, day: str = "date") -> DataFrame:
    return snapshot(spark, root).between(day, *window_bounds(as_of, 30))


def scan_trailing_59d(spark: SparkSession, root: str, as_of: date, day: str = "view_date") -> DataFrame:
    """30 days of output and the 29 before that their windows need."""
    return snapshot(spark, root).between(day, *window_bounds(as_of, 59))


def _view(spark: SparkSession, root: str, names: tuple[str, ...]) -> DataFrame:
    table = snapshot(spark, root)
    df = spark.read.option("mergeSchema", "true").parquet(root) if table.plain else table.read()
    for name in names:
        df.createOrReplaceTempView(name)
    return df


def view_prices_compact(spark: SparkSession, root: str, name: str = "silver_prices_compact") -> DataFrame:
    return _view(spark, root, (name,))


def view_news(spark: SparkSession, root: str, name: str = "silver_news") -> DataFrame:
    return _view(spark, root, (name,))


def view_pageviews(spark: SparkSession, root: str, name: str = "silver_pageviews", aliases: tuple[str, ...] = ()) -> DataFrame:
    """The view, and the same under other names."""
    return _view(spark, root, (name, *aliases))


def scan_rank_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless `rank,domain` lines."""
    return spark.read.schema(schemas.RANKS).csv(path, header=False)


def snapshot_as_of(df: DataFrame, as_of: date, day: str = "date") -> DataFrame:
    """The newest snapshot not after `as_of`, else the newest of all."""
    d = F.col(day)
    chosen = df.agg(F.coalesce(F.max(F.when(d <= F.lit(as_of), d)), F.max(d)).alias("_chosen"))
    return df.join(F.broadcast(chosen), d == F.col("_chosen")).drop("_chosen")


def snapshot_latest(df: DataFrame, day: str = "date") -> DataFrame:
    newest = df.agg(F.max(day).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(day) == F.col("_newest")).drop("_newest")


def newest_day(values: list[str], as_of: date | None = None) -> str | None:
    """The newest of sorted days that is not after `as_of`, else the newest of all."""
    before = [v for v in values if as_of is None or v <= as_of.isoformat()]
    return (before or values or [None])[-1]


def scan_snapshot_as_of(spark: SparkSession, root: str, as_of: date, day: str = "date") -> DataFrame:
    """`snapshot_as_of` of a stored table. The day comes from the names of its partitions, so one partition is read; a table that isn't parted by day is read twice, as there."""
    table = snapshot(spark, root)
    found = newest_day(table.days(day), as_of)
    return snapshot_as_of(table.read(), as_of, day) if found is None else table.day(day, found)


def scan_snapshot_latest(spark: SparkSession, root: str, day: str = "date") -> DataFrame:
    """`snapshot_latest` (or `latest_slice`) of a stored table, by the names of its partitions."""
    table = snapshot(spark, root)
    found = newest_day(table.days(day))
    return snapshot_latest(table.read(), day) if found is None else table.day(day, found)


def ingest_bars(raw: DataFrame) -> DataFrame:
    """Upper-case the symbol and stamp the rows; without a symbol column the result is empty."""
    if "symbol" not in raw.columns:
        return raw.withColumns({"symbol": F.lit(None).cast("string"), "ingested_ts": F.current_timestamp()}).where(F.lit(False))
    return raw.withColumns({"symbol": F.upper("symbol"), "ingested_ts": F.current_timestamp()})


def ingest_assets(raw: DataFrame, source_id: str = "id") -> DataFrame:
    return raw.withColumns({source_id: F.col(source_id).cast("string"), "ingested_ts": F.current_timestamp()})


_STORY = T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in ("uuid", "title", "publisher", "link", "type", "summary")] + [T.StructField("providerPublishTime", T.DoubleType())]))
_VIEWS = T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in ("project", "article", "granularity", "timestamp", "access", "agent")] + [T.StructField("views", T.LongType())]))


def ingest_news_json(raw: DataFrame, payload: str = "payload", query_date: date | None = None) -> DataFrame:
    """Stories of each symbol's landed array; epoch seconds become UTC timestamps."""
    rows = raw.select(F.upper("symbol").alias("symbol"), F.explode(F.from_json(payload, _STORY)).alias("s"))
    day = F.lit(query_date).cast("date") if query_date else F.current_date()
    return rows.select("symbol", "s.uuid", "s.title", "s.publisher", "s.link", epoch_to_ts("s.providerPublishTime").alias("provider_publish_time"), "s.type", "s.summary", day.alias("query_date"), F.current_timestamp().alias("ingested_ts"))


def ingest_pageviews_json(raw: DataFrame, as_of: date, payload: str = "payload", project: str = "en.wikipedia.org") -> DataFrame:
    """Items of each company's landed array; blank article and project take the request's; the date is the requested day."""
    rows = raw.select("symbol", "company_name", F.col("article").alias("_article"), F.explode(F.from_json(payload, _VIEWS)).alias("i"))
    pick = lambda c, other: F.coalesce(F.when(c != "", c), other)
    return rows.select(
        "symbol", "company_name", pick(F.col("i.article"), F.col("_article")).alias("article"), pick(F.col("i.project"), F.lit(project)).alias("project"),
        "i.access", "i.agent", "i.granularity", F.lit(as_of.strftime("%Y%m%d")).alias("view_date"), "i.views", F.current_timestamp().alias("ingested_ts"),
    )


def ingest_title_bindings(raw: DataFrame, seq: str = "seq", prefix: str = "https://en.wikipedia.org/wiki/") -> DataFrame:
    """(symbol, title) of (ticker, article URL) rows; blanks go, of several the last by `seq` stays."""
    title = article_title(F.regexp_replace("article", "^" + prefix.replace(".", r"\."), ""))
    rows = raw.select(norm_symbol("ticker").alias("symbol"), title.alias("title"), F.col(seq).alias("_seq")).where("symbol <> '' AND title <> ''")
    return rows.groupBy("symbol").agg(F.max_by("title", "_seq").alias("title"))


def schema_probe(df: DataFrame, required: set[str]) -> list[str]:
    """Required columns that are missing, sorted."""
    return sorted(set(required) - set(df.columns))


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """Whether a catalog table, or a path, is there."""
    if "/" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    path = spark._jvm.org.apache.hadoop.fs.Path(name_or_path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
