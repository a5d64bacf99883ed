"""Page-view jobs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import window_bounds
from ..functions.columns import parse_view_date
from ..operators.joins import join_fallback
from ..operators.merges import purge_before, refresh_window
from ..operators.windows import rolling_views_30
from ..sources.readers import scan_trailing_59d
from ..sources.sinks import sink_merge_keep_last
from ..sources.versions import load, snapshot
from .prices import Paths

KEYS = ["asset_id", "view_date", "granularity"]


def silver_pageview_rows(raw: DataFrame, assets: DataFrame, as_of: date) -> DataFrame:
    """Page views with asset ids (by symbol, else by name) and dates."""
    rows = join_fallback(raw, assets).withColumn("view_date", parse_view_date("view_date", as_of))
    return rows.select("asset_id", "granularity", "view_date", "views", "ingested_ts")


def silver_pageviews(spark: SparkSession, paths: Paths, as_of: date) -> None:
    raw = load(spark, paths.table("bronze", "pageviews")).where(F.col("view_date") == as_of.strftime("%Y%m%d"))
    new = silver_pageview_rows(raw, load(spark, paths.table("silver", "assets")), as_of)
    sink_merge_keep_last(new, paths.table("silver", "pageviews"), KEYS, "ingested_ts")


def activity_rows(views: DataFrame, as_of: date) -> DataFrame:
    """The 30 days to `as_of` with their 30-row means; `views` reaches 29 days further back."""
    start, end = window_bounds(as_of, 30)
    rows = views.where(F.col("asset_id").isNotNull()).withColumnRenamed("view_date", "activity_date")
    rolled = rolling_views_30(rows, tie="granularity")
    inside = rolled.where((F.col("activity_date") >= F.lit(start)) & (F.col("activity_date") < F.lit(end)))
    return inside.select("asset_id", "activity_date", F.lit("wikipedia").alias("source"), F.lit("pageviews").alias("event_type"), "views", "views_30d_avg", "views_vs_30d_avg", "ingested_ts")


def gold_activity(spark: SparkSession, paths: Paths, as_of: date) -> None:
    """Rebuild the last 30 days; without page views nothing changes, not even by purging."""
    views = scan_trailing_59d(spark, paths.table("silver", "pageviews"), as_of)
    if views.isEmpty():
        return
    table, (start, end) = snapshot(spark, paths.table("gold", "activity")), window_bounds(as_of, 30)
    rows = activity_rows(views, as_of)
    if table.exists():
        rows = refresh_window(purge_before(table.read(), "activity_date", start), rows, "activity_date", start, end)
    table.replace(rows)
