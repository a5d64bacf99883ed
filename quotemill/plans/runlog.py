"""Run logs from a table of materialization events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import add_column_if_missing
from ..operators.aggregations import asset_metrics_rollup, run_duration, run_metrics_rollup


def pipeline_run_log(events: DataFrame, runs: DataFrame, now: datetime) -> tuple[DataFrame, DataFrame]:
    """(run_log, run_asset_log); totals of a run without events are null, but for the count of 0."""
    stamp = F.lit(now).cast("timestamp")
    for name in ("partition_key", "tags_json", "error_message"):
        runs = add_column_if_missing(runs, name, "string")
    per_asset = asset_metrics_rollup(events)
    asset_log = per_asset.join(runs.select("run_id", "status", "partition_key"), "run_id", "left").withColumn("logged_ts", stamp)
    totals = run_metrics_rollup(per_asset, ("run_id",))
    rows = run_duration(events, runs).join(totals, "run_id", "left").withColumns({"assets_materialized_count": F.coalesce("assets_materialized_count", F.lit(0)), "logged_ts": stamp})
    return rows.select(*[f.name for f in schemas.RUN_LOG.fields]), asset_log.select(*[f.name for f in schemas.RUN_ASSET_LOG.fields])
