"""A path for intermediate tables in a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """Under `spark.checkpoint.dir`; where that is unset, under a local temporary folder, but only in local mode: a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master
    if not root and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = root or "file://" + tempfile.mkdtemp(prefix="quotemill-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
