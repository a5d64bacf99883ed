"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; where unset a local folder, set here, but only in local mode: a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quotemill-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_temporary: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession):
    """What is put into the shared folder meanwhile is removed at the end, but for what is `lasting`."""
    _temporary.append([])
    try:
        yield
    finally:
        for path in _temporary.pop():
            held = spark._jvm.org.apache.hadoop.fs.Path(path)
            held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(held, True)


def new_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    owners = _temporary[:-1] if lasting else _temporary
    if owners:
        owners[-1].append(path)
    return path


def keep(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = new_path(df.sparkSession, name, lasting)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a URI or an absolute local path."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def write_atomic(uri: str, name: str, write) -> None:
    """Call `write(sink)` on a hidden file, then rename it; a repeated task attempt replaces the file by an equal one."""
    fs, path = open_fs(uri)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as sink:
        write(sink)
    fs.move(part, f"{path}/{name}")


_COPIES: dict[str, str] = {}


def memory_map(uri: str) -> pa.Buffer:
    """The file's bytes, memory-mapped: in place on a mounted folder, else from one local copy per process."""
    fs, path = open_fs(uri)
    if not isinstance(fs, pafs.LocalFileSystem):
        if uri not in _COPIES:
            handle, held = tempfile.mkstemp()
            atexit.register(os.unlink, held)
            with os.fdopen(handle, "wb") as out, fs.open_input_stream(path) as source:
                while chunk := source.read(1 << 22):
                    out.write(chunk)
            _COPIES[uri] = held
        path = _COPIES[uri]
    if not os.path.getsize(path):
        return pa.py_buffer(b"")
    return pa.memory_map(path).read_buffer()


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
