"""Session defaults for tests, the bench and stand-alone use."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def build_session(cores: str | int = "*", app: str = "tillworks", **conf) -> SparkSession:
    """A local session. A cluster brings its own; nothing below is needed there except adaptive execution."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TILLWORKS_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one only in local mode, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tillworks-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


_SCRATCH: list[str] = []
_TABLES: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below :func:`shared_folder`; it stays until :func:`remove_scratch`."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def _at(spark: SparkSession, name: str):
    """(file system, path) of a name on whatever storage it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, name: str) -> bool:
    files, path = _at(spark, name)
    return files.exists(path)


def delete_path(spark: SparkSession, name: str) -> None:
    """Delete a file or folder with all below it, if it is there."""
    files, path = _at(spark, name)
    files.delete(path, True)


def move_path(spark: SparkSession, old: str, new: str) -> None:
    """Put a file or folder in the place of another; nothing to do if it is not there (any more)."""
    files, source = _at(spark, old)
    if files.exists(source):
        target = _at(spark, new)[1]
        files.delete(target, True)
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise OSError(f"{old} could not be moved to {new}")


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    files, draft = _at(spark, f"{name}.draft")
    out = files.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    move_path(spark, f"{name}.draft", name)


def folders_below(spark: SparkSession, name: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    files, path = _at(spark, name)
    return [f.getPath().getName() for f in files.listStatus(path) if f.isDirectory()] if files.exists(path) else []


def remove_scratch(spark: SparkSession) -> int:
    """Delete what this process wrote to scratch paths, once no frame built on them is needed; returns how many there were."""
    n = len(_SCRATCH)
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS `{_TABLES.pop()}`")
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())
    return n


def observed(told: Observation) -> dict:
    """What an observation counted; nothing if the frame turned out to be empty while it was planned, which leaves the observation out."""
    try:
        return told.get
    except Py4JJavaError:
        return {}


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: survives lost executors and keeps plans built on top small."""
    path = scratch_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int, name: str = "bucketed") -> DataFrame:
    """Write a frame as a table cut and sorted by a key, below the shared folder; joins and groupings on the key then need no shuffle among
    tables of as many buckets. All rows of a key lie in one file: for keys with few rows each."""
    path = scratch_path(df.sparkSession, name)
    table = "tillworks_" + path.rsplit("/", 1)[1].replace("-", "_")
    _TABLES.append(table)
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)
