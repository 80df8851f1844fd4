"""Intermediate tables in the folder that all executors share.

The folder is the session's ``spark.checkpoint.dir``.  Only where that is unset
(tests, a laptop) is a private folder made and set.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, else a new folder of our own, for local sessions."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path is None:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="lexmill-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lexmill/{name}-{uuid.uuid4().hex}"


def _remember(spark: SparkSession, path: str) -> None:
    if not _written:
        atexit.register(clear)
    _written.append((spark, path))


def folder(spark: SparkSession, name: str) -> str:
    """A path for files that tasks write themselves; deleted with the tables."""
    path = new_path(spark, name)
    _remember(spark, path)
    return path


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the table read again: lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    _remember(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def finished(path: str) -> DataFrame | None:
    """The table at ``path`` if it was written to its end, else None."""
    spark = SparkSession.active()
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return spark.read.parquet(path) if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) else None


def clear() -> None:
    """Delete the tables that this process wrote."""
    while _written:
        spark, path = _written.pop()
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session may be gone
            return
