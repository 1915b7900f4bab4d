"""Where intermediate tables and stream checkpoints live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# Tables that ``store`` wrote in this process, for ``discard``.
_stored: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a folder of one
    machine would be lost with it, so the setting is required there.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    # "local-cluster" has executors of its own, and a client that knows no master may talk to any cluster.
    if master == "local" or master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(SETTING, folder) if spark.conf.isModifiable(SETTING) else None
        return folder
    raise RuntimeError(f"set {SETTING} to a folder all executors share")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table used several times and read it back: no recomputation, pruned scans, short lineage."""
    path = fresh_path(df.sparkSession, name)
    _stored.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path, whatever store it is in, and the path as that system has it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the tables below a folder that were written to their end, rising."""
    system, where = _files(spark, folder)
    if not system.exists(where):
        return []
    named = [s.getPath().getName() for s in system.listStatus(where)]
    numbers = [int(n.removeprefix("version=")) for n in named if n.startswith("version=")]
    return sorted(n for n in numbers if system.exists(_files(spark, f"{folder}/version={n}/_SUCCESS")[1]))


def write_version(df: DataFrame, folder: str, number: int) -> DataFrame:
    """One numbered table below a folder; what a failed attempt left of it is overwritten."""
    path = f"{folder}/version={number}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_version(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame | None:
    """A numbered table, the newest one by default; None if there is none."""
    known = versions(spark, folder)
    number = (known or [None])[-1] if number is None else number
    return spark.read.parquet(f"{folder}/version={number}") if number in known else None


def drop_versions(spark: SparkSession, folder: str, before: int) -> None:
    """Delete the tables with smaller numbers."""
    for n in versions(spark, folder):
        if n < before:
            system, where = _files(spark, f"{folder}/version={n}")
            system.delete(where, True)


def discard(spark: SparkSession) -> int:
    """Delete the tables that ``store`` wrote in this process, once nothing reads them any more; how many there were."""
    files, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    n = len(_stored)
    while _stored:
        path = files.Path(_stored.pop())
        path.getFileSystem(conf).delete(path, True)
    return n
