"""Stage tables -- read a saved stage if present, else compute and publish once."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from yieldcast.sources.files import write_table


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a committed table or model stands at ``path``."""
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path(path, "_SUCCESS"))


def commit(spark: SparkSession, path: str) -> None:
    """Mark a folder of several tables as whole, as writers of single tables do."""
    fs, hadoop_path = _fs(spark, path)
    fs.create(hadoop_path(path, "_SUCCESS")).close()


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path(path), True)


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder of its own, then move it to ``path``.

    A writer that dies leaves only its own folder behind. If another writer has published meanwhile, its
    table stays and this one is dropped. An uncommitted folder at ``path`` (of an older layout) is replaced.
    """
    building = f"{path.rstrip('/')}.building-{uuid.uuid4().hex}"
    fs, hadoop_path = _fs(spark, path)
    try:
        write(building)
        if not exists(spark, path):
            target = hadoop_path(path)
            if fs.exists(target):
                fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(hadoop_path(building), target) and not exists(spark, path):
                raise OSError(f"cannot move {building} to {path}")
    finally:
        fs.delete(hadoop_path(building), True)


def stage_table(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                partition_by: Sequence[str] | None = ("year",)) -> DataFrame:
    """Return the stage at ``path``; build and publish it first when missing.

    An error of the build is raised as it is. The returned frame is always the re-read table (lineage cut at the
    stage boundary, so a lost executor recomputes from the stored table).
    """
    if not exists(spark, path):
        publish(spark, path, lambda to: write_table(build(), to, partition_by=partition_by))
    return spark.read.parquet(path)
