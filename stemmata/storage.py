"""Intermediate tables, written once and read where they are needed: lineage ends there, and lost executors lose nothing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def _folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; where it is unset, a folder of this process, if Spark runs in it alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="stemmata-kept-"))
    return "file://" + _own[0]


def new_folder(spark: SparkSession, name: str) -> str:
    """The URI of a folder of the cluster's shared one that nothing else uses."""
    return f"{_folder(spark)}/stemmata/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """The table as written. Joins with it are by sorting: the size of its files says little of that of its rows, which compress to a
    hundredth where keys and texts repeat, so that Spark would gather millions of them in the driver to send them to all tasks."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).hint("merge")


@atexit.register
def _clear() -> None:
    """The process's own folder goes with it; a shared one is its owner's to clear."""
    while _own:
        shutil.rmtree(_own.pop(), ignore_errors=True)
