"""Tables written to the shared folder of the cluster, to cut lineage and to be read more than once.

The folder is the one named by ``spark.checkpoint.dir``. Where that is unset and Spark runs in this process
alone, as in tests, a folder of this process is used; on a cluster that is an error, since executors share no
local folder. Written tables survive the loss of executors.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="stemmata-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the table read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stemmata/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``written``, and joins with the table are by sorting unless a broadcast is asked for: the size of its files, and a share of it for
    some columns, says little of its rows, least of all where an array among them is exploded into many."""
    return written(df, name).hint("merge")


def keep_until_exit(spark: SparkSession, path: str) -> str:
    """Note a folder that the process shall delete at its end, as it does with written tables."""
    _written.append((spark, path))
    return path


def drop_written() -> None:
    """Delete every table this process has written; the results that read them must be done."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended: the folder's owner clears it
            return


atexit.register(drop_written)


def arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the Arrow batches that go to Python workers: long texts make large rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
