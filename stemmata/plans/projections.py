"""The driver's tables seen as editions.

An order is a version (and passage) of the work that is its customer; the distinct line numbers of an order
are its units; suppliers are witnesses; what an order's line says for a supplier is a reading, and returned
lines are omissions. Documents, conversations, events and parts stand for texts, turns, aligned streams and
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(version, unit)."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("version"), F.col("l_linenumber").cast("long").alias("unit")).distinct()


def witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(version, witness): the suppliers that an order cites."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("version"), F.col("l_suppkey").alias("witness")).distinct()


def attestations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(version, unit, witness, text): the least of several texts, so that a witness has one reading of a unit."""
    said = F.when(F.col("l_returnflag") == "R", "").otherwise(F.concat("l_returnflag", "l_linestatus", F.lit("-"), F.col("l_partkey").cast("string")))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("version"), F.col("l_linenumber").cast("long").alias("unit"), F.col("l_suppkey").alias("witness"), said.alias("text"))
    return rows.groupBy("version", "unit", "witness").agg(F.min("text").alias("text"))


UNITS = "SELECT DISTINCT l_orderkey AS version, l_linenumber::BIGINT AS unit FROM lineitem"
WITNESSES = "SELECT DISTINCT l_orderkey AS version, l_suppkey AS witness FROM lineitem"
ATTESTATIONS = """SELECT l_orderkey AS version, l_linenumber::BIGINT AS unit, l_suppkey AS witness,
  min(CASE WHEN l_returnflag = 'R' THEN '' ELSE l_returnflag || l_linestatus || '-' || l_partkey END) AS text
FROM lineitem GROUP BY ALL"""
MATRIX = f"""SELECT u.version, u.unit, w.witness, a.text,
  CASE WHEN a.text IS NULL THEN 'unattested' WHEN a.text = '' THEN 'omission' ELSE 'reading' END AS status
FROM ({UNITS}) u JOIN ({WITNESSES}) w ON u.version = w.version
LEFT JOIN ({ATTESTATIONS}) a ON a.version = u.version AND a.unit = u.unit AND a.witness = w.witness"""
