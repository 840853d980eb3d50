"""Extensions beyond batch: the counts that arrive with a stream of attestations or events.

The batch operators know no streams; these are additions. They keep bounded state by watermarks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, *, time: str, keys: list[str], value: str, width: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Number and sum by key and time window; rows later than the watermark are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, *, time: str, keys: list[str], gap: str = "20 minutes", late: str = "30 minutes") -> DataFrame:
    """Runs of rows of a key without a pause of ``gap``."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
