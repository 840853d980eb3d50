"""Fail closed: a broken rule raises, nothing is guessed.

``broken`` counts of a rule are taken eagerly; ``raise_if`` puts the error into the plan itself where a
separate pass would be too much.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        if name not in df.columns:
            raise ValueError(f"column {name!r} is not loaded")
    return df


def none_of(df: DataFrame, what: str, *, error: type[Exception] = ValueError, show: int = 3) -> None:
    """``df`` holds what breaks a rule: it must be empty."""
    if found := df.limit(show).collect():
        raise error(f"{what}: " + "; ".join(str(r.asDict()) for r in found))


def repeated(df: DataFrame, *key: str) -> DataFrame:
    """The keys that occur more than once, with their number."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def dangling(df: DataFrame, other: DataFrame, *key: str) -> DataFrame:
    """Rows whose key is missing in ``other``."""
    return df.join(other.select(*key).distinct(), list(key), "left_anti")


def raise_if(condition: Column, message: Column | str, value: Column) -> Column:
    """``value``, or an error where the condition holds."""
    return F.when(condition, F.raise_error(message if isinstance(message, Column) else F.lit(message)).cast("string")).otherwise(value)


def exists(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise KeyError(what)
    return df
