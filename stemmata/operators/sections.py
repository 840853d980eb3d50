"""Addresses of text: chapter and verse from division paths, boundaries, anchors.

A division has a path of numbers, a level (1 at the top) and belongs to a version with ``depth`` declared
levels. Divisions deeper than that, and divisions without units, make no section.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from .numbering import occurrence_label


def addresses(divs: DataFrame, *, compact: bool = False) -> DataFrame:
    """(chapter, verse, source_ref) of the divisions with units of their own.

    One level: the chapter is ``1`` and the division the verse. More levels: a division at the last level
    has its parent's path as chapter; one a level above that holds units has its grandparent's path, or its
    own number where it has none. ``compact``: the division is the chapter and each unit a verse.
    ``divs``: path, delimiters, level, depth, has_units, and unit_id with ``compact``.
    """
    ref = text.reference(F.col("path"), F.col("delimiters"))
    rows = divs.where("has_units").withColumn("source_ref", ref)
    if compact:
        return rows.withColumn("chapter", ref).withColumn("verse", F.col("unit_id"))
    parents = text.reference(F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0))), F.col("delimiters"))
    shallow = F.col("level") < F.col("depth")
    chapter = F.when(F.col("depth") == 1, F.lit("1")).when(F.size("path") == 1, F.element_at("path", 1)).otherwise(parents)
    rows = rows.where(F.col("level") <= F.col("depth")).where((F.col("depth") <= 2) | (F.col("level") >= F.col("depth") - 1))
    return rows.withColumn("chapter", chapter).withColumn("verse", F.element_at("path", -1)).withColumn("is_shallow", shallow)


def unique_addresses(sections: DataFrame, version: str, order: list[str]) -> DataFrame:
    """Repeated verses of a chapter get ``~2``, ``~3``; the source's reference stays. Adds verse_index and section_occurrence."""
    n = F.row_number().over(Window.partitionBy(version, "chapter", "verse").orderBy(*order))
    return (
        sections.withColumn("section_occurrence", n)
        .withColumn("label", occurrence_label(F.col("verse"), [version, "chapter", "verse"], order))
        .withColumn("verse_index", F.row_number().over(Window.partitionBy(version).orderBy(*order)))
    )


def unit_boundaries(units: DataFrame, version: list[str], order: list[str], linebreak: Column) -> DataFrame:
    """What separates a unit from the next: a line break, else one space unless it is the version's last."""
    last = F.lead(F.lit(1)).over(Window.partitionBy(*version).orderBy(*order)).isNull()
    own = text.boundary(linebreak)
    return units.withColumn("boundary", F.when(own != "", own).when(last, "").otherwise(" "))


def first_of_both(reading: Column, unit: Column) -> Column:
    """The reading's line break if it is not empty before stripping, else the unit's: a blank one hides the unit's."""
    return F.when(F.coalesce(reading, F.lit("")) != "", reading).otherwise(F.coalesce(unit, F.lit("")))


def anchors(divs: DataFrame, slots: DataFrame, version: str, path: str = "path") -> DataFrame:
    """An anchor for every division: its first slot, else that of the nearest ancestor with slots, else the version's first.

    ``slots``: (version, path, slot) of the divisions that own slots, those of their descendants included.
    """
    first = slots.groupBy(version, path).agg(F.min("slot").alias("slot")).withColumnRenamed(path, "__prefix")
    whole = slots.groupBy(version).agg(F.min("slot").alias("__version_slot"))
    prefixes = divs.select(version, path, F.explode(F.transform(F.sequence(F.lit(1), F.size(path)), lambda n: F.slice(path, 1, n))).alias("__prefix"))
    nearest = prefixes.join(first, [version, "__prefix"]).groupBy(version, path).agg(F.max_by("slot", F.size("__prefix")).alias("slot"), F.max(F.size("__prefix")).alias("anchor_level"))
    return divs.join(nearest, [version, path], "left").join(whole, version, "left").withColumn("slot", F.coalesce("slot", "__version_slot")).withColumn("anchor_level", F.coalesce("anchor_level", F.lit(0))).drop("__version_slot")


def with_ancestors(slots: DataFrame, path: str = "path") -> DataFrame:
    """Each slot's row once for its division and once for every ancestor."""
    return slots.withColumn(path, F.explode(F.transform(F.sequence(F.lit(1), F.size(path)), lambda n: F.slice(path, 1, n))))
