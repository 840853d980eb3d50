"""Slots for nodes that have no words of their own: divisions without text, manuscripts, resources, ellipses, stray readings.

A division's anchor is the first slot of its subtree, else that of the nearest ancestor whose subtree has one, else the
version's first. Subtrees are ranges of division numbers, so the slots find all their divisions by a range
join and the divisions all their ancestors by another; none is walked. Subtrees and their first slots are written once: each
is needed several times, and so a plan that holds several anchors stays small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import kept
from .intervals import containing, subtrees

V = ["version_id"]


def first_slots(units: DataFrame, words: DataFrame) -> DataFrame:
    """(version_id, div, slot): the first slot of the units right in a division."""
    return words.groupBy(*V, "unit").agg(F.min("slot").alias("slot")).join(units.select(*V, "unit", "div"), [*V, "unit"]).groupBy(*V, "div").agg(F.min("slot").alias("slot"))


def div_anchors(divs: DataFrame, slots: DataFrame) -> DataFrame:
    """(version_id, div, slot, anchor_div) of every division of a version with slots; ``anchor_div`` is null for the version's first slot."""
    trees = kept(subtrees(divs.select(*V, "div", "level"), V).select(*V, "div", "last_div").withColumn("div", F.col("div").cast("long")), "subtrees")
    own = slots.select(*V, F.col("div").cast("long").alias("at"), "slot")
    held = kept(containing(own, trees, V, inner_range=("at", "at"), outer_range=("div", "last_div")).groupBy(*V, "div").agg(F.min("slot").alias("slot")), "held")
    rooted = trees.join(held, [*V, "div"])
    bare = trees.join(held, [*V, "div"], "left_anti").select(*V, F.col("div").alias("at"))
    # as of its place, the last division to open among those around it that have slots
    around = containing(bare, rooted, V, inner_range=("at", "at"), outer_range=("div", "last_div"))
    nearest = around.groupBy(*V, "at").agg(F.max_by("slot", "div").alias("slot"), F.max("div").alias("anchor_div")).withColumnRenamed("at", "div")
    whole = slots.groupBy(*V).agg(F.min("slot").alias("__first"))
    found = rooted.select(*V, "div", "slot", F.col("div").alias("anchor_div")).unionByName(nearest)
    out = trees.select(*V, "div").join(whole, V).join(found, [*V, "div"], "left")
    return out.select(*V, "div", F.coalesce("slot", "__first").alias("slot"), "anchor_div")


def technical(tables: dict[str, DataFrame]) -> DataFrame:
    """(version_id, otype, key, div, slot): the anchors of manuscripts, resources, ellipses and stray readings.

    The first two stand at their version's first slot, those of a version without text at the first of the work's first version
    that has any, else at slot 1. Ellipses and stray readings stand at the anchor of their division.
    """
    slots = first_slots(tables["units"], tables["words"])
    first = slots.groupBy(*V).agg(F.min("slot").alias("slot"))
    versions = tables["versions"].select(*V, "work_id", "version")
    of_work = versions.join(first, V).groupBy("work_id").agg(F.min_by("slot", "version").alias("__of_work"))
    whole = versions.join(first, V, "left").join(of_work, "work_id", "left").select(*V, F.coalesce("slot", "__of_work", F.lit(1)).cast("long").alias("slot"))
    no_div = F.lit(None).cast("long")
    above = [
        tables["manuscripts"].select(*V, F.lit("manuscript").alias("otype"), F.col("witness").alias("key")),
        tables["resources"].select(*V, F.lit("resource").alias("otype"), F.col("position").cast("string").alias("key")),
    ]
    placed = [
        tables["ellipses"].select(*V, F.lit("ellipsis").alias("otype"), F.concat_ws("/", "div", "child_index").alias("key"), F.col("div").cast("long").alias("div")),
        tables["orphan_readings"].select(*V, F.lit("orphan_reading").alias("otype"), F.concat_ws("/", "div", "reading").alias("key"), F.col("div").cast("long").alias("div")),
    ]
    anchors = div_anchors(tables["divs"], slots).select(*V, "div", "slot")
    high = reduce(DataFrame.unionByName, above).join(whole, V, "left").select(*V, "otype", "key", no_div.alias("div"), "slot")
    low = reduce(DataFrame.unionByName, placed).join(anchors, [*V, "div"], "left").join(whole.withColumnRenamed("slot", "__first"), V, "left")
    return high.unionByName(low.select(*V, "otype", "key", "div", F.coalesce("slot", "__first").alias("slot")))


def misplaced(technical_nodes: DataFrame, otype: str, anchors: DataFrame) -> DataFrame:
    """Ellipses or stray readings that stand at no slot, in no division, or elsewhere than their division; one row each.

    ``anchors``: (version_id, div, slot) of the divisions. A node of two slots is misplaced once for each.
    """
    own = technical_nodes.where(F.col("otype") == otype)
    n = F.count("*").over(Window.partitionBy(*V, "key"))
    joined = own.withColumn("__n", n).join(anchors.select(*V, "div", F.col("slot").alias("__at")), [*V, "div"], "left")
    return joined.where((F.col("__n") != 1) | F.col("slot").isNull() | F.col("__at").isNull() | (F.col("slot") != F.col("__at"))).select(*technical_nodes.columns)


def disowned(nodes: DataFrame, versions: DataFrame, identity: list[str]) -> DataFrame:
    """Nodes whose version_id names not exactly one version, or one that differs from what the node itself says in ``identity``."""
    owners = versions.groupBy(*V).agg(F.count("*").alias("__n"), *[F.first(c).alias(f"__{c}") for c in identity])
    joined = nodes.join(owners, V, "left")
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__{c}")) for c in identity], F.lit(False))
    return joined.where(F.col("__n").isNull() | (F.col("__n") != 1) | differs).select(*nodes.columns)


def strayed(cited: DataFrame, manuscripts: DataFrame) -> DataFrame:
    """Citations of stray readings by a witness that their own version has not."""
    return cited.join(manuscripts.select(*V, "witness").distinct(), [*V, "witness"], "left_anti")
