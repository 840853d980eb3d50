"""The shapes of versions' trees, told from the set of levels that hold units.

Each division has the bit of its level if it holds units. Bits are put together bottom up: by the ranges of its subtree every
division gets those of all below it, and the version those of all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import containing, subtrees

V = ["version_id"]
#: A bit for each level; deeper ones share the last.
LEVELS = 62


def subtree_levels(divs: DataFrame) -> DataFrame:
    """(version_id, div, level, own, below): the bit of the level of each division that holds units, and the bits of its whole subtree."""
    bit = F.expr(f"shiftleft(1L, least(level - 1, {LEVELS}))")
    trees = subtrees(divs.select(*V, "div", "level", F.when(F.col("has_units"), bit).otherwise(F.lit(0)).alias("own")), V)
    inner = trees.where("own <> 0").select(*V, F.col("div").cast("long").alias("at"), F.col("own").alias("__bit"))
    outer = trees.select(*V, F.col("div").cast("long").alias("div"), "last_div")
    below = containing(inner, outer, V, inner_range=("at", "at"), outer_range=("div", "last_div")).groupBy(*V, "div").agg(F.bit_or("__bit").alias("below"))
    return trees.join(below, [*V, "div"], "left").select(*V, "div", "level", "own", F.coalesce("below", F.lit(0)).cast("long").alias("below"))


def version_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """(version_id, shape, unit_levels, n_divs, n_bare_subtrees, has_units, has_other_items) of every version.

    ``shape``: ``no divisions``; ``no units``; ``one level`` where all units stand on the same; ``mixed`` where a level above the
    deepest holds some too, in other branches; ``nested`` where a division with units has units below it. ``unit_levels`` is the set of levels as bits; a
    bare subtree is a topmost division or a division of a branch with units that has none in itself or below.
    """
    bits = subtree_levels(tables["divs"])
    parent = tables["divs"].select(*V, F.col("parent").alias("__parent"), "div")
    above = bits.select(*V, F.col("div").alias("__parent"), F.col("below").alias("__around"))
    with_parent = bits.join(parent, [*V, "div"]).join(above, [*V, "__parent"], "left")
    bare = (F.col("below") == 0) & (F.col("__parent").isNull() | (F.col("__around") != 0))
    nested = (F.col("own") != 0) & (F.col("below") != F.col("own"))
    sums = with_parent.groupBy(*V).agg(F.bit_or("own").alias("unit_levels"), F.count("*").alias("n_divs"), F.count_if(bare).alias("n_bare_subtrees"), F.max(nested).alias("__nested"))
    others = tables["ellipses"].select(*V).unionByName(tables["orphan_readings"].select(*V)).distinct().withColumn("__others", F.lit(True))
    with_units = tables["units"].select(*V).distinct().withColumn("__units", F.lit(True))
    found = tables["versions"].select(*V).join(sums, V, "left").join(with_units, V, "left").join(others, V, "left")
    levels = F.coalesce("unit_levels", F.lit(0)).cast("long")
    shape = F.when(F.col("n_divs").isNull(), "no divisions").when(levels == 0, "no units").when(F.col("__nested"), "nested").when(F.bit_count(levels) == 1, "one level").otherwise("mixed")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select(*V, shape.alias("shape"), levels.alias("unit_levels"), n("n_divs"), n("n_bare_subtrees"), F.coalesce("__units", F.lit(False)).alias("has_units"), F.coalesce("__others", F.lit(False)).alias("has_other_items"))
