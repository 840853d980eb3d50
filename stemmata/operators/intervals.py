"""Intervals of slots: containment and overlap as equi-joins on bins, runs merged to islands, subtrees as intervals.

An interval (``first``, ``last``, both included) of length n has the level of the least power of two that is no
less than n, and stands in the bins of that width that it touches: two at most. Intervals of over 2**WIDEST are cut at
the borders of bins of that width, so that no bin gathers more than it spans. A range looks for those that contain it
with one key for each level that occurs, never below its own; the exact comparison follows in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bins are 2**WIDEST slots wide at most.
WIDEST = 16


def _level(first: Column, last: Column) -> Column:
    n = last - first
    return F.least(F.when(n <= 0, 0).otherwise(F.length(F.bin(n))), F.lit(WIDEST)).cast("int")


def _in_bins(ranges: DataFrame, first: str, last: str) -> DataFrame:
    """Each range once for every bin of its level that it touches."""
    leveled = ranges.withColumn("__level", _level(F.col(first), F.col(last)))
    bins = F.sequence(F.expr(f"shiftright(`{first}`, __level)"), F.expr(f"shiftright(`{last}`, __level)"))
    return leveled.withColumn("__bin", F.explode(bins))


def containing(inner: DataFrame, outer: DataFrame, on: list[str], *, inner_range: tuple[str, str], outer_range: tuple[str, str]) -> DataFrame:
    """Pairs of rows with equal ``on`` of which the outer range holds the inner one, each pair once.

    Ranges are whole numbers; an empty one (last before first), or one with a null, holds nothing and is in nothing. The
    other columns of the two sides must differ in name.
    """
    a, b = inner_range
    c, d = outer_range
    held = _in_bins(outer.where(F.col(c) <= F.col(d)), c, d)
    levels = sorted(r[0] for r in held.select("__level").distinct().collect())  # 17 at most
    if not levels:
        levels = [0]
    own = inner.where(F.col(a) <= F.col(b))
    fit = F.filter(F.array(*map(F.lit, levels)), lambda x: x >= _level(F.col(a), F.col(b)))
    asked = own.withColumn("__level", F.explode(fit)).withColumn("__bin", F.expr(f"shiftright(`{a}`, __level)"))
    both = asked.join(held.hint("merge"), [*on, "__level", "__bin"])  # both sides have more rows than what they are exploded from, by whose size Spark would broadcast them
    return both.where((F.col(c) <= F.col(a)) & (F.col(b) <= F.col(d))).drop("__level", "__bin")


def overlapping(left: DataFrame, right: DataFrame, on: list[str], *, left_range: tuple[str, str], right_range: tuple[str, str]) -> DataFrame:
    """Pairs of rows with equal ``on`` whose ranges share a slot, each pair once: one of the two begins within the other."""
    a, b = left_range
    c, d = right_range
    columns = [*on, *[x for x in left.columns if x not in on], *[x for x in right.columns if x not in on]]
    mark = "__at"
    begins = containing(left.where(F.col(a) <= F.col(b)).withColumn(mark, F.col(a)), right, on, inner_range=(mark, mark), outer_range=(c, d))
    later = containing(right.where(F.col(c) <= F.col(d)).withColumn(mark, F.col(c)), left, on, inner_range=(mark, mark), outer_range=(a, b))
    return begins.select(*columns).unionByName(later.where(F.col(c) > F.col(a)).select(*columns))


def islands(rows: DataFrame, on: list[str], at: str, *, first: str = "first", last: str = "last", n: str = "n") -> DataFrame:
    """The runs of consecutive places that occur: (on.., first, last, number of different places)."""
    places = rows.where(F.col(at).isNotNull()).select(*on, at).distinct()
    run = F.col(at) - F.row_number().over(Window.partitionBy(*on).orderBy(at))
    return places.withColumn("__run", run).groupBy(*on, "__run").agg(F.min(at).alias(first), F.max(at).alias(last), F.count("*").alias(n)).drop("__run")


def subtrees(divs: DataFrame, version: list[str], *, div: str = "div", level: str = "level") -> DataFrame:
    """Add ``last_div``: divisions are numbered as they open, so that a subtree is the range from its division to the one before the
    next that is no deeper. Looks through one window a version, with a column for each level that occurs."""
    levels = [r[0] for r in divs.select(level).distinct().orderBy(level).collect()]
    after = Window.partitionBy(*version).orderBy(F.desc(div)).rowsBetween(Window.unboundedPreceding, -1)
    nearest = F.coalesce(*[F.when(F.col(level) == x, F.last(F.when(F.col(level) <= x, F.col(div)), ignorenulls=True).over(after)) for x in levels]) if levels else F.lit(None)
    end = F.max(div).over(Window.partitionBy(*version))
    return divs.withColumn("__next", nearest.cast("long")).withColumn("last_div", F.coalesce(F.col("__next") - 1, end).cast("long")).drop("__next")
