"""Two orders of the same things: what one lacks, what it repeats, what it has in another order, and what has only moved up.

Units that both sides have once are ranked on each side among themselves. In the order of the one, the rank on the other must
grow by one from unit to unit: where it falls, two stand the wrong way round; where it grows by more, the units between
stand elsewhere and are reported there. Places that differ while ranks agree come from gaps alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MISSING, EXTRA, REPEATED, SWAPPED, SHIFTED = "missing", "extra", "repeated", "swapped", "shifted"


def order_violations(source: DataFrame, other: DataFrame, on: list[str], identity: list[str], order: list[str], *, shifts: bool = True) -> DataFrame:
    """(on.., identity.., kind, source_place, other_place) of every unit that breaks the alignment of ``other`` with ``source``.

    Places count from 1 in ``order``. ``missing``: in source alone; ``extra``: in other alone; ``repeated``: an identity twice on a side,
    with its first places; ``swapped``: before a unit in other that precedes it in source; ``shifted``: the same order at another place, left
    out without ``shifts``.
    """
    key = [*on, *identity]

    def numbered(side: DataFrame, name: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*on).orderBy(*order, *identity)).cast("long")
        seen = side.select(*key, *[c for c in order if c not in key]).withColumn("__place", place)
        return seen.groupBy(*key).agg(F.min("__place").alias(f"{name}_place"), F.count("*").alias(f"__{name}"))

    both = numbered(source, "source").join(numbered(other, "other"), key, "full_outer")
    several = (F.coalesce("__source", F.lit(0)) > 1) | (F.coalesce("__other", F.lit(0)) > 1)
    kind = F.when(several, REPEATED).when(F.col("other_place").isNull(), MISSING).when(F.col("source_place").isNull(), EXTRA)
    judged = both.withColumn("kind", kind)
    out = [*key, "kind", "source_place", "other_place"]
    common = judged.where("kind is null")
    rank = F.row_number().over(Window.partitionBy(*on).orderBy("other_place"))
    before = F.lag("__rank").over(Window.partitionBy(*on).orderBy("source_place"))
    ranked = common.withColumn("__rank", rank).withColumn("__before", before)
    fell = F.col("__rank") < F.col("__before")
    moved = F.col("source_place") != F.col("other_place")
    wrong = ranked.withColumn("kind", F.when(fell, SWAPPED).when(moved if shifts else F.lit(False), SHIFTED)).where("kind is not null")
    return judged.where("kind is not null").select(*out).unionByName(wrong.select(*out))
