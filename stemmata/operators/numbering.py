"""Numbers for rows: dense ids over all rows, ordinals within keys, occurrence labels, type blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from ..storage import kept

#: Bits of a row's place in its range, in the numbers that Spark gives to the rows of a table.
PLACES = 33


def ordinal(keys: list[str], order: list[Column | str]) -> Column:
    """1, 2, ... within the keys."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def dense_ids(df: DataFrame, order: list[str], name: str, *, ranges: int | None = None, start: int = 1) -> DataFrame:
    """Number all rows by ``order`` without gathering them in one partition.

    Rows are sorted over the cluster by the whole order, so that a long run of one leading value is many ranges, and written once with
    their place in their range. Counting the ranges of that table, one number each, gives what each begins with.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = kept(dealt.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part, at = F.shiftright("__at", PLACES), F.col("__at").bitwiseAND((1 << PLACES) - 1)
    counts = dict(placed.groupBy(part.cast("int").alias("k")).count().collect())  # one row a range
    before, total = [], start
    for k in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(k, 0)
    offset = F.get(F.array(*[F.lit(x).cast("long") for x in before]), part.cast("int")) if before else F.lit(0).cast("long")
    return placed.withColumn(name, offset + at).drop("__at")


def type_blocks(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(otype, node, key): one block of dense ids for each table that has rows, in the order of ``tables``.

    The keys of all types are numbered at once, by their type first: a number or a text of a key stands in a column of its own kind.
    """
    widest = max(len(order) for _, order in tables.values())
    parts = []
    for rank, (otype, (table, order)) in enumerate(tables.items()):
        cells = []
        for i in range(widest):
            c = F.col(order[i]) if i < len(order) else F.lit(None)
            text = i < len(order) and isinstance(table.schema[order[i]].dataType, StringType)
            cells += [(F.lit(None) if text else c).cast("long").alias(f"__n{i}"), (c if text else F.lit(None)).cast("string").alias(f"__t{i}")]
        key = F.concat_ws("/", *[F.col(c).cast("string") for c in order])
        parts.append(table.select(*order).distinct().select(F.lit(rank).alias("__rank"), F.lit(otype).alias("otype"), *cells, key.alias("key")))
    rows = reduce(DataFrame.unionByName, parts)
    return dense_ids(rows, ["__rank", *[f"__{k}{i}" for i in range(widest) for k in "nt"]], "node").select("otype", "node", "key")


def occurrence_label(label: Column, keys: list[str], order: list[Column | str]) -> Column:
    """A label as it is the first time within its keys, then with ``~2``, ``~3``, ..."""
    n = ordinal(keys, order)
    return F.when(n == 1, label).otherwise(F.concat(label, F.lit("~"), n.cast("string")))


def version_ids(versions: DataFrame, *, work: str = "work_id", slug: str = "slug", order: list[str]) -> DataFrame:
    """``version_id``: the work for an only version, else ``work__slug``, repeated ones with ``_2``, ``_3``, ..."""
    base = F.concat(F.col(work), F.lit("__"), F.col(slug))
    n = ordinal([work, slug], order)
    only = F.count("*").over(Window.partitionBy(work)) == 1
    return versions.withColumn("version_id", F.when(only, F.col(work)).when(n == 1, base).otherwise(F.concat(base, F.lit("_"), n.cast("string"))))


def bounds(nodes: DataFrame, slots: str = "word") -> DataFrame:
    """max_slot and max_node of a node table (otype, node)."""
    return nodes.agg(F.max(F.when(F.col("otype") == slots, F.col("node"))).alias("max_slot"), F.max("node").alias("max_node"))
