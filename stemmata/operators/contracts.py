"""What columns and edges hold, observed in one pass over each table, and whether that keeps what was promised."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
#: Characters that are shown of the first and the last text.
SHOWN = 200
MEASURES = "column string, type string, position int, n_rows bigint, n_null bigint, least double, greatest double, first_text string, last_text string, n_distinct bigint"


def columns_of(df: DataFrame) -> DataFrame:
    """For each column its type, place, number of rows and of nulls, ends of its range, and about how many values it has.

    One aggregate of the whole table with partial sums, then one row a column by ``stack``: rows are never multiplied by columns.
    ``least`` and ``greatest`` are for numbers, ``first_text`` and ``last_text`` for texts, of which they show the beginning; the number of
    values is a sketch's, within 5 %. A zero has no sign.
    """
    sums, parts = [F.count("*").alias("n")], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        number, text = isinstance(f.dataType, _NUMBERS), isinstance(f.dataType, T.StringType)
        hashed = F.xxhash64(c) if not isinstance(f.dataType, (T.MapType, T.VariantType)) else F.xxhash64(F.to_json(F.struct(c)))
        ends = lambda when, kind, c=c: [f(c if when else F.lit(None)).cast(kind) for f in (F.min, F.max)]
        own = [F.count(c), *[x + F.lit(0.0) for x in ends(number, "double")], *ends(text, "string", F.substring(c, 1, SHOWN) if text else c), F.approx_count_distinct(F.when(c.isNotNull(), hashed))]
        sums += [a.alias(f"a{i}_{k}") for k, a in enumerate(own)]
        name, kind = f.name.replace("'", "\\'"), f.dataType.simpleString()
        parts.append(f"'{name}', '{kind}', {i + 1}, n, n - a{i}_0, {', '.join(f'a{i}_{k}' for k in range(1, 6))}")
    names = ", ".join(f"`{x.split()[0]}`" for x in MEASURES.split(", "))
    return df.agg(*sums).select(F.expr(f"stack({len(parts)}, {', '.join(parts)}) as ({names})"))


def catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """``columns_of`` for every table, with its name."""
    return reduce(DataFrame.unionByName, [columns_of(df).select(F.lit(n).alias("table"), "*") for n, df in tables.items()])


@dataclass(frozen=True)
class Edge:
    """An edge (src, dst) and what is promised of it: types of its ends, least and greatest number of targets of a source."""

    rows: DataFrame
    source: str
    target: str
    least: int = 0
    most: int | None = None


def edges_of(edges: dict[str, Edge], sources: dict[str, DataFrame]) -> DataFrame:
    """(edge, source, target, n_edges, n_sources, n_without, least, greatest, ok): the number of different targets that the nodes of the
    source type have. ``sources``: (node) of each type; nodes without an edge count as having none, edges of other nodes are broken."""
    out = []
    for name, e in edges.items():
        nodes = sources[e.source].select(F.col("node").alias("src")).distinct().withColumn("__node", F.lit(True))
        degree = e.rows.select("src", "dst").groupBy("src").agg(F.count("*").alias("__edges"), F.countDistinct("dst").alias("__targets"))
        n = F.coalesce("__targets", F.lit(0))
        both = nodes.join(degree, "src", "full_outer")
        broken = F.col("__node").isNull() | (n < e.least) | (F.lit(e.most is not None) & (n > F.lit(e.most if e.most is not None else 0)))
        out.append(both.agg(
            F.coalesce(F.sum("__edges"), F.lit(0)).cast("long").alias("n_edges"), F.count_if(F.col("__node") & (n > 0)).alias("n_sources"), F.count_if(F.col("__node") & (n == 0)).alias("n_without"),
            F.min(F.when(F.col("__node"), n)).cast("long").alias("least"), F.max(F.when(F.col("__node"), n)).cast("long").alias("greatest"), (F.count_if(broken) == 0).alias("ok"),
        ).select(F.lit(name).alias("edge"), F.lit(e.source).alias("source"), F.lit(e.target).alias("target"), "*"))
    return reduce(DataFrame.unionByName, out)


def observed(nodes: DataFrame, features: list[str], otype: str = "otype") -> DataFrame:
    """(feature, otypes, n_values): the types of nodes on which each feature has a value; features without any are there with none."""
    sums = nodes.groupBy(otype).agg(*[F.count(c).alias(f"__{i}") for i, c in enumerate(features)])  # one row a type
    each: Column = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"__{i}").alias("n")) for i, c in enumerate(features)]))
    rows = sums.select(otype, each.alias("x")).select(otype, "x.*")
    return rows.groupBy("feature").agg(F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.col(otype)))).alias("otypes"), F.sum("n").alias("n_values"))
