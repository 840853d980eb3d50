"""Translations and their sources: matching versions, aligning units by occurrence, joining by position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .guards import none_of, repeated


def signatures(items: DataFrame, version: list[str], identity: list[str]) -> DataFrame:
    """A version's multiset of identities as one digest: equal digests, equal multisets."""
    counts = items.groupBy(*version, *identity).agg(F.count("*").alias("__n"))
    listed = F.array_sort(F.collect_list(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(f"i{k}") for k, c in enumerate(identity)], F.col("__n").alias("n"))))
    return counts.groupBy(*version).agg(F.sha2(F.to_json(listed), 256).alias("signature"))


def match_versions(translations: DataFrame, sources: DataFrame, *, translation: str, source: str) -> DataFrame:
    """(translation, n_matches, source): the source version of equal signature, where it is the only one."""
    candidates = sources.groupBy("signature").agg(F.count("*").alias("n_matches"), F.min(source).alias("__s"))
    found = translations.select(translation, "signature").join(candidates, "signature", "left")
    return found.select(translation, F.coalesce("n_matches", F.lit(0)).alias("n_matches"), F.when(F.col("n_matches") == 1, F.col("__s")).alias(source))


def one_source_each(matches: DataFrame) -> DataFrame:
    none_of(matches.where("n_matches <> 1"), "a translation has not exactly one source version")
    return matches


def occurrences(rows: DataFrame, identity: list[str], order: list[str], name: str = "occurrence") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*identity).orderBy(*order)))


def align(translation: DataFrame, source: DataFrame, identity: list[str], order: list[str], key: str, *, strict: bool = False) -> DataFrame:
    """The k-th unit of an identity on one side with the k-th on the other: (identity.., occurrence, translation key, source key).

    Positions play no part. ``strict``: units without a partner are an error.
    """
    left = occurrences(translation, identity, order).select(*identity, "occurrence", F.col(key).alias(f"translation_{key}"))
    right = occurrences(source, identity, order).select(*identity, "occurrence", F.col(key).alias(f"source_{key}"))
    both = left.join(right, [*identity, "occurrence"], "full_outer")
    if strict:
        none_of(both.where(F.col(f"translation_{key}").isNull() | F.col(f"source_{key}").isNull()), "units without a partner")
    return both


def aligned_units(alignment: DataFrame, translation: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Aligned pairs with ``columns`` of both sides."""
    side = lambda t, p: t.select(F.col(key).alias(f"{p}_{key}"), *[F.col(c).alias(f"{p}_{c}") for c in columns])
    return alignment.join(side(translation, "translation"), f"translation_{key}").join(side(source, "source"), f"source_{key}")


def to_source_units(alignment: DataFrame, wanted: DataFrame, key: str, *, check: bool = True) -> DataFrame:
    """For each source unit of ``wanted`` (with its position) the translation's unit, null without one."""
    linked = alignment.where(F.col(f"source_{key}").isNotNull() & F.col(f"translation_{key}").isNotNull()).select(f"source_{key}", f"translation_{key}")
    if check:
        none_of(repeated(linked, f"source_{key}"), "a source unit has several units of a translation")
    return wanted.join(linked, f"source_{key}", "left")


def drift(a: DataFrame, b: DataFrame, identity: list[str]) -> DataFrame:
    """Multiset comparison by identity: common, missing (more in b), extra (more in a). One grouping of both, without a join; an identity with
    a null equals none of the other side."""
    side = lambda df, n: df.select(*identity, F.lit(n).alias("__side"))
    unknown = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in identity])
    rows = side(a, 1).unionByName(side(b, 2)).withColumn("__apart", F.when(unknown, F.col("__side")).otherwise(0))
    n = rows.groupBy(*identity, "__apart").agg(F.count_if(F.col("__side") == 1).alias("__a"), F.count_if(F.col("__side") == 2).alias("__b"))
    x, y = F.col("__a"), F.col("__b")
    return n.select(*identity, F.least(x, y).alias("common"), F.greatest(y - x, F.lit(0)).alias("missing"), F.greatest(x - y, F.lit(0)).alias("extra"))


def nearest_sources(common: DataFrame, translation: str, source: str, limit: int = 3) -> DataFrame:
    """Per translation the ``limit`` sources with most in common, then least missing and extra, then by key."""
    order = Window.partitionBy(translation).orderBy(F.desc("common"), F.col("missing") + F.col("extra"), source)
    return common.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def positional(*sides: DataFrame, on: list[str]) -> DataFrame:
    """Rows of equal keys and position on every side; rows that some side lacks stay, with nulls."""
    out = sides[0]
    for s in sides[1:]:
        out = out.join(s, on, "full_outer")
    return out


def positional_within(rows: DataFrame, key: str, order: list[Column], sides: list[Column]) -> DataFrame:
    """``positional`` for sides of one table: (key, position, the sides' columns). A side is an array of structs with columns of its own, what
    a row has there: nothing (also null), one, or several in a row. Their positions count along ``order``.

    Rows are sent once, by key; the k-th of each side meet in one grouping there, which the key already keeps together. What a row has at one
    position on several sides is one record of that grouping.
    """
    every = range(len(sides))
    upto = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = rows.repartition(key).select("*", *[F.coalesce(c, F.array()).alias(f"__s{i}") for i, c in enumerate(sides)])
    before = [(F.sum(F.size(f"__s{i}")).over(upto) - F.size(f"__s{i}")).alias(f"__n{i}") for i in every]
    counted = held.select(key, *[f"__s{i}" for i in every], *before)
    apart = lambda i: F.when(F.col(key).isNull(), i).otherwise(-1)  # noqa: E731  a null key equals no other side's
    places = [F.transform(f"__s{i}", lambda _, at: F.struct(apart(i).alias("apart"), (F.col(f"__n{i}") + at + 1).alias("position"))) for i in every]
    each = counted.withColumn("__at", F.explode(F.array_distinct(F.concat(*places))))
    there = lambda i: F.when(F.col("__at.apart").isin(-1, i), F.get(f"__s{i}", (F.col("__at.position") - F.col(f"__n{i}") - 1).cast("int")))
    cells = each.select(key, "__at.*", *[there(i).alias(f"__c{i}") for i in every]).select(key, "apart", "position", *[f"__c{i}.*" for i in every])
    return cells.groupBy(key, "apart", "position").agg(*[F.max(c).alias(c) for c in cells.columns[3:]]).drop("apart")


def coverage_ratio(aligned: Column, total: Column) -> Column:
    return F.round(F.when(total == 0, F.lit(1.0)).otherwise(aligned / total), 3)
