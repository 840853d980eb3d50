"""Diagnostics of translations and of matched measurements: drift with totals, omissions against markers, ABBA blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import alignment
from .intervals import islands, overlapping

#: What a translation puts where its source has nothing, by language; fixed values of the generator.
MARKERS = {"English": "[...]", "French": ""}
ABBA = ["A", "B", "B", "A"]


# --- drift ----------------------------------------------------------------------------------


def translation_drift(generated: DataFrame, source: DataFrame, on: list[str], identity: list[str], order: list[str]) -> DataFrame:
    """Per version: units on both sides, common, missing and extra ones as multisets, whether multisets and sequences agree, and the
    first place (from 0) at which the sequences differ. A version that one side lacks has 0 units there."""
    by_identity = alignment.drift(generated, source, [*on, *identity])
    sums = by_identity.groupBy(*on).agg(*[F.sum(c).cast("long").alias(c) for c in ("common", "missing", "extra")])

    def placed(side: DataFrame, name: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*on).orderBy(*order, *identity)) - 1
        return side.select(*on, place.cast("long").alias("__place"), F.struct(*identity).alias(name))

    both = placed(generated, "__g").join(placed(source, "__s"), [*on, "__place"], "full_outer")
    first = both.where(~F.col("__g").eqNullSafe(F.col("__s"))).groupBy(*on).agg(F.min("__place").alias("first_mismatch"))
    out = sums.join(first, on, "left")
    return out.select(
        *on,
        (F.col("common") + F.col("extra")).alias("generated_units"),
        (F.col("common") + F.col("missing")).alias("source_units"),
        "common", "missing", "extra",
        ((F.col("missing") == 0) & (F.col("extra") == 0)).alias("multiset_equal"),
        F.col("first_mismatch").isNull().alias("sequence_equal"),
        "first_mismatch",
    )


def id_collisions(generated: DataFrame, on: list[str], bare_id: str, text: str, *, placeholder: str = MARKERS["English"]) -> DataFrame:
    """Ids that several units of a version bear once their language is cut off: how many, whether their texts agree, how many are blank or
    the placeholder."""
    said = F.trim(F.coalesce(F.col(text), F.lit("")))
    found = generated.groupBy(*on, bare_id).agg(
        F.count("*").alias("occurrences"),
        (F.min(F.coalesce(text, F.lit(""))) == F.max(F.coalesce(text, F.lit("")))).alias("all_equal"),
        F.count_if(said == "").alias("n_empty"),
        F.count_if(said == placeholder).alias("n_placeholder"),
    )
    return found.where("occurrences > 1")


def totals(records: DataFrame, by: list[str], sums: dict[str, Column]) -> DataFrame:
    """``sums`` over all levels of ``by``: (by.., grouping, ...). ``grouping`` has a bit for each column that a row sums over, the first
    column's highest, so that a null value isn't taken for a total."""
    return records.rollup(*by).agg(F.grouping_id().cast("long").alias("grouping"), *[c.alias(n) for n, c in sums.items()])


# --- omissions ------------------------------------------------------------------------------


def is_marker(language: Column, text: Column) -> Column:
    """Whether a generated text says that its source has none; null for a language without a rule."""
    said = F.trim(F.coalesce(text, F.lit("")))
    out = F.lit(None).cast("boolean")
    for name, mark in MARKERS.items():
        out = F.when(language == name, said == mark).otherwise(out)
    return out


def state_mismatches(source: DataFrame, generated: DataFrame, on: list[str], *, empty: str, marker: str) -> DataFrame:
    """Identities whose units are empty in the source and marked in the translation a different number of times, or that differ in number.

    ``ambiguous``: one side has several units of the identity, so that which of them differ is unknown.
    """
    a = source.groupBy(*on).agg(F.count("*").alias("n_source"), F.count_if(F.col(empty)).alias("n_empty"))
    b = generated.groupBy(*on).agg(F.count("*").alias("n_generated"), F.count_if(F.col(marker)).alias("n_marked"))
    both = a.join(b, on, "full_outer").fillna(0, ["n_source", "n_empty", "n_generated", "n_marked"])
    wrong = both.where("n_source <> n_generated or n_empty <> n_marked")
    return wrong.withColumn("ambiguous", (F.col("n_source") > 1) | (F.col("n_generated") > 1))


def omission_runs(omitted: DataFrame, marked: DataFrame, on: list[str], at: str) -> DataFrame:
    """Runs of omitted places against runs of marked ones: (on.., status, omitted_first, omitted_last, marked_first, marked_last, shared).

    ``matched`` for each pair that shares a place, ``exact`` where the two are the same run; ``unmarked`` and ``unfounded`` for a run that
    meets none on the other side.
    """
    a = islands(omitted, on, at, first="omitted_first", last="omitted_last", n="__na")
    b = islands(marked, on, at, first="marked_first", last="marked_last", n="__nb")
    met = overlapping(a, b, on, left_range=("omitted_first", "omitted_last"), right_range=("marked_first", "marked_last"))
    shared = F.least("omitted_last", "marked_last") - F.greatest("omitted_first", "marked_first") + 1
    same = (F.col("omitted_first") == F.col("marked_first")) & (F.col("omitted_last") == F.col("marked_last"))
    ranges = ["omitted_first", "omitted_last", "marked_first", "marked_last"]
    out = [*on, "status", *ranges, "shared"]
    pairs = met.withColumn("status", F.when(same, "exact").otherwise("matched")).withColumn("shared", shared.cast("long"))
    no_shared = F.lit(0).cast("long").alias("shared")
    none = lambda side, n: F.lit(None).cast(side.schema[n].dataType).alias(n)
    lone_a = a.join(met, [*on, *ranges[:2]], "left_anti").select(*on, F.lit("unmarked").alias("status"), *ranges[:2], none(b, ranges[2]), none(b, ranges[3]), no_shared)
    lone_b = b.join(met, [*on, *ranges[2:]], "left_anti").select(*on, F.lit("unfounded").alias("status"), none(a, ranges[0]), none(a, ranges[1]), *ranges[2:], no_shared)
    return pairs.select(*out).unionByName(lone_a).unionByName(lone_b)


# --- matched measurements -------------------------------------------------------------------


def abba_blocks(samples: DataFrame, session: list[str], order: list[str], *, variant: str = "variant", value: str = "value") -> DataFrame:
    """(session.., block, a, b, difference) of the blocks of four samples in a row, counted from a session's first, that are A B B A:
    the means of both variants and how much B is above A. What drifts evenly through a block cancels out."""
    place = F.row_number().over(Window.partitionBy(*session).orderBy(*order)) - 1
    own = samples.select(*session, F.floor(place / 4).cast("long").alias("block"), (place % 4).alias("__k"), F.col(variant).alias("__variant"), F.col(value).alias("__value"))
    four = own.groupBy(*session, "block").agg(F.array_sort(F.collect_list(F.struct("__k", "__variant", "__value"))).alias("__four"))  # four samples at most
    whole = four.where(F.transform("__four", lambda x: x["__variant"]) == F.array(*map(F.lit, ABBA)))
    v = [F.get("__four", F.lit(i))["__value"] for i in range(4)]
    means = whole.select(*session, "block", ((v[0] + v[3]) / 2).alias("a"), ((v[1] + v[2]) / 2).alias("b"))
    return means.withColumn("difference", F.col("b") - F.col("a"))


def matched_summary(blocks: DataFrame, by: list[str]) -> DataFrame:
    """Per label: number of blocks, medians of both variants and of the differences within blocks, rounded, and the ratio of the medians;
    the ratio is null where the second is not above 0."""
    m = lambda c: F.round(F.median(c), 3)
    out = blocks.groupBy(*by).agg(F.count("*").alias("n_blocks"), m("a").alias("baseline_median"), m("b").alias("candidate_median"), m("difference").alias("median_difference"))
    return out.withColumn("ratio", F.when(F.col("candidate_median") > 0, F.round(F.col("baseline_median") / F.col("candidate_median"), 3)))
