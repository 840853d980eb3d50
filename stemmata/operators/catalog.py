"""Document metadata, classifications, labels of works, and the catalogue of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import without_xml_suffix
from .guards import dangling, none_of


def attach_metadata(documents: DataFrame, slots: DataFrame, key: str) -> DataFrame:
    """A node for each document, anchored at its work's first slot, else at slot 1."""
    first = slots.groupBy(key).agg(F.min("slot").alias("__slot"))
    return documents.join(first, key, "left").withColumn("slot", F.coalesce("__slot", F.lit(1))).drop("__slot")


def labels_of(assigned: DataFrame, vocabulary: DataFrame, key: str, ids: str = "ids") -> DataFrame:
    """The labels of each document in the order of its ids; an id that the vocabulary lacks is an error."""
    each = assigned.select(key, F.posexplode(ids).alias("position", "id"))
    none_of(dangling(each, vocabulary, "id"), "a label is not in the vocabulary")
    return each.join(vocabulary, "id").select(key, F.col("position").cast("long"), "id", "label")


def works_by_label(labels: DataFrame, key: str, label: str = "label") -> DataFrame:
    return labels.groupBy(label).agg(F.countDistinct(key).alias("n_works"), F.min(key).alias("first_work"), F.max(key).alias("last_work"))


def vocabulary_use(vocabulary: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Every label of the vocabulary with the number of its assignments, unused ones with 0."""
    used = labels.groupBy(label).agg(F.count("*").alias("n"))
    return vocabulary.select(label).distinct().join(used, label, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def known_works(classified: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """``classified`` if each of its works has metadata."""
    none_of(dangling(classified, documents, key), "a classified work is unknown")
    return classified


def work_labels(versions: DataFrame, work: str, title: str) -> DataFrame:
    """``title (work)`` where all versions of a work agree on one title that is not blank, else the work."""
    t = F.trim(F.coalesce(F.col(title), F.lit("")))
    seen = versions.where(F.trim(F.coalesce(work, F.lit(""))) != "").groupBy(work).agg(F.countDistinct(t).alias("__n"), F.max(t).alias("__t"))
    return seen.select(work, F.when((F.col("__n") == 1) & (F.col("__t") != ""), F.concat(F.col("__t"), F.lit(" ("), F.col(work), F.lit(")"))).otherwise(F.col(work)).alias("label"))


def category(name: Column, kind: Column) -> Column:
    """The chapter of the data dictionary that a column belongs to; the first rule that fits counts."""
    return (
        F.when(kind == "edge", "relations")
        .when(name.startswith("intro_") | name.startswith("historical_"), "document metadata")
        .when(name.rlike(r"(^|_)(sha256|format|file|version_id|provenance)$"), "provenance")
        .when(name.rlike(r"^(ms_|bibliography|manuscript)"), "witnesses")
        .when(name.rlike(r"^(chapter|verse|section|div|source_ref)"), "sections")
        .when(name.rlike(r"(word|prefix|trailer|lex|morph|token)"), "words")
        .when(name.rlike(r"^(reading|is_primary|is_omission|option)"), "readings")
        .otherwise("text")
    )


def column_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, nullable, category) from schemas alone; no rows are read."""
    rows = [(t, i, f.name, f.dataType.simpleString(), f.nullable) for t, df in tables.items() for i, f in enumerate(df.schema.fields, 1)]
    out = spark.createDataFrame(rows, "table string, position int, column string, type string, nullable boolean")
    return out.withColumn("category", category(F.col("column"), F.when(F.col("column").isin("src", "dst"), "edge").otherwise("node")))


def latency_summary(samples: DataFrame, by: list[str], value: str, order: list[str]) -> DataFrame:
    """First sample, number, median, least and greatest."""
    return samples.groupBy(*by).agg(F.count("*").alias("n"), F.min_by(value, F.struct(*order)).alias("first"), F.median(value).alias("median"), F.min(value).alias("least"), F.max(value).alias("greatest"))


def collisions(rows: DataFrame, key: list[str], ident: str) -> DataFrame:
    """Keys that several rows share."""
    return rows.groupBy(*key).agg(F.count("*").alias("n"), F.min(ident).alias("first"), F.max(ident).alias("last")).where("n > 1")
