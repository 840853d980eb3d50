"""Labels of works as a stored inverted index, and metadata of works as a stored table: point questions read one bucket.

Two tables hold the assignments, one bucketed by label and one by work, each bucket sorted; a third holds the vocabulary, so that
labels that nobody bears are known. The rows of a label that most works bear are written by several tasks, as several
files of its bucket.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .guards import dangling, none_of, repeated

BUCKETS = 16
#: Tasks that share the rows of one label.
SPREAD = 8
_NONE = object()


def _stored(df: DataFrame, name: str, by: str, order: list[str], buckets: int, folder: str | None) -> None:
    """A bucketed table; its files stand in ``folder``, or else in the warehouse."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(*order)
    (writer.option("path", f"{folder}/{name}") if folder else writer).saveAsTable(name)


class LabelIndex:
    """The questions. ``name`` is the prefix of the tables, which ``write`` makes."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.by_label, self.by_work, self.vocabulary = (spark.table(f"{name}_{x}") for x in ("by_label", "by_work", "vocabulary"))

    @classmethod
    def write(cls, assigned: DataFrame, vocabulary: DataFrame, name: str, *, buckets: int = BUCKETS, folder: str | None = None) -> LabelIndex:
        """Store ``assigned`` (work, kind, position, label) and ``vocabulary`` (kind, label).

        A label that the vocabulary lacks, a repeated word of it, or a label that a work has twice, is an error and nothing is stored.
        """
        assigned, vocabulary = assigned.select("work", "kind", "position", "label"), vocabulary.select("kind", "label")
        none_of(repeated(vocabulary, "kind", "label"), "the vocabulary repeats a label")
        none_of(dangling(assigned, vocabulary, "kind", "label"), "a label is not in the vocabulary")
        none_of(repeated(assigned, "work", "kind", "label"), "a work has a label twice")
        salt = F.pmod(F.xxhash64("work"), F.lit(SPREAD))
        spread = assigned.repartition(int(assigned.sparkSession.conf.get("spark.sql.shuffle.partitions")), "label", salt)
        _stored(spread, f"{name}_by_label", "label", ["label", "work"], buckets, folder)
        _stored(assigned.repartition(buckets, "work"), f"{name}_by_work", "work", ["work", "kind", "position"], buckets, folder)
        _stored(vocabulary.repartition(1), f"{name}_vocabulary", "label", ["kind", "label"], 1, folder)
        return cls(assigned.sparkSession, name)

    def works_by(self, kind: str, label: str) -> DataFrame:
        """The works with a label, sorted; a label that the vocabulary lacks is a KeyError, one that nobody bears has none."""
        if self.vocabulary.where((F.col("kind") == kind) & (F.col("label") == label)).isEmpty():
            raise KeyError(label)
        return self.by_label.where((F.col("label") == label) & (F.col("kind") == kind)).select("work").orderBy("work")

    def get(self, work: str, default: object = None) -> dict[str, list[str]] | object:
        """The labels of a work by kind, in their order; ``default`` for a work without any."""
        found = self.by_work.where(F.col("work") == work).orderBy("kind", "position").collect()  # one work's labels
        out: dict[str, list[str]] = {}
        for r in found:
            out.setdefault(r.kind, []).append(r.label)
        return out or default

    def __getitem__(self, work: str) -> dict[str, list[str]]:
        found = self.get(work, _NONE)
        if found is _NONE:
            raise KeyError(work)
        return found

    def keys(self) -> DataFrame:
        return self.by_work.select("work").distinct().orderBy("work")

    def labels(self, kind: str) -> DataFrame:
        """The vocabulary of a kind, sorted, with the number of works of each label."""
        n = self.by_label.where(F.col("kind") == kind).groupBy("label").agg(F.count("*").alias("n_works"))
        return self.vocabulary.where(F.col("kind") == kind).select("label").join(n, "label", "left").select("label", F.coalesce("n_works", F.lit(0)).alias("n_works")).orderBy("label")

    def postings(self) -> DataFrame:
        """(kind, label, work) of the whole index; a label that nobody bears once, without a work."""
        return self.vocabulary.join(self.by_label, ["kind", "label"], "left").select("kind", "label", "work")


class MetadataStore:
    """Metadata of works from a stored table (work, field, value) of JSON texts: a field that is absent differs from one that is null."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.values = spark, spark.table(name)

    @classmethod
    def write(cls, values: DataFrame, name: str, *, buckets: int = BUCKETS, folder: str | None = None) -> MetadataStore:
        rows = values.select("work", "field", "value")
        none_of(repeated(rows, "work", "field"), "a field is given twice")
        _stored(rows.repartition(buckets, "work"), name, "work", ["work", "field"], buckets, folder)
        return cls(values.sparkSession, name)

    def get(self, work: str, default: object = None) -> dict[str, object] | object:
        """All fields of a work, also by its file's name; nested ones under the names before their dots."""
        name = work.removesuffix(".xml")
        out: dict[str, object] = {}
        for r in self.values.where(F.col("work") == name).orderBy("field").collect():  # one work's fields
            at, *path = r.field.split(".")
            holder = out
            while path:
                holder, (at, *path) = holder.setdefault(at, {}), path
            holder[at] = None if r.value is None else json.loads(r.value)
        return out or default

    def __getitem__(self, work: str) -> dict[str, object]:
        found = self.get(work, _NONE)
        if found is _NONE:
            raise KeyError(work)
        return found

    def keys(self) -> DataFrame:
        return self.values.select("work").distinct().orderBy("work")
