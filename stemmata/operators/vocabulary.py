"""JSON arrays of labels against a controlled vocabulary: types are checked in the plan, wrong rows are kept apart with their reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Why a row is wrong; the first that fits counts.
REASONS = ("null", "not JSON", "absent", "no array", "no text", "blank", "unknown", "repeated")


def _typed(value: Column, path: str) -> tuple[Column, Column, Column]:
    """What the first six reasons say, the labels, and the reason why they can't be read."""
    doc = F.try_parse_json(value)
    found = F.try_variant_get(doc, path, "variant")
    kind = F.schema_of_variant(found)
    members = F.try_variant_get(found, "$", "array<variant>")
    texts = F.transform(members, lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")))
    shape = F.when(value.isNull(), "null").when(doc.isNull(), "not JSON").when(found.isNull(), "absent").when(~kind.startswith("ARRAY"), "no array")
    inside = F.when(F.exists(texts, lambda x: x.isNull()), "no text").when(F.exists(texts, lambda x: F.trim(x) == ""), "blank")
    return texts, shape, inside


def checked(rows: DataFrame, vocabulary: DataFrame, key: str, value: str, path: str, *, label: str = "label") -> DataFrame:
    """(key, reason, labels): the labels of each row as texts, or the reason why they are none and no labels.

    ``key`` is unique. Membership is a join, so that the vocabulary may be of any size; labels meet it once each, not once a row.
    """
    texts, shape, inside = _typed(F.col(value), path)
    read = rows.select(F.col(key), texts.alias("__texts"), F.coalesce(shape, inside).alias("__reason"))
    each = read.where("__reason is null").select(key, F.explode(F.array_distinct("__texts")).alias("__label"))
    known = vocabulary.select(F.col(label).alias("__label")).distinct()
    strange = each.select("__label").distinct().join(known, "__label", "left_anti")
    unknown = each.join(strange, "__label", "left_semi").select(key).distinct().withColumn("__unknown", F.lit(True))
    judged = read.join(unknown, key, "left")
    repeated = F.size(F.array_distinct("__texts")) < F.size("__texts")
    reason = F.coalesce(F.col("__reason"), F.when(F.col("__unknown"), "unknown"), F.when(repeated, "repeated"))
    return judged.withColumn("reason", reason).select(key, "reason", F.when(F.col("reason").isNull(), F.col("__texts")).alias("labels"))
