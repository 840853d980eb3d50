"""JSON side sources: document metadata and historical classifications, read strictly.

Both files describe works, not words, and are read on the driver; their tables are joined like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import json_text, not_blank, positive, strict_json
from ..operators.guards import none_of

# The fields of a document's metadata, and the keys of both files.
FIELDS = ("introduction", "provenance", "themes", "status", "manuscripts", "bibliography", "corrections", "sigla", "copyright")
REQUIRED, OPTIONAL = ("title", "version"), ("citation", "author", "editor")
CLASSIFICATION_KEYS = ("source", "genres", "biblical_figures", "documents")
#: What a file of classifications says of its own source.
SOURCE_KEYS = ("repository", "historical_commit", "historical_commit_date", "storage_sqlite_git_blob", "storage_sqlite_sha256", "status")


def _bytes(spark: SparkSession, path: str) -> bytes:
    found = spark.read.format("binaryFile").load(path).select("content").collect()
    if len(found) != 1:
        raise ValueError(f"{path}: one file is needed, {len(found)} found")
    return bytes(found[0].content)


def _keys(value: object, where: str, required: tuple[str, ...], optional: tuple[str, ...] = ()) -> dict:
    if not isinstance(value, dict):
        raise ValueError(f"{where} is no object")
    if missing := [k for k in required if k not in value]:
        raise ValueError(f"{where} lacks {', '.join(missing)}")
    if unknown := sorted(set(value) - set(required) - set(optional)):
        raise ValueError(f"{where} has unknown keys {', '.join(unknown)}")
    return value


def _scalar(value: object, where: str) -> str:
    """As JSON text: what is null stays apart from what is absent."""
    if isinstance(value, (dict, list)):
        raise ValueError(f"{where} is no scalar")
    return json_text(value)


def metadata(spark: SparkSession, path: str, works: DataFrame | None = None) -> DataFrame:
    """(document, field, value, source_sha256): one row a field that is present; values are JSON texts.

    ``works``: (file) of the XML files; a document without a file is an error.
    """
    data = _bytes(spark, path)
    top = _keys(strict_json(data), "metadata", ("documents",), ("_meta",))
    if not isinstance(top["documents"], dict) or not isinstance(top.get("_meta", {}), dict):
        raise ValueError("metadata: documents and _meta are objects")
    rows = []
    for name, entry in top["documents"].items():
        if not name.endswith(".xml"):
            raise ValueError(f"metadata of {name!r}: the key is no XML file name")
        entry = _keys(entry, name, (*REQUIRED, "fields"), OPTIONAL)
        fields = _keys(entry["fields"], f"{name}: fields", (), FIELDS)
        rows += [(name, k, _scalar(entry[k], f"{name}: {k}")) for k in (*REQUIRED, *OPTIONAL) if k in entry]
        rows += [(name, f"fields.{k}", _scalar(v, f"{name}: {k}")) for k, v in fields.items()]
    out = spark.createDataFrame(rows, "document string, field string, value string").withColumn("source_sha256", F.lit(hashlib.sha256(data).hexdigest()))
    if works is not None:
        names = works.select(F.element_at(F.split("file", "/"), -1).alias("document"))
        none_of(out.select("document").distinct().join(names, "document", "left_anti"), "metadata of unknown files")
    return out


def classifications(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """genres and biblical_figures (id, label), documents (work_id, historical_doc_id, genre_ids, figure_ids), source (key, value, source_sha256)."""
    data = _bytes(spark, path)
    top = _keys(strict_json(data), "classification", CLASSIFICATION_KEYS)
    source = _keys(top["source"], "source", SOURCE_KEYS)
    for k, v in source.items():
        not_blank(v, f"source.{k}")

    def vocabulary(name: str) -> dict[int, str]:
        found: dict[int, str] = {}
        for row in _list(top[name], name):
            row = _keys(row, name, ("id", "label"))
            number, label = positive(row["id"], f"{name} id"), not_blank(row["label"], f"{name} label")
            if number in found or label in found.values():
                raise ValueError(f"{name}: {number} {label!r} is repeated")
            found[number] = label
        return found

    def ids(value: object, known: dict[int, str], where: str) -> list[int]:
        found = [positive(x, where) for x in _list(value, where)]
        if len(set(found)) != len(found) or set(found) - set(known):
            raise ValueError(f"{where}: repeated or unknown ids")
        return found

    genres, figures, documents = vocabulary("genres"), vocabulary("biblical_figures"), []
    for row in _list(top["documents"], "documents"):
        row = _keys(row, "documents", ("historical_doc_id", "work_id", "genre_ids", "biblical_figure_ids"))
        work = not_blank(row["work_id"], "work_id")
        documents.append((work, positive(row["historical_doc_id"], "historical_doc_id"), ids(row["genre_ids"], genres, f"{work}: genres"), ids(row["biblical_figure_ids"], figures, f"{work}: figures")))
    for k, what in ((0, "work"), (1, "document id")):
        if len({d[k] for d in documents}) != len(documents):
            raise ValueError(f"documents: a {what} is repeated")
    table: Callable = lambda rows: spark.createDataFrame(sorted(rows.items()), "id int, label string")
    return {
        "genres": table(genres), "biblical_figures": table(figures),
        "documents": spark.createDataFrame(documents, "work_id string, historical_doc_id int, genre_ids array<int>, figure_ids array<int>"),
        "source": spark.createDataFrame(sorted(source.items()), "key string, value string").withColumn("source_sha256", F.lit(hashlib.sha256(data).hexdigest())),
    }


def _list(value: object, where: str) -> list:
    if not isinstance(value, list):
        raise ValueError(f"{where} is no list")
    return value
