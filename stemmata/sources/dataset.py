"""Stored editions, folders of sources, and archives."""

from __future__ import annotations

import hashlib
import io
import os
import re
import subprocess
import zipfile
from collections.abc import Iterable
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.guards import require_columns

#: Columns that each family of queries reads.
CONTRACTS: dict[str, dict[str, tuple[str, ...]]] = {
    "apparatus": {"units": ("version_id", "unit", "unit_id", "source_ref"), "readings": ("version_id", "unit", "reading", "text", "is_primary"), "reading_witness": ("version_id", "unit", "reading", "witness"), "manuscripts": ("version_id", "witness", "is_undeclared", "is_synthetic", "show"), "sections": ("version_id", "chapter", "label", "verse_index")},
    "translations": {"versions": ("version_id", "source_version_id", "version_kind", "language"), "unit_alignment": ("version_id", "translation_unit", "source_unit"), "units": ("version_id", "unit", "unit_id", "source_ref"), "readings": ("version_id", "unit", "text", "is_primary")},
}


def load(spark: SparkSession, folder: str, tables: dict[str, Iterable[str]]) -> dict[str, DataFrame]:
    """The named columns of the named tables; a missing column is an error that names it. Nothing else is read."""
    return {name: require_columns(spark.read.parquet(f"{folder}/{name}"), *columns).select(*columns) for name, columns in tables.items()}


def load_all(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}").persist() for name in names}


def load_tables(spark: SparkSession, prefix: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Tables that ``sinks.dataset.store`` has kept: nothing is read before a question, and then what it is about."""
    return {name: spark.table(f"{prefix}_{name}") for name in names}


def check_folder(folder: str, *, reviewed_files: Iterable[str] = (), reviewed_folders: Iterable[str] = ("backups", "drafts"), side_files: Iterable[str] = ("intros.json",)) -> list[str]:
    """The XML files of a source folder, sorted. Links, and anything that nobody has reviewed, are errors."""
    known, names, odd = {*reviewed_files, *side_files}, [], []
    with os.scandir(folder) as entries:
        for e in sorted(entries, key=lambda x: x.name):
            if e.is_symlink() or not (e.is_file() or e.is_dir()):
                odd.append(e.name)
            elif e.is_dir():
                if e.name not in reviewed_folders:
                    odd.append(f"{e.name}/")
            elif e.name.endswith(".xml") and not e.name.startswith("."):
                names.append(os.path.join(folder, e.name))
            elif e.name not in known:
                odd.append(e.name)
    if odd:
        raise ValueError(f"{folder}: not reviewed: {', '.join(odd)}")
    return names


def git_commit(folder: str) -> str | None:
    """The commit of a checkout, or null."""
    done = subprocess.run(["git", "-C", folder, "rev-parse", "HEAD"], capture_output=True, text=True)
    found = done.stdout.strip()
    return found if done.returncode == 0 and re.fullmatch("[0-9a-f]{40}", found) else None


def git_clean(folder: str) -> bool:
    """Whether a checkout has no changes in this folder, untracked and ignored files included."""
    done = subprocess.run(["git", "-C", folder, "status", "--porcelain", "--ignored", "--untracked-files=all", "--", "."], capture_output=True, text=True)
    return done.returncode == 0 and not done.stdout.strip()


def archive_members(path: str, suffix: str = "") -> list[tuple[str, int, str]]:
    """(name, bytes, sha256) of the top-level members; every member is read to its end, so its checksum is checked."""
    found = []
    with zipfile.ZipFile(path) as archive:
        for info in sorted(archive.infolist(), key=lambda i: i.filename):
            if "/" in info.filename or not info.filename.endswith(suffix):
                raise ValueError(f"{path}: unexpected member {info.filename!r}")
            digest, size = hashlib.sha256(), 0
            with archive.open(info) as member:
                while part := member.read(1 << 20):
                    digest.update(part)
                    size += len(part)
            found.append((info.filename, size, digest.hexdigest()))
    if len({n for n, _, _ in found}) != len(found):
        raise ValueError(f"{path}: a member is repeated")
    return found


def _root(data: bytes) -> tuple[str | None, list[str]]:
    """The root's name without its namespace (null if there is none), and of a TEI file its licences as ``target text``."""
    root, found = None, []
    try:
        for event, e in ET.iterparse(io.BytesIO(data), events=("start", "end")):
            name = e.tag.rsplit("}", 1)[-1]
            if root is None:
                root = name
            if root != "TEI":
                break
            if event == "end" and name in ("licence", "license"):
                found.append(" ".join([*filter(None, [e.get("target")]), *"".join(e.itertext()).split()]))
    except ET.ParseError:
        pass
    return root, found


def evidence(spark: SparkSession, folder: str) -> DataFrame:
    """(kind, n, n_bytes, licences) of the files below a folder, by what they are evidence of; licences as TEI files declare them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    roots = F.udf(_root, "root string, licences array<string>")
    read = files.withColumn("x", F.when(name.endswith(".xml"), roots("content")))
    kind = F.when(name.rlike("licen[cs]e|copying"), "licence").when(name.rlike(r"readme|notice|contributing"), "notice").when(F.col("x.root") == "TEI", "tei").when(name.endswith(".xml"), "edition").when(name.endswith(".json"), "metadata").otherwise("other")
    rows = read.select(kind.alias("kind"), "length", F.col("x.licences").alias("own"))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum("length").alias("n_bytes"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("licences"))
