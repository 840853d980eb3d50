"""Zip archives as tables: a data source whose partitions are archives and whose rows are members.

``read`` streams every member through its checksum and a SHA-256 in the task that has the archive; the driver lists names only.
``write`` makes one archive of the members of a group: sorted, with fixed times and modes, so that equal contents give equal
bytes, under a name that no other attempt of the task has, and put in its place by the commit. Paths are URIs of file
systems that pyarrow knows; all executors must reach them.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.text import path_component

FORMAT = "zip_members"
ROWS = "archive string, member string, n_bytes long, crc32 long, sha256 string, problem string"
#: Bytes that are looked at, and held for rows, at once.
PART = 1 << 20
#: The earliest time that archives can hold, and a plain file that all may read.
EPOCH, MODE = (1980, 1, 1, 0, 0, 0), 0o100644
ROWS_AT_ONCE = 5_000
#: Bytes of the end record that every archive has.
SMALLEST = 22

MISSING, SURPLUS, CHANGED, BROKEN = "missing", "surplus", "changed", "broken"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


@dataclass
class _Archive(InputPartition):
    path: str
    name: str


def _problem(info: zipfile.ZipInfo, before: str | None) -> str | None:
    """What is wrong with a member by its entry alone; the central list is sorted by name."""
    parts = info.filename.split("/")
    if info.is_dir():
        return "a folder"
    if info.filename.startswith("/") or "\\" in info.filename or any(x in ("", ".", "..") for x in parts):
        return "a name that leaves the archive"
    if info.filename == before:
        return "repeated"
    if info.flag_bits & 1:
        return "encrypted"
    kind = info.external_attr >> 16 & 0o170000
    return "a link or device" if kind not in (0, 0o100000) else None


def members(source: object) -> Iterator[tuple]:
    """(member, n_bytes, crc32, sha256, problem) of an open archive, by name; contents are streamed."""
    with zipfile.ZipFile(source) as archive:
        before = None
        for info in sorted(archive.infolist(), key=lambda x: x.filename):
            problem, before = _problem(info, before), info.filename
            if problem:
                yield info.filename, info.file_size, info.CRC, None, problem
                continue
            digest, n = hashlib.sha256(), 0
            try:
                with archive.open(info) as data:
                    while part := data.read(PART):
                        digest.update(part)
                        n += len(part)
            except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError) as e:
                yield info.filename, n, info.CRC, None, f"unreadable: {e}"
                continue
            yield info.filename, n, info.CRC, digest.hexdigest(), None


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]

    def partitions(self) -> list[InputPartition]:
        store, root = _place(self.root)
        info = store.get_file_info(root)
        if info.type == fs.FileType.File:
            return [_Archive(root, posixpath.basename(root))]
        found = store.get_file_info(fs.FileSelector(root))
        named = sorted(x.path for x in found if x.is_file and x.base_name.endswith(".zip") and not x.base_name.startswith((".", "_")))
        return [_Archive(x, posixpath.basename(x)) for x in named] or [_Archive("", "")]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, _ = _place(self.root)
        rows: list[tuple] = []
        try:
            with store.open_input_file(partition.path) as source:
                if source.size() < SMALLEST:
                    raise zipfile.BadZipFile("too short")
                for row in members(source):
                    rows.append((partition.name, *row))
                    if len(rows) >= ROWS_AT_ONCE:
                        yield _batch(rows)
                        rows = []
        except zipfile.BadZipFile as e:
            rows.append((partition.name, "", None, None, None, f"no archive: {e}"))
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in ROWS.split(", ")])


@dataclass
class _Written(WriterCommitMessage):
    found: list[tuple[str, str]]


class _Writer(DataSourceArrowWriter):
    """Rows (archive, member, content) come sorted by archive and member; an archive's rows are all in one task."""

    def __init__(self, options: dict[str, str]):
        self.root = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _place(self.root)
        store.create_dir(root, recursive=True)
        found: list[tuple[str, str]] = []
        name = out = archive = None

        def close() -> None:
            if archive is not None:
                archive.close()
                out.close()

        for b in batches:
            for to, member, content in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if to != name:
                    close()
                    name, hidden = to, f".{uuid.uuid4().hex}.tmp"
                    out = store.open_output_stream(posixpath.join(root, hidden))
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=9)
                    found.append((hidden, f"{path_component(to, 'archive')}.zip"))
                info = zipfile.ZipInfo(member, EPOCH)
                info.compress_type, info.external_attr, info.create_system = zipfile.ZIP_DEFLATED, MODE << 16, 3
                archive.writestr(info, content or b"")
        close()
        return _Written(found)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _place(self.root)
        for hidden, name in (x for m in messages if m for x in m.found):
            store.move(posixpath.join(root, hidden), posixpath.join(root, name))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _place(self.root)
        for hidden, _ in (x for m in messages if m for x in m.found):
            store.delete_file(posixpath.join(root, hidden))


class ZipMembers(DataSource):
    """The format ``zip_members`` of ``spark.read`` and ``df.write``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROWS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, n_bytes, crc32, sha256, problem) of an archive, or of all ``.zip`` files right in a folder."""
    spark.dataSource.register(ZipMembers)
    return spark.read.format(FORMAT).load(path)


def write(rows: DataFrame, path: str) -> None:
    """Write (archive, member, content) as archives of a folder; the members of one archive are written by one task, one after the other."""
    rows.sparkSession.dataSource.register(ZipMembers)
    own = rows.select(F.col("archive").cast("string"), F.col("member").cast("string"), F.col("content").cast("binary"))
    own.repartition("archive").sortWithinPartitions("archive", "member").write.format(FORMAT).mode("append").save(path)


def differences(expected: DataFrame, found: DataFrame, by: list[str] = ["archive"]) -> DataFrame:  # noqa: B006
    """(by.., member, kind, expected_sha256, found_sha256): members that ``found`` lacks, has besides, has with other bytes, or whose entry
    or content is no good. Both as ``read`` gives them; a broken member of either side is reported as such."""
    key = [*by, "member"]

    def side(df: DataFrame, name: str) -> DataFrame:
        digest = F.min(F.struct("sha256", "n_bytes"))
        return df.groupBy(*key).agg(digest.alias(f"__{name}"), (F.max("problem").isNotNull() | (F.count("*") > 1)).alias(f"__{name}_bad"))

    both = side(expected, "e").join(side(found, "f"), key, "full_outer")
    bad = F.coalesce("__e_bad", F.lit(False)) | F.coalesce("__f_bad", F.lit(False))
    kind = F.when(bad, BROKEN).when(F.col("__f").isNull(), MISSING).when(F.col("__e").isNull(), SURPLUS).when(F.col("__e") != F.col("__f"), CHANGED)
    return both.withColumn("kind", kind).where("kind is not null").select(*key, "kind", F.col("__e.sha256").alias("expected_sha256"), F.col("__f.sha256").alias("found_sha256"))
