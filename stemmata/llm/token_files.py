"""Token ids in binary files: patched frame-of-reference blocks, written and read by Spark tasks.

A file holds the ids of consecutive documents. Ids are cut into blocks of a fixed number. Of a block the least id
is subtracted; what remains is packed at the width that a percentile of the block needs, one plane of bits
after the other; the higher bits of the few outliers stand in a list of exceptions behind the planes.
The footer has for each block where it starts, its least id, its width and its number of exceptions, and for each
document its doc_id and number of ids, so that any range of ids is read with its own blocks only.

``write`` sorts documents by doc_id over the cluster and writes files through a data source of its own: tasks write
files under names no other attempt has, and the commit lists those that count, with the ids before each, in a
manifest; what lost attempts left behind is in no manifest. ``read`` gives one row a document, and one task a file.
Paths are URIs of file systems that pyarrow knows; all executors must reach them.

Results by case: a null or empty text has only the end id; repeated rows are written each, those of equal doc_id
in an order of their texts' hashes; a null doc_id comes first and stays null; very long texts make one file of their
own, however long; an empty table gives no file and no row; other columns are left out, so that none can clash.
"""

from __future__ import annotations

import json
import posixpath
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .storage import keep_until_exit, partitions, shared_dir

#: Ids of a block, and the percentile of its numbers that its width must hold.
BLOCK = 256
PERCENTILE = 95
#: Ids after which a file ends with its document, and characters of text that are encoded together.
FILE_IDS = 1 << 22
TEXT = 1 << 24
#: Words whose ids a worker remembers.
WORDS = 900_000
END = 2

_TRAILER = struct.Struct("<4sIQQQQ")
_MAGIC = b"PFR1"
FORMAT = "patched_token_ids"
ROWS = "doc_id long, start long, n_tokens long, ids binary"


# --- blocks ---------------------------------------------------------------------------------


@dataclass
class Blocks:
    """Packed blocks and their index; ``starts`` has one entry more than there are blocks."""

    payload: bytes
    starts: np.ndarray
    least: np.ndarray
    width: np.ndarray
    n_exceptions: np.ndarray


def _bits(x: np.ndarray) -> np.ndarray:
    """The number of bits that each number needs."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.uint8)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> Blocks:
    """Pack unsigned 32-bit ids. ``block`` is a multiple of 8 of at most 65,536; the last block is filled with its least id."""
    if block % 8 or not 8 <= block <= 1 << 16:
        raise ValueError("a block has a multiple of 8 ids, 65,536 at most")
    n = -(-len(ids) // block)
    padded = np.empty(n * block, np.uint32)
    padded[: len(ids)] = ids
    if n * block > len(ids):
        padded[len(ids) :] = ids[(n - 1) * block :].min()
    rows = padded.reshape(n, block)
    least = rows.min(axis=1) if n else np.empty(0, np.uint32)
    rest = rows - least[:, None]
    at = min(block - 1, int(block * percentile / 100))
    width = _bits(np.partition(rest, at, axis=1)[:, at]) if n else np.empty(0, np.uint8)
    high = (rest.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    of, position = np.nonzero(high)
    n_exceptions = np.bincount(of, minlength=n).astype(np.uint32)
    plane = block // 8
    starts = np.zeros(n + 1, np.uint64)
    np.cumsum(width.astype(np.uint64) * plane + n_exceptions.astype(np.uint64) * 6, out=starts[1:])
    out = np.zeros(int(starts[-1]), np.uint8)
    within = np.arange(plane, dtype=np.int64)
    for b in range(int(width.max(initial=0))):
        some = np.flatnonzero(width > b)
        to = starts[some].astype(np.int64) + b * plane
        out[to[:, None] + within] = np.packbits(((rest[some] >> np.uint32(b)) & np.uint32(1)).astype(np.uint8), axis=1)
    places, values = _exception_bytes(starts, width, n_exceptions, of, plane)
    out[places] = position.astype("<u2").view(np.uint8).reshape(-1, 2)
    out[values] = high[of, position].astype("<u4").view(np.uint8).reshape(-1, 4)
    return Blocks(out.tobytes(), starts, least, width, n_exceptions)


def _exception_bytes(starts: np.ndarray, width: np.ndarray, n_exceptions: np.ndarray, of: np.ndarray, plane: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes of each exception's place and value are; ``of``: the exceptions' blocks, in order."""
    before = np.cumsum(n_exceptions, dtype=np.int64) - n_exceptions
    k = np.arange(len(of), dtype=np.int64) - before[of]
    first = starts[of].astype(np.int64) + width[of].astype(np.int64) * plane
    return (first + 2 * k)[:, None] + np.arange(2), (first + 2 * n_exceptions[of].astype(np.int64) + 4 * k)[:, None] + np.arange(4)


def unpack(blocks: Blocks, block: int = BLOCK) -> np.ndarray:
    """The ids of whole blocks, those that fill the last one included."""
    n, plane = len(blocks.width), block // 8
    data, starts = np.frombuffer(blocks.payload, np.uint8), blocks.starts - blocks.starts[0]
    rest = np.zeros((n, block), np.uint32)
    within = np.arange(plane, dtype=np.int64)
    for b in range(int(blocks.width.max(initial=0))):
        some = np.flatnonzero(blocks.width > b)
        at = starts[some].astype(np.int64) + b * plane
        rest[some] |= np.unpackbits(data[at[:, None] + within], axis=1).astype(np.uint32) << np.uint32(b)
    of = np.repeat(np.arange(n), blocks.n_exceptions)
    places, values = _exception_bytes(starts, blocks.width, blocks.n_exceptions, of, plane)
    position = np.ascontiguousarray(data[places]).view("<u2").ravel()
    high = np.ascontiguousarray(data[values]).view("<u4").ravel()
    rest[of, position] |= (high.astype(np.uint64) << blocks.width[of].astype(np.uint64)).astype(np.uint32)
    return (rest + blocks.least[:, None]).ravel()


# --- a file ---------------------------------------------------------------------------------


def file_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """A file of documents: blocks, footer, trailer."""
    b = pack(ids, block, percentile)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [
        np.array([d or 0 for d in doc_ids], "<i8"), known, lengths.astype("<u8"),
        b.starts.astype("<u8"), b.least.astype("<u4"), b.width, b.n_exceptions.astype("<u4"),
    ]
    footer = b"".join(p.tobytes() for p in parts)
    return b.payload + footer + _TRAILER.pack(_MAGIC, block, len(ids), len(doc_ids), len(b.width), len(b.payload))


class TokenFile:
    """An open file: its documents, and the ids of any range of it."""

    def __init__(self, source: pa.NativeFile):
        size = source.size()
        magic, self.block, self.n_ids, n_docs, n_blocks, at = _TRAILER.unpack(source.read_at(_TRAILER.size, size - _TRAILER.size))
        if magic != _MAGIC:
            raise ValueError("not a file of token ids")
        footer, self.source, place = source.read_at(size - _TRAILER.size - at, at), source, 0

        def column(kind: str, n: int) -> np.ndarray:
            nonlocal place
            out = np.frombuffer(footer, kind, n, place)
            place += out.nbytes
            return out

        doc_ids, known, self.lengths = column("<i8", n_docs), column("u1", n_docs), column("<u8", n_docs).astype(np.int64)
        self.doc_ids = pa.array(doc_ids, mask=known == 0)
        self.starts, self.least, self.width, self.n_exceptions = column("<u8", n_blocks + 1), column("<u4", n_blocks), column("u1", n_blocks), column("<u4", n_blocks)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids ``start`` to ``stop`` (not included): only their blocks are read."""
        if not 0 <= start <= stop <= self.n_ids:
            raise ValueError(f"{start}..{stop} of {self.n_ids} ids")
        if start == stop:
            return np.empty(0, np.uint32)
        a, b = start // self.block, -(-stop // self.block)
        low, high = int(self.starts[a]), int(self.starts[b])
        part = Blocks(self.source.read_at(high - low, low), self.starts[a : b + 1], self.least[a:b], self.width[a:b], self.n_exceptions[a:b])
        return unpack(part, self.block)[start - a * self.block : stop - a * self.block]


# --- ids ------------------------------------------------------------------------------------

#: The pre-tokens of tokenizers that drop white space, a fixed value of their files: no ids span white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _drops_white_space(path: str) -> bool:
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    steps = (found.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    kinds = {x["type"] for x in (found.get("normalizer") or {}).get("normalizers", [])}
    split = steps[0].get("pattern", {}).get("Regex") == WORD_PATTERN and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
    return bool(split) and kinds <= {"NFC", "Replace", "Lowercase"} and not any(x["lstrip"] or x["rstrip"] for x in found.get("added_tokens", []))


class Encoder:
    """Ids of texts by the tokenizers library. Where a tokenizer drops white space, words are looked up and only new ones encoded."""

    _of: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words, self.known = _drops_white_space(path), {}
        mark = self._plain(["\0"])[0] if self.by_words else []
        self.mark = int(mark[0]) if len(mark) == 1 else None

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Encode new words, many at once with a mark between them; words that hold the mark, or a special token perhaps, one by one."""
        odd = [w for w in words if "\0" in w or "<|" in w or not w] if self.mark is not None else words
        if odd:
            words = sorted(set(words).difference(odd))
            self.known.update(zip(odd, (x.tobytes() for x in self._plain(odd)), strict=True))
        for i in range(0, len(words), 4096):
            part = words[i : i + 4096]
            ids = self._plain([" \0 ".join(part)])[0]
            ends, raw, low = 4 * np.flatnonzero(ids == self.mark), ids.tobytes(), 0
            for w, high in zip(part, [*ends.tolist(), len(raw)], strict=True):
                self.known[w] = raw[low:high]
                low = high + 4

    def _common(self, texts: pa.Array) -> pa.Array:
        """The same texts with fewer different words: A-Z in lower case, and marks between a letter and white space set apart, which these
        tokenizers do themselves. Texts that may hold the name of a special token, or a mark that joins the letter before
        it otherwise in lower case, stay."""
        odd = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, "[\u0300-\u036f]"))
        apart = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-zß-öø-ÿ])([.,!?;:#$%&*()-]+)(\s)", r"\1 \2\3")
        return pc.if_else(odd, texts, apart) if pc.any(odd).as_py() else apart

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each); nulls are empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_words:
            each = self._plain(texts.to_pylist())
            return np.concatenate([np.empty(0, "<u4"), *each]), np.array([len(x) for x in each], np.int64)
        split = pc.ascii_split_whitespace(self._common(texts))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) > WORDS:
            self.known.clear()
        self._learn([w for w in words if w not in self.known])
        found = [self.known[w] for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        index = coded.indices.to_numpy()
        n = size[index]
        ends = np.cumsum(n)
        ids = flat[np.arange(n.sum()) + np.repeat(first[index] - ends + n, n)]
        per_text = np.diff(np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()])
        return ids, per_text


# --- the data source ------------------------------------------------------------------------


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


@dataclass
class _Files(WriterCommitMessage):
    found: list[tuple]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        o, task = self.options, TaskContext.get()
        store, root = _place(o["path"])
        store.create_dir(root, recursive=True)
        encoder, end, limit = Encoder.of(o["tokenizer"]), int(o["end"]), int(o["file_ids"])
        found: list[tuple] = []
        docs: list[int | None] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def flush() -> None:
            name = f"part-{task.partitionId():06d}-{len(found):05d}-{uuid.uuid4().hex}.ids"
            n, every = np.concatenate(lengths), np.concatenate(ids)
            with store.open_output_stream(posixpath.join(root, name)) as out:
                out.write(file_bytes(docs, n, every, int(o["block"]), float(o["percentile"])))
            found.append((task.partitionId(), len(found), name, len(docs), len(every)))
            for x in (docs, lengths, ids):
                x.clear()

        for doc_ids, texts in _gathered(batches):
            own, n = encoder.encode(texts)
            ids.append(np.insert(own, np.cumsum(n), end).astype("<u4"))
            lengths.append(n + 1)
            docs += doc_ids.to_pylist()
            if sum(map(len, ids)) >= limit:
                flush()
        if docs:
            flush()
        return _Files(found)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Write the manifest: one line a file, in the order of documents."""
        store, root = _place(self.options["path"])
        store.create_dir(root, recursive=True)
        start, lines = 0, []
        for _, _, name, n_docs, n_ids in sorted(x for m in messages if m for x in m.found):
            lines.append(json.dumps({"name": name, "start": start, "n_docs": n_docs, "n_ids": n_ids}))
            start += n_ids
        with store.open_output_stream(posixpath.join(root, "_manifest")) as out:
            out.write("".join(f"{x}\n" for x in lines).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _place(self.options["path"])
        for m in messages:
            for x in m.found if m else ():
                store.delete_file(posixpath.join(root, x[2]))


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(doc_ids, texts) of some MB of text: more batches together while they are small, slices of one that is large."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> tuple[pa.Array, pa.Array]:
        t = pa.Table.from_batches(held).combine_chunks()
        return t.column(0).combine_chunks(), t.column(1).combine_chunks().cast(pa.large_string())

    for b in batches:
        chars = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(chars) // TEXT
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(chars)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                held.append(b.slice(lo, hi - lo))
                size += int(chars[lo:hi].sum())
                if size >= TEXT:
                    yield joined()
                    held, size = [], 0
    if held:
        yield joined()


@dataclass
class _OneFile(InputPartition):
    name: str
    start: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]

    def partitions(self) -> list[InputPartition]:
        store, root = _place(self.root)
        with store.open_input_stream(posixpath.join(root, "_manifest")) as lines:
            found = [json.loads(x) for x in lines.read().splitlines()]
        return [_OneFile(x["name"], x["start"]) for x in found] or [_OneFile("", 0)]

    def read(self, partition: _OneFile) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        store, root = _place(self.root)
        with store.open_input_file(posixpath.join(root, partition.name)) as source:
            f = TokenFile(source)
            ends = np.cumsum(f.lengths)
            lo = 0
            while lo < len(ends):  # some documents at once: their blocks are read with one call
                before = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + TEXT // 8, "right")))
                data = f.ids(before, int(ends[hi - 1])).astype("<u4").tobytes()
                offsets = 4 * (np.concatenate([[before], ends[lo:hi]]) - before)
                values = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
                starts = pa.array(partition.start + offsets[:-1] // 4 + before)
                yield pa.RecordBatch.from_arrays([f.doc_ids.slice(lo, hi - lo), starts, pa.array(f.lengths[lo:hi]), values], names=["doc_id", "start", "n_tokens", "ids"])
                lo = hi


class TokenIdSource(DataSource):
    """The format of these files for ``spark.read`` and ``df.write``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROWS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


def write(docs: DataFrame, tokenizer: str, path: str | None = None, *, end: int = END, block: int = BLOCK, percentile: float = PERCENTILE, file_ids: int = FILE_IDS, text: str = "text", doc_id: str = "doc_id") -> str:
    """Write the ids of all texts, each followed by ``end``, in ascending doc_id order; returns the folder.

    Without ``path`` the folder is in the shared folder of the cluster and goes when the session ends.
    """
    spark = docs.sparkSession
    spark.dataSource.register(TokenIdSource)
    if path is None:
        path = keep_until_exit(spark, f"{shared_dir(spark)}/stemmata/ids-{uuid.uuid4().hex}")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    # the hash is part of the ranges, so that rows that share a doc_id need not share a task
    dealt = rows.repartitionByRange(partitions(spark), *order[:2]).sortWithinPartitions(*order)
    settings = {"tokenizer": tokenizer, "end": end, "block": block, "percentile": percentile, "file_ids": file_ids}
    dealt.write.format(FORMAT).mode("append").options(**settings).save(path)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document: ``start`` counts the ids of all documents before it, ``ids`` are little-endian."""
    spark.dataSource.register(TokenIdSource)
    return spark.read.format(FORMAT).load(path)
