"""Media columns: pages as interleaved sequences of texts and media references, resolved by digest.

``interleave`` parses HTML into ordered segments: a text, or a media reference with its caption (the
caption of its figure, else its alternative text) and digest (of a ``sha256:`` name, or of the bytes of a
``data:`` address). ``resolve`` joins the references with a payload table by digest; positions and captions
stay with them. ``stored`` keeps payloads of bytes as grey images, 8 bits a sample, without loss.

Results by case: null and empty HTML have no segment; a reference whose digest is unknown or without a
payload stays, with null payload columns; equal payloads are stored once a row and resolved once a digest;
repeated rows are parsed each; extra columns stay, and ``segments`` is replaced.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import html
import struct
import urllib.parse
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written
from .text import as_bytes

#: Payloads are filled up to a multiple of this, the samples of a row of an image.
ROW = 576
FILL = 255
LEVEL = 4
#: A digest is hot if over 1/HOT of all references name it, so HOT digests at most are.
HOT = 4096
MEDIA = {"img", "video", "audio", "source", "embed"}
#: Elements whose ends and starts end a text.
BLOCKS = {"p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "table", "tr", "td", "th", "br", "hr", "blockquote", "pre", "figure", "figcaption", "nav", "header", "footer", "main", "aside", "body"}
HIDDEN = {"script", "style", "template", "noscript", "title"}
SEGMENT = "struct<position: int, kind: string, text: string, ref: string, digest: string>"
_SEGMENT = pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("digest", pa.string())])
_PNG = b"\x89PNG\r\n\x1a\n"


# --- pages ----------------------------------------------------------------------------------


def digest_of(ref: str) -> str | None:
    """The SHA-256 that a reference names or holds, in lowercase hexadecimal digits."""
    if ref.startswith("sha256:"):
        return ref[7:].lower() if len(ref) == 71 and all(c in "0123456789abcdefABCDEF" for c in ref[7:]) else None
    if ref.startswith("data:"):
        head, mark, body = ref[5:].partition(",")
        try:
            data = base64.b64decode(body, validate=True) if head.endswith(";base64") else urllib.parse.unquote_to_bytes(body)
        except (binascii.Error, ValueError):
            return None
        return hashlib.sha256(data).hexdigest() if mark else None
    return None


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[dict] = []
        self.run: list[str] = []
        self.hidden = 0
        self.figure: list[dict] | None = None
        self.caption: list[str] | None = None

    def _flush(self) -> None:
        text = " ".join("".join(self.run).split())
        self.run = []
        if text:
            self.out.append({"kind": "text", "text": text, "ref": None, "digest": None})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in HIDDEN:
            self.hidden += 1
        elif tag == "figure":
            self._flush()
            self.figure = []
        elif tag == "figcaption" and self.figure is not None:
            self._flush()
            self.caption = []
        elif tag in MEDIA:
            given = dict(attrs)
            if ref := (given.get("src") or "").strip():
                self._flush()
                item = {"kind": "media", "text": " ".join((given.get("alt") or "").split()) or None, "ref": ref, "digest": digest_of(ref)}
                self.out.append(item)
                if self.figure is not None:
                    self.figure.append(item)
        elif tag in BLOCKS and self.caption is None:
            self._flush()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HIDDEN:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("figcaption", "figure"):
            if self.caption is not None:
                text = " ".join("".join(self.caption).split())
                if self.figure:
                    for item in self.figure:
                        item["text"] = text or item["text"]
                elif text:
                    self.out.append({"kind": "text", "text": text, "ref": None, "digest": None})
                self.caption = None
            if tag == "figure":
                self._flush()
                self.figure = None
        elif tag in BLOCKS and self.caption is None:
            self._flush()

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            (self.run if self.caption is None else self.caption).append(data)

    def close(self) -> None:
        super().close()
        if self.caption is not None:
            self.handle_endtag("figcaption")
        self._flush()


def segments(page: str | None) -> list[dict]:
    """The ordered segments of a page, positions from 0."""
    parser = _Page()
    parser.feed(page or "")
    parser.close()
    return [{"position": i, **x} for i, x in enumerate(parser.out)]


def interleave(pages: DataFrame, *, page: str = "html") -> DataFrame:
    """``pages`` with the array ``segments`` in place of the HTML column."""
    names = [c for c in pages.columns if c not in ("segments", page)]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([segments(x) for x in b.column(len(names)).to_pylist()], pa.list_(_SEGMENT))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], found], names=[*names, "segments"])

    return pages.select(*[f"`{c}`" for c in names], F.col(f"`{page}`")).mapInArrow(run, ", ".join([*fields, f"segments array<{SEGMENT}>"]))


def resolve(sequences: DataFrame, payloads: DataFrame) -> DataFrame:
    """One row a media reference: the columns of ``sequences``, position, caption, ref, digest, and those of the digest's payload.

    ``payloads`` has a column digest; of several rows of a digest one counts. Its columns that are named like
    those of the references are left out. References to a digest that many of them share, and those without a
    digest, are dealt over several tasks, and such a digest's payload goes to each of these.
    """
    own = [c for c in sequences.columns if c != "segments"]
    refs = sequences.select(*[f"`{c}`" for c in own], F.explode(F.filter("segments", lambda s: s["kind"] == "media")).alias("__s"))
    refs = refs.select(*[f"`{c}`" for c in own], F.col("__s.position").alias("position"), F.col("__s.text").alias("caption"), F.col("__s.ref").alias("ref"), F.col("__s.digest").alias("digest"))
    rest = [c for c in payloads.columns if c != "digest" and c not in refs.columns]
    refs = written(refs, "references")
    total = refs.count()
    sizes = refs.where("digest is not null").groupBy("digest").agg(F.count("*").alias("__n")).where(F.col("__n") * HOT > total)
    shares = F.broadcast(written(sizes.select("digest", F.ceil(F.col("__n") * HOT / max(total, 1)).cast("int").alias("__shares")), "hot-digests"))  # fewer than HOT rows
    dealt = lambda n: F.coalesce(F.pmod(F.monotonically_increasing_id(), n).cast("int"), F.lit(0))
    refs = refs.join(shares, "digest", "left").withColumn("__share", dealt(F.when(F.col("digest").isNull(), HOT).otherwise(F.col("__shares")))).drop("__shares")
    one = payloads.where("digest is not null").groupBy("digest").agg(*[F.first(f"`{c}`").alias(c) for c in rest])
    one = one.join(shares, "digest", "left").withColumn("__share", F.explode(F.sequence(F.lit(0), F.coalesce("__shares", F.lit(1)) - 1))).drop("__shares")
    return refs.join(one, ["digest", "__share"], "left").drop("__share")


# --- payloads -------------------------------------------------------------------------------


def image(payload: bytes) -> bytes:
    """A grey image, 8 bits a sample, ROW samples a row, of a payload whose size is a multiple of ROW."""
    height = len(payload) // ROW
    raw = np.zeros((height, ROW + 1), np.uint8)  # a row begins with its filter, 0: none
    raw[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, ROW)
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return _PNG + part(b"IHDR", struct.pack(">IIBBBBB", ROW, height, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw.tobytes(), LEVEL)) + part(b"IEND", b"")


def samples(data: bytes) -> np.ndarray:
    """The samples of an image as ``image`` makes it, a row each; ValueError for other or damaged data."""
    if not data.startswith(_PNG):
        raise ValueError("not an image")
    at, size, body = len(_PNG), None, []
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        if struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + part):
            raise ValueError("damaged image")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        at += 12 + n
    if size is None or size[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not a grey image of 8 bits a sample")
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(size[1], size[0] + 1)
    if raw[:, 0].any():
        raise ValueError("a row has a filter")
    return raw[:, 1:]


def padded(data: bytes) -> bytes:
    return data + bytes([FILL]) * ((-len(data)) % ROW if data else ROW)


def feature(grey: np.ndarray) -> str:
    """Size, mean, deviation and an 8-bin histogram of the samples, in whole numbers."""
    flat = grey.ravel()
    counts = np.bincount(flat, minlength=256)
    values, n = np.arange(256), len(flat)
    s1, s2 = int(counts @ values), int(counts @ values**2)
    deviation = int(np.sqrt(max(n * s2 - s1 * s1, 0)) * 1000 / n)
    return f"{grey.shape[1]}x{grey.shape[0]} mean={s1 * 1000 // n} dev={deviation} hist={','.join(map(str, counts.reshape(8, 32).sum(axis=1).tolist()))}"


def stored(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A stored table (doc_id, n_bytes, html, digest, media): each text as an image, and a page that shows it."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                texts = [t or b"" for t in as_bytes(part.column(1))]
                media = [image(padded(t)) for t in texts]
                digests = [hashlib.sha256(m).hexdigest() for m in media]
                pages = [f'<figure><img src="sha256:{d}" alt="text"><figcaption>document {html.escape(str(i))}</figcaption></figure>' for d, i in zip(digests, part.column(0).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, texts), pa.int64()), pa.array(pages), pa.array(digests), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "html", "digest", "media"])

    return written(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes long, html string, digest string, media binary"), "media")


def described(media: DataFrame) -> DataFrame:
    """What the stored bytes hold when read back, a row for each of ``media`` (digest, media)."""
    names = ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                grey = samples(m)
                payload = grey.tobytes()
                rows.append((d, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature(grey)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return media.select("digest", "media").mapInArrow(run, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
