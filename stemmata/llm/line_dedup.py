"""Line dedup against a sharded minimal perfect hash.

Each text is split at newlines; a line's key is the line stripped of white space and with A-Z
lower-cased. Keys of at least ``least`` code points found in at least two documents lose all their
lines except in the smallest doc_id that holds them.

1. Documents send the 128-bit hashes of their distinct keys; an aggregate with map-side combine keeps
   count and smallest doc_id of every distinct hash.
2. Hot hashes, those with over 1/``HOT`` of all counted rows, are ``HOT`` at most; their index goes to
   every task, so that no shard sees their probes.
3. The other hashes are dealt to shards. A shard builds its minimal perfect hash once, as arrays of
   64-bit fingerprints, owners and counts, and the probes of all documents stream past it. A probe drops its line
   where the fingerprint is its own, the count two documents at least, and the owner another one.
4. Hits return to their documents, which drop the lines.

Results by case: null and empty texts are one empty line and stay as they are; rows without a doc_id
own no line and keep all theirs; rows of equal doc_id are one document; extra columns stay, and columns
named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import partitions, written
from .text import as_bytes, code_points_reach, line_keys, mixed

LEAST = 10
#: Hot hashes that may be broadcast, at most, and so 1/HOT of all rows is the most a key may send to a shard.
HOT = 4096
#: Hashes of a shard, about.
SHARD = 250_000
RESULT = ("n_lines", "n_dropped")


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys with fingerprint, owner and count arrays.

    Level by level, keys that alone hit a bit of a table of 1.5 n bits are placed there; the others
    go on. A key's slot is the number of set bits before its own, so slots are dense.
    """

    def __init__(self, h1: np.ndarray, h2: np.ndarray, owner: np.ndarray, count: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        slots, rest, base = np.empty(len(h1), np.int64), np.arange(len(h1)), 0
        while len(rest):
            size = max(64, int(1.5 * len(rest)))
            at = self._at(h1[rest], h2[rest], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            ranks = np.cumsum(alone) - alone
            done = alone[at]
            slots[rest[done]] = base + ranks[at[done]]
            self.levels.append((alone, ranks.astype(np.uint32), base))
            base, rest = base + int(done.sum()), rest[~done]
        self.fingerprints, self.owners, self.counts = np.empty(len(h1), np.int64), np.empty(len(h1), np.int64), np.empty(len(h1), np.int64)
        self.fingerprints[slots], self.owners[slots], self.counts[slots] = h2, owner, count

    @staticmethod
    def _at(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            seed = np.uint64((level * 2 + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
            return (mixed(h1.view(np.uint64) ^ mixed(h2.view(np.uint64) + seed)) % np.uint64(size)).astype(np.int64)

    def owner(self, h1: np.ndarray, h2: np.ndarray, missing: np.ndarray, documents: int = 1) -> np.ndarray:
        """Each key's owner, or the value of ``missing`` where the index doesn't hold the key or counts fewer documents."""
        out, rest = missing.copy(), np.arange(len(h1))
        for level, (bits, ranks, base) in enumerate(self.levels):
            if not len(rest):
                break
            at = self._at(h1[rest], h2[rest], level, len(bits))
            hit = bits[at]
            slot, who = base + ranks[at[hit]].astype(np.int64), rest[hit]
            same = (self.fingerprints[slot] == h2[who]) & (self.counts[slot] >= documents)
            out[who[same]] = self.owners[slot[same]]
            rest = rest[~hit]
        return out


def key_hashes(text: bytes, least: int) -> np.ndarray:
    """The distinct 128-bit hashes of a text's keys, as rows of two numbers."""
    own = {xxhash.xxh3_128_digest(k) for k in set(line_keys(text)) if code_points_reach(k, least)}
    return np.frombuffer(b"".join(sorted(own)), np.int64).reshape(-1, 2)


def _keys(batches: Iterator[pa.RecordBatch], least: int, hot: PerfectHash | None) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        found = [key_hashes(t or b"", least) for t in as_bytes(b.column(1))]
        n = [len(x) for x in found]
        both = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        h1, h2, docs = both[:, 0].copy(), both[:, 1].copy(), np.repeat(ids, n)
        if hot is not None:
            cold = hot.owner(h1, h2, np.full(len(h1), np.iinfo(np.int64).min)) == np.iinfo(np.int64).min
            h1, h2, docs = h1[cold], h2[cold], docs[cold]
        yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(docs, pa.int64())], names=["h1", "h2", "doc"])


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A stream sorted by (shard, probe): each shard's index rows, then its probes."""
    shard, parts, index = None, [], None
    for b in batches:
        shards, probe = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(shards) | (np.diff(probe.astype(np.int8)) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(shards)], strict=True):
            if hi == lo:
                continue
            if shards[lo] != shard:
                shard, parts, index = shards[lo], [], None
            h1, h2, doc, count = (b.column(i).slice(lo, hi - lo).to_numpy() for i in (2, 3, 4, 5))
            if not probe[lo]:
                parts.append((h1, h2, doc, count))
                continue
            if index is None and parts:
                index, parts = PerfectHash(*(np.concatenate(x) for x in zip(*parts, strict=True))), []
            if index is not None:
                hit = index.owner(h1, h2, doc, documents=2) != doc
                if hit.any():
                    yield pa.RecordBatch.from_arrays([pa.array(doc[hit]), pa.array(h1[hit])], names=["doc", "h1"])


def dedup(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", least: int = LEAST) -> DataFrame:
    """``docs`` with the kept lines as text, and n_lines (before dropping) and n_dropped."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text")).where("doc is not null")
    keyed = narrow.mapInArrow(lambda it: _keys(it, least, None), "h1 long, h2 long, doc long")
    counted = keyed.groupBy("h1", "h2").agg(F.min("doc").alias("owner"), F.max("doc").alias("other"), F.count("*").alias("n"))
    distinct = written(counted.select("h1", "h2", "owner", F.when(F.col("owner") < F.col("other"), F.col("n")).otherwise(1).alias("n")), "lines")
    total, entries = distinct.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hot_rows = distinct.where(F.col("n") * HOT > total).collect()  # fewer than HOT rows
    hot = PerfectHash(*(np.array([r[i] for r in hot_rows], np.int64) for i in range(4))) if hot_rows else None

    n = partitions(spark)
    shards = 4 * max(n, -(-entries // SHARD))
    shard = F.pmod("h1", F.lit(shards)).cast("int").alias("shard")
    index = distinct.where(F.col("n") * HOT <= total).select(shard, F.lit(False).alias("probe"), "h1", "h2", F.col("owner").alias("doc"), "n")
    probes = narrow.mapInArrow(lambda it: _keys(it, least, hot), "h1 long, h2 long, doc long").select(shard, F.lit(True).alias("probe"), "h1", "h2", "doc", F.lit(0).cast("long").alias("n"))
    stream = index.unionByName(probes).repartition(max(n, shards // 4), "shard").sortWithinPartitions("shard", "probe")
    drops = stream.mapInArrow(_probe, "doc long, h1 long").groupBy("doc").agg(F.collect_set("h1").alias("__drops")).hint("merge")

    names = [c for c in docs.columns if c not in RESULT]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names]
    at = names.index(text)
    joined = docs.select(*[f"`{c}`" for c in names], F.col(f"`{doc_id}`").cast("long").alias("__doc")).join(drops.withColumnRenamed("doc", "__doc"), "__doc", "left").select(*[f"`{c}`" for c in names], "__doc", "__drops")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lines, dropped = [], [], []
            for t, doc, drop in zip(as_bytes(b.column(at)), b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist(), strict=True):
                raw = (t or b"").split(b"\n")
                lost = _lost(raw, doc, set(drop or ()), hot, least) if doc is not None and (drop or hot) else set()
                texts.append(b"\n".join(x for i, x in enumerate(raw) if i not in lost) if lost else t)
                lines.append(len(raw))
                dropped.append(len(lost))
            own = list(b.columns[: len(names)])
            own[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*own, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, *RESULT])

    return joined.mapInArrow(rewrite, ", ".join([*fields, "n_lines long", "n_dropped long"]))


def _lost(raw: list[bytes], doc: int, drop: set[int], hot: PerfectHash | None, least: int) -> set[int]:
    """Numbers of the lines that go: their hash was hit in a shard, or is hot and owned elsewhere."""
    at, digests = [], []
    for i, line in enumerate(raw):
        key = line.strip(b" \t\n\x0b\x0c\r").lower()
        if code_points_reach(key, least):
            at.append(i)
            digests.append(xxhash.xxh3_128_digest(key))
    if not at:
        return set()
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    h1, h2 = both[:, 0].copy(), both[:, 1].copy()
    gone = np.isin(h1, np.fromiter(drop, np.int64, len(drop))) if drop else np.zeros(len(h1), bool)
    if hot is not None:
        gone |= hot.owner(h1, h2, np.full(len(h1), doc)) != doc
    return {at[i] for i in np.flatnonzero(gone)}
