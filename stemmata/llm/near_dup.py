"""Near-duplicate documents with SetSketch registers.

1. Each document's set of word shingles gives a digest and a sketch of ``REGISTERS`` registers. A register
   is floor(1 - log_b x) of the least of exponential numbers x of the shingles, held between 0 and the
   limit; registers of a union are the maxima, and equal registers become likelier with similarity.
2. Documents of equal sets are one class with its smallest doc_id, so groups of copies cost one row.
3. ``ROWS`` registers make a band. In each bucket of equal bands every class is paired with the smallest
   class there (a star, not all pairs). Pairs whose sizes rule out the similarity, or whose joint maximum
   likelihood does, go no further; the others are verified on the full sets of the two texts.
4. Components of the links. In the buckets that still hold several components, sketches mark the classes
   that might be linked with one of another component; blocks of their full sets are compared with each
   other, and a spanning forest of the links found there joins components.

Chance of missing a link of similarity 0.8 in all bands: (1 - 0.8 ** 3) ** 21 = 3e-7; by the likelihood
test and the least number of equal registers: 1e-5. Everything else is exact.

Results by case: a null, empty or wordless text has an empty set and is linked with nothing; a row without
a doc_id is linked with nothing, has no component and is kept; rows of one doc_id with different texts
belong to the components of their own texts; repeated rows are one class; long texts are read to the end; an
empty table gives no row. ``near_duplicates`` returns its own columns alone; ``first_of_each`` returns the
columns of its input, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import partitions, stored
from .text import as_bytes, mixed, shingle_sets

WIDTH = 5
#: Similarity from which documents are linked, in hundredths, so that the test is exact.
PERCENT = 80
REGISTERS, ROWS = 63, 3
BANDS = REGISTERS // ROWS
BASE, RATE, LIMIT = 1.001, 20.0, 65535
#: Log-likelihood that the similarity asked for may lack against the likeliest one.
DOUBT = 10.0
#: Equal registers below which the likelihood test always rules out the similarity: of two sets of similarity 0.8
#: fewer are equal with probability 1e-6.
FEW = 34
#: Members of a verification group that share a copy of their root's text.
GROUP = 256
#: Classes of a block of a bucket whose sketches are compared with another block's.
BLOCK = 2048
#: Classes of a block of a bucket whose full sets are compared with another block's.
SETS = 512
#: A class is hot if it has over 1/HOT of all rows, so HOT classes at most are.
HOT = 4096
RESULT = ("n_shingles", "component_id", "kept")

_draw = np.random.Generator(np.random.PCG64(7))
_MUL = (_draw.integers(0, 2**32, (REGISTERS, 1), dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
_ADD = _draw.integers(0, 2**32, (REGISTERS, 1), dtype=np.uint32)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a set. x = -ln(u) / rate is least where u is greatest, so one pass of maxima serves."""
    top = np.zeros(REGISTERS, np.uint32)
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(h), 2048):
            np.maximum(top, (h[None, at : at + 2048] * _MUL + _ADD).max(axis=1), out=top)
    x = -np.log((top + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


def bands(sketch: np.ndarray) -> np.ndarray:
    """A number for each band: its registers and its place, without loss."""
    k = sketch.reshape(BANDS, ROWS).astype(np.int64)
    return (np.arange(BANDS, dtype=np.int64) << 48) | (k[:, 0] << 32) | (k[:, 1] << 16) | k[:, 2]


def likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of sketches: the likeliest similarity, and whether ``percent`` is not ruled out.

    With u, v the shares of the two sizes, a register is greater in A with probability p(u - vJ), in B with
    p(v - uJ), p(x) = -log_b(1 - x (b - 1) / b), and equal otherwise; sizes are known, so J alone is free.
    """
    greater, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = REGISTERS - greater - less
    u = na / (na + nb)
    v = 1 - u

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        p = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
        more, fewer = p(u - v * j), p(v - u * j)
        return greater * np.log(more) + less * np.log(fewer) + equal * np.log(np.clip(1 - more - fewer, 1e-9, 1))

    most = np.minimum(u / v, v / u)
    lo, hi = np.zeros(len(u)), most.copy()
    for _ in range(24):  # the likelihood has one maximum
        left, right = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        better = log_likelihood(left) < log_likelihood(right)
        lo, hi = np.where(better, left, lo), np.where(better, hi, right)
    best = (lo + hi) / 2
    asked = np.minimum(percent / 100, most)
    return best, (best >= percent / 100) | (log_likelihood(best) - log_likelihood(asked) <= DOUBT)


def _describe(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, digests, sketches, keys = [], [], [], []
        for s in shingle_sets(as_bytes(b.column(1)), width):
            n.append(len(s))
            digests.append(_digest(s) if len(s) else None)
            k = registers(s) if len(s) else None
            sketches.append(k.tobytes() if k is not None else None)
            keys.append(bands(k) if k is not None else None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc", "mark", "n", "digest", "sketch", "bands"])


def _sizes_allow(percent: int) -> F.Column:
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def _screen(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""
    side = lambda c: classes.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").where(_sizes_allow(percent)).select("a", "b", "na", "nb", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sketch = lambda i: np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS)  # noqa: E731, B023
                _, ok = likely(sketch(4), sketch(5), b.column(2).to_numpy(), b.column(3).to_numpy(), percent)
                yield b.select([0, 1]).filter(pa.array(ok))

    return both.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b), a stored table, whose full sets are similar enough. ``texts``: (id, text) of all ids in pairs.

    Each root a is sent with its text once for about GROUP of its members, so that no task gets all
    members of a large group; a stream sorted by root compares each member's set with its root's.
    """
    salts = pairs.groupBy("a").agg(F.floor(F.count("*") / GROUP + 1).cast("int").alias("salts"))
    dealt = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "b")
    members = dealt.join(texts.withColumnRenamed("id", "b"), "b").select("a", "salt", "b", "text")
    roots = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).join(texts.withColumnRenamed("id", "a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    stream = roots.unionByName(members).repartition(partitions(pairs.sparkSession), "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.empty(0, np.uint64)
        for batch in batches:
            a, b, hits = batch.column(0), batch.column(2), []
            for i, (member, s) in enumerate(zip(b.to_pylist(), shingle_sets(as_bytes(batch.column(3)), width), strict=True)):
                if member is None:
                    own = s
                    continue
                common = np.searchsorted(own, s)
                shared = int((own[np.minimum(common, len(own) - 1)] == s).sum()) if len(own) and len(s) else 0
                if shared and 100 * shared >= percent * (len(own) + len(s) - shared):
                    hits.append(i)
            take = pa.array(hits, pa.int32())
            yield pa.RecordBatch.from_arrays([a.take(take), b.take(take)], names=["a", "b"])

    return stream.mapInArrow(run, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The runs of equal values in the first ``keys`` columns of a sorted stream."""
    now, group = None, []
    for b in batches:
        if not b.num_rows:
            continue
        values = np.stack([b.column(i).to_numpy() for i in range(keys)])
        cuts = np.flatnonzero((np.diff(values, axis=1) != 0).any(axis=0)) + 1
        for x, y in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
            if (key := tuple(values[:, x])) != now and group:
                yield pa.Table.from_batches(group)
                group = []
            now = key
            group.append(b.slice(x, y - x))
    if group:
        yield pa.Table.from_batches(group)


def _in_blocks(rows: DataFrame, block: int, *columns: str) -> DataFrame:
    """A stream of (key, lo, hi, own, columns) sorted by its first three: every two blocks of a bucket (key, size) meet once."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", *columns)
    return dealt.repartition(partitions(rows.sparkSession), "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def _needed(rows: DataFrame, percent: int) -> DataFrame:
    """From (key, size, id, component, n, sketch) of buckets: (key, id) of classes that the sketches let pass with one of another component.

    A pair counts in the first bucket that holds it. Nothing but members of such pairs is returned.
    """
    def mark(t: pa.Table) -> pa.RecordBatch | None:
        lo, hi, own, ids, comp, n = (t.column(i).to_numpy() for i in range(1, 7))
        if len(ids) < 2 or (comp == comp[0]).all():
            return None
        band, sketch = int(t.column(0)[0].as_py()) >> 48, np.frombuffer(b"".join(t.column(7).to_pylist()), np.uint16).reshape(-1, REGISTERS)
        marked = np.zeros(len(ids), bool)
        for i in range(len(ids) - 1):
            j = np.arange(i + 1, len(ids))
            open_ = (comp[j] != comp[i]) & (np.minimum(n[j], n[i]) * 100 >= np.maximum(n[j], n[i]) * percent)
            if marked[i]:
                open_ &= ~marked[j]
            if lo[0] != hi[0]:
                open_ &= own[j] != own[i]
            j = j[open_]
            if not len(j):
                continue
            equal = sketch[j] == sketch[i]
            near = equal.sum(axis=1) >= FEW
            if band:
                near &= ~equal[:, : band * ROWS].reshape(len(j), band, ROWS).all(axis=2).any(axis=1)
            j = j[near]
            if len(j):
                _, ok = likely(np.broadcast_to(sketch[i], (len(j), REGISTERS)), sketch[j], np.full(len(j), n[i]), n[j], percent)
                if ok.any():
                    marked[i] = True
                    marked[j[ok]] = True
        return pa.RecordBatch.from_arrays([pa.array(t.column(0).to_numpy()[marked]), pa.array(ids[marked])], names=["key", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            if (found := mark(t)) is not None:
                yield found

    return _in_blocks(rows, BLOCK, "id", "component", "n", "sketch").mapInArrow(run, "key long, id long").distinct()


def _exact_links(rows: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """From (key, id, component) of buckets: links (a, b) that join components of a bucket wherever full sets are similar enough.

    The sets of two blocks are compared in full by products of their incidence matrices, some columns at a
    time; of the links only a spanning forest goes on, at most one less than the components of the blocks.
    """
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in shingle_sets(as_bytes(b.column(1)), width)], pa.binary())], names=["id", "shingles"])

    sets = texts.join(rows.select("id").distinct(), "id", "left_semi").select("id", "text").mapInArrow(describe, "id long, shingles binary")
    sized = rows.join(rows.groupBy("key").agg(F.count("*").alias("size")), "key")

    def link(t: pa.Table) -> pa.RecordBatch | None:
        lo, hi, own, ids, comp = (t.column(i).to_numpy() for i in range(1, 6))
        if len(ids) < 2 or (comp == comp[0]).all():
            return None
        parts = [np.frombuffer(x, np.uint64) for x in t.column(6).to_pylist()]
        n, row = np.array([len(p) for p in parts]), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        _, column, seen = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = seen[column] > 1
        order = np.argsort(column[shared], kind="stable")
        column, row = column[shared][order], row[shared][order]
        column = np.cumsum(np.diff(column, prepend=column[:1]) != 0) if len(column) else column
        common = np.zeros((len(ids), len(ids)), np.float32)
        width_ = max(1, (1 << 21) // len(ids))
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, width_):
            x, y = np.searchsorted(column, (at, at + width_))
            m = np.zeros((len(ids), width_), np.float32)
            m[row[x:y], column[x:y] - at] = 1
            common += m @ m.T
        common = common.astype(np.int64)
        hit = np.triu(100 * common >= percent * (n[:, None] + n[None, :] - common), 1) & (comp[:, None] != comp[None, :])
        if lo[0] != hi[0]:
            hit &= own[:, None] != own[None, :]
        head = {c: c for c in comp.tolist()}
        a, b = [], []
        for i, j in zip(*(x.tolist() for x in np.nonzero(hit)), strict=True):
            u, v = int(comp[i]), int(comp[j])
            while head[u] != u:
                head[u] = u = head[head[u]]
            while head[v] != v:
                head[v] = v = head[head[v]]
            if u != v:
                head[u] = v
                a.append(int(ids[i]))
                b.append(int(ids[j]))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            if (found := link(t)) is not None:
                yield found

    return _in_blocks(sized.join(sets, "id"), SETS, "id", "component", "shingles").mapInArrow(run, "a long, b long")


def _narrow(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc, text, mark of the text) of the rows with a doc_id."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text")).where("doc is not null").withColumn("mark", F.xxhash64("text"))


def classes_and_components(narrow: DataFrame, *, width: int = WIDTH, percent: int = PERCENT, only: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc, mark, n, digest) of every row of ``narrow``, and (digest, component, size) of every class: the smallest doc it reaches.

    ``only`` (doc): rows of other docs are left out.
    """
    sketches = narrow.mapInArrow(lambda it: _describe(it, width), "doc long, mark long, n long, digest binary, sketch binary, bands array<long>")
    described = stored(sketches if only is None else sketches.join(only, "doc", "left_semi"), "sketches")
    grouped = described.where("n > 0").groupBy("digest").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"), F.count("*").alias("members"))
    classes = stored(grouped.withColumn("id", F.monotonically_increasing_id()), "classes")
    banded = classes.select("id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("id").alias("root"), F.count("*").alias("size")).where("size > 1")
    in_buckets = stored(banded.join(buckets, "key").select("key", "root", "size", "id"), "buckets")
    stars = in_buckets.where("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b")).distinct()
    candidates = stored(_screen(stars, classes, percent), "pairs")
    # one text of each class that shares a bucket with another
    involved = in_buckets.select("id").distinct().join(classes.select("id", "doc", "digest"), "id")
    texts = stored(_of_digest(narrow.select("doc", "text").join(involved, "doc").select("id", "digest", "text"), width).dropDuplicates(["id"]), "texts")
    links = stored(_verified(candidates, texts, width, percent), "found")
    edges = lambda: links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    labels = components(edges())
    labelled = stored(in_buckets.join(labels, in_buckets["id"] == labels["node"], "left").select("key", "size", "id", F.coalesce("component", "id").alias("component")), "labelled")
    still = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    rows = labelled.join(still, "key").join(classes.select("id", "n", "sketch"), "id").select("key", "size", "id", "component", "n", "sketch")
    needed = stored(_needed(rows, percent).join(labelled.select("key", "id", "component"), ["key", "id"]), "needed")
    more = stored(_exact_links(needed, texts, width, percent).distinct(), "found")
    if more.limit(1).count():
        links = links.unionAll(more)
        labels = components(edges())
    named = classes.join(labels, classes["id"] == labels["node"], "left").select("digest", "doc", "members", F.coalesce("component", "id").alias("label"))
    least = named.groupBy("label").agg(F.min("doc").alias("component"))
    return described.select("doc", "mark", "n", "digest"), named.join(least, "label").select("digest", "component", F.col("members").alias("size"))


def _with_component(described: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, mark, n, component) of every described row; a row with an empty set is its own component.

    The components of hot classes go to every task, so that no task gets all copies of a text.
    """
    found = stored(found, "components")
    total = found.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    hot = F.broadcast(found.where(F.col("size") * HOT > total).select("digest", "component"))  # fewer than HOT rows
    cold = found.where(F.col("size") * HOT <= total).select("digest", "component")
    some = described.where("digest is not null")
    columns = ["doc", "mark", "n", "component"]
    rest = some.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest").select(*columns)
    empty = described.where("digest is null").withColumn("component", F.col("doc")).select(*columns)
    return some.join(hot, "digest").select(*columns).unionAll(rest).unionAll(empty)


def _of_digest(rows: DataFrame, width: int) -> DataFrame:
    """The rows (id, digest, text) whose text has that digest: a doc_id may have other texts, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(as_bytes(b.column(2)), width)
            yield b.filter(pa.array([_digest(s) == d for s, d in zip(sets, b.column(1).to_pylist(), strict=True)], pa.bool_())).select([0, 2])

    return rows.mapInArrow(run, "id long, text string")


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def near_duplicates(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; n_shingles and component_id are null without a doc_id."""
    described, found = classes_and_components(_narrow(docs, text, doc_id), width=width, percent=percent)
    rows = _with_component(described, found).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    nothing = F.lit(None).cast("long")
    lost = docs.where(F.col(f"`{doc_id}`").isNull()).select(nothing.alias("doc_id"), nothing.alias("n_shingles"), nothing.alias("component_id"))
    return rows.unionByName(lost).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def first_of_each(docs: DataFrame, *, before: DataFrame | None = None, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of the smallest doc_id of each component, equal texts of a doc_id once; rows without a doc_id stay.

    ``before`` holds earlier texts of the same documents: documents are also linked if those are near copies. Rows of
    documents that are not in ``docs`` any more are left out.
    """
    now = _narrow(docs, text, doc_id)
    rows = _with_component(*classes_and_components(now, width=width, percent=percent))
    if before is not None:
        # one search each: a document's texts of then and now would mostly find one another
        rows = stored(rows, "rows")
        then = _with_component(*classes_and_components(_narrow(before, text, doc_id), width=width, percent=percent, only=rows.select("doc").distinct()))
        ties = components(rows.select("doc", "component").unionAll(then.select("doc", "component")).select(F.col("doc").alias("u"), F.col("component").alias("v")))
        rows = rows.drop("component").join(ties, rows["doc"] == ties["node"], "left").select("doc", "mark", F.coalesce("component", "doc").alias("component"))
    kept = rows.where("doc = component").select(F.col("doc").alias("__doc"), F.col("mark").alias("__mark")).distinct()
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col(f"`{doc_id}`").cast("long").alias("__doc"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("__mark"))
    first = own.where("__doc is not null").join(kept, ["__doc", "__mark"], "left_semi").dropDuplicates(["__doc", "__mark"])
    return first.unionByName(own.where("__doc is null")).select(*[F.col(n).alias(c) for c, n in names.items()])
