"""Digests of long sequences: a task reads a group's pieces one after the other and holds none of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digests(rows: DataFrame, by: list[str], order: list[Column], piece: Column, separator: str) -> DataFrame:
    """(by.., n, n_chars, sha256) of the pieces of each group in ``order``, joined by ``separator``; pieces that are null are left out.

    The digest of a sequence has to see it in order, so that one task has a group; but it is sorted outside of memory, and what
    the task keeps of it are two numbers and the digest's state.
    """
    names = [f"__{i}" for i in range(len(order))]
    own = rows.where(piece.isNotNull()).select(*by, *[c.alias(n) for c, n in zip(order, names, strict=True)], piece.alias("__piece"))
    dealt = own.repartition(*by).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in by], *names).select(*by, "__piece")
    between = separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ready, schema = None, [], None
        n = chars = 0
        digest = hashlib.sha256()

        def flush() -> pa.RecordBatch:
            cols = list(zip(*ready, strict=True))
            ready.clear()
            types = [*(schema.field(i).type for i in range(len(by))), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[*by, "n", "n_chars", "sha256"])

        for b in batches:
            schema = b.schema
            for *group, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if n and group == held:
                    digest.update(between)
                    chars += len(separator)
                else:
                    if n:
                        ready.append((*held, n, chars, digest.hexdigest()))
                    held, n, chars, digest = group, 0, 0, hashlib.sha256()
                digest.update(text.encode())
                n, chars = n + 1, chars + len(text)
            if len(ready) >= 1000:
                yield flush()
        if n:
            ready.append((*held, n, chars, digest.hexdigest()))
        if ready:
            yield flush()

    kinds = ", ".join(f"`{c}` {own.schema[c].dataType.simpleString()}" for c in by)
    return dealt.mapInArrow(run, f"{kinds}, n long, n_chars long, sha256 string")
