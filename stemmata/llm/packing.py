"""Best-fit packing of token sequences by a configuration linear program over the length histogram.

Documents are tokenised and cut; the histogram of piece lengths (at most ``capacity`` numbers, whatever
the corpus' size) goes to the driver. There the linear program over configurations, the ways to fill a
sequence, is solved slice by slice: a slice is a share of every length's need. Lengths hold prices that grow
by the exponential of the part of their need that is not yet placed (multiplicative weights). A knapsack
dynamic program prices all capacities at once, so each round finds for every length the best configuration
that holds it; those within the room that the bound leaves (none, where full sequences may suffice) or that
no piece fits are taken as often as the slice lasts. The knapsack's value also certifies the bound: no plan has
fewer sequences than the prices of all pieces over the price of the best configuration.
Rounding: the program's first configurations are kept, as many as possible without costing a sequence
against the best number found, and best fit places the rest. The plan has runs: pieces of a length, by rank, go to a
run of sequences at a slot. Ranks are counted in buckets with an offset from each, so that no task sees
all pieces of a length.

Results by case: null text is an empty document of one token (the end id); repeated rows are packed
each; a null doc_id stays null; an empty table gives no sequence; extra columns of documents are left out.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .storage import partitions, written

CAPACITY = 1024
END = 2
#: Shares of every length's need at which the slices of the program end.
SLICES = (0.2, 0.4, 0.6, 0.8, 0.9, 0.95, 0.98, 1.0)
#: How fast prices grow with what is not yet placed, and rounds of a slice at most; a slice ends sooner when a round places nothing.
STEP = 0.5
ROUNDS = 60
#: Numbers of configurations that rounding tries to keep.
TRIALS = 64
#: Pieces of a bucket in which ranks are counted, about.
BUCKET = 100_000


# --- tokens ---------------------------------------------------------------------------------

_encoders: dict[tuple[str, bool], object] = {}


def encoder(path: str, *, special: bool = False):
    """Function from text to the little-endian 32-bit ids of a byte-level BPE file.

    The names of special tokens in a text are ordinary text, or with ``special`` those tokens, as the
    tokenizers library takes them unless told otherwise. The file's ranks, merges and split pattern are those of the
    ``.tiktoken`` file beside it, where there is one; that library gives the same ids several times faster
    and without a list of Python integers.
    """
    if (path, special) not in _encoders:
        _encoders[path, special] = _encoder(path, special)
    return _encoders[path, special]


def _encoder(path: str, special: bool):
    import base64
    import json
    import os

    ranks = path.removesuffix(".json") + ".tiktoken"
    if path.endswith(".json") and os.path.exists(ranks):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(path, encoding="utf-8") as file:
            named = {x["content"]: x["id"] for x in json.load(file)["added_tokens"]} if special else {}
        fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=named)
        core, allowed = fast._core_bpe, set(named)

        def encode(text: str) -> bytes:
            try:
                return bytes(core.encode_to_tiktoken_buffer(text, allowed))
            except UnicodeEncodeError:
                return np.array(fast.encode(text, allowed_special=allowed, disallowed_special=()), "<u4").tobytes()

        return encode
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = not special
    return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = END, text: str = "text", doc_id: str = "doc_id", ids: bool = True, special: bool = True, row: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, and ids if asked for) of each document's tokens and the end id.

    Only documents of over ``capacity`` tokens are cut; their first piece takes the rest. The name of a special token in a text
    is that token (``special``), as the tokenizer's own call has it.
    """
    mark = np.array([end], "<u4").tobytes()
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, special=special)
        for b in batches:
            rows: list[tuple] = []
            at: list[int] = []
            for k, t in enumerate(b.column(1).to_pylist()):
                data = (encode(t) if t else b"") + mark
                n, start, piece = len(data) // 4, 0, 0
                length = (n - 1) % capacity + 1
                while start < n:
                    part = data[4 * start : 4 * (start + length)]
                    rows.append((piece, start, length, zlib.crc32(part)) + ((np.frombuffer(part, "<u4"),) if ids else ()))
                    at.append(k)
                    piece, start, length = piece + 1, start + length, capacity
            cols = list(zip(*rows, strict=True)) if rows else [()] * (4 + ids)
            new = [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:4])] + ([pa.array([x.astype(np.int32) for x in cols[4]], pa.list_(pa.int32()))] if ids else [])
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), *new, *([b.column(2).take(at)] if row else [])], names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids + [row] * bool(row))

    more = f", `{row}` {docs.schema[row].dataType.simpleString()}" if row else ""
    used = [F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")] + ([F.col(f"`{row}`")] if row else [])
    return docs.select(*used).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids + more)


# --- the plan -------------------------------------------------------------------------------


def knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each capacity the greatest price of a multiset of lengths within it, and a length of such a multiset (0: room is left)."""
    value, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int32)
    reverse = prices[::-1]  # prices[0] is length 0
    n = len(prices)
    for c in range(1, capacity + 1):
        # value[c] = max over l <= c of prices[l] + value[c - l]
        m = min(c, n - 1)
        totals = value[c - m : c] + reverse[n - 1 - m : n - 1]
        k = int(totals.argmax())
        if totals[k] > value[c - 1]:
            value[c], pick[c] = totals[k], m - k
        else:
            value[c] = value[c - 1]
    return value, pick


def _traced(pick: np.ndarray, capacity: int, most: np.ndarray, first: int = 0) -> dict[int, int]:
    """The multiset that ``pick`` tells for ``capacity``, beginning with ``first``; of each length ``most`` at most, the rest is left out."""
    out: dict[int, int] = defaultdict(int)
    if first:
        out[first] = 1
    c = capacity - first
    while c > 0:
        if k := int(pick[c]):
            if out[k] < most[k]:
                out[k] += 1
            c -= k
        else:
            c -= 1
    return {k: v for k, v in out.items() if v}


def best_configuration(prices: np.ndarray, capacity: int, most: np.ndarray) -> dict[int, int]:
    """The multiset of lengths of most price within ``capacity``, of each length ``most`` at most (unbounded knapsack, then trimmed)."""
    return _traced(knapsack(prices, capacity)[1], capacity, most)


@dataclass(frozen=True)
class Solution:
    plan: list[tuple[dict[int, int], int]]  #: (configuration, times): every piece once
    bound: float  #: no plan has fewer sequences
    whole: int  #: sequences of one piece that fills them
    program: int  #: sequences from the linear program
    rest: int  #: sequences from best fit


def solve(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """(configuration, times) that hold every piece of the histogram exactly once, in few sequences."""
    return solution(histogram, capacity, rounds).plan


def solution(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> Solution:
    need = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        need[length] = n
    whole, need[capacity] = int(need[capacity]), 0
    full = [({capacity: 1}, whole)] if whole else []
    if not need.any():
        return Solution(full, whole, whole, 0, 0)
    sizes = np.arange(capacity + 1) / capacity
    # each length is cut into slices at its own places, so that rare lengths are spread over all slices
    spread = np.random.default_rng(1).random(capacity + 1)
    bound, placed, taken = 0.0, np.zeros(capacity + 1, np.int64), []
    for share in SLICES:
        quota = np.minimum(need, np.floor(need * share + spread).astype(np.int64)) - placed
        for _ in range(rounds):
            live = np.flatnonzero(quota)
            if not len(live):
                break
            prices = np.zeros(capacity + 1)
            prices[live] = sizes[live] * np.exp(STEP * quota[live] / need[live])
            value, pick = knapsack(prices, capacity)
            bound = max(bound, float(need @ prices) / value[capacity])
            if not taken:  # sizes alone as prices
                bound = max(bound, float(need @ sizes) / knapsack(np.where(need > 0, sizes, 0.0), capacity)[0][capacity])
            # room that the bound leaves, or that no piece could ever fill
            room, before = max(int(capacity * (1 - need @ sizes / bound) + 1e-6), int(np.flatnonzero(need)[0]) - 1), len(taken)
            for first in map(int, live[::-1]):
                while quota[first]:
                    config = _traced(pick, capacity, quota, first)
                    if capacity - sum(k * v for k, v in config.items()) > room:
                        break
                    times = min(int(quota[k]) // v for k, v in config.items())
                    taken.append((config, times))
                    for k, v in config.items():
                        quota[k] -= v * times
                        placed[k] += v * times
            if len(taken) == before:
                break
    # configurations of few pieces first, since small pieces are of most use to best fit; as many are kept as leave
    # the least number of sequences when best fit places the rest
    taken.sort(key=lambda c: (sum(c[0].values()), -max(c[0])))
    left, tried = need.copy(), []
    for i in range(len(taken) + 1):
        if i % max(1, -(-len(taken) // TRIALS)) == 0 or i == len(taken):
            tried.append((sum(t for _, t in taken[:i]) + sum(t for _, t in _best_fit(left, capacity)), -i))
        for config, times in taken[i : i + 1]:
            for k, v in config.items():
                left[k] -= v * times
    left, plan = need.copy(), defaultdict(int)
    for config, times in taken[: -min(tried)[1]]:
        plan[tuple(sorted(config.items()))] += times
        for k, v in config.items():
            left[k] -= v * times
    program = sum(plan.values())
    for config, times in _greedy(left, capacity):
        plan[tuple(sorted(config.items()))] += times
    return Solution(full + [(dict(k), v) for k, v in sorted(plan.items())], whole + bound, whole, program, sum(plan.values()) - program)


def _greedy(left: np.ndarray, capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """What the program leaves over goes by best fit."""
    yield from _best_fit(left, capacity)


def _best_fit(need: np.ndarray, capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """Best fit, largest first: each configuration takes, again and again, the largest piece that fits, as often as pieces last."""
    left = need.copy()
    sizes = [int(k) for k in np.flatnonzero(left)]
    while sizes:
        room, config = capacity, defaultdict(int)
        at = len(sizes)
        while at and room:
            at = bisect.bisect_right(sizes, room, 0, at)
            if not at:
                break
            size = sizes[at - 1]
            n = min(room // size, int(left[size]))
            config[size] += n
            room -= n * size
            at -= 1
        times = max(1, min(int(left[k]) // v for k, v in config.items()))
        yield dict(config), times
        for k, v in config.items():
            left[k] -= v * times
            if not left[k]:
                sizes.remove(k)


@dataclass(frozen=True)
class Run:
    """Pieces of a length of rank first .. last go to sequences from ``sequence`` on, ``each`` to one, the first at ``offset``."""

    length: int
    first: int
    last: int
    sequence: int
    each: int
    offset: int


def layout(plan: list[tuple[dict[int, int], int]]) -> list[Run]:
    runs, taken, sequence = [], defaultdict(int), 0
    for config, times in plan:
        offset = 0
        for length, each in sorted(config.items(), reverse=True):
            first = taken[length]
            taken[length] += each * times
            runs.append(Run(length, first, taken[length] - 1, sequence, each, offset))
            offset += length * each
        sequence += times
    return runs


def place(table: DataFrame, *, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``table`` (a stored table of pieces with doc_id, piece, length and a number ``deal`` that deals them to buckets) with sequence_id and offset in place of deal."""
    sizes = table.groupBy("length").count().collect()  # at most capacity rows
    histogram = {int(r["length"]): int(r["count"]) for r in sizes}
    if any(x < 1 or x > capacity for x in histogram):
        raise ValueError("a piece is empty or longer than a sequence")
    runs = layout(solve(histogram, capacity, rounds))
    starts: dict[int, list[Run]] = defaultdict(list)
    for r in runs:
        starts[r.length].append(r)
    keys = {k: [r.first for r in v] for k, v in starts.items()}

    total = sum(histogram.values())
    buckets = max(partitions(table.sparkSession), -(-total // BUCKET))
    bucket = F.pmod(F.xxhash64("deal"), F.lit(buckets)).cast("int")
    dealt = table.withColumn("__bucket", bucket)
    counts = dealt.groupBy("__bucket", "length").agg(F.count("*").alias("n"))
    before = counts.select("__bucket", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("__bucket")) - F.col("n")).alias("__before"))
    # each bucket's stream: first its offsets, one row a length, then its pieces
    names = [c for c in table.columns if c != "deal"]
    fields = [f for f in table.schema.fields if f.name != "deal"]
    empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "length" else F.col("length") for f in fields]
    stream = before.select("__bucket", F.lit(False).alias("__piece"), "__before", *empty).unionByName(dealt.select("__bucket", F.lit(True).alias("__piece"), F.lit(None).cast("long").alias("__before"), *names))
    joined = stream.repartition(max(partitions(table.sparkSession), buckets // 4), "__bucket").sortWithinPartitions("__bucket", "__piece")
    at = [joined.columns.index(c) for c in names]
    at_length = joined.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, ranks = None, {}
        for b in batches:
            ids, offs, rows = [], [], []
            for i, (k, piece, before, length) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 1, 2, at_length)), strict=True)):
                if k != bucket:
                    bucket, ranks = k, {}
                if not piece:
                    ranks[length] = before
                    continue
                rank = ranks[length]
                ranks[length] = rank + 1
                r = starts[length][bisect.bisect_right(keys[length], rank) - 1]
                n, slot = divmod(rank - r.first, r.each)
                rows.append(i)
                ids.append(r.sequence + n)
                offs.append(r.offset + slot * length)
            take = pa.array(rows, pa.int32())
            own = [b.column(c).take(take) for c in at]
            yield pa.RecordBatch.from_arrays([*own, pa.array(ids, pa.int64()), pa.array(offs, pa.int64())], names=[*names, "sequence_id", "offset"])

    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return joined.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = END, text: str = "text", doc_id: str = "doc_id", ids: bool = False, special: bool = True, row: str | None = None) -> DataFrame:
    """Every piece of ``docs`` with its sequence and offset there. ``row`` names a column of docs that each piece takes along: it tells repeated documents apart."""
    cut = pieces(docs, tokenizer, capacity=capacity, end=end, text=text, doc_id=doc_id, ids=ids, special=special, row=row)
    return place(written(cut.withColumn("deal", F.rand(1)), "pieces"), capacity=capacity)  # equal rows are dealt apart
