"""Repair of conversations: a forward Viterbi search over the four states of their grammar.

The roles of a sound conversation are a system turn perhaps, then pairs of user and assistant, or nothing at all. A row is
kept (0), given another role (1) or deleted (2); rows without text and repeated ones must go, one whose text breaks off
costs 5 unless deleted, and a turn without text may be put in anywhere (5). For each row, and each state
that the rows so far can end in, the search carries the cheapest cost with its string of edits, the least in
ASCII order among equals, and closes the row's layer with the insertions that lead from state to state.
Equal costs after the same rows mean that no string begins another, so that the least prefix stays the least.

No task needs a whole conversation: rows are sorted over the cluster, cut into segments of a few thousand, and each
segment's part of a conversation becomes a table of the best way from every state to every state. These tables are then
chained for each conversation, and the chosen edits go back to the rows by their position.

Results by case: null roles and texts are one space; a null turn comes first and counts in no gap; a null conv_id
is a conversation; rows of one turn are ordered by role, then by the first 64 characters of the text, then by its
hash; repeated rows are duplicates, of which the first stays; very long texts are only looked at by built-in functions and
travel once; an empty table gives no conversation; other columns are left out, so that none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import partitions, written

REROLE, DELETE, CUT_OFF, INSERT = 1, 2, 5, 5
#: Rows of a segment, as a power of two.
SEGMENT_BITS = 12
#: Conversations whose repair a worker remembers by their codes.
KNOWN = 50_000
WHITE = r"[\x20\x09-\x0D]"

#: State after a role's initial: 0 nothing yet, 1 system, 2 user, 3 assistant.
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: State after a user or assistant turn of our choice: only one of the two fits.
NEXT = (2, 2, 3, 2)
FINAL = (0, 3)
LEGAL = {"su", "ua", "au"}

Way = tuple[int, str]  #: cost and edits
Layer = list[Way | None]


# --- the search -----------------------------------------------------------------------------


def closed(layer: Layer) -> Layer:
    """``layer`` with the insertions that make a state cheaper: three rounds reach every state."""
    for _ in range(3):
        changed = False
        for s, way in enumerate(list(layer)):
            if way is not None:
                new, t = (way[0] + INSERT, way[1] + "I"), NEXT[s]
                if layer[t] is None or new < layer[t]:
                    layer[t], changed = new, True
        if not changed:
            break
    return layer


def advanced(layer: Layer, code: str) -> Layer:
    """The layer after one more row; ``code``: see ``coded``."""
    out: Layer = [None] * 4
    must_go, more = code.isdigit(), CUT_OFF if code.isupper() else 0
    initial = code.lower()
    for s, way in enumerate(layer):
        if way is None:
            continue
        cost, edits = way
        found = [(s, (cost + DELETE, edits + "D"))]
        if not must_go:
            found.append((NEXT[s], (cost + REROLE + more, edits + "R")))
            if (s, initial) in KEEP:
                found.append((KEEP[s, initial], (cost + more, edits + "K")))
        for t, new in found:
            if out[t] is None or new < out[t]:
                out[t] = new
    return closed(out)


def started() -> Layer:
    return closed([(0, ""), None, None, None])


def ways(codes: str, entry: int | None) -> Layer:
    """The best ways through rows from a state, or from the start of a conversation with what is put before it."""
    layer: Layer = started() if entry is None else [(0, "") if s == entry else None for s in range(4)]
    for code in codes:
        layer = advanced(layer, code)
    return layer


def chained(layers: list[Layer], table: list[Layer]) -> tuple[Layer, list[int | None]]:
    """A layer with the table of a segment behind it, and the state from which each way enters."""
    out: Layer = [None] * 4
    enters: list[int | None] = [None] * 4
    for e, way in enumerate(layers):
        for s, more in enumerate(table[e]) if way is not None else ():
            if more is not None:
                new = (way[0] + more[0], way[1] + more[1])
                if out[s] is None or new < out[s]:
                    out[s], enters[s] = new, e
    return out, enters


def pieces(edits: str, codes: str, state: int) -> tuple[list[str], int]:
    """Edits by row, as letters of ``PIECES``, and the state after them. Insertions stand with the row behind them, last ones with the last row."""
    out, held, k = [], "", 0
    for x in edits:
        if x == "I":
            held += "ua"[NEXT[state] - 2]
            state = NEXT[state]
            continue
        if x == "K":
            held, state = held + "K", KEEP[state, codes[k].lower()]
        elif x == "R":
            held, state = held + "UA"[NEXT[state] - 2], NEXT[state]
        else:
            held += "D"
        out.append(held)
        held, k = "", k + 1
    if held:
        out[-1] += held
    return out, state


# --- rows and codes -------------------------------------------------------------------------


def placed(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of all conversations in order, with numbers that go on by one within a part of the table, written."""
    text_of = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    own = rows.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), text_of(role).alias("role"), text_of(text).alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64), F.xxhash64("text")]
    dealt = own.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order, "text")
    return written(dealt.withColumn("pos", F.monotonically_increasing_id()), "turns")


def coded(turns: DataFrame) -> DataFrame:
    """(pos, conv_id, turn, code): the initial of the role, other ones as x, in upper case where the text breaks off; 1 to 4 for a
    row without text and 5 to 8 for a repeated one, in the order s, u, a, x."""
    blank = F.regexp_replace("text", WHITE, "") == ""
    last = F.substring(F.regexp_replace("text", WHITE + "+$", ""), -1, 1)
    digest = F.struct(F.xxhash64("text"), F.md5("text"))
    first = turns.where(~blank).groupBy("conv_id", "role", digest.alias("digest")).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    of = F.substring("role", 1, 1)
    kind = F.when(of == "s", 1).when(of == "u", 2).when(of == "a", 3).otherwise(4)
    plain = turns.select("pos", "conv_id", "turn", kind.alias("kind"), blank.alias("blank"), last.isin(".", "!", "?").alias("ends"))
    marked = plain.join(first, "pos", "left")
    shift = F.when(F.col("blank"), 0).when(F.col("first").isNull(), 4).when(~F.col("ends"), 12).otherwise(8)
    return marked.select("pos", "conv_id", "turn", F.substring(F.lit("12345678suaxSUAX"), F.col("kind") + shift, F.lit(1)).alias("code"))


@dataclass
class _Run:
    """A conversation's rows of one segment."""

    conv_id: object
    pos: int
    begins: bool
    codes: list[str]
    turns: list[int]


_RUN = "pos long, begins boolean, codes string, n_turns long, first_turn long, last_turn long, costs array<long>, ways array<string>"


def _initials(codes: str) -> str:
    return "".join("suaxsuax"[int(c) - 1] if c.isdigit() else c.lower() for c in codes)


_tables: dict[tuple[str, bool], list[Layer]] = {}


def _table(codes: str, begins: bool) -> list[Layer]:
    key = (codes, begins)
    if key not in _tables:
        if len(_tables) >= KNOWN:
            _tables.clear()
        found = [ways(codes, None)] if begins else [ways(codes, e) for e in range(4)]
        if len(codes) > 64:
            return found
        _tables[key] = found
    return _tables[key]


def runs(codes: DataFrame) -> DataFrame:
    """One row for each segment's part of a conversation, with its table of ways: costs and edits from state to state."""
    kind = codes.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *[x.split()[0] for x in _RUN.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Run | None = None
        segment, rows, schema = None, [], None

        def done(r: _Run) -> tuple:
            text = "".join(r.codes)
            cells = [w for layer in _table(text, r.begins) for w in layer]
            distinct = sum(a != b for a, b in zip(r.turns, r.turns[1:], strict=False)) + bool(r.turns)
            ends = (r.turns[0], r.turns[-1]) if r.turns else (None, None)
            return (r.conv_id, r.pos, r.begins, text, distinct, *ends, [w[0] if w else None for w in cells], [w[1] if w else None for w in cells])

        for b in batches:
            schema = b.schema
            for pos, c, turn, code in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if held is None or pos >> SEGMENT_BITS != segment or c != held.conv_id:
                    if held is not None:
                        rows.append(done(held))
                    begins = pos >> SEGMENT_BITS == segment
                    segment, held = pos >> SEGMENT_BITS, _Run(c, pos, begins, [], [])
                held.codes.append(code)
                if turn is not None:
                    held.turns.append(turn)
            if len(rows) >= 1000:
                yield _batch(rows, names, schema.field(1).type)
                rows = []
        if held is not None:
            rows.append(done(held))
            yield _batch(rows, names, schema.field(1).type)

    part = F.shiftrightunsigned("pos", SEGMENT_BITS)
    dealt = codes.select("pos", "conv_id", "turn", "code").repartition(partitions(codes.sparkSession), part).sortWithinPartitions("pos")
    return dealt.mapInArrow(run, f"conv_id {kind}, {_RUN}")


def _batch(rows: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


_SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def solved(parts: DataFrame) -> DataFrame:
    """For each part of a conversation the edits of its rows, and in the row of the last part the conversation's sums and audit."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "pos", "pieces", "last", *_SUMMARY, "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows: list[tuple] = []
        type_of = None

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            types = [type_of, pa.int64(), pa.list_(pa.string()), pa.bool_(), *[pa.int64()] * len(_SUMMARY), pa.string()]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for b in batches:
            type_of = b.schema.field(0).type
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and row[0] != held[0][0]:
                    rows += _solve(held)
                    held = []
                held.append(row)
                if len(rows) >= 1000:
                    yield flush()
        if held:
            rows += _solve(held)
        if rows:
            yield flush()

    dealt = parts.repartition(partitions(parts.sparkSession), "conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos")
    return dealt.mapInArrow(run, f"conv_id {kind}, pos long, pieces array<string>, last boolean, " + ", ".join(f"{c} long" for c in _SUMMARY) + ", audit string")


def _solve(parts: list[tuple]) -> list[tuple]:
    """Chain the tables of a conversation's parts, follow the cheapest way back, and say what each part's rows become."""
    layer, back, before = started(), [], None
    for _, _, begins, codes, *_, costs, edits in parts:
        cells = [None if c is None else (c, e) for c, e in zip(costs, edits, strict=True)]
        if begins:  # its table starts with the conversation
            layer, enters, table = cells, [0] * 4, [cells]
        else:
            table = [cells[4 * e : 4 * e + 4] for e in range(4)]
            before = layer
            layer, enters = chained(before, table)
        back.append((enters, table))
    cost, audit, at = min((*layer[s], s) for s in FINAL if layer[s] is not None)
    chosen: list[str] = []
    for k in range(len(parts) - 1, -1, -1):
        enters, table = back[k]
        chosen.append(table[enters[at]][at][1])
        at = enters[at]
    chosen.reverse()
    if not parts[0][2]:  # what stands before the first row belongs to no table
        chosen[0] = started()[at][1] + chosen[0]
    state, out = 0, []
    for (conv_id, pos, _, codes, *_), edits in zip(parts, chosen, strict=True):
        rows, state = pieces(edits, codes, state)
        out.append((conv_id, pos, rows, False, *[None] * len(_SUMMARY), None))
    every = "".join(p[3] for p in parts)
    initials = _initials(every)
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    turns, last = 0, None
    for p in parts:
        if p[4]:
            turns += p[4] - (last is not None and last == p[5])
            last = p[6]
    first = next((p[5] for p in parts if p[5] is not None), None)
    gaps = last - first + 1 - turns if first is not None else 0
    n = lambda kinds: sum(map(every.count, kinds))
    out[-1] = (*out[-1][:3], True, gaps, n("1234"), n("5678"), n("SUAX"), illegal, cost, audit)
    return out


# --- the whole ------------------------------------------------------------------------------


@dataclass
class Repaired:
    """``turns``: the repaired rows (conv_id, pos, k, edit, role, text), to be sorted by conv_id, pos and k.
    ``conversations``: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)."""

    turns: DataFrame
    conversations: DataFrame


def repair(rows: DataFrame, **columns: str) -> Repaired:
    """Repair all conversations of a table; ``columns`` names conv_id, turn, role and text where they differ."""
    turns = placed(rows, **columns)
    found = written(solved(runs(coded(turns))), "repairs")
    each = found.select(F.posexplode("pieces").alias("i", "piece"), F.col("pos").alias("start")).select((F.col("start") + F.col("i")).alias("pos"), "piece")
    letters = F.filter(F.transform(F.split("piece", ""), lambda x, i: F.struct((i + 1).alias("k"), x.alias("letter"))), lambda x: (x["letter"] != "D") & (x["letter"] != ""))
    edited = turns.join(each, "pos").withColumn("x", F.explode(letters)).select("conv_id", "pos", "x.k", "x.letter", "role", "text")
    letter = F.col("letter")
    role = F.when(F.lower(letter) == "u", "user").when(F.lower(letter) == "a", "assistant").otherwise(F.col("role"))
    inserted = letter.isin("u", "a")
    edit = F.when(letter == "K", "K").when(inserted, "I").otherwise("R")
    out = edited.select("conv_id", "pos", "k", edit.alias("edit"), role.alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"))
    return Repaired(out, found.where("last").select("conv_id", *_SUMMARY, "audit"))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` of the rows in order, with newlines between. A digest has to see a conversation's
    rows one after the other: a task streams them and holds none."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, ready, kind_of = None, None, [], None

        def flush() -> pa.RecordBatch:
            cols = list(zip(*ready, strict=True))
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind_of), pa.array(cols[1], pa.string())], names=["conv_id", "repaired_sha256"])

        for b in batches:
            kind_of = b.schema.field(0).type
            for c, role, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if digest is None or c != held:
                    if digest is not None:
                        ready.append((held, digest.hexdigest()))
                    held, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if len(ready) >= 1000:
                yield flush()
        if digest is not None:
            ready.append((held, digest.hexdigest()))
            yield flush()

    dealt = turns.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos", "k")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations as they might arrive: by a hash of conv_id and turn a row is lost, emptied, without its marks of an end, repeated, or of role user."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    own = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("__kind")).where("__kind <> 0")
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("__kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("__kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return own.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("__copy")).drop("__copy")
