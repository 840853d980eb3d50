"""Fill-in-middle: texts cut at two places and put together again with marks, by an index of checkpoints.

The units of a text are runs of ASCII letters and single other code points. One scan over the UTF-8 bytes counts
them and notes, every so many units, the byte and the code point at which a unit begins. A cut before unit k is found by
a binary search among these checkpoints and a short scan from the one before it; texts are cut as bytes.

Where the cuts fall, and which form a text takes, follows from hashes of its doc_id and of a seed: cuts are those
of two draws among the n + 1 places, in order; ``plain`` texts stay, ``psm`` texts become prefix, suffix, middle, ``spm`` texts
suffix, prefix, middle, each behind its mark. A text that holds a mark stays plain, so that ``restored`` is exact.

Results by case: a null or empty text has no unit and is plain, with an empty output; very long texts are scanned in
slices and cut like others; repeated rows are cut alike, rows of equal doc_id at places by the same draws; a null
doc_id is drawn as if it were an empty string; an empty table gives no row; extra columns stay, and columns named
like a result column are replaced.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units between checkpoints, and bytes that are scanned at once.
EVERY = 512
SLICE = 1 << 20
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of a hundred texts those that are cut, and of a hundred of these the ones whose suffix goes first.
CUT, SUFFIX_FIRST = 90, 20
RESULT = ("n", "form", "prefix_chars", "middle_chars", "output")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_MORE = np.zeros(256, bool)  # bytes that go on with a code point
_MORE[0x80:0xC0] = True


def _begins(part: np.ndarray, letter_before: bool) -> np.ndarray:
    """Which bytes begin a unit."""
    letter = _LETTER[part]
    before = np.empty(len(part), bool)
    before[0] = letter_before
    before[1:] = letter[:-1]
    return ~(letter & before) & ~_MORE[part]


@dataclass
class Checkpoints:
    """Of every so many units the number, the byte and the code point where it begins; and the text's sums."""

    data: bytes
    units: list[int] = field(default_factory=list)
    at_byte: list[int] = field(default_factory=list)
    at_point: list[int] = field(default_factory=list)
    n_units: int = 0
    n_points: int = 0
    scanned: int = 0  #: bytes that ``place`` has looked at

    @classmethod
    def of(cls, data: bytes, every: int = EVERY) -> Checkpoints:
        out = cls(data)
        all_bytes, letter = np.frombuffer(data, np.uint8), False
        for lo in range(0, len(data), SLICE):
            part = all_bytes[lo : lo + SLICE]
            starts = np.flatnonzero(_begins(part, letter))
            due = starts[-out.n_units % every :: every]
            points = np.cumsum(~_MORE[part])
            out.units += range(out.n_units + -out.n_units % every, out.n_units + len(starts), every) if len(due) else ()
            out.at_byte += (due + lo).tolist()
            out.at_point += (points[due] - 1 + out.n_points).tolist()
            out.n_units += len(starts)
            out.n_points += int(points[-1])
            letter = bool(_LETTER[part[-1]])
        return out

    def place(self, unit: int) -> tuple[int, int]:
        """(byte, code point) where ``unit`` begins; for the number of units, where the text ends."""
        if not 0 <= unit <= self.n_units:
            raise ValueError(f"unit {unit} of {self.n_units}")
        if unit == self.n_units:
            return len(self.data), self.n_points
        k = bisect.bisect_right(self.units, unit) - 1
        need, at, point, letter = unit - self.units[k], self.at_byte[k], self.at_point[k], False
        size = 4 * EVERY
        while need >= 0:
            part = np.frombuffer(self.data, np.uint8, min(size, len(self.data) - at), at)
            self.scanned += len(part)
            starts = np.flatnonzero(_begins(part, letter))
            if need < len(starts):
                here = int(starts[need])
                return at + here, point + int(np.count_nonzero(~_MORE[part[:here]]))
            need -= len(starts)
            at, point, letter = at + len(part), point + int(np.count_nonzero(~_MORE[part])), bool(_LETTER[part[-1]])
        raise AssertionError


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits, the same for a doc_id and seed everywhere."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transformed(docs: DataFrame, *, seed: int = 1, cut: int = CUT, suffix_first: int = SUFFIX_FIRST, every: int = EVERY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Add the number of units, the form, the code points of prefix and middle (null for plain texts), and the text as it becomes."""
    names = [c for c in docs.columns if c not in RESULT]
    h = draws(F.col(f"`{doc_id}`"), seed)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = F.lit(False)
    for m in MARKS:
        marked |= F.contains(body, F.lit(m))
    form = F.when((body == "") | marked | (h[2] % 100 >= cut), "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    used = docs.select(*[F.col(f"`{c}`") for c in names], body.alias("__body"), form.alias("__form"), h[0].alias("__a"), h[1].alias("__b"))
    p, s, m = (x.encode() for x in MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rest, n_of, chars, outputs = len(names), [], [], []
            texts, forms, first, second = (b.column(rest + i) for i in range(4))
            for data, kind, x, y in zip(texts.cast(pa.binary()).to_pylist(), forms.to_pylist(), first.to_pylist(), second.to_pylist(), strict=True):
                index = Checkpoints.of(data, every)
                n_of.append(index.n_units)
                if kind == "plain":
                    chars.append((None, None))
                    outputs.append(data)
                    continue
                low, high = sorted((x % (index.n_units + 1), y % (index.n_units + 1)))
                (i, i_point), (j, j_point) = index.place(low), index.place(high)
                chars.append((i_point, j_point - i_point))
                prefix, middle, suffix = data[:i], data[i:j], data[j:]
                outputs.append(b"".join((p, prefix, s, suffix, m, middle) if kind == "psm" else (s, suffix, p, prefix, m, middle)))
            new = [pa.array(n_of, pa.int64()), forms, *(pa.array([c[k] for c in chars], pa.int64()) for k in range(2)), pa.array(outputs, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[:rest], *new], names=[*names, *RESULT])

    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in used.schema.fields[: len(names)]]
    return used.mapInArrow(run, ", ".join([*own, "n long", "form string", "prefix_chars long", "middle_chars long", "output string"]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from: each mark stands in it once, where it was put."""
    p, s, m = MARKS
    body = F.substring(output, 4, 2**31 - 1)
    upto, after = (lambda c, x: F.substring_index(c, x, 1)), (lambda c, x: F.substring_index(c, x, -1))
    middle = after(output, m)
    psm = F.concat(upto(body, s), middle, upto(after(output, s), m))
    spm = F.concat(upto(after(output, p), m), middle, upto(body, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
