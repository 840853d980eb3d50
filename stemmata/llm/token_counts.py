"""Token counts that follow edits.

A document's text is cut into leaves at places where a pre-token always begins: a single space between
two characters that are not white space. Leaves hold whole pre-tokens, so the number of tokens of a text
is the sum of its leaves'. A segment tree keeps the sums. An edit re-encodes the leaves that it touches,
and a neighbour only if the edit comes so near that the cut between them might no longer hold; the sums
above them are updated.

``counted`` makes trees for the edits of the same row. ``kept`` stores the leaves of all documents as a table, and
``edited`` takes that table with a table of later edits: only documents with edits are shuffled, their trees are
built from the stored numbers, and only the leaves that edits touch are encoded.

Results by case: a null text has no tokens and takes no edit; an empty text has none; edits must be sorted,
apart from each other and inside the text, else ValueError; repeated rows are counted each (trees of ``kept`` need
one row a doc_id, else ValueError); an empty table gives no row; extra columns stay, and columns named like a
result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import encoder

#: Characters of a leaf, about.
LEAF = 256
RESULT = ("n_tokens", "n_edits", "n_tokens_after", "n_encoded_again")
Edit = tuple[int, int, str]  #: from, to (not included), new text


def cuts(text: str, leaf: int = LEAF) -> list[int]:
    """Starts of the leaves."""
    out, at = [0], leaf
    while (at := text.find(" ", at)) > 0:
        if at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace():
            out.append(at)
            at += leaf
        else:
            at += 1
    return out


class TokenTree:
    """Leaves of a text with their numbers of tokens, and a heap of sums over them."""

    def __init__(self, text: str, count: Callable[[str], int], leaf: int = LEAF):
        starts = cuts(text, leaf)
        leaves = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]
        self._build(leaves, list(map(count, leaves)), count)

    @classmethod
    def of(cls, leaves: list[str], tokens: list[int], count: Callable[[str], int]) -> TokenTree:
        """The tree of stored leaves and their numbers of tokens: nothing is encoded."""
        tree = cls.__new__(cls)
        tree._build(leaves or [""], tokens or [0], count)
        return tree

    def _build(self, leaves: list[str], tokens: list[int], count: Callable[[str], int]) -> None:
        self.count, self.leaves = count, leaves
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.tokens = [0] * (2 * self.size)
        self.chars = [0] * (2 * self.size)
        for i, (x, n) in enumerate(zip(leaves, tokens, strict=True)):
            self.tokens[self.size + i], self.chars[self.size + i] = n, len(x)
        for i in range(self.size - 1, 0, -1):
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one for the end of the text), and where the leaf starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.size, start

    def _put(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        i = self.size + leaf
        self.tokens[i], self.chars[i] = tokens, len(text)
        while i := i // 2:
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]

    def edit(self, start: int, end: int, new: str) -> int:
        """Replace characters start .. end; returns the number of characters that were encoded again."""
        if not 0 <= start <= end <= self.chars[1]:
            raise ValueError(f"edit {start}..{end} of a text of {self.chars[1]}")
        # a cut holds if the characters before, at and after it stay
        first, at = self.find(max(start - 2, 0))
        last, _ = self.find(min(end + 1, max(self.chars[1] - 1, 0)))
        old = "".join(self.leaves[first : last + 1])
        text = old[: start - at] + new + old[end - at :]
        self._put(first, text, self.count(text))
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self._put(leaf, "", 0)
        return len(text)

    def apply(self, edits: list[Edit]) -> int:
        """Edits in terms of the text as it was, sorted and apart; returns the number of characters encoded again."""
        if any(a[1] > b[0] for a, b in zip(edits, edits[1:], strict=False)):
            raise ValueError("edits overlap or are not sorted")
        return sum(self.edit(a, b, new) for a, b, new in reversed(edits))


#: Edits of production: addresses and telephone numbers give way to marks, runs of blanks to one blank.
_EDITS = re.compile(r"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})|(?P<phone>\+\d{1,3} \(\d{3}\) \d{3}-\d{4})|(?P<blanks>  +)")
_MARKS = {"email": "<email>", "phone": "<phone>", "blanks": " "}


def redactions(text: str) -> list[Edit]:
    if "@" not in text and "+" not in text and "  " not in text:
        return []
    return [(m.start(), m.end(), _MARKS[m.lastgroup]) for m in _EDITS.finditer(text)]


def counted(docs: DataFrame, tokenizer: str, *, edits: Callable[[str], list[Edit]] = redactions, text: str = "text", leaf: int = LEAF) -> DataFrame:
    """Add the number of tokens before and after the edits of each text, of edits, and of characters encoded again."""
    names = [c for c in docs.columns if c not in RESULT]
    used = [*names, text] if text not in names else names
    at = used.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        count = lambda x: len(encode(x)) // 4 if x else 0
        for b in batches:
            rows = []
            for t in b.column(at).to_pylist():
                tree, changes = TokenTree(t or "", count, leaf), edits(t) if t else []
                before = tree.total
                again = tree.apply(changes)
                rows.append((before, len(changes), tree.total, again))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *(pa.array(c, pa.int64()) for c in cols)], names=[*names, *RESULT])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in names]).schema.fields]
    return docs.select(*[F.col(f"`{c}`") for c in used]).mapInArrow(run, ", ".join(fields + [f"{c} long" for c in RESULT]))


#: A row of the table of leaves: ``leaf`` orders a document's leaves.
LEAVES = "doc_id long, leaf int, text string, n_tokens long"


def kept(docs: DataFrame, tokenizer: str, *, text: str = "text", doc_id: str = "doc_id", leaf: int = LEAF) -> DataFrame:
    """The leaves of all documents with a doc_id, to be stored; a null or empty text is one empty leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for b in batches:
            rows = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tree = TokenTree(t or "", count, leaf)
                rows += [(d, i, x, tree.tokens[tree.size + i]) for i, x in enumerate(tree.leaves)]
            yield _leaves(rows)

    return docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")).where(F.col(f"`{doc_id}`").isNotNull()).mapInArrow(run, LEAVES)


def edited(leaves: DataFrame, edits: DataFrame, tokenizer: str) -> DataFrame:
    """The table of leaves after ``edits`` (doc_id, at, end, new), places in terms of the stored text.

    Documents without edits pass as they are. Edits of unknown documents change nothing.
    """
    touched = edits.select("doc_id").distinct()
    cut = "array<struct<at: long, end: long, new: string>>"
    changes = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.col("at").cast("long").alias("at"), F.col("end").cast("long").alias("end"), "new"))).cast(cut).alias("edits"))
    trees = leaves.join(touched, "doc_id", "left_semi").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("leaf", "text", "n_tokens"))).alias("leaves"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for b in batches:
            rows = []
            for d, own, changed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if len({x["leaf"] for x in own}) < len(own):
                    raise ValueError(f"document {d} has two trees")
                tree = TokenTree.of([x["text"] for x in own], [x["n_tokens"] for x in own], count)
                tree.apply([(x["at"], x["end"], x["new"]) for x in changed])
                rows += [(d, i, x, tree.tokens[tree.size + i]) for i, x in enumerate(tree.leaves)]
            yield _leaves(rows)

    return leaves.join(touched, "doc_id", "left_anti").select("doc_id", "leaf", "text", "n_tokens").unionAll(trees.join(changes, "doc_id").select("doc_id", "leaves", "edits").mapInArrow(run, LEAVES))


def totals(leaves: DataFrame) -> DataFrame:
    """(doc_id, n_tokens) of a table of leaves."""
    return leaves.groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"))


def _counter(tokenizer: str) -> Callable[[str], int]:
    encode = encoder(tokenizer)
    return lambda x: len(encode(x)) // 4 if x else 0


def _leaves(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["doc_id", "leaf", "text", "n_tokens"])
