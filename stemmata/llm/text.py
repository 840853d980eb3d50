"""Words, shingles and lines of UTF-8 texts, vectorised over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: The white space of all rules here: [\x20\x09-\x0D].
WHITE = b" \t\n\x0b\x0c\r"
#: Bytes of text that are hashed at once; longer texts go in slices cut at white space.
SLICE = 1 << 20

_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True
_draw = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _draw.integers(1, 2**64 - 1, 256, dtype=np.uint64)
for _c in range(ord("A"), ord("Z") + 1):
    _BYTE[_c] = _BYTE[_c + 32]
_BYTE[_IS_WHITE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = _draw.integers(1, 2**64 - 1, 64, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        with np.errstate(over="ignore"):
            _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, np.uint64))])
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _hash_slice(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one slice, A-Z as a-z."""
    word = ~_IS_WHITE[buf]
    if not word.any():
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    edge = np.empty(len(buf), bool)
    edge[0] = word[0]
    np.logical_and(word[1:], ~word[:-1], out=edge[1:])
    starts = np.flatnonzero(edge)
    spans = np.diff(np.append(starts, len(buf)))
    at = np.arange(starts[0], len(buf)) - np.repeat(starts, spans)
    terms = _BYTE[buf[starts[0] :]] * _powers_to(int(spans.max()) + 1)[at]
    return starts, mixed(np.add.reduceat(terms, starts - starts[0]))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of ``data``, in bounded memory."""
    buf, at, starts, hashes = np.frombuffer(data, np.uint8), 0, [], []
    while at < len(buf):
        end = min(at + SLICE, len(buf))
        while end < len(buf):  # a slice ends at white space
            gap = np.flatnonzero(_IS_WHITE[buf[end : end + SLICE]])
            end = end + (int(gap[0]) if len(gap) else SLICE)
            if len(gap):
                break
        end = min(end, len(buf))
        s, h = _hash_slice(buf[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of ``width`` words.

    With fewer words the whole sequence counts as one shingle; without words the set is empty.
    """
    out: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        for group in _grouped(texts):
            joined = b"\n".join(t or b"" for t in group)
            starts, words = word_hashes(joined)
            ends = np.cumsum([len(t or b"") + 1 for t in group])
            cuts = np.searchsorted(starts, ends)
            full = sum((words[i : len(words) - width + 1 + i] * _STEP[i] for i in range(1, width)), words[: len(words) - width + 1] * _STEP[0]) if len(words) >= width else np.empty(0, np.uint64)
            full = mixed(full)
            low = 0
            for high in cuts.tolist():
                n = high - low
                if n >= width:
                    s = np.sort(full[low : high - width + 1])
                    keep = np.empty(len(s), bool)
                    keep[0] = True
                    np.not_equal(s[1:], s[:-1], out=keep[1:])
                    out.append(s[keep])
                elif n:
                    out.append(mixed((words[low:high] * _STEP[32 : 32 + n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)))
                else:
                    out.append(np.empty(0, np.uint64))
                low = high
    return out


def _grouped(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or b"")
        if size >= SLICE:
            yield group
            group, size = [], 0
    if group:
        yield group


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line: white space stripped at both ends, A-Z lower-cased."""
    return [line.strip(WHITE).lower() for line in text.split(b"\n")]


def code_points_reach(key: bytes, least: int) -> bool:
    """Whether ``key`` has at least ``least`` code points."""
    n = len(key)
    return n >= least and (n >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
