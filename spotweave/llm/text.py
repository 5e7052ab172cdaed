"""Vectorised words and shingles over Arrow text columns.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, with A-Z
lowered.  A word's 64-bit hash is a polynomial over random byte codes,
computed for all words of a slice at once from one running sum.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; longer texts are taken in pieces cut at white space.
PIECE = 1 << 18
SLICE = 1 << 18

_rng = np.random.default_rng(20240607)
CODES = _rng.integers(0, 2**64, 256, dtype=np.uint64)
CODES[65:91] = CODES[97:123]
GAP = np.zeros(256, bool)
GAP[[0x20, 9, 10, 11, 12, 13]] = True
_P = int(_rng.integers(0, 2**63)) * 2 + 1
_STEPS = (_rng.integers(0, 2**63, 8, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, PIECE + (PIECE >> 3))
        for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[name] = np.cumprod(out)
    return _powers["up"], _powers["down"]


def keep_freed() -> None:
    """Have the allocator keep freed arrays for the next ones: returned to the system, each would be mapped and cleared anew.  Up to :func:`give_back`."""
    try:
        libc = ctypes.CDLL(None)
        # Fixed numbers of the two thresholds: above which memory is mapped, and returned.
        libc.mallopt(-3, 1 << 30)
        libc.mallopt(-1, 1 << 30)
    except (OSError, AttributeError):  # not glibc
        pass


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with about ``max_bytes`` of text; nulls in ``column`` become ''."""
    for batch in batches:
        k = batch.schema.get_field_index(column)
        col = pc.fill_null(batch.column(k).cast(pa.large_string()), "")
        batch = batch.set_column(k, column, col)
        size = np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, base + max_bytes, "right")))
            yield batch.slice(at, end - at)
            at = end
    give_back()


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a large_string column without nulls."""
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    if not col.buffers()[2] or off[0] == off[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of each word, the byte after its last)."""
    gap = GAP[data]
    first = np.empty(len(data), bool)
    first[0] = True
    first[1:] = gap[:-1]
    inner = off[:-1][(off[:-1] < len(data)) & (off[1:] > off[:-1])]
    first[inner] = True
    last = np.empty(len(data), bool)
    last[-1] = True
    last[:-1] = gap[1:]
    last[inner[inner > 0] - 1] = True
    return np.flatnonzero(first & ~gap), np.flatnonzero(last & ~gap) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
    """The hash of each run of bytes, of runs in order that don't overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        lo, hi = starts[at], ends[end - 1]
        up, down = _power(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(codes[data[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = starts[at:end] - lo, ends[at:end] - lo
        out[at:end] = (total[e] - total[s]) * down[s]
        at = end
    return mix(out)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and the total)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    starts, ends = word_bounds(data, off)
    return hashes(data, starts, ends), np.searchsorted(starts, off)


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all n-word shingles in order, first shingle of each row and the total).

    A row with 1 to n-1 words has one shingle, the whole sequence; one without words has none.
    """
    counts = np.diff(first)
    have = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(have)))
    out = np.empty(begin[-1], np.uint64)
    if len(words) >= n:
        every = words[: len(words) - n + 1] * _STEPS[0]
        for k in range(1, n):
            every = every + words[k : len(words) - n + 1 + k] * _STEPS[k]
    row = np.repeat(np.arange(len(counts)), have)
    place = np.arange(begin[-1]) - begin[row] + first[row]
    long = counts[row] >= n
    if long.any():
        out[long] = every[place[long]]
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        w = words[first[i] : first[i + 1]]
        out[begin[i]] = (w * _STEPS[: len(w)]).sum(dtype=np.uint64) + np.uint64(len(w))
    return mix(out), begin
