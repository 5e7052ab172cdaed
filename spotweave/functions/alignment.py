"""Local alignment of short adapters in Arrow-batched UDFs.

With match 1, mismatch -1 and gaps of 10, a gapped alignment of L bases
scores at most L - 10.  Where that is below the threshold every passing
alignment is ungapped: a running maximum along diagonals, done for a whole
batch of reads in L vector steps.  Otherwise the affine recurrence is used.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

HIT = "score int, start int, end int"
#: Cells of a padded batch of reads, at most.
CELLS = 1_000_000
_CODE = np.full(256, 9, np.uint8)
for _i, _b in enumerate(b"ACGT"):
    _CODE[_b] = _i


def threshold(adapter: str, min_match: float) -> int:
    return int(round(min_match * len(adapter)))


def _padded(reads: list[bytes]) -> np.ndarray:
    out = np.full((len(reads), max(map(len, reads), default=0)), 8, np.uint8)
    for i, r in enumerate(reads):
        out[i, : len(r)] = _CODE[np.frombuffer(r, np.uint8)]
    return out


def _scores(reads: np.ndarray, base: int, match: int, mismatch: int, kind=np.int32) -> np.ndarray:
    """Per position; bases outside ACGT score 0, padding can't be reached."""
    s = np.where(reads == base, kind(match), kind(mismatch))
    s[(reads == 9) | (base == 9)] = 0
    s[reads == 8] = np.iinfo(kind).min // 2
    return s


def _tables(reads: np.ndarray, match: int, mismatch: int, longest: int) -> dict[int, np.ndarray]:
    """Scores of a batch for each base, in the smallest numbers that hold an adapter's."""
    kind = next(k for k in (np.int8, np.int16, np.int32) if longest * max(match, -mismatch) < np.iinfo(k).max // 2)
    return {base: _scores(reads, base, match, mismatch, kind) for base in (0, 1, 2, 3, 9)}


def ungapped(tables: dict[int, np.ndarray], adapter: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(best score, smallest last position reaching it) by the batch's scores for each base."""
    rows, n = tables[0].shape
    if not n:
        return np.zeros(rows, np.int32), np.full(rows, -1)
    kind = tables[0].dtype
    h, best = np.zeros((rows, n + 1), kind), np.zeros((rows, n), kind)
    for base in _CODE[np.frombuffer(adapter, np.uint8)]:
        # Column 0 stays 0; what is below 0 starts anew.
        h[:, 1:] = h[:, :-1] + tables[int(base)]
        np.maximum(best, h[:, 1:], out=best)
        np.maximum(h, 0, out=h)
    at = best.argmax(1)
    return best[np.arange(rows), at].astype(np.int32), at


def gapped(reads: np.ndarray, adapter: bytes, match: int, mismatch: int, opening: int, extend: int) -> tuple[np.ndarray, np.ndarray]:
    """The affine recurrence, for all reads of a batch at once; a gap of k costs opening + (k - 1) * extend."""
    rows, n = reads.shape
    a = _CODE[np.frombuffer(adapter, np.uint8)]
    low = -1_000_000
    h = np.zeros((len(a) + 1, rows), np.int32)
    e = np.full((len(a) + 1, rows), low, np.int32)
    best, at = np.zeros(rows, np.int32), np.full(rows, -1)
    table = [_scores(reads, b, match, mismatch) for b in a]
    for i in range(n):
        diagonal = h[0].copy()
        f = np.full(rows, low, np.int32)
        for j in range(1, len(a) + 1):
            e[j] = np.maximum(h[j] - opening, e[j] - extend)
            f = np.maximum(h[j - 1] - opening, f - extend)
            new = np.maximum(np.maximum(diagonal + table[j - 1][:, i], 0), np.maximum(e[j], f))
            diagonal = h[j].copy()
            h[j] = new
        top = np.where(reads[:, i] == 8, 0, h.max(0))
        better = top > best
        best[better], at[better] = top[better], i
    return best, at


def locate(reads: pd.Series, adapters: list[tuple[str, int]], match: int = 1, mismatch: int = -1, opening: int = 10, extend: int = 1) -> list[pd.DataFrame]:
    """For each (adapter, least): score, start, end of its best hit in each read, or nulls below ``least``; start is end - len(adapter).

    A batch of reads is coded once for all adapters.
    """
    n = len(reads)
    score, end = np.zeros((len(adapters), n), np.int64), np.full((len(adapters), n), -1, np.int64)
    data = [(r or "").encode() for r in reads]
    order = np.argsort([len(d) for d in data], kind="stable")
    longest = max((len(a) for a, _ in adapters), default=0)
    at = 0
    while at < n:
        stop = at + 1
        while stop < n and (stop - at + 1) * max(1, len(data[order[stop]])) <= CELLS:
            stop += 1
        own = order[at:stop]
        block = _padded([data[i] for i in own])
        tables = None
        for k, (adapter, least) in enumerate(adapters):
            if mismatch < 0 and match * len(adapter) - opening < least:
                tables = tables or _tables(block, match, mismatch, longest)
                score[k, own], end[k, own] = ungapped(tables, adapter.encode())
            else:
                score[k, own], end[k, own] = gapped(block, adapter.encode(), match, mismatch, opening, extend)
        at = stop
    out = []
    for k, (adapter, least) in enumerate(adapters):
        found = pd.DataFrame({"score": score[k], "start": end[k] - len(adapter) + 1, "end": end[k] + 1}).astype("Int32")
        found[(score[k] < least) | (end[k] < 0)] = pd.NA
        out.append(found)
    return out


def adapter_hit(read, adapter: str, min_match: float = 0.7) -> Column:
    """Best local hit of ``adapter`` as a struct (score, start, end); its fields are NULL without one.

    The start is assumed from the end, so it can be negative.
    """
    least = threshold(adapter, min_match)

    @F.pandas_udf(HIT)
    def hit(reads: pd.Series) -> pd.DataFrame:
        return locate(reads, [(adapter, least)])[0]

    return hit(F.col(read) if isinstance(read, str) else read)


def adapter_hits(read, adapters: list[str], min_match: float = 0.7) -> Column:
    """Best local hits of several adapters in one pass: a struct with score0, start0, end0, score1 and so on."""
    asked = [(a, threshold(a, min_match)) for a in adapters]

    @F.pandas_udf(", ".join(f"score{i} int, start{i} int, end{i} int" for i in range(len(asked))))
    def hits(reads: pd.Series) -> pd.DataFrame:
        return pd.concat([h.add_suffix(str(i)) for i, h in enumerate(locate(reads, asked))], axis=1)

    return hits(F.col(read) if isinstance(read, str) else read)


def internal_hit(read, adapters: list[str], least: int) -> Column:
    """Best hit over several internal adapters with match 4, mismatch 1 and gaps of 6; the first one wins a tie."""

    @F.pandas_udf(HIT)
    def hit(reads: pd.Series) -> pd.DataFrame:
        best = None
        for found in locate(reads, [(a, least) for a in dict.fromkeys(adapters)], 4, 1, 6, 6):
            if best is None:
                best = found
            else:
                better = (found["score"].fillna(-1) > best["score"].fillna(-1)).astype(bool)
                best[better] = found[better]
        return best

    return hit(F.col(read) if isinstance(read, str) else read)


def positional_hit(position: int) -> Column:
    """A hard-coded position as a hit; 420 marks it."""
    return F.struct(F.lit(420).alias("score"), F.lit(position).alias("start"), F.lit(position).alias("end"))
