"""Adapters cut from reads with errors and gaps, at either end, in several rounds.

Adapters are aligned to all reads of a group at once: a step goes to the next
base of every read and updates all places of the adapter.  A match is worth 1,
a wrong, missing or additional base -1; score, errors and the place where an
alignment begins are one number, so the larger number is the better alignment.
Groups hold reads of about one length, and reads never meet: there is no
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: One number: score above bit 32, errors below it (fewer are larger), then the place of the beginning (earlier is larger).
SCORE, ERRORS, PLACE = 32, 20, 0
NO_ERRORS, FIRST = 4095, 1 << 19
MATCH, ERROR = 1 << SCORE, -(1 << SCORE) - (1 << ERRORS)
#: Reads aligned together, and bases of a read at most.
GROUP, LONGEST = 512, FIRST - 1


@dataclass(frozen=True)
class Adapter:
    """``end`` is 3 (what follows goes too), 5 (what precedes goes too) or 0 (either, as the better alignment has it).

    At its open end an adapter may be cut off by the read's; ``inner`` False asks that a 3' one reaches the read's end, or a 5'
    one its beginning.  ``error`` is the part of its aligned bases that may be wrong, ``overlap`` how many have to
    be aligned.  N in an adapter matches any base, as N in a read does if ``wild``.
    """

    name: str
    seq: str
    end: int = 3
    error: float = 0.1
    overlap: int = 3
    inner: bool = True
    wild: bool = True


def _start(score: int, errors: int, place: np.ndarray | int):
    return (score << SCORE) + ((NO_ERRORS - errors) << ERRORS) + (FIRST - place)


def _parts(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, errors, place of the beginning)."""
    return v >> SCORE, NO_ERRORS - ((v >> ERRORS) & 0xFFF), FIRST - (v & 0xFFFFF)


def located(bases: np.ndarray, lengths: np.ndarray, adapter: Adapter, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, begin, stop) of the best alignment of a 3' or 5' adapter in each read of a padded matrix; the score is 0 where there is none.

    Of alignments with one score the one with fewer errors is taken, then the one that begins first, then the one that stops first.
    """
    n, width = bases.shape
    a = np.frombuffer(adapter.seq.upper().encode(), np.uint8)
    m = len(a)
    i = np.arange(m + 1)
    free = end == 5
    if free:
        # A 5' adapter may have lost its first bases at the read's beginning; the place is then before it.
        now = np.broadcast_to(_start(0, 0, -i), (n, m + 1)).copy()
    else:
        now = np.broadcast_to(_start(0, 0, 0) + i * ERROR, (n, m + 1)).copy()
    any_a = a == ord("N")
    best = np.zeros(n, np.int64)
    begin, stop = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def offer(rows: np.ndarray, v: np.ndarray, aligned: np.ndarray, at: int) -> None:
        score, errors, place = _parts(v)
        aligned = aligned + np.minimum(place, 0)  # without the bases lost before the read
        fine = (score > 0) & (errors <= np.floor(adapter.error * aligned + 1e-9)) & (aligned >= min(adapter.overlap, m))
        if free and not adapter.inner:
            fine &= place <= 0
        # What counts is the number as a whole; an earlier stop stays where all is equal.
        better = fine & (v > best[rows])
        w = rows[better]
        best[w], begin[w], stop[w] = v[better], np.maximum(place[better], 0), at

    for j in range(width + 1):
        if j:
            base = bases[:, j - 1, None]
            same = (base == a) | any_a
            if adapter.wild:
                same = same | (base == ord("N"))
            step = now[:, :-1] + np.where(same, MATCH, ERROR)
            now[:, 1:] = np.maximum(step, now[:, 1:] + ERROR)
            # A 3' adapter, and a 5' one as well, may begin behind any base.
            now[:, 0] = _start(0, 0, j)
            now = np.maximum.accumulate(now - i * ERROR, axis=1) + i * ERROR
        if free or adapter.inner:
            live = np.flatnonzero(lengths >= j)
            offer(live, now[live, m], np.full(len(live), m), j)
        ending = np.flatnonzero(lengths == j)
        if len(ending) and not free:
            for k in range(1, m + 1):
                offer(ending, now[ending, k], np.full(len(ending), k), j)
    score = np.where(best > 0, best >> SCORE, 0)
    return score, begin, stop


def quality_kept(quality: np.ndarray, lengths: np.ndarray, cutoff: int) -> np.ndarray:
    """Bases to keep of each read of a padded matrix: from the 3' end the running sum of cutoff - q is greatest at the cut, and it ends where it falls below 0."""
    n, width = quality.shape
    place = lengths[:, None] - 1 - np.arange(width)
    lost = np.where(place >= 0, cutoff - np.take_along_axis(quality, np.maximum(place, 0), 1), -(1 << 30))
    total = np.cumsum(lost, 1)
    over = np.logical_or.accumulate(total < 0, axis=1)
    total[over] = 0
    most = total.max(1, initial=0)
    return np.where(most > 0, lengths - 1 - (total.argmax(1) if width else 0), lengths)


def _matrix(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], np.int64)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(texts), width), np.uint8)
    inside = np.arange(width) < lengths[:, None]
    out[inside] = np.frombuffer(b"".join(texts), np.uint8)
    return out, lengths


def trimmed_group(seqs: list[bytes], quals: list[bytes], adapters: list[Adapter], quality: int | None, nextseq: int | None, rounds: int, trim_n: bool) -> list[tuple[int, int, list[str]]]:
    """(first base kept, base after the last, names of the adapters cut) of each read."""
    bases, lengths = _matrix([s.upper() for s in seqs])
    if len(lengths) and lengths.max() > LONGEST:
        raise ValueError(f"a read has more than {LONGEST} bases")
    lo, hi = np.zeros(len(seqs), np.int64), lengths.copy()
    for cutoff, dark in ((nextseq, True), (quality, False)):
        if cutoff is not None:
            q = _matrix([x[:h] for x, h in zip(quals, hi, strict=True)])[0].astype(np.int64) - 33
            if dark:  # a G may be no signal at all
                q[bases[:, : q.shape[1]] == ord("G")] = cutoff - 1
            hi = quality_kept(q, hi, cutoff)
    cut: list[list[str]] = [[] for _ in seqs]
    open_ = np.arange(len(seqs))
    for _ in range(rounds):
        if not len(open_) or not adapters:
            break
        part, own = _matrix([seqs[r].upper()[lo[r] : hi[r]] for r in open_])
        top = np.zeros(len(open_), np.int64)
        chosen, left, right = np.full(len(open_), -1), np.zeros(len(open_), np.int64), own.copy()
        for k, adapter in enumerate(adapters):
            for end in (3, 5) if adapter.end == 0 else (adapter.end,):
                score, begin, stop = located(part, own, adapter, end)
                won = score > top
                top[won], chosen[won] = score[won], k
                left[won], right[won] = (0, begin[won]) if end == 3 else (stop[won], own[won])
        hit = chosen >= 0
        for r, k in zip(open_[hit], chosen[hit], strict=True):
            cut[r].append(adapters[k].name)
        hi[open_[hit]] = lo[open_[hit]] + right[hit]
        lo[open_[hit]] += left[hit]
        open_ = open_[hit]
    out = []
    for r, s in enumerate(seqs):
        a, b = int(lo[r]), int(hi[r])
        if trim_n:
            own = s[a:b]
            a, b = a + len(own) - len(own.lstrip(b"Nn")), a + len(own.rstrip(b"Nn"))
        out.append((a, max(a, b), cut[r]))
    return out


def trim(
    reads: DataFrame, adapters: list[Adapter], quality: int | None = None, nextseq: int | None = None, rounds: int = 1, trim_n: bool = False
) -> DataFrame:
    """``reads`` (with seq and qual) trimmed, and ``cut``, the names of the adapters found, in order.

    First low qualities go from the 3' end, by ``nextseq`` (with G of no quality) and by ``quality``; then, ``rounds`` times, the adapter with the best score of all is
    cut (of equals the first named); then N at both ends.  A read without a sequence is empty; a quality that is
    missing or of another length than its sequence is an error.
    """
    names = reads.columns
    schema = StructType([*reads.schema.fields, StructField("cut", ArrayType(StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, quals = ([(x or "").encode() for x in batch.column(c).to_pylist()] for c in ("seq", "qual"))
            if any(len(s) != len(q) for s, q in zip(seqs, quals, strict=True)):
                raise ValueError("sequence and quality differ in length")
            kept: list = [None] * len(seqs)
            order = sorted(range(len(seqs)), key=lambda r: len(seqs[r]))
            for at in range(0, len(order), GROUP):
                group = order[at : at + GROUP]
                found = trimmed_group([seqs[r] for r in group], [quals[r] for r in group], adapters, quality, nextseq, rounds, trim_n)
                for r, x in zip(group, found, strict=True):
                    kept[r] = x
            new = {
                "seq": pa.array([s[a:b].decode() for s, (a, b, _) in zip(seqs, kept, strict=True)], pa.string()),
                "qual": pa.array([q[a:b].decode() for q, (a, b, _) in zip(quals, kept, strict=True)], pa.string()),
            }
            columns = [new.get(c, batch.column(c)) for c in names] + [pa.array([c for *_, c in kept], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "cut"])

    return reads.mapInArrow(run, schema)


def pair_filter(pairs: DataFrame, least1: int = 0, least2: int = 0, rule: str = "any", seq1: str = "seq1", seq2: str = "seq2") -> DataFrame:
    """Pairs that stay: one goes if any of its reads is too short (``rule`` any), or only if both are."""
    from pyspark.sql import functions as F

    short = [F.coalesce(F.length(c), F.lit(0)) < n for c, n in ((seq1, least1), (seq2, least2))]
    if rule not in ("any", "both"):
        raise ValueError("rule is any or both")
    return pairs.where(~(short[0] | short[1]) if rule == "any" else ~(short[0] & short[1]))
