"""Periodic runs of words by linear-time Lyndon arrays, and texts with the repeats collapsed.

A run is a maximal stretch of words with smallest period q.  Words become
ranks of an ordered alphabet (by sorting, a slice of texts at a time).  For an
order and its reverse, one pass from left to right finds each suffix's next
smaller one, which bounds the longest Lyndon word there: every run has such a
word as its root under one of the two.  How far two suffixes agree is kept with
each pair compared; inside a stretch that an earlier comparison has matched
already, the result is copied from the earlier place and only what lies beyond
is compared word by word.  No suffix arrays or trees, no hashes.

A run of at least LEAST words and TIMES periods repeats groups of four words
at a short distance for a long stretch.  Stretches that don't are left out
beforehand, by sorting: an exact test, whose bound ``candidates`` derives.  Arrow batches
carry whole texts; Spark deals the rows, and no rows meet.

Edge cases: a null or empty text has no words and no runs; a null doc_id takes
no periodic tail; repeated rows get equal results; long texts are taken whole;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm.common import shared_dir
from spotweave.llm.text import text_slices

#: Words that a run has at least, and periods.
LEAST, TIMES = 24, 3
#: Words of a group whose return marks a stretch that may hold a run.
GRAM = 4
#: Bytes of text handled at once.
SLICE = 1 << 20


def lyndon(t: list[int]) -> tuple[list[int], list[int], int]:
    """(next smaller suffix of each place, words that the two agree in, words compared).

    The end counts as smaller than any word; where no later suffix is smaller the first is ``len(t)``, the second 0.
    """
    n = len(t)
    following, agree = [n] * n, [0] * n
    before, agree_before = [-1] * n, [0] * n
    # The match that reaches farthest: words from `since` up to `reach` equal those `shift` places earlier.
    since, shift, reach, compared = 0, 0, 0, 0
    for i in range(1, n):
        j, known, sure = i - 1, 0, False
        while True:
            if not sure:
                if i < reach and j >= since:
                    was, at = j - shift, i - shift
                    if following[was] == at:
                        same = agree[was]
                    elif before[at] == was:
                        same = agree_before[at]
                    else:
                        same = known
                    if same < reach - i:
                        # A recorded agreement that ends inside the match is exact here too.
                        known = max(known, same)
                    else:
                        known = reach - i
                first = known
                while i + known < n and t[j + known] == t[i + known]:
                    known += 1
                compared += known - first + 1
                if i + known > reach:
                    since, shift, reach = i, i - j, i + known
            if i + known < n and t[j + known] < t[i + known]:
                before[i], agree_before[i] = j, known
                break
            following[j], agree[j] = i, known
            k = before[j]
            if k < 0:
                break
            below = agree_before[j]
            if below < known:
                before[i], agree_before[i] = k, below
                break
            # Where k and j agree farther than j and i do, k and i differ where j and i do.
            sure = below > known
            j = k
    return following, agree, compared


def runs(t: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with at least ``least`` words and ``times`` (2 or more) periods, in order."""
    found, ended = set(), set()
    for ranks in (t, [-x for x in t]):
        following, agree, _ = lyndon(ranks)
        for i, nxt in enumerate(following):
            period, right = nxt - i, agree[i]
            # The first root of a run starts within its first period, so that much agrees behind it.
            if right < (times - 2) * period or nxt == len(t):
                continue
            end = nxt + right
            if (period, end) in ended:  # another root of a run that was measured
                continue
            ended.add((period, end))
            start = i
            while start > 0 and t[start - 1] == t[start - 1 + period]:
                start -= 1
            if end - start >= max(least, times * period):
                found.add((start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def ranked(words: list[bytes]) -> np.ndarray:
    """The rank of each word among the distinct ones."""
    return pc.rank(pa.array(words, pa.binary()), tiebreaker="dense").to_numpy().astype(np.int64)


def _stretches(ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], ok.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def candidates(ranks: np.ndarray, first: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(row, from, to) of the stretches of words that hold all runs asked for, with a word on each side where there is one.

    ``first`` has the first word of each row and the total.  In a run of length l and period q, each group of GRAM words that
    starts after the first period was seen q places before: at least m = max(least, times * q) - q - GRAM + 1 of them in
    succession.  So stretches of returning groups shorter than the smallest such m hold no run, and in a stretch
    of m groups only returns within (m + GRAM - 1) / (times - 1) places count.
    """
    need = least - least // times - GRAM + 1
    counts = np.diff(first)
    if need < 1:
        return [(int(r), int(first[r]), int(first[r + 1])) for r in np.flatnonzero(counts)]
    if len(ranks) < GRAM:
        return []
    row = np.repeat(np.arange(len(counts)), counts)
    gram, base = ranks - 1, int(ranks.max())
    width = 1
    while width < GRAM:
        code = gram[: len(gram) - width] * base + gram[width:]
        if base > 50_000:  # the next product would not fit
            gram = np.unique(code, return_inverse=True)[1].reshape(-1).astype(np.int64)
            base = int(gram.max(initial=0)) + 1
        else:
            gram, base = code, base * base
        width *= 2
    whole = row[: len(gram)] == row[GRAM - 1 :]
    order = np.argsort(gram, kind="stable")
    again = (gram[order[1:]] == gram[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    back = np.zeros(len(gram), np.int64)
    back[order[1:][again]] = (order[1:] - order[:-1])[again]
    # Groups that begin in one row and end in the next don't count.
    ok = (back > 0) & whole
    for _ in range(4):
        a, b = _stretches(ok)
        length = np.repeat(b - a, b - a)
        place = np.flatnonzero(ok)
        fine = (length >= need) & (back[place] * (times - 1) <= length + GRAM - 1)
        if fine.all():
            break
        ok[place[~fine]] = False
    a, b = _stretches(ok)
    a, b = a[b - a >= need], b[b - a >= need]
    reach = (b - a + GRAM - 1) // (times - 1) + 1
    out: list[tuple[int, int, int]] = []
    for x, y, q in zip(a.tolist(), b.tolist(), reach.tolist(), strict=True):
        r = int(row[x])
        lo, hi = max(int(first[r]), x - q), min(int(first[r + 1]), y + GRAM)
        # A later, longer stretch can reach back over several earlier ones.
        while out and out[-1][0] == r and out[-1][2] >= lo:
            _, before, until = out.pop()
            lo, hi = min(lo, before), max(hi, until)
        out.append((r, lo, hi))
    return out


def runs_of(rows: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs of each row's words."""
    first = np.concatenate(([0], np.cumsum([len(w) for w in rows]))).astype(np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in rows]
    if not first[-1]:
        return out
    ranks = ranked([w for words in rows for w in words])
    for r, lo, hi in candidates(ranks, first, least, times):
        shift = lo - int(first[r])
        out[r] += [(start + shift, length, period) for start, length, period in runs(ranks[lo:hi].tolist(), least, times)]
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run holds after its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep)]


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods; of equals the first, then the one of the smallest period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _over_words(docs: DataFrame, make: Callable, schema: str, tail: Callable | None, least: int, times: int) -> DataFrame:
    shared_dir(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SLICE):
            ids = batch.column("doc_id").to_pylist()
            rows = [text.split() for text in batch.column("text").cast(pa.large_binary()).to_pylist()]
            if tail is not None:
                rows = [tail(i, words) for i, words in zip(ids, rows, strict=True)]
            yield make(ids, rows, runs_of(rows, least, times))

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, schema)


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, runs, text) for each row of ``docs``: its runs and its words, joined by single spaces, without the repeats."""

    def make(ids, rows, found):
        texts = [b" ".join(collapsed(w, f)).decode("utf-8", "replace") for w, f in zip(rows, found, strict=True)]
        shown = [[{"start": s, "length": n, "period": p} for s, n, p in f] for f in found]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(shown, kind), pa.array(texts, pa.string())], ["doc_id", "runs", "text"])

    return _over_words(docs, make, "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string", None, least, times)


def planted_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's words: of a tenth of the documents, by a checksum of doc_id, the rest after some word repeats with a period."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def run_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) for each row of ``docs``, with planted tails."""
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2

    def make(ids, rows, found):
        out = []
        for i, words, own in zip(ids, rows, found, strict=True):
            best = strongest(own)
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in own).encode()
            top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
            out.append((i, len(own), *top, hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, own))).hexdigest()))
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    schema = ", ".join(f"{c} {'string' if k == pa.string() else 'long'}" for c, k in zip(names, kinds, strict=True))
    return _over_words(docs, make, schema, planted_tail, LEAST, TIMES)
