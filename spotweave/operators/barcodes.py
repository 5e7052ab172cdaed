"""Whitelists and barcode correction: candidates that share a k-mer, edit distance, and the two least per barcode."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.functions import sequences as sq
from spotweave.sources.scratch import written

#: Entries of a whitelist that may be sent to every executor; a larger one is joined by k-mers instead.
SENT_ENTRIES = 1_000_000
#: Barcodes that are gathered before their distances are computed.
AT_ONCE = 16384
#: Pairs of a barcode and an entry whose distances are computed at once.
PAIRS = 1 << 17
#: Edits within which entries are found without k-mers (3 at most, see KmerIndex.few), and buckets of each of the tables for them, as a power of 2 (of a prime less 1).
NEAR, BUCKET_BITS = 3, 19
NONE = np.iinfo(np.int64).max


def clean_whitelist(raw: DataFrame, column: str = "value") -> DataFrame:
    """(barcode, line): trimmed, cut at the first '-', blanks dropped; an empty whitelist is an error when it is used."""
    b = F.substring_index(F.trim(F.col(column)), "-", 1)
    return raw.select(b.alias("barcode"), *[c for c in raw.columns if c != column]).where("barcode <> ''")


def split_whitelist(whitelist: DataFrame, at: int) -> DataFrame:
    return whitelist.select("*", sq.split_barcode("barcode", at).alias("p")).select("barcode", "p.part1", "p.part2", "p.joined")


def unique_parts(parts: DataFrame, column: str) -> DataFrame:
    return parts.select(column).distinct()


def uniqueness(parts: DataFrame, columns: list[str]) -> DataFrame:
    """For each column: entries, distinct entries, per cent distinct to 2 places."""
    one = None
    for c in columns:
        n, d = F.count(c), F.count_distinct(c)
        row = parts.agg(F.lit(c).alias("part"), n.alias("n"), d.alias("n_unique"), F.bround(100.0 * d / n, 2).alias("pct_unique"))
        one = row if one is None else one.unionByName(row)
    return one


def zip_whitelists(first: DataFrame, second: DataFrame, compat: bool = False) -> DataFrame:
    """Parts joined by line number; ``compat`` pairs them by rank after each is sorted."""
    if compat:
        rank = Window.orderBy("barcode")
        first, second = (w.select("barcode", F.row_number().over(rank).alias("line")) for w in (first, second))
    a, b = first.select("line", F.col("barcode").alias("a")), second.select("line", F.col("barcode").alias("b"))
    return a.join(b, "line").select(F.concat("a", "b").alias("barcode"), "line")


def in_whitelist(calls: DataFrame, whitelist: DataFrame, column: str = "bc") -> DataFrame:
    """Exact matches only."""
    return calls.join(whitelist.select(F.col("barcode").alias(column)).distinct(), column, "left_semi")


def gram_codes(words: np.ndarray, k: int, base: int = 256) -> np.ndarray:
    """k-mers of equally long words (a matrix of digits below ``base``) as numbers, k being 8 at most."""
    out = np.zeros((len(words), words.shape[1] - k + 1), np.uint64)
    for i in range(k):
        out = out * np.uint64(base) + words[:, i : words.shape[1] - k + 1 + i]
    return out


def near_seeds(length: int, near: int = NEAR) -> list[tuple[list[int], list[list[int]]]]:
    """For each choice of half the pieces of a word: their places in an entry, and the places where a barcode at most ``near`` edits away may show the same bases.

    A word is cut into 2 * near pieces.  An edit breaks one piece at most (an insertion between two pieces counts for either), so as many pieces as
    ``near`` stay whole.  Of equally long words 3 edits hold at most one insertion with its deletion: whole pieces that lie between these two are moved by
    one place, one way or the other, all others aren't.
    """
    ends = np.linspace(0, length, 2 * near + 1).astype(int).tolist()
    pieces = list(zip(ends, ends[1:], strict=False))
    out = []
    for whole in combinations(range(2 * near), near):
        broken = [i for i in range(2 * near) if i not in whole]
        moved = {frozenset(i for i in whole if a < i < b) for a, b in combinations(broken, 2)} | {frozenset()}
        shown = {tuple(c + (by if i in m else 0) for i in whole for c in range(*pieces[i])) for m in moved for by in (-1, 1)}
        out.append(([c for i in whole for c in range(*pieces[i])], [list(x) for x in sorted(shown)]))
    return out


class KmerIndex:
    """A whitelist of equally long words by what they show at chosen places and by k-mers, and bit-parallel edit distances of many barcodes to many entries.

    Only words and times are sent; the tables are made where they are used, once a process.
    """

    def __init__(self, words: list[str] | np.ndarray, times: list[int] | np.ndarray, k: int):
        data = words if isinstance(words, np.ndarray) else np.frombuffer("".join(words).encode(), np.uint8).reshape(len(words), -1)
        self.alphabet = np.flatnonzero(sum(np.bincount(c, minlength=256) for c in data.T)).astype(np.uint8)
        order = np.argsort(self.ordered(self.digits(data)), kind="stable")
        self.k, self.bytes, self.times = k, data[order], np.asarray(times)[order]
        self.times = self.times.astype(np.min_scalar_type(self.times.max()))

    def digits(self, q: np.ndarray) -> np.ndarray:
        """Bytes as digits; those in no entry share the one after the last."""
        code = np.full(256, len(self.alphabet), np.uint8)
        code[self.alphabet] = np.arange(len(self.alphabet))
        return code[q]

    def ordered(self, words: np.ndarray) -> np.ndarray:
        """Words (digits) as values with the words' order: numbers where 64 bits hold them, else bytes."""
        base, m = len(self.alphabet) + 1, words.shape[1]
        return gram_codes(words, m, base).ravel() if base**m < 1 << 64 else np.ascontiguousarray(words + np.uint8(1)).view(f"S{m}").ravel()

    @cached_property
    def entries(self) -> np.ndarray:
        return self.digits(self.bytes)

    @cached_property
    def in_order(self) -> np.ndarray:
        return self.ordered(self.entries)

    def find(self, q: np.ndarray) -> np.ndarray:
        """The entry that each row of ``q`` (digits) is, or -1."""
        own = self.ordered(q)
        at = np.minimum(np.searchsorted(self.in_order, own), len(self.in_order) - 1)
        return np.where(self.in_order[at] == own, at, -1)

    @cached_property
    def text(self) -> pa.Array:
        n, m = self.bytes.shape
        return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(np.arange(0, n * m + 1, m, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(self.bytes))])

    # Entries a few edits away

    def bucket(self, words: np.ndarray, packed: tuple[np.ndarray, np.ndarray] | None, places: list[int], shown: list[int]) -> np.ndarray:
        """Numbers of BUCKET_BITS bits for what words show at ``shown``, as entries do at ``places``, one place apart at most: equal bases have equal ones, and some others, which distances tell apart."""
        if packed is None:
            out = np.zeros(len(words), np.uint64)
            for c in shown:
                out = out * np.uint64(max(2, len(self.alphabet))) + words[:, c]
            return (out % np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)
        code, m = packed[0], words.shape[1]
        kind, bits = code.dtype.type, np.iinfo(code.dtype).bits
        out = np.zeros_like(code)
        for by in sorted({to - c for to, c in zip(places, shown, strict=True)}):
            mask = kind(sum(1 << p * m + c for p in range(self.planes) for to, c in zip(places, shown, strict=True) if to - c == by))
            out |= (code & mask) << kind(by) if by > 0 else (code & mask) >> kind(-by)
        out ^= out >> kind(bits // 2)
        out *= kind(0x9E3779B1 if bits == 32 else 0x9E3779B97F4A7C15)
        return (out >> kind(bits - BUCKET_BITS)).astype(np.int64)

    @property
    def planes(self) -> int:
        """Bits of a digit."""
        return max(1, (len(self.alphabet) - 1).bit_length())

    @cached_property
    def tables(self) -> dict[int, list[tuple]]:
        return {}

    def near_tables(self, near: int) -> list[tuple]:
        """(ids by bucket, where each bucket begins, places of an entry, places to look at in a barcode: those in place, those that are moved) of each seed."""
        if near not in self.tables:
            out, own = [], np.arange(len(self.entries), dtype=np.int64)
            bits = len(own).bit_length()
            for places, shown in near_seeds(self.bytes.shape[1], near):
                at = self.bucket(self.entries, self.packed, places, places)
                starts = np.zeros((1 << BUCKET_BITS) + 1, np.int32)
                np.cumsum(np.bincount(at, minlength=1 << BUCKET_BITS), out=starts[1:])
                at <<= bits
                at |= own
                at.sort()
                at &= (1 << bits) - 1
                out.append((at.astype(np.int32), starts, places, ([places], [x for x in shown if x != places])))
            self.tables[near] = out
        return self.tables[near]

    def met(self, q: np.ndarray, packed: tuple[np.ndarray, np.ndarray] | None, near: int, seed: int, moved: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row of ``q``, entry, distance) of those at most ``near`` edits apart that a seed brings together by bases in place, or ``moved``; some of them twice."""
        ids, starts, places, shown = self.near_tables(min(near, NEAR))[seed]
        if not shown[moved]:
            return
        at = np.concatenate([self.bucket(q, packed, places, x) for x in shown[moved]])
        lo, size = starts[at].astype(np.int64), (starts[at + 1] - starts[at]).astype(np.int64)
        rows = np.tile(np.arange(len(q)), len(shown[moved]))
        for a, b in runs(size, PAIRS):
            row, entry = np.repeat(rows[a:b], size[a:b]), ids[spread(lo[a:b], size[a:b])]
            d = self.distances(q, row, entry) if packed is None else self.few(packed, row, entry)
            (close,) = np.nonzero(d <= near)
            yield row[close], entry[close], d[close].astype(np.int64)

    def pack(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Digits as numbers, the lowest bits of all first, then the next ones, and bits for those in no entry; None where they are too many."""
        m, planes = words.shape[1], self.planes
        if m * planes > 64:
            return None
        kind = np.uint32 if m * planes <= 32 else np.uint64
        code, lost = np.zeros(len(words), kind), np.zeros(len(words), next(t for t in (np.uint16, np.uint32, np.uint64) if np.iinfo(t).bits >= m))
        for c, digits in enumerate(np.ascontiguousarray(words.T)):
            for p in range(planes):
                code |= (digits >> p & 1).astype(kind) << kind(p * m + c)
            lost |= (digits == len(self.alphabet)).astype(lost.dtype) << lost.dtype.type(c)
        return code, lost

    @cached_property
    def packed(self) -> tuple[np.ndarray, np.ndarray] | None:
        return self.pack(self.entries)

    def few(self, packed: tuple[np.ndarray, np.ndarray], row: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Levenshtein distances of packed barcodes and entries where they are 3 at most, elsewhere the number of bases that differ, from 4 on.

        Equally long words at most 3 edits apart differ in as many bases, or hold one insertion, its deletion and one other base at most.  What lies
        between these two is moved by one place, one way or the other, and what lies before and behind isn't: they lie best at the first and the last base
        that differ, or at the second or last but one where the other base is the first or the last.
        """
        m, (code, lost) = self.bytes.shape[1], packed
        kind, some = lost.dtype.type, bool(lost.any())
        full = code.dtype.type((1 << m) - 1)

        def differing(x: np.ndarray, row: np.ndarray) -> np.ndarray:
            out = x.copy()
            for at in range(m, self.planes * m, m):
                out |= x >> code.dtype.type(at)
            out &= full
            out = out.astype(kind)
            return out | lost[row] if some else out

        def down(x: np.ndarray) -> np.ndarray:
            for by in (1, 2, 4, 8, 16, 32):
                if by < m:
                    x = x | x >> kind(by)
            return x

        x, e = code[row], np.take(self.packed[0], ids)
        apart = differing(x ^ e, row)
        d = np.bitwise_count(apart)
        (at,) = np.nonzero(d > 2)
        x, e, row, apart = x[at], e[at], row[at], apart[at]
        upto = down(apart)
        rest, less = apart & (apart - kind(1)), down(apart & upto >> kind(1))
        since, later = apart | (~apart + kind(1)), rest | (~rest + kind(1))
        near = d[at]
        for by, a, a2, b, b2 in (
            (e >> code.dtype.type(1), since, later, upto >> kind(1), less >> kind(1)),
            (e << code.dtype.type(1), since << kind(1), later << kind(1), upto, less),
        ):
            other = differing(x ^ by, row)
            within = other & a & b
            near[(np.bitwise_count(within) <= 1) | (other & a2 & b == 0) | (within & b2 == 0)] = 3
            near[within == 0] = 2
            d[at] = np.minimum(d[at], near)
        return d

    def share_kmer(self, q: np.ndarray, row: np.ndarray, ids: np.ndarray) -> np.ndarray:
        base = len(self.alphabet) + 1
        a, b = gram_codes(q, self.k, base), gram_codes(np.take(self.entries, ids, axis=0), self.k, base)
        out = np.zeros(len(ids), bool)
        for i in range(a.shape[1]):
            out |= (a[row, i][:, None] == b).any(axis=1)
        return out

    def sharing(self, q: np.ndarray, row: np.ndarray, ids: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Which pairs, d edits apart, share a k-mer."""
        # d edits leave d + 1 whole stretches, one of them as long as their mean at least.
        unsure = np.ceil((q.shape[1] - d) / (d + 1)) < self.k
        ok = ~unsure
        ok[unsure] = self.share_kmer(q, row[unsure], ids[unsure])
        return ok

    def near(self, q: np.ndarray, near: int = NEAR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``q``, entry, distance) of all that share a k-mer and are at most ``near`` edits apart, each once, by row."""
        packed = self.pack(q)
        kept = [x for seed in range(len(self.near_tables(near))) for moved in (False, True) for x in self.met(q, packed, near, seed, moved)]
        none = (np.zeros(0, np.int64),) * 3
        row, ids, d = (np.concatenate(x) for x in zip(none, *kept, strict=True))
        pair, first = np.unique(row * len(self.bytes) + ids, return_index=True)
        row, ids, d = pair // len(self.bytes), pair % len(self.bytes), d[first]
        ok = self.sharing(q, row, ids, d)
        return row[ok], ids[ok], d[ok]

    def any_at(self, q: np.ndarray, near: int) -> np.ndarray:
        """Which rows have an entry that shares a k-mer and is exactly ``near`` edits away; a row that has one leaves, most with the first seeds and bases in place.

        More than NEAR edits away not all such entries are found: those that seeds for NEAR bring together by bases in place, and that differ in ``near`` bases.
        """
        out, packed = np.zeros(len(q), bool), self.pack(q)
        for moved in (False, True)[: 2 if near <= NEAR else 1]:
            for seed in range(len(self.near_tables(min(near, NEAR)))):
                (left,) = np.nonzero(~out)
                own = packed and tuple(x[left] for x in packed)
                for row, ids, d in self.met(q[left], own, near, seed, moved) if len(left) else ():
                    row, ids = row[d == near], ids[d == near]
                    out[left[row[self.sharing(q[left], row, ids, np.full(len(row), near))]]] = True
        return out

    # Entries that share a k-mer

    @cached_property
    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(k-mers, keys, where each begins, owners): entries by place and number of their k-mer."""
        codes = gram_codes(self.entries, self.k, len(self.alphabet) + 1)
        known = np.unique(np.concatenate([np.unique(c) for c in codes.T]))
        keys, starts, owner = [], [], np.empty(codes.size, np.int32)
        own, bits = np.arange(len(codes)), len(codes).bit_length()
        for j, column in enumerate(codes.T):
            ordered = np.sort(np.searchsorted(known, column) << bits | own)
            owner[j * len(own) : (j + 1) * len(own)] = ordered & ((1 << bits) - 1)
            rank = ordered >> bits
            start = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
            keys.append(j * len(known) + rank[start])
            starts.append(j * len(own) + start)
        return known, np.concatenate(keys), np.append(np.concatenate(starts), codes.size), owner

    def listed(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where they begin, how many) among owners, of the entries with each k-mer of each row at each place."""
        known, keys, starts, _ = self.grams
        grams = gram_codes(q, self.k, len(self.alphabet) + 1)
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        key = (at[:, :, None] + len(known) * np.arange(grams.shape[1])).reshape(len(q), -1)
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        found = (keys[place] == key) & np.repeat(known[at] == grams, grams.shape[1], axis=1)
        return starts[place], np.where(found, starts[place + 1] - starts[place], 0)

    def distances(self, q: np.ndarray, row: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Levenshtein distances of q[row] and entries ids by Myers' recurrence, a column of all pairs a step, in words just wide enough."""
        m, base = q.shape[1], len(self.alphabet) + 1
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(t).bits >= m)
        one, top = kind(1), kind(1 << (m - 1))
        masks = np.zeros((base, len(q)), kind)
        for i in range(m):
            masks[q[:, i], np.arange(len(q))] |= kind(1 << i)
        masks, at = masks.ravel(), row.astype(np.int32)
        places = np.multiply(np.take(self.entries, ids, axis=0).T, np.int32(len(q)), dtype=np.int32, order="C")
        up, down = np.full(len(ids), ~kind(0)), np.zeros(len(ids), kind)
        score = np.full(len(ids), m, np.int8)
        eq, v, h, at_c = np.empty_like(up), np.empty_like(up), np.empty_like(up), np.empty_like(at)
        for c in range(m):
            np.take(masks, np.add(at, places[c], out=at_c), out=eq, mode="clip")
            np.bitwise_or(eq, down, out=v)
            np.bitwise_and(eq, up, out=h)
            h += up
            h ^= up
            h |= eq
            np.bitwise_and(up, h, out=eq)  # what falls
            h |= up
            np.invert(h, out=h)
            h |= down  # what rises
            score += (h & top).astype(bool).view(np.int8)
            score -= (eq & top).astype(bool).view(np.int8)
            h += h
            h |= one
            eq += eq
            np.bitwise_and(h, v, out=down)
            h |= v
            np.invert(h, out=h)
            np.bitwise_or(eq, h, out=up)
        return score

    def least(self, n: int, row: np.ndarray, ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
        """(d, least entry at d, entries at d, next distance) of n rows from pairs by row; NONE where there is none."""
        first, second, entry, times = np.full(n, NONE), np.full(n, NONE), np.full(n, NONE), np.zeros(n, np.int64)
        if len(row):
            opens = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            first[row[opens]] = np.minimum.reduceat(d, opens)
            second[row[opens]] = np.minimum.reduceat(np.where(d > first[row], d, NONE), opens)
            tied = np.unique(row[d == first[row]] * len(self.bytes) + ids[d == first[row]])
            who, own = tied // len(self.bytes), tied % len(self.bytes)
            entry[who[::-1]] = own[::-1]
            times = np.bincount(who, self.times[own], n).astype(np.int64)
        return first, entry, times, second

    def by_kmers(self, q: np.ndarray) -> tuple[np.ndarray, ...]:
        """What :meth:`least` tells of each row of ``q`` (digits), over all entries that share a k-mer and are less than its length apart."""
        lo, size = self.listed(q)
        owner, parts = self.grams[3], []
        for a, b in runs(size.sum(axis=1), PAIRS):
            row = np.repeat(np.arange(b - a), size[a:b].sum(axis=1))
            ids = owner[spread(lo[a:b].ravel(), size[a:b].ravel())]
            d = self.distances(q[a:b], row, ids).astype(np.int64)
            under = d < q.shape[1]
            parts.append(self.least(b - a, row[under], ids[under], d[under]))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def best(self, q: np.ndarray) -> list[tuple]:
        """(d, least entry at d, entries at d, next distance or None) of each row of ``q``, None where no distance is below the length."""
        found = zip(*self.by_kmers(self.digits(q)), strict=True)
        return [(int(d), self.text[int(e)].as_py(), int(t), int(n) if n < NONE else None) if d < NONE else None for d, e, t, n in found]

    def search(self, q: np.ndarray) -> tuple[np.ndarray, ...]:
        """As ``best``, in columns; a row with several entries at its least distance may lack others and the next distance, which don't count then.

        Entries nearer than NEAR edits come first.  A row with one nearest of them and no next need only know whether any is NEAR edits away; one without
        meets all that are.  A row with one of all these and no next leaves if an entry found one edit farther tells the next.  Only rows that these leave
        open meet all entries that share a k-mer.
        """
        q = self.digits(q)
        if q.shape[1] < 2 * NEAR:
            return self.by_kmers(q)
        out = first, _, times, then = self.least(len(q), *self.near(q, NEAR - 1))
        (far,), (alone,) = np.nonzero(first == NONE), np.nonzero((times == 1) & (then == NONE))
        then[alone[self.any_at(q[alone], NEAR)]] = NEAR
        for column, value in zip(out, self.least(len(far), *self.near(q[far])), strict=True):
            column[far] = value
        (alone,) = np.nonzero((times == 1) & (then == NONE))
        then[alone[self.any_at(q[alone], NEAR + 1)]] = NEAR + 1
        (open_,) = np.nonzero((times < 2) & (then == NONE))
        if len(open_):
            for column, value in zip(out, self.by_kmers(q[open_]), strict=True):
                column[open_] = value
        return out


def runs(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Stretches of rows that cover all, each with ``most`` in sum, or one row."""
    upto, at, out = np.cumsum(sizes), 0, []
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
        out.append((at, to))
        at = to
    return out


def spread(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """lo, lo + 1, ... of each row, as many as its size."""
    upto = np.cumsum(size)
    return np.repeat(lo - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


def _counted(whitelist: DataFrame, keep_duplicates: bool = True) -> DataFrame:
    wl = whitelist.select("barcode").where("barcode is not null")
    return (wl if keep_duplicates else wl.distinct()).groupBy("barcode").agg(F.count("*").alias("times"))


Known = tuple[list[int], KmerIndex | None] | None


def _collected(counted: DataFrame, k: int) -> Known:
    """(lengths of entries, and their index where they are alike enough to have one) of a whitelist that may be sent; None for a larger one."""
    wl = counted.select("barcode", "times").limit(SENT_ENTRIES + 1).toArrow().combine_chunks()
    if wl.num_rows > SENT_ENTRIES:
        return None
    if not wl.num_rows:
        return [], None
    b = wl.column("barcode").combine_chunks().cast(pa.large_string())
    lengths, ends = sorted(pc.utf8_length(b).unique().to_pylist()), pc.min_max(pc.binary_length(b)).as_py()
    width = ends["max"]
    if [ends["min"]] != [width] or lengths != [width] or not k <= min(8, width) or width > 64:
        return lengths, None
    return lengths, KmerIndex(_matrix(b, width), wl.column("times").to_numpy(), k)


def _matrix(words: pa.Array, width: int) -> np.ndarray:
    """Words of ``width`` letters as rows of bytes; letters beyond ASCII are in no entry and share one byte."""
    if pc.sum(pc.binary_length(words)).as_py() == len(words) * width:
        lo = np.frombuffer(words.buffers()[1], np.int64 if pa.types.is_large_string(words.type) else np.int32)[words.offset]
        data = np.frombuffer(words.buffers()[2], np.uint8)[lo : lo + len(words) * width]
    else:
        data = np.frombuffer("".join(w if w.isascii() else "".join(c if c < "\x80" else "\xff" for c in w) for w in words.to_pylist()).encode("latin-1"), np.uint8)
    return data.reshape(len(words), width)


def gathered(batches: Iterator[pa.RecordBatch], column: str, least: int) -> Iterator[pa.Array]:
    """A column of batches, in pieces of ``least`` rows, the last one with the rest."""
    some, n = [], 0
    for batch in batches:
        some.append(batch.column(column))
        n += batch.num_rows
        while n >= least:
            whole = pa.concat_arrays(some)
            yield whole.slice(0, least)
            some, n = [whole.slice(least)], n - least
    if n:
        yield pa.concat_arrays(some)


SLOT = "bc string, d int, b string, t bigint, next int"


def _slots(bcs: DataFrame, counted: DataFrame, known: Known, k: int) -> DataFrame:
    """(bc, d, b, t, next): for each barcode the least distance to its candidates, its least entry and number of entries there, and the next distance; NULLs without candidates.

    An entry of the whitelist has itself, distance 0 and no next one.  With several entries at the least distance their number may be any above 1, and
    the next distance is not told for certain.

    A barcode that is as long as no entry of the whitelist is an error, whichever way its candidates are found.
    """
    if known is None or known[1] is None:
        # Measured, marked and joined: written, so that it is made once.
        counted = written(counted, "whitelist")
    lengths, index = known or (sorted(counted.agg(F.collect_set(F.length("barcode"))).first()[0]), None)
    wrong = F.raise_error(F.concat(F.lit("barcode "), "bc", F.lit(f" is as long as no entry of the whitelist ({lengths})"))).cast("string")
    checked = F.when(F.length("bc").isin(lengths), F.col("bc")).otherwise(wrong if lengths else F.col("bc")).alias("bc")
    if index is not None:
        shared, width = bcs.sparkSession.sparkContext.broadcast(index), lengths[0]

        def match(batches):
            for words in gathered(batches, "bc", AT_ONCE):
                q = _matrix(words, width)
                entry = shared.value.find(shared.value.digits(q))
                d, times, then = np.zeros(len(q), np.int64), np.ones(len(q), np.int64), np.full(len(q), NONE)
                (rest,) = np.nonzero(entry < 0)
                if len(rest):
                    d[rest], entry[rest], times[rest], then[rest] = shared.value.search(q[rest])
                none, last = d == NONE, then == NONE
                b = shared.value.text.take(pa.array(entry, pa.int64(), mask=none)).cast(pa.string())
                cols = [words, pa.array(np.where(none, 0, d), pa.int32(), mask=none), b, pa.array(times, pa.int64(), mask=none), pa.array(np.where(last, 0, then), pa.int32(), mask=last)]
                yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in SLOT.split(", ")])

        # A number of parts is kept as it is: rows are few bytes but much work each.
        parts = max(bcs.sparkSession.sparkContext.defaultParallelism, int(bcs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return bcs.select(checked).repartition(parts, "bc").mapInArrow(match, SLOT)
    # Sizes are guessed from files, which hold ids in place of barcodes: the whitelist would be sent to all.
    marked = bcs.join(counted.select(F.col("barcode").alias("hit")).hint("merge"), F.col("bc") == F.col("hit"), "left")
    exact = marked.where("hit is not null").select("bc", F.lit(0).alias("d"), F.col("bc").alias("b"), F.lit(1).cast("bigint").alias("t"), F.lit(None).cast("int").alias("next"))
    rest = marked.where("hit is null").select(checked)
    grams = rest.select("bc", F.explode(F.array_distinct(sq.kmers("bc", k))).alias("gram"))
    listed = counted.select("barcode", "times", F.explode(F.array_distinct(sq.kmers("barcode", k))).alias("gram"))
    near = grams.join(listed, "gram").select("bc", "barcode", "times").distinct().withColumn("d", F.levenshtein("bc", "barcode")).where(F.col("d") < F.length("bc"))
    # One slot a distance (at most as many as bases), then the slots of a barcode in order.
    slots = near.groupBy("bc", "d").agg(F.min("barcode").alias("b"), F.sum("times").alias("t"))
    s = F.array_sort(F.collect_list(F.struct("d", "b", "t")))
    slots = slots.groupBy("bc").agg(s.alias("s"))
    slots = slots.select("bc", F.col("s")[0]["d"].alias("d"), F.col("s")[0]["b"].alias("b"), F.col("s")[0]["t"].alias("t"), F.get("s", F.lit(1))["d"].alias("next"))
    return exact.unionByName(rest.join(slots.hint("merge"), "bc", "left"))


def best_matches(barcodes: DataFrame, whitelist: DataFrame, k: int = 5, keep_duplicates: bool = True) -> DataFrame:
    """(bc, corr, dist, margin, exact) for each distinct barcode.

    Candidates share a k-mer.  dist is the least edit distance below the
    barcode's length, margin what the next one is farther (the length stands
    in for missing ones); without a candidate corr is NULL, dist the length,
    margin 0.  An exact match has margin NULL.  Ties take the least entry.
    Repeated whitelist entries tie with themselves unless dropped.  A barcode
    as long as no entry is an error; an empty whitelist corrects nothing.
    """
    counted = _counted(whitelist, keep_duplicates)
    return _matches(barcodes, counted, _collected(counted, k), k)


def _matches(barcodes: DataFrame, counted: DataFrame, known: Known, k: int) -> DataFrame:
    slots = _slots(barcodes.select("bc").where("bc is not null").distinct(), counted, known, k)
    exact, length = F.coalesce(F.col("d") == 0, F.lit(False)), F.length("bc")
    nxt = F.when(F.col("t") > 1, F.col("d")).otherwise(F.coalesce("next", length))
    margin = F.when(~exact, F.coalesce(nxt - F.col("d"), F.lit(0)))
    return slots.select("bc", F.col("b").alias("corr"), F.coalesce("d", length).alias("dist"), margin.alias("margin"), exact.alias("exact"))


def check_correction(n_whitelists: int, k: int, max_dist: list[int], min_margin: list[int]) -> tuple[list[int], list[int]]:
    """Thresholds for each whitelist, single ones replicated; wrong parameters are an error."""
    if n_whitelists < 1:
        raise ValueError("correction needs a whitelist")
    if k < 1:
        raise ValueError("k-mers have one base at least")
    out = []
    for name, values in (("max_dist", max_dist), ("min_margin", min_margin)):
        values = list(values)
        if len(values) == 1:
            values *= n_whitelists
        if len(values) != n_whitelists:
            raise ValueError(f"{name} has {len(values)} values for {n_whitelists} whitelists")
        if any(v < 0 for v in values):
            raise ValueError(f"{name} isn't negative")
        out.append(values)
    return tuple(out)


def correct(calls: DataFrame, whitelists: list[DataFrame], k: int = 5, max_dist: list[int] = (2,), min_margin: list[int] = (1,), concat: bool = False, keep: list[str] = (), stored: bool = False) -> DataFrame:
    """(read_id if there is one, *keep, parts): each part is (orig, corr before thresholds, dist, margin, exact, kept after thresholds).

    Distinct barcodes are corrected once each and joined back to the reads;
    reads without a barcode don't take part in the join.  ``keep`` names other
    columns of ``calls`` to carry along, so that nothing has to be joined to
    the reads again.  Reads are needed thrice for each whitelist, and filters
    on barcodes would be moved in front of what makes them and make them anew:
    they are written first, unless ``calls`` are read from a table already
    (``stored``).  Whitelists are collected at the same time.

    Corrections are joined by hashing: a part of the distinct barcodes, as
    many as there are over the shuffle's partitions, fits a task's memory.
    """
    n = 1 if concat else len(whitelists)
    max_dist, min_margin = check_correction(n, k, max_dist, min_margin)
    keep = [*(["read_id"] if "read_id" in calls.columns else []), *keep]
    out = calls.select(*keep, *[(F.array_join("bcs", "") if concat else F.get("bcs", F.lit(i))).alias(f"bc{i}") for i in range(n)])
    counted = [_counted(whitelists[i]) for i in range(n)]
    with ThreadPoolExecutor(n) as pool:
        known = [pool.submit(inheritable_thread_target(out.sparkSession)(_collected), c, k) for c in counted]
        if not stored:
            out = written(out, "reads")
    for i in range(n):
        m = _matches(out.select(F.col(f"bc{i}").alias("bc")), counted[i], known[i].result(), k)
        kept = F.when((F.col("dist") == 0) | ((F.col("dist") <= max_dist[i]) & (F.col("margin") >= min_margin[i])), F.col("corr"))
        m = m.select(F.col("bc").alias(f"bc{i}"), F.struct(F.col("bc").alias("orig"), "corr", "dist", "margin", "exact", kept.alias("kept")).alias(f"p{i}"))
        some, none = out.where(F.col(f"bc{i}").isNotNull()), out.where(F.col(f"bc{i}").isNull())
        out = some.join(m.hint("shuffle_hash"), f"bc{i}", "left").unionByName(none, allowMissingColumns=True)
    return out.select(*keep, F.array(*[f"p{i}" for i in range(n)]).alias("parts"))


def slim(corrected: DataFrame, enforce_thresholds: bool = False) -> DataFrame:
    """(read_id if there is one, cb, and what was kept beside): joined corrections; thresholds are ignored unless enforced."""
    field = "kept" if enforce_thresholds else "corr"
    values = F.transform("parts", lambda p: p[field])
    return corrected.where(~F.exists(values, F.isnull)).select(*[c for c in corrected.columns if c == "read_id"], F.array_join(values, "").alias("cb"), *[c for c in corrected.columns if c not in ("read_id", "parts")])


def alike(calls: DataFrame, reads: str = "reads") -> DataFrame:
    """(bcs, and the number of reads) of calls with the same barcodes: all that summaries of corrections need."""
    return calls.groupBy("bcs").agg(F.count("*").alias(reads))


def correction_summary(corrected: DataFrame, reads: str | None = None) -> DataFrame:
    """For each part: totals, efficiency, mean distances (0 where there are none) and mean distance of the second match.

    A row counts as one read, or as many as the column ``reads`` tells (see :func:`alike`).
    """
    n = F.lit(1).cast("long") if reads is None else F.col(reads)
    p = corrected.select(n.alias("n"), F.posexplode("parts").alias("part", "p")).where("p is not null")
    ok = F.col("p.kept").isNotNull()
    some = lambda where: F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0).cast("long"))
    mean = lambda value, where: F.bround(F.coalesce(F.sum(F.when(where, value * F.col("n"))) / F.sum(F.when(where & value.isNotNull(), F.col("n"))), F.lit(0.0)), 4)
    total = F.sum("n")
    return p.groupBy("part").agg(
        total.alias("total"),
        some(ok).alias("corrected"),
        F.bround(100.0 * some(ok) / total, 4).alias("efficiency"),
        mean(F.col("p.dist"), ok).alias("mean_dist_corrected"),
        mean(F.col("p.dist"), ~ok).alias("mean_dist_uncorrected"),
        mean(F.col("p.dist") + F.col("p.margin"), ~F.col("p.exact")).alias("mean_second_dist"),
    )


def distance_histogram(corrected: DataFrame, reads: str | None = None) -> DataFrame:
    """(part, dist, n, pct): reads at each distance; a row counts as one, or as many as the column ``reads`` tells (see :func:`alike`)."""
    n = F.lit(1).cast("long") if reads is None else F.col(reads)
    p = corrected.select(n.alias("n"), F.posexplode("parts").alias("part", "p")).where("p is not null")
    counts = p.groupBy("part", F.col("p.dist").alias("dist")).agg(F.sum("n").alias("n"))
    return counts.withColumn("pct", F.bround(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("part")), 2))


def barcode_tally(cells: DataFrame, observed: DataFrame, key: str, add_missing: bool = False) -> DataFrame:
    """Observations of each cell, 0 for none; with ``add_missing`` unknown cells too."""
    n = observed.groupBy(key).agg(F.count("*").alias("tally"))
    return cells.join(n, key, "full_outer" if add_missing else "left").fillna(0, ["tally"])


def sentinel(c: Column, mark: str = "-") -> Column:
    """NULL as the mark that text sinks use."""
    return F.coalesce(c.cast("string"), F.lit(mark))
