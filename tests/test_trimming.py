"""Adapters cut with gaps, against a plain alignment cell by cell."""

import os
import random

import numpy as np
import pytest

from spotweave import quant_queries
from spotweave.operators import trimming as tm
from spotweave.operators.reads import quality_cut


def plain_located(read, adapter, end):
    """(score, begin, stop) by a table of (score, -errors, -place) tuples."""
    a, m = adapter.seq, len(adapter.seq)
    free = end == 5
    row = [(0, 0, i) if free else (-i, -i, 0) for i in range(m + 1)]
    best = None

    def offer(cell, aligned, at):
        nonlocal best
        score, errors, place = cell[0], -cell[1], -cell[2]
        aligned += min(place, 0)
        if score > 0 and errors <= int(adapter.error * aligned + 1e-9) and aligned >= min(adapter.overlap, m) and (not free or adapter.inner or place <= 0) and (best is None or cell > best[0]):
            best = (cell, max(place, 0), at)

    for j in range(len(read) + 1):
        if j:
            c = read[j - 1]
            new = [(0, 0, -j)]
            for i in range(1, m + 1):
                fits = c == a[i - 1] or a[i - 1] == "N" or (adapter.wild and c == "N")
                d, u, le = row[i - 1], row[i], new[i - 1]
                new.append(max((d[0] + 1, d[1], d[2]) if fits else (d[0] - 1, d[1] - 1, d[2]), (u[0] - 1, u[1] - 1, u[2]), (le[0] - 1, le[1] - 1, le[2])))
            row = new
        if free or adapter.inner:
            offer(row[m], m, j)
        if j == len(read) and not free:
            for k in range(1, m + 1):
                offer(row[k], k, j)
    return (best[0][0], best[1], best[2]) if best else (0, 0, 0)


SMALL = "/root/testdata/sf0.001"
ADAPTERS = [
    tm.Adapter("a", "ACGTTGCA", 3, 0.25, 3), tm.Adapter("b", "GGCATNCA", 5, 0.2, 4), tm.Adapter("tail", "AAAAAAAAAA", 3, 0.2, 3, inner=False), tm.Adapter("either", "TTGACC", 0, 0.2, 3),
    tm.Adapter("anchored", "CCGTA", 5, 0.2, 2, inner=False), tm.Adapter("plain", "CATCAT", 3, 0.0, 2, wild=False),
]


def reads(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        s = r.choices("ACGTN", weights=[5, 5, 5, 5, 1], k=r.choice([0, 1, 4, 12, 30, 45]))
        for _ in range(r.choice([0, 1, 1, 2])):
            piece = list(r.choice(ADAPTERS).seq.replace("N", "G"))
            for _ in range(r.choice([0, 0, 1, 2])):
                k = r.randrange(len(piece))
                piece[k : k + r.choice([0, 1])] = r.choices("ACGT", k=r.choice([0, 1, 1]))
                piece = piece or ["A"]
            at = r.choice([0, len(s), r.randrange(len(s) + 1)])
            cut = r.choice([0, 0, r.randrange(len(piece))])
            s[at:at] = piece[cut:] if at == 0 else piece[: len(piece) - cut]
        out.append("".join(s))
    return out


def test_alignments_cell_by_cell():
    texts, hits = reads(1, 250), 0
    bases, lengths = tm._matrix([t.encode() for t in texts])
    for adapter in ADAPTERS:
        for end in (3, 5) if adapter.end == 0 else (adapter.end,):
            got = list(zip(*(x.tolist() for x in tm.located(bases, lengths, adapter, end)), strict=True))
            for t, g in zip(texts, got, strict=True):
                want = plain_located(t, adapter, end)
                assert g[0] == want[0] and (not g[0] or g == want), (t, adapter, end, g, want)
                hits += g[0] > 0
    assert hits > 300


def test_quality_of_padded_reads():
    r = random.Random(4)
    rows = [[r.randrange(2, 41) for _ in range(r.randrange(0, 30))] for _ in range(300)]
    width = max(map(len, rows))
    q = np.zeros((len(rows), width), np.int64)
    for i, x in enumerate(rows):
        q[i, : len(x)] = x
    lengths = np.array([len(x) for x in rows])
    for cutoff in (0, 10, 20, 40):
        assert tm.quality_kept(q, lengths, cutoff).tolist() == [quality_cut(np.array(x), cutoff) for x in rows]
    assert tm.quality_kept(np.zeros((2, 0), np.int64), np.zeros(2, np.int64), 20).tolist() == [0, 0]


def plain_trim(seq, qual, quality, nextseq, rounds, trim_n, adapters=ADAPTERS):
    for cutoff, dark in ((nextseq, True), (quality, False)):
        if cutoff is not None:
            q = np.array([cutoff - 1 if dark and c == "G" else ord(x) - 33 for c, x in zip(seq, qual, strict=True)])
            keep = quality_cut(q, cutoff)
            seq, qual = seq[:keep], qual[:keep]
    cut = []
    for _ in range(rounds):
        top = (0, None)
        for a in adapters:
            for end in (3, 5) if a.end == 0 else (a.end,):
                score, begin, stop = plain_located(seq, a, end)
                if score > top[0]:
                    top = (score, (a, 0, begin) if end == 3 else (a, stop, len(seq)))
        if top[1] is None:
            break
        a, lo, hi = top[1]
        cut.append(a.name)
        seq, qual = seq[lo:hi], qual[lo:hi]
    if trim_n:
        left = len(seq) - len(seq.lstrip("N"))
        right = max(left, len(seq.rstrip("N")))
        seq, qual = seq[left:right], qual[left:right]
    return seq, qual, cut


@pytest.mark.parametrize(("quality", "nextseq", "rounds", "trim_n"), [(None, None, 1, False), (20, 15, 3, True)])
def test_whole_reads_against_plain_alignment(spark, quality, nextseq, rounds, trim_n):
    r = random.Random(6)
    rows = [(i, s, "".join(chr(33 + r.choice([2, 12, 30, 38, 40])) for _ in s), "x") for i, s in enumerate(reads(9, 400))] + [(900, None, None, "y"), (901, "", "", "y")]
    df = spark.createDataFrame(rows, "read_id long, seq string, qual string, extra string").repartition(3)
    got = {x["read_id"]: (x["seq"], x["qual"], x["cut"]) for x in tm.trim(df, ADAPTERS, quality, nextseq, rounds, trim_n).collect()}
    assert got == {i: plain_trim(s or "", q or "", quality, nextseq, rounds, trim_n) for i, s, q, _ in rows}
    assert {len(c) for *_, c in got.values()} >= set(range(rounds + 1)) - {3}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")
def test_every_row_of_the_query(spark):
    rows = quant_queries.adapter_reads(spark, SMALL).collect()
    got = {r["read_id"]: (r["seq"], r["qual"], r["cut"]) for r in quant_queries.trim_with_gaps(spark, SMALL).collect()}
    want = {}
    for r in rows:
        s, q, cut = plain_trim(r["seq"], r["qual"], 20, None, 2, True, quant_queries.TRIMMED)
        want[r["read_id"]] = (s, q, ",".join(cut))
    assert got == want
    assert {c for *_, c in got.values()} >= {"read_end", "read_end,switch"}


def test_odd_reads(spark):
    bad = spark.createDataFrame([("ACGT", "II")], "seq string, qual string")
    with pytest.raises(Exception, match="differ in length"):
        tm.trim(bad, ADAPTERS).collect()
    assert tm.trim(bad.limit(0), ADAPTERS).collect() == []
    pairs = spark.createDataFrame([("AAAA", "CC"), ("A", "CCCC"), ("A", "C"), (None, "CCCC"), ("AAAA", "CCCC")], "seq1 string, seq2 string")
    assert tm.pair_filter(pairs, 3, 3).count() == 1 and tm.pair_filter(pairs, 3, 3, "both").count() == 4
    with pytest.raises(ValueError):
        tm.pair_filter(pairs, rule="first")
