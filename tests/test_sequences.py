import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spotweave.functions import alignment as al
from spotweave.functions import sequences as sq


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first().asDict()


def test_bases(spark):
    s = F.lit("AACCCGT")
    got = one(spark, rc=sq.revcomp(s), gc=sq.gc_pct(F.lit("G" + "A" * 31)), run=sq.homopolymer_max(s), base=sq.homopolymer_base(s), compat=sq.homopolymer_base(s, True), k=sq.kmers(s, 5), empty=sq.gc_pct(F.lit("")))
    assert got == {"rc": "ACGGGTT", "gc": 3.12, "run": 3, "base": "C", "compat": "A", "k": ["AACCC", "ACCCG", "CCCGT"], "empty": None}


def test_revcomp_twice_is_identity(spark):
    s = F.lit(sq.IUPAC)
    assert one(spark, x=sq.revcomp(sq.revcomp(s)))["x"] == sq.IUPAC


def test_slices(spark):
    s = F.lit("ACGTACGT")
    got = one(spark, a=sq.py_slice(s, F.lit(2), F.lit(5)), b=sq.py_slice(s, F.lit(-4), F.lit(-1)), c=sq.py_slice(s, F.lit(-4), F.lit(-1), wrap=True), t=sq.trim_ends(s, 2, 3), h=sq.hard_trim(s, 2, 5, 2))
    assert got == {"a": "GTA", "b": None, "c": "ACG", "t": "GTA", "h": "ACAC"}


@pytest.mark.parametrize("code,at,parts", [("ACGTACGTGCGC", 8, ("ACGTACGT", "GCGC", "ACGTACGT_GCGC")), ("ACGTACGTGCGC", 10, ("ACGTACGTGC", "GC", "ACGTACGTGC_GC"))])
def test_split_barcode(spark, code, at, parts):
    assert tuple(one(spark, p=sq.split_barcode(F.lit(code), at))["p"]) == parts


def test_insert_adapter(spark):
    got = one(spark, a=sq.insert_adapter(F.lit("ACGTACGT"), F.lit("GCGC"), "TCTTCAGCGTTCCCGAGA", "CTACACGACGCTCTTCCGATCT"))
    assert got["a"] == "CTACACGACGCTCTTCCGATCT" + "ACGTACGT" + "TCTTCAGCGTTCCCGAGA" + "GCGC"


def test_report_number(spark):
    assert one(spark, v=sq.report_number(F.lit(" 1,234 (56.7%)")))["v"] == "1234"


def smith_waterman(read, adapter, match, mismatch, opening, extend):
    """The affine recurrence in plain Python; the smallest end of the best score."""
    low = -(10**9)
    h, e = [0] * (len(adapter) + 1), [low] * (len(adapter) + 1)
    best = (0, -1)
    for i, r in enumerate(read):
        f = low
        new = [0] * (len(adapter) + 1)
        for j, a in enumerate(adapter, 1):
            s = 0 if r not in "ACGT" or a not in "ACGT" else match if r == a else mismatch
            e[j] = max(h[j] - opening, e[j] - extend)
            f = max(new[j - 1] - opening, f - extend)
            new[j] = max(0, h[j - 1] + s, e[j], f)
        h = new
        if max(h) > best[0]:
            best = (max(h), i)
    return best


@pytest.mark.parametrize("scores,least", [((1, -1, 10, 1), 0.7), ((4, 1, 6, 6), 2.0)])
def test_hits_against_the_recurrence(scores, least):
    r = random.Random(5)
    for n in (8, 18, 22, 27):
        adapter = "".join(r.choices("ACGT", k=n))
        reads = ["", "ACN", *("".join(r.choices("ACGTN", [9, 9, 9, 9, 1], k=r.randrange(5, 60))) for _ in range(40))]
        for i in range(2, 30):
            a = list(adapter)
            a[r.randrange(n)] = r.choice("ACGT")
            reads[i] = (reads[i][:10] + "".join(a)[r.choice([0, 0, 3]) :] + reads[i][10:])[:70]
        want = round(least * n)
        got = al.locate(pd.Series(reads), [(adapter, want)], *scores)[0]
        for read, (_, row) in zip(reads, got.iterrows(), strict=True):
            score, end = smith_waterman(read, adapter, *scores)
            if score >= want and end >= 0:
                assert (row["score"], row["end"], row["start"]) == (score, end + 1, end + 1 - n)
            else:
                assert row.isna().all()


def test_threshold_is_half_even():
    assert [al.threshold("A" * n, 0.5) for n in (1, 3, 5)] == [0, 2, 2]


def test_edit_distances_and_candidates():
    from spotweave.operators.barcodes import KmerIndex

    r = random.Random(9)
    words = ["".join(r.choices("ACGT", k=12)) for _ in range(300)]

    def levenshtein(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            old, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
        return row[-1]

    index = KmerIndex(sorted(set(words)), [1] * len(set(words)), 4)
    best = lambda q: index.best(np.frombuffer(q.encode(), np.uint8).reshape(1, -1))[0]
    grams = lambda w: {w[i : i + 4] for i in range(9)}
    for w in words[:25]:
        q = w[:5] + r.choice("ACGT") + w[5:11]
        d = sorted((levenshtein(q, x), x) for x in set(words) if grams(q) & grams(x) and levenshtein(q, x) < 12)
        near = sorted({v for v, _ in d})
        own = [x for v, x in d if v == near[0]]
        assert best(q) == (near[0], min(own), len(own), near[1] if len(near) > 1 else None)
    assert best("NNNNNNNNNNNN") is None
