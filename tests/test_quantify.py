"""Counting of reads that fit several genes, assembled transcripts and BUS files against plain Python."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spotweave.operators import intervals
from spotweave.operators import quantify as qt
from spotweave.operators import transcripts as tr
from spotweave.sources import bus, readers

# Expectation maximisation ---------------------------------------------------------


def plain_em(hits, tolerance, rounds):
    """{(cell, gene): n} by loops; hits are (cell, umi, gene, weight)."""
    sets = {}
    for c, u, g, w in hits:
        if None not in (c, u, g, w) and w > 0:
            own = sets.setdefault((c, u), {})
            own[g] = max(w, own.get(g, 0))

    def counted(worth):
        out = {}
        for (c, _), own in sets.items():
            p = {g: w * worth(c, g) for g, w in own.items()}
            for g in own:
                out[c, g] = out.get((c, g), 0) + p[g] / sum(p.values())
        return out

    now = counted(lambda c, g: 1)
    for _ in range(rounds):
        before = now
        now = counted(lambda c, g: before[c, g])
        worst = max((abs(n - before[k]) / n for k, n in now.items() if n >= 0.01), default=None)
        if tolerance and (worst is None or worst <= tolerance):
            break
    return now


def hits_fixture():
    r = random.Random(2)
    rows = []
    for cell in ("a", "b", "c"):
        for umi in range(120):
            for g in r.sample("pqrstuv", r.choice([1, 1, 1, 2, 2, 3, 5])):
                rows.append((cell, f"u{umi}", g, r.choice([1.0, 1.0, 0.5, 0.25])))
    return rows + rows[:5] + [("a", "u0", None, 1.0), (None, "u1", "p", 1.0), ("a", None, "p", 1.0), ("d", "u1", "p", 0.0), ("e", "only", "z", 1.0), ("f", "m", "x", 1.0), ("f", "m", "y", 1.0)]


@pytest.mark.parametrize(("weight", "tolerance", "rounds"), [(None, 0, 4), ("w", 0, 3), ("w", 1e-3, 100), (None, 1e-2, 100)])
def test_em_against_loops(spark, weight, tolerance, rounds):
    rows = hits_fixture()
    df = spark.createDataFrame(rows, "cell string, umi string, gene string, w double").repartition(5)
    got = {(r["cell"], r["gene"]): r["n"] for r in qt.em_counts(df, weight=weight, tolerance=tolerance, rounds=rounds).collect()}
    want = plain_em([r if weight else (*r[:3], 1.0) for r in rows], tolerance, rounds)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    molecules = {}
    for c, u, g, w in rows:
        if None not in (c, u, g) and (w > 0 or not weight):
            molecules.setdefault(c, set()).add(u)
    for c, own in molecules.items():
        assert abs(sum(n for (cell, _), n in got.items() if cell == c) - len(own)) < 1e-6


def test_em_of_whole_samples_and_nothing(spark):
    df = spark.createDataFrame([("r1", "t1"), ("r1", "t2"), ("r2", "t1")], "read string, transcript string")
    got = {r["transcript"]: r["n"] for r in qt.em_counts(df, [], "read", "transcript", tolerance=0, rounds=2).collect()}
    want = plain_em([("", a, b, 1.0) for a, b in [("r1", "t1"), ("r1", "t2"), ("r2", "t1")]], 0, 2)
    assert got.keys() == {"t1", "t2"} and all(abs(got[g] - want["", g]) < 1e-12 for g in got)
    assert qt.em_counts(df.where(F.lit(False)), [], "read", "transcript").collect() == []


# Evidence ------------------------------------------------------------------------------


def test_correction_by_evidence_against_loops(spark):
    r = random.Random(5)
    whitelist = ["".join(r.choices("ACGT", k=8)) for _ in range(40)]
    whitelist += [whitelist[0][:-1] + x for x in "ACGT"]
    rows = []
    for i in range(1200):
        b = list(r.choice(whitelist[:3] * 10 + whitelist))
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            b[r.randrange(8)] = r.choice("ACGTN")
        rows.append((i, "".join(b), r.choice([None, "".join(chr(33 + r.randrange(2, 41)) for _ in range(8))])))
    rows += [(5000, None, None), (5001, "", ""), (5002, whitelist[0] + "A", "I" * 9), (5003, whitelist[5][:-1] + "N", "II")]
    df = spark.createDataFrame(rows, "read_id long, bc string, bc_qual string").repartition(4)
    listed = spark.createDataFrame([(w,) for w in whitelist + whitelist[:2]], "barcode string")
    got = {x["read_id"]: (x["barcode"], x["posterior"]) for x in qt.correct_by_evidence(df, listed).collect()}
    entries, seen = set(whitelist), {}
    for _, b, _ in rows:
        if b in entries:
            seen[b] = seen.get(b, 0) + 1
    want = {}
    for i, b, q in rows:
        if b in entries:
            want[i] = (b, 1.0)
        elif b:
            odds = {}
            for w in entries:
                if len(w) == len(b):
                    places = [k for k in range(len(b)) if w[k] != b[k]]
                    if len(places) == 1:
                        p = places[0]
                        odds[w] = (seen.get(w, 0) + 1) * (10 ** (-(ord(q[p]) - 33) / 10) if q is not None and len(q) > p else 0.1)
            if odds:
                best = min(odds, key=lambda w: (-odds[w], w))
                if odds[best] / sum(odds.values()) >= 0.975:
                    want[i] = (best, odds[best] / sum(odds.values()))
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    said = {i: b for i, b, _ in rows}
    assert sum(want[i][0] != said[i] for i in want) > 50 and any(p < 1 for _, p in want.values()) and len(want) < len(rows) - 50


def test_umis_of_one_gene_and_near_umis(spark):
    r = random.Random(6)
    rows = [(r.choice("ab"), "".join(r.choices("AC", k=4)), r.choice("pqr")) for _ in range(400)] + [("a", None, "p"), ("c", "AAAA", "p"), ("c", "AAAA", "q")]
    df = spark.createDataFrame(rows, "cell string, umi string, gene string").repartition(3)
    per = {}
    for c, u, g in rows:
        if u:
            per.setdefault((c, u), {}).setdefault(g, 0)
            per[c, u][g] += 1
    one = {k: max(v, key=v.get) for k, v in per.items() if list(v.values()).count(max(v.values())) == 1}
    assert {(x["cell"], x["umi"]): (x["gene"], x["n"]) for x in qt.one_gene_a_umi(df).collect()} == {k: (g, per[k][g]) for k, g in one.items()}
    groups = {}
    for (c, u), g in one.items():
        groups.setdefault((c, g), {})[u] = per[c, u][g]
    want = {}
    for key, own in groups.items():
        into = set()
        for u, n in own.items():
            near = [(own[v], v) for v in own if sum(a != b for a, b in zip(u, v, strict=True)) == 1 and (own[v], v) > (n, u)]
            into.add(max(near)[1] if near else u)
        want[key] = len(into)
    assert {(x["cell"], x["gene"]): x["n"] for x in qt.count_collapsed(df).collect()} == want


# Transcripts ---------------------------------------------------------------------------------

GTF = """#comment
c1\tsrc\tgene\t101\t400\t.\t+\t.\tgene_id "g1";
c1\tsrc\texon\t301\t400\t.\t+\t.\tgene_id "g1"; transcript_id "t1";
c1\tsrc\texon\t101\t150\t.\t+\t.\tgene_id "g1"; transcript_id "t1";
c1\tsrc\texon\t101\t150\t.\t+\t.\tgene_id "g1"; transcript_id "t1";
c1\tsrc\texon\t201\t240\t.\t+\t.\tgene_id "g1"; transcript_id "t1";
c1\tsrc\tCDS\t131\t150\t.\t+\t0\tgene_id "g1"; transcript_id "t1";
c1\tsrc\tCDS\t201\t230\t.\t+\t0\tgene_id "g1"; transcript_id "t1";
c1\tsrc\tstop_codon\t231\t233\t.\t+\t0\tgene_id "g1"; transcript_id "t1";
c1\tsrc\texon\t101\t150\t.\t+\t.\tgene_id "g1"; transcript_id "t2";
c1\tsrc\texon\t151\t180\t.\t+\t.\tgene_id "g1"; transcript_id "t2";
c1\tsrc\texon\t301\t390\t.\t+\t.\tgene_id "g1"; transcript_id "t2";
c2\tsrc\texon\t11\t20\t.\t-\t.\tgene_id "g2"; transcript_id "t3";
c2\tsrc\tCDS\t1\t2\t.\t-\t0\tgene_id "g3"; transcript_id "no_exon";
c2\tsrc\texon\t5\t9\t.\t-\t.\tgene_id "g4";
"""


@pytest.fixture
def assembled(spark, tmp_path):
    (tmp_path / "a.gtf").write_text(GTF)
    return tr.assemble(readers.gtf(spark, str(tmp_path / "a.gtf")))


def test_transcripts_and_junctions(assembled):
    rows = {r["name"]: tuple(r)[:3] + tuple(r)[5:] for r in tr.bed12(assembled).collect()}
    assert rows == {
        "t1": ("c1", 100, 400, "+", 130, 233, "0", 3, "50,40,100,", "0,100,200,"),
        "t2": ("c1", 100, 390, "+", 390, 390, "0", 2, "80,90,", "0,200,"),
        "t3": ("c2", 10, 20, "-", 20, 20, "0", 1, "10,", "0,"),
    }
    gaps = sorted(tuple(r) for r in tr.junctions(assembled).collect())
    assert gaps == [("c1", 150, 200, "t1", 0, "+"), ("c1", 180, 300, "t2", 0, "+"), ("c1", 240, 300, "t1", 0, "+")]
    both = assembled.unionByName(assembled.withColumn("transcript", F.concat("transcript", F.lit("x"))))
    assert sorted(tuple(r) for r in tr.junctions(both, distinct=True).collect())[0] == ("c1", 150, 200, "t1", 2, "+")


def test_splice_verdicts(spark, assembled):
    cigars = {
        "in_both": (105, "30M"), "junction": (141, "10M50N20M"), "near_junction": (141, "10M52N20M"), "exon_of_one": (205, "20M"), "intron": (241, "30M"), "retained": (145, "20M"),
        "across": (351, "60M"), "outside": (500, "20M"), "deleted": (110, "5M2D10M"), "clipped": (110, "5S20M5S"),
    }
    rows = [(n, 0, "c1", p, 9, c) for n, (p, c) in cigars.items()] + [("wrong_strand", 16, "c1", 105, 9, "30M"), ("unaligned", 4, "*", 0, 0, "*"), ("last", 16, "c2", 12, 9, "5M")]
    al = spark.createDataFrame(rows, "qname string, flag int, rname string, pos int, mapq int, cigar string")
    got = {r["name"]: r["verdict"] for r in qt.splice_verdicts(intervals.spans(al), assembled).collect()}
    want = {"in_both": "spliced", "deleted": "spliced", "clipped": "spliced", "junction": "ambiguous", "near_junction": "unspliced", "exon_of_one": "ambiguous", "intron": "unspliced", "retained": "ambiguous", "last": "spliced"}
    assert got == want
    blocks = intervals.cigar_blocks(al).where("name = 'junction'").orderBy("start").collect()
    assert [(b["start"], b["end"]) for b in blocks] == [(140, 150), (200, 220)]


def test_one_verdict_a_umi(spark):
    verdicts = spark.createDataFrame([("r1", "g", "spliced"), ("r2", "g", "ambiguous"), ("r3", "g", "unspliced"), ("r4", "g", "spliced"), ("r5", "g", "unspliced"), ("r6", "g", "ambiguous"), ("r7", "h", "spliced")], "name string, gene string, verdict string")
    cells = spark.createDataFrame([("r1", "c", "a"), ("r2", "c", "a"), ("r3", "c", "b"), ("r4", "c", "d"), ("r5", "c", "d"), ("r6", "c", "e"), ("r7", "c", "a"), ("r8", "c", "z"), ("r6", None, "z")], "name string, cell string, umi string")
    got = sorted(tuple(r) for r in qt.velocity_counts(verdicts, cells).collect())
    assert got == [("c", "g", 1, 1, 2), ("c", "h", 1, 0, 0)]


# BUS ----------------------------------------------------------------------------------------------


def test_sequences_are_two_bits_a_base():
    r = random.Random(1)
    for n in (1, 5, 16, 31, 32):
        s = ["".join(r.choices("ACGT", k=n)) for _ in range(50)]
        codes = bus.encode(pa.array(s), n)
        assert codes.tolist() == [int("".join(str("ACGT".index(c)) for c in x), 4) for x in s]
        assert bus.decode(codes, n).to_pylist() == s and np.argsort(codes, kind="stable").tolist() == sorted(range(50), key=lambda i: s[i])
    assert bus.decode(np.zeros(2, np.uint64), 0).to_pylist() == ["", ""]
    for bad in (["ACGN"], ["ACG"], [None], ["acgt"]):
        with pytest.raises(ValueError):
            bus.encode(pa.array(bad, pa.string()), 4)


def test_files_are_read_in_runs(spark, tmp_path):
    r = random.Random(3)
    rows = [("".join(r.choices("ACGT", k=6)), "".join(r.choices("ACGT", k=4)), r.randrange(50), r.randrange(1, 2**32), r.randrange(4)) for _ in range(1000)]
    path = f"file://{tmp_path}/out"
    bus.write_bus(spark.createDataFrame(rows, bus.SCHEMA).repartition(3), path, 6, 4)
    back = bus.read_bus(spark, path, 64)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert back.rdd.getNumPartitions() >= 16 and not [f for f in (tmp_path / "out").iterdir() if f.name.startswith(".") and f.suffix == ".bus"]
    # A file as another program writes it, with a text in its header.
    text = b"made elsewhere"
    one = tmp_path / "one.bus"
    record = struct.pack("<QQiIII", 0b0011, 0b01, -1, 7, 0, 0)
    one.write_bytes(struct.pack("<4sIIII", b"BUS\x00", 1, 2, 1, len(text)) + text + record * 100)
    got = bus.read_bus(spark, str(one), 30)
    assert got.count() == 100 and set(map(tuple, got.collect())) == {("AT", "C", -1, 7, 0)} and got.rdd.getNumPartitions() == 4
    one.write_bytes(struct.pack("<4sIIII", b"BUS\x00", 1, 2, 1, 0))
    assert bus.read_bus(spark, str(one)).count() == 0
    one.write_bytes(b"BUS\x00" + record)
    with pytest.raises(Exception, match="not a BUS file"):
        bus.read_bus(spark, str(one)).count()
    with pytest.raises(Exception, match="not 6 bases|bases long"):
        bus.write_bus(spark.createDataFrame([("ACG", "ACGT", 1, 1, 0)], bus.SCHEMA), f"{tmp_path}/bad", 6, 4)


def test_records_corrected_sorted_and_counted(spark, tmp_path):
    listed = ["AAAA", "AATT", "CCCC", "GGGG"]
    rows = [("AAAA", "CC", 0, 1, 0), ("AAAA", "CC", 0, 2, 0), ("AAAC", "CC", 1, 1, 0), ("AAAT", "GG", 2, 1, 0), ("CCCG", "GG", 2, 1, 0), ("GGGG", "TT", 0, 1, 0), ("GGGG", "TT", 2, 1, 0), ("TTTT", "TT", 0, 1, 0), ("GGGG", "AA", 3, 1, 1)]
    records = spark.createDataFrame(rows, bus.SCHEMA)
    fixed = bus.sorted_records(bus.corrected(records, spark.createDataFrame([(x,) for x in listed], "barcode string")))
    # AAAT is one base from two entries, TTTT from none.
    want = [("AAAA", "CC", 0, 3, 0), ("AAAA", "CC", 1, 1, 0), ("CCCC", "GG", 2, 1, 0), ("GGGG", "AA", 3, 1, 1), ("GGGG", "TT", 0, 1, 0), ("GGGG", "TT", 2, 1, 0)]
    assert list(map(tuple, fixed.collect())) == want
    (tmp_path / "matrix.ec").write_text("0\t0,1\n1\t1,2\n2\t3\n")
    (tmp_path / "transcripts.txt").write_text("t0\nt1\nt2\nt3\n")
    genes = spark.createDataFrame([("t0", "x"), ("t1", "y"), ("t2", "y"), ("t3", "z")], "transcript string, gene string")
    ec = bus.class_genes(spark, str(tmp_path / "matrix.ec"), str(tmp_path / "transcripts.txt"), genes)
    assert sorted(map(tuple, ec.collect())) == [(0, "x"), (0, "y"), (1, "y"), (2, "z")]
    molecules = bus.molecule_genes(fixed, ec)
    assert sorted(map(tuple, molecules.collect())) == [("AAAA", "CC", "y"), ("CCCC", "GG", "z")]
    assert sorted(map(tuple, bus.gene_counts(molecules).collect())) == [("AAAA", "y", 1), ("CCCC", "z", 1)]
    seen = dict(map(tuple, bus.inspected(fixed, spark.createDataFrame([("AAAA",), ("AAAA",)], "barcode string")).collect()))
    assert seen == {"records": 6, "reads": 8, "barcodes": 3, "umis": 4, "listed_reads": 4, "listed_barcodes": 1}


# Merging with equal starts combined -----------------------------------------------------------------


def test_merged_intervals_of_a_deep_locus(spark):
    r = random.Random(7)
    rows = [("c", "+", s, s + r.randrange(1, 40)) for s in r.choices(range(0, 3000, 7), k=2000)] + [("c", "-", 5, 9)] * 500
    df = spark.createDataFrame(rows, "chrom string, strand string, start long, end long")
    want = []
    for strand in "+-":
        for s, e in sorted((s, e) for _, x, s, e in rows if x == strand):
            if want and want[-1][1] == strand and s <= want[-1][3] + 2:
                want[-1][3], want[-1][4] = max(want[-1][3], e), want[-1][4] + 1
            else:
                want.append(["c", strand, s, e, 1])
    got = sorted(tuple(x[c] for c in ("chrom", "strand", "start", "end", "n")) for x in intervals.merge_intervals(df, 2, block=64).collect())
    assert got == sorted(map(tuple, want))
