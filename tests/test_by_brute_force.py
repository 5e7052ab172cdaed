"""Queries that SQL can't express, every row against plain Python; and operators on small inputs of their own."""

import gzip
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave import plan_queries, queries
from spotweave.operators import barcodes as bc
from spotweave.operators import hmm, intervals, spatial
from spotweave.operators import matrix as mx
from spotweave.operators import reads as rd
from spotweave.operators import tags as tg
from spotweave.operators import umis as um
from spotweave.plans import config, pipeline
from spotweave.sources import readers, writers
from spotweave.streaming import reads as streams

SMALL = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")
FLIP = str.maketrans("ACGTN", "TGCAN")


def turned(s):
    return s[::-1].translate(FLIP)


def local_hit(read, adapter, least, match=1, mismatch=-1, opening=10, extend=1):
    """(score, start, end) of the best local alignment by the affine recurrence, the smallest end of equal ones; start is end - len(adapter)."""
    low = -(10**6)
    n = len(adapter)
    h, e = [0] * (n + 1), [low] * (n + 1)
    best, at = 0, -1
    for i, base in enumerate(read):
        new, f = [0] * (n + 1), low
        for j in range(1, n + 1):
            e[j] = max(h[j] - opening, e[j] - extend)
            f = max(new[j - 1] - opening, f - extend)
            s = match if base == adapter[j - 1] else mismatch
            new[j] = max(0, h[j - 1] + s, e[j], f)
            if new[j] > best:
                best, at = new[j], i
        h = new
    return (best, at + 1 - n, at + 1) if best >= least else None


def fast_hit(read, adapter, least):
    """The same for adapters whose gapped alignments can't reach ``least``: runs along diagonals."""
    best, at = 0, -1
    scores = [0] * (len(adapter) + 1)
    for i, base in enumerate(read):
        now = [0] * (len(adapter) + 1)
        for j, a in enumerate(adapter, 1):
            now[j] = max(0, scores[j - 1] + (1 if a == base else -1))
            if now[j] > best:
                best, at = now[j], i
        scores = now
    return (best, at + 1 - len(adapter), at + 1) if best >= least else None


def test_the_two_recurrences_agree():
    r = random.Random(1)
    for _ in range(60):
        adapter = "".join(r.choices("ACGT", k=r.choice([8, 12])))
        read = "".join(r.choices("ACGT", k=40)) + adapter[: r.randrange(13)] + "".join(r.choices("ACGT", k=9))
        least = round(0.7 * len(adapter))
        assert local_hit(read, adapter, least) == fast_hit(read, adapter, least)


def long_rows(spark):
    return [(r["read_id"], r["seq"]) for r in queries.long_sequenced(spark, SMALL).collect()]


@tables
def test_adapter_scan_of_every_read(spark):
    a1, a2 = queries.ADAPTER1, queries.ADAPTER2
    want = {}
    for name, seq in long_rows(spark):
        hits = []
        for label, a, ways in (("adapter1", a1, "+-"), ("adapter2", a2, "-+")):
            for way, s, strand in (("f", a, ways[0]), ("r", turned(a), ways[1])):
                h = fast_hit(seq, s, round(0.7 * len(s)))
                if h:
                    hits.append((h[1], h[2], f"{label}_0_{way}", strand, h[0]))
        hits.sort()
        config_ = "-".join(h[2] for h in hits) or "ambiguous"
        lo, hi, n = max((h[0] for h in hits), default=0), min((h[1] for h in hits), default=0), len(seq)
        table = {
            "ambiguous": (0, n, "=", "no_adapters"),
            "adapter1_0_f-adapter2_0_r": (hi, lo, "+", "full_len"), "adapter2_0_f-adapter1_0_r": (hi, lo, "-", "full_len"),
            "adapter1_0_f": (hi, n, "+", "adapter1_single"), "adapter1_0_r": (hi, n, "-", "adapter1_single"),
            "adapter2_0_r": (0, lo, "+", "adapter2_single"), "adapter2_0_f": (0, lo, "-", "adapter2_single"),
        }
        sums = {s: sum(h[4] for h in hits if h[3] == s) for s in "+-"}
        if config_ in table:
            want[name] = (n, *table[config_], config_)
        elif sums["+"] and sums["-"]:
            by = "+" if sums["+"] > 1.1 * sums["-"] else "-" if sums["-"] > 1.1 * sums["+"] else "="
            double = {frozenset(("adapter1_0_f", "adapter1_0_r")): "adapter1_double", frozenset(("adapter2_0_f", "adapter2_0_r")): "adapter2_double"}
            label = double.get(frozenset(config_.split("-"))) if len(hits) == 2 else None
            want[name] = (n, hi, lo, by, label, config_) if label else (n, 0, n, by, "other_ambiguous", config_)
        else:
            want[name] = (n, 0, n, "+" if sums["+"] else "-", "other", config_)
    got = {r["read_id"]: (r["readlen"], r["start"], r["end"], r["strand"], r["lab"], r["adapter_config"]) for r in queries.adapter_scan_classify(spark, SMALL).collect()}
    assert got == want and len(want) > 500


@tables
def test_split_of_every_read(spark):
    want = {}
    for name, seq in long_rows(spark):
        anchor, cut = fast_hit(seq, queries.ADAPTER1, round(0.7 * len(queries.ADAPTER1))), fast_hit(seq, "T" * 8, round(0.7 * 8))
        at = cut[2] + 8 if cut else 0
        if not anchor or not cut:
            want[name] = ("no_split" if anchor else "no_anchor", None, None)
        elif len(seq[:at]) > 12 and len(seq[at:]) > 12:
            want[name] = ("written", seq[:at], turned(seq[at:]))
        else:
            want[name] = ("too_short", None, None)
    got = {r["read_id"]: (r["status"], r["r1"], r["r2"]) for r in queries.split_long_reads(spark, SMALL).collect()}
    assert got == want and {w[0] for w in want.values()} > {"written"}


@tables
def test_barcodes_of_every_long_read(spark):
    want = {}
    for name, seq in long_rows(spark):
        hit = fast_hit(seq, queries.ADAPTER1, round(0.7 * len(queries.ADAPTER1)))
        b, u = (seq[hit[2] : hit[2] + 16], seq[hit[2] + 16 : hit[2] + 28]) if hit else ("", "")
        want[name] = (b if len(b) == 16 else None, u if len(u) == 12 else None)
    assert {r["read_id"]: (r["bc"], r["umi"]) for r in queries.barcode_extract_adapter(spark, SMALL).collect()} == want


@tables
def test_internal_trim_of_every_read(spark):
    adapter, want = "TCTTCAGCGTTCCCGAGA", {}
    for r in queries.derived_reads(spark, SMALL).collect():
        seq = r["bc"][:8] + adapter + r["bc"][8:14] + r["umi"][:7]
        hit = local_hit(seq, adapter, 58, 4, 1, 6, 6)
        if not hit:
            want[r["read_id"]] = ("N", "!", "missing")
            continue
        _, start, end = hit
        if start < 8:
            out = "N" * (8 - start) + seq[start:8] + seq[end:]
            status, lost = "deletion", 8 - start
        else:
            out, status, lost = seq[:8] + seq[end:], "exact" if start == 8 else "insertion", 0
        want[r["read_id"]] = (out, "!" * lost + "I" * (len(out) - lost), status)
    got = {r["read_id"]: (r["seq"], r["qual"], r["status"]) for r in queries.internal_adapter_trim(spark, SMALL).collect()}
    assert got == want


@tables
def test_adapter_trimming_of_every_read(spark):
    adapter, want = "AGATCGGAAGAGC", {}
    for r in queries.derived_reads(spark, SMALL).collect():
        i = r["event_id"]
        seq = "N" * (i % 3) + r["bc"] + (adapter if i % 2 == 0 else r["cdna"][:13]) + r["umi"][: i % 12 + 1] + "N" * (i % 2)
        poor = i % 9
        qual = "I" * (len(seq) - poor) + "#" * poor
        s, q = seq[: len(seq) - poor], qual[: len(seq) - poor]
        best = (0, len(s))
        for at in range(len(s)):
            n = min(len(adapter), len(s) - at)
            wrong = sum(x != y for x, y in zip(s[at : at + n], adapter, strict=False))
            if n >= 5 and wrong <= int(0.1 * n) and n - wrong > best[0]:
                best = (n - wrong, at)
        s, q = s[: best[1]], q[: best[1]]
        left, right = len(s) - len(s.lstrip("N")), len(s.rstrip("N"))
        want[r["read_id"]] = (s[left:right], q[left:right])
    got = {r["read_id"]: (r["seq"], r["qual"]) for r in plan_queries.trim_adapters(spark, SMALL).collect()}
    assert got == want


@tables
def test_segments_of_every_point(spark):
    points = [(r["cell"], r["x"], r["y"]) for r in queries._points(spark, SMALL).collect()]
    want = {}
    for section in range(8):
        own = sorted(p for p in points if p[0] % 8 == section)
        label = list(range(len(own)))
        for i, (_, x, y) in enumerate(own):
            for j, (_, a, b) in enumerate(own):
                if ((x - a) ** 2 + (y - b) ** 2) ** 0.5 <= 0.1:
                    label[j] = label[i]
        names = {v: str(k) for k, v in enumerate(sorted(set(label)))}
        want |= {p[0]: names[v] for p, v in zip(own, label, strict=True)}
    assert {r["cell"]: r["segment"] for r in queries.tissue_segments(spark, SMALL).collect()} == want


def plain_fit(tracks):
    """Baum-Welch and Viterbi by loops over windows."""
    model, before = hmm.Model.initial(), -np.inf

    def passes(x):
        e, n = model.emissions(x), len(x)
        f, b = np.empty((n, 2)), np.zeros((n, 2))
        f[0] = model.start + e[0]
        for t in range(1, n):
            f[t] = np.logaddexp(f[t - 1, 0] + model.trans[0], f[t - 1, 1] + model.trans[1]) + e[t]
        for t in range(n - 2, -1, -1):
            b[t] = np.logaddexp(model.trans[:, 0] + e[t + 1, 0] + b[t + 1, 0], model.trans[:, 1] + e[t + 1, 1] + b[t + 1, 1])
        return e, f, b

    for _ in range(50):
        got, sums, moves = 0.0, np.zeros((2, 3)), np.zeros((2, 2))
        for x in tracks.values():
            e, f, b = passes(x)
            total = np.logaddexp(*f[-1])
            post = np.exp(f + b - total)
            got += total
            sums += np.column_stack((post.sum(0), (post * x[:, None]).sum(0), (post * np.log(x)[:, None]).sum(0)))
            for t in range(len(x) - 1):
                moves += np.exp(f[t][:, None] + model.trans + e[t + 1] + b[t + 1] - total)
        if not np.isfinite(got) or got - before < hmm.STOP:
            break
        before = got
        fitted = [hmm._gamma(*sums[i], model.shape[i]) if sums[i, 0] > 1e-6 else (model.shape[i], model.scale[i]) for i in range(2)]
        rows = moves.sum(1, keepdims=True)
        trans = np.where(rows > 1e-9, np.log(np.maximum(moves / np.maximum(rows, 1e-300), 1e-300)), model.trans)
        model = hmm.Model(np.array([a for a, _ in fitted]), np.array([b for _, b in fitted]), trans, model.start)
    return model


def plain_regions(model, tracks):
    """Runs of the likeliest states by a loop over windows."""
    found = set()
    for (c, s), x in tracks.items():
        e = model.emissions(x)
        v, back = model.start + e[0], []
        for t in range(1, len(x)):
            ways = v[:, None] + model.trans
            back.append(ways.argmax(0))
            v = ways.max(0) + e[t]
        state = [int(v.argmax())]
        for b in back[::-1]:
            state.append(int(b[state[-1]]))
        edge = np.diff([0, *state[::-1], 0])
        found |= {(c, s, int(a) * 50, int(b) * 50) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)}
    return found


def test_hidden_states_against_loops(spark):
    r = random.Random(3)
    reads = [(c, s, at + r.randrange(900)) for c in "ab" for s in "+-" for at in (2000, 6000) for _ in range(r.choice([40, 300]))] + [(c, "+", r.randrange(9000)) for c in "ab" for _ in range(40)]
    df = spark.createDataFrame(reads, "chrom string, strand string, start long")
    tracks = {}
    for c, s, at in reads:
        tracks.setdefault((c, s), []).append(at // 50)
    tracks = {k: 1 + np.bincount(v).astype(float) for k, v in tracks.items()}
    model, want = hmm.fit(hmm.windows(df)), plain_fit(tracks)
    assert np.allclose(model.shape, want.shape, rtol=1e-5) and np.allclose(model.scale, want.scale, rtol=1e-5) and np.allclose(np.exp(model.trans), np.exp(want.trans), atol=1e-6)
    regions = {(g["chrom"], g["strand"], g["start"], g["end"]) for g in hmm.transcribed_regions(df, model=want).collect()}
    found = plain_regions(want, tracks)
    assert regions == found and found


@tables
def test_regions_of_the_catalogue(spark):
    """The query's own windows, from whole tables, give the regions of the plain fit."""
    got = {(g["chrom"], g["strand"], g["start"], g["end"]) for g in queries.transcribed_regions(spark, SMALL).collect()}
    tracks = {}
    for i in queries.derived_transcription(spark, SMALL).collect():
        tracks.setdefault((i["chrom"], i["strand"]), []).append(i["start"] // 50)
    tracks = {k: 1 + np.bincount(v).astype(float) for k, v in tracks.items()}
    model = plain_fit(tracks)
    own = hmm.fit(hmm.windows(queries.derived_transcription(spark, SMALL)))
    assert np.allclose(own.shape, model.shape, rtol=1e-4) and np.allclose(own.scale, model.scale, rtol=1e-4)
    assert got == plain_regions(model, tracks) and got


# Correction --------------------------------------------------------------------------------


def plain_correct(q, whitelist, k=5):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    if q in whitelist:
        return q, 0, None
    grams = lambda s: {s[i : i + k] for i in range(len(s) - k + 1)}
    found = sorted((d, w) for w in whitelist if grams(q) & grams(w) and (d := distance(q, w)) < len(q))
    d = [x[0] for x in found] + [len(q), len(q)]
    return (found[0][1] if found else None), d[0], d[1] - d[0] if found else 0


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_correction_by_both_ways(spark, monkeypatch, sent):
    """The index that is sent and the join by k-mers: the same rows, and the same error."""
    monkeypatch.setattr(bc, "SENT_ENTRIES", sent)
    monkeypatch.setattr(bc, "AT_ONCE", 7)
    r = random.Random(5)
    whitelist = ["".join(r.choices("ACGT", k=12)) for _ in range(60)]
    whitelist += whitelist[:3] + [whitelist[4][:-1] + "A", whitelist[4][:-1] + "C"]
    queries_ = set()
    for w in whitelist:
        q = list(w)
        for _ in range(r.randrange(4)):
            q[r.randrange(12)] = r.choice("ACGTN")
        queries_.add("".join(q))
    queries_ |= {"".join(r.choices("ACGT", k=12)) for _ in range(20)} | {w[1:] + "A" for w in whitelist[:10]}
    wl = spark.createDataFrame([(w,) for w in whitelist], "barcode string")
    got = {g["bc"]: (g["corr"], g["dist"], g["margin"]) for g in bc.best_matches(spark.createDataFrame([(q,) for q in queries_] + [(None,)], "bc string"), wl).collect()}
    assert got == {q: plain_correct(q, whitelist) for q in queries_}
    with pytest.raises(Exception, match="as long as no entry"):
        bc.best_matches(spark.createDataFrame([("ACGTACGTACG",)], "bc string"), wl).collect()
    assert bc.best_matches(spark.createDataFrame([("ACGTACGTACG",)], "bc string"), wl.limit(0)).first()["corr"] is None


def test_correction_parameters():
    assert bc.check_correction(2, 5, [2], [1, 0]) == ([2, 2], [1, 0])
    for wrong in ((0, 5, [2], [1]), (1, 0, [2], [1]), (2, 5, [1, 2, 3], [1]), (1, 5, [-1], [1])):
        with pytest.raises(ValueError):
            bc.check_correction(*wrong)


def test_reads_without_a_barcode_keep_their_columns(spark):
    wl = spark.createDataFrame([("AAAACCCC",)], "barcode string")
    calls = spark.createDataFrame([("a", ["AAAACCCC"], "u"), ("b", [None], "v"), ("c", [], "w")], "read_id string, bcs array<string>, umi string")
    got = {r["read_id"]: (r["umi"], r["parts"][0] and r["parts"][0]["corr"]) for r in bc.correct(calls, [wl], keep=["umi"]).collect()}
    assert got == {"a": ("u", "AAAACCCC"), "b": ("v", None), "c": ("w", None)}


# Alignments -----------------------------------------------------------------------------------


ALIGNMENT = f"qname string, flag int, rname string, pos long, mapq int, cigar string, tags {tg.TAGS}"


def test_duplicates_by_unclipped_ends(spark):
    rows = [("a", 0, "c", 105, 9, "5S20M"), ("b", 0, "c", 100, 9, "25M"), ("c", 16, "c", 80, 3, "20M5S"), ("d", 16, "c", 85, 7, "20M"), ("e", 0, "c", 101, 9, "2H1S24M")]
    df = spark.createDataFrame([(*r, {"CB": ("Z", "x"), "UB": ("Z", "y")}) for r in rows], ALIGNMENT)
    assert {r["qname"] for r in um.dedup_positions(df).collect()} == {"a", "d"}
    assert {r["qname"] for r in um.dedup_positions(df, compat=True).collect()} == {"a", "b", "c", "d", "e"}


def test_bam_bytes_of_odd_records(spark, tmp_path):
    tags = {"XI": ("i", "-5"), "XU": ("i", "4000000000"), "XF": ("f", "0.5"), "XA": ("A", "q"), "XZ": ("Z", "a:b"), "XB": ("B", "s,1,-2"), "XH": ("H", "1AE3")}
    rows = [
        ("r1", 99, "c10", 5, 60, "3S10M2I5M1D4M", "=", 50, 70, "ACGTN" * 4 + "ACGT", "I" * 24, tags), ("r2", 4, "*", 0, 0, "*", "*", 0, 0, "*", "*", {}),
        ("r3", 16, "c2", 2**20, 1, "5M", "c10", 7, -9, "ACGTA", "*", {"XZ": ("Z", "")}), ("r4", 0, "lost", 3, 1, "4M", "*", 0, 0, "ACGT", "IIII", {}),
    ]
    df = spark.createDataFrame(rows, f"qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags {tg.TAGS}").coalesce(1)
    refs = spark.createDataFrame([("c10", 1000), ("c2", 2**21)], "name string, length long")
    writers.bam(df, str(tmp_path / "b"), refs=refs, rows=3)
    got = {r["qname"]: (r["rname"], r["pos"], r["cigar"], r["rnext"], r["pnext"], r["seq"], r["qual"], {k: (v["type"], v["value"]) for k, v in r["tags"].items()}) for r in readers.bam(spark, str(tmp_path / "b")).collect()}
    assert got["r1"] == ("c10", 5, "3S10M2I5M1D4M", "=", 50, "ACGTN" * 4 + "ACGT", "I" * 24, tags)
    assert got["r2"][:4] == ("*", 0, "*", "*") and got["r3"][0] == "c2" and got["r3"][3] == "c10" and got["r3"][6] == "*" and got["r4"][0] == "*"
    files = sorted(p for p in (tmp_path / "b").iterdir() if p.name.startswith("part"))
    assert len(files) == 2
    for f in files:
        data = f.read_bytes()
        assert data.endswith(writers.BGZF_END) and data[12:16] == b"BC\x02\x00" and gzip.decompress(data)[:4] == b"BAM\x01"
        at = 0
        while at < len(data):  # every block says its own length
            at += int.from_bytes(data[at + 16 : at + 18], "little") + 1
        assert at == len(data)


def test_sam_parts_are_one_file(spark, tmp_path):
    df = spark.createDataFrame([("r", 0, "c1", 4, 9, "4M", "*", 0, 0, "ACGT", "IIII", {"CB": ("Z", "x")}), ("q", 0, "c1", 9, 9, "4M", "*", 0, 0, "ACGT", "IIII", {})], f"qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags {tg.TAGS}")
    writers.sam(df, str(tmp_path / "s"), header=True, order="coordinate", read_groups=["g"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "s").iterdir()) if p.name.startswith("part")).splitlines()
    assert text[:3] == ["@HD\tVN:1.6\tSO:coordinate", "@SQ\tSN:c1\tLN:12", "@RG\tID:g\tSM:g"] and text[3].startswith("@PG") and text[4].startswith("r\t0\tc1\t4")


def test_reads_of_unknown_files(spark):
    with pytest.raises(ValueError, match="no FASTQ"):
        readers.reads_of(spark, ["a.cram"])
    with pytest.raises(ValueError, match="needs files"):
        readers.reads_of(spark, [])


def test_fastq_over_many_blocks(spark, tmp_path):
    """Records cut by the edges of blocks and batches."""
    n = 4000
    text = "".join(f"@r{i} x\tz\n{'ACGT' * (i % 9)}\n+\n{'I' * 4 * (i % 9)}\n" for i in range(n))
    for name in "ab":
        (tmp_path / f"{name}.fq").write_text(text)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = [(r["read_id"], r["seq"], r["qual"], r["ord"]) for r in readers.fastq(spark, str(tmp_path / "*.fq")).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(got) == sorted(2 * [(f"r{i}", "ACGT" * (i % 9), "I" * 4 * (i % 9), i) for i in range(n)])


def test_a_folder_of_spots(spark, tmp_path):
    x = spark.createDataFrame([("g1", "AAA-1", 2.0), ("g2", "AAA-1", 3.0), ("g1", "CCC-1", 4.0), ("g2", "lost", 9.0)], "gene string, cell string, n double")
    folder = tmp_path / "array"
    (folder / "spatial").mkdir(parents=True)
    with pytest.raises(ValueError, match="h5"):
        readers.spots_folder(spark, str(folder))
    writers.matrix_market(*mx.long_to_coo(x), str(folder / "x_raw_feature_bc_matrix"))
    with pytest.raises(ValueError, match="tissue_positions"):
        readers.spots_folder(spark, str(folder))
    (folder / "spatial" / "tissue_positions.csv").write_text("barcode,in_tissue,pxl_row,pxl_col\nAAA-1,1,40,80\nCCC-1,0,8,4\nGGG-1,0,1,1\n")
    (folder / "annotation.csv").write_text("spot,region\nAAA-1,cortex\n")
    m = readers.spots_folder(spark, str(folder))
    assert sorted(map(tuple, m.obs.select("cell", "x", "y", "region").collect())) == [("AAA-1", 20.0, 10.0, "cortex"), ("CCC-1", 1.0, 2.0, None)]
    assert sorted(map(tuple, m.x.select("cell", "gene", "n").collect())) == [("AAA-1", "g1", 2.0), ("AAA-1", "g2", 3.0), ("CCC-1", "g1", 4.0)]


# Intervals ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_blocks_change_nothing(spark, block):
    r = random.Random(9)
    iv = [("c" + str(r.randrange(2)) if r.random() < 0.95 else None, r.choice("+-"), (s := r.randrange(4000)), s + r.choice([1, 9, 60, 700])) for _ in range(200)]
    df = spark.createDataFrame(iv, "chrom string, strand string, start long, end long")
    want = []
    for key in {i[:2] for i in iv}:
        open_ = None
        for _, _, a, b in sorted((i for i in iv if i[:2] == key), key=lambda i: i[2:]):
            if open_ and a <= open_[1] + 5:
                open_ = [open_[0], max(open_[1], b), open_[2] + 1]
            else:
                want += [(*key, *open_)] if open_ else []
                open_ = [a, b, 1]
        want.append((*key, *open_))
    got = [(m["chrom"], m["strand"], m["start"], m["end"], m["n"]) for m in intervals.merge_intervals(df, 5, block).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    depth = {}
    for c, _, a, b in iv:
        for at in range(a, b):
            depth[c, at] = depth.get((c, at), 0) + 1
    cover = {}
    for m in intervals.genome_coverage(df, block=block).collect():
        for at in range(m["start"], m["end"]):
            cover[m["chrom"], at] = m["depth"]
    assert cover == depth
    extra = [("c0", "+", 100, 100), ("c1", "-", 50, 50), ("c9", "+", 1, 2), *iv[:2]]
    targets = spark.createDataFrame(iv + extra, df.schema)
    for stranded in (True, False):
        want = [(*t, sum(b[0] is not None and t[0] == b[0] and (not stranded or t[1] == b[1]) and t[2] < b[3] and b[2] < t[3] for b in iv + extra)) for t in iv + extra]
        got = [tuple(r) for r in intervals.coverage(targets, targets, stranded, block).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


# Matrices, sheets and runs ------------------------------------------------------------------------


def test_turned_matrices_keep_everything(spark):
    x = spark.createDataFrame([("a", "g", 1.0), ("b", "h", 2.0)], "cell string, gene string, n double")
    m = mx.from_long(x).keep_raw().subset(cells=x.where("cell = 'a'"))
    m.obsm["spatial"] = spark.createDataFrame([("a", 1.0)], "cell string, x double")
    turned = m.transposed()
    assert [tuple(r) for r in turned.x.collect()] == [("g", "a", 1.0)] and turned.raw.count() == 2
    assert turned.obsm["spatial"].columns == ["gene", "x"] and turned.obs.columns == ["cell"] and turned.obs.first()["cell"] == "g"


def test_lists_and_sums():
    assert config.greatest_sum(["8 6", "16", ""]) == 16 and config.greatest_sum([]) == 0
    assert config.spread([3], 2) == [3, 3] and config.spread([1, 2], 2) == [1, 2]
    with pytest.raises(ValueError):
        config.spread([1, 2, 3], 2)
    assert config.read_branch("visium_rRNA-bwa_internalTrim") == ("bwa", "internal") and config.read_branch("x") == ("none", "none")


def test_checks_of_sheets():
    row = dict.fromkeys(config.RECIPE_COLUMNS, "") | {"recipe": "visium", "BC_adapter": "0", "BC_length": "16", "UMI_adapter": "16", "UMI_length": "12"}
    split = row | {"recipe": "seeker", "BC_adapter": "TCTT", "BC_length": "8 6", "BC_max_ED": "1 1"}
    recipe = config.Recipe.from_row(split)
    assert config.strategy(recipe) == "split" and config.strategy(config.Recipe.from_row(row)) == "single"
    joined = config.Recipe.from_row(split | {"BC_concat": "True"})
    assert config.strategy(joined) == "single" and config.check_compatible(joined, 14) == [] and "14 for entries of 16" in config.check_compatible(joined, 16)[0]
    sample = {"sampleID": "a", "recipe": "visium", "fastq_R1": "a.fq.gz", "fastq_R2": "b.fq.gz", "BC_map": "m", "recipe_ONT": "", "cdna_fa": ""}
    assert config.check_all([sample], [row]) == []
    assert any("comes 2 times" in w for w in config.check_all([sample, sample], [row]))
    assert any("for entries of" in w for w in config.check_all([sample], [row, split | {"BC_concat": "True"}], {"seeker": 20}))
    for wrong in (sample | {"recipe": "rRNA-bwa"}, sample | {"recipe_ONT": "visium", "ONT": "x"}):
        with pytest.raises(ValueError, match="cdna_fa"):
            config.check_all([wrong], [row])
    with pytest.raises(ValueError, match="no UMI_length"):
        config.check_all([sample], [row | {"UMI_length": ""}])
    with pytest.raises(FileNotFoundError):
        config.check_all([sample], [row], exists=lambda f: f != "b.fq.gz")


def test_long_reads_are_turned_and_split(spark):
    r = random.Random(2)
    recipe = config.Recipe("x", fwd_primer=queries.ADAPTER1)
    rows, want = [], {}
    for i in range(40):
        cdna = "".join(r.choices("ACG", k=30))
        seq = queries.ADAPTER1 + "".join(r.choices("ACG", k=28)) + "T" * 12 + cdna + turned(queries.ADAPTER2)
        rows.append((f"r{i}", turned(seq) if i % 2 else seq, "I" * len(seq)))
        full = seq[len(queries.ADAPTER1) : len(seq) - len(queries.ADAPTER2)]
        want[f"r{i}"] = len(full)
    got = pipeline.long_reads(spark.createDataFrame(rows, "read_id string, seq string, qual string"), recipe, queries.ADAPTER2).collect()
    assert {g["read_id"] for g in got} == set(want)
    for g in got:
        seq = dict((a, b) for a, b, _ in rows)[g["read_id"]]
        forward = seq if seq.startswith(queries.ADAPTER1) else turned(seq)
        whole = g["r1"]["seq"] + turned(g["r2"]["seq"])
        assert whole == forward and len(g["r1"]["seq"]) == len(g["r1"]["qual"])


def test_streams_of_corrected_reads(spark, tmp_path):
    """Files that arrive one after another, corrected by a static table, counted within a watermark."""
    folder = tmp_path / "in"
    schema = "bc string, gene string, umi string, ts timestamp"
    rows = [("AAAA", "g", "u1", "2024-01-01 00:05:00"), ("AAAT", "g", "u1", "2024-01-01 00:06:00"), ("AAAT", "g", "u2", "2024-01-01 00:07:00"), ("CCCC", "g", "u9", "2024-01-01 00:08:00"), ("AAAA", "g", "u3", "2024-01-01 03:00:00")]
    for i, some in enumerate((rows[:2], rows[2:])):
        spark.createDataFrame(some, "bc string, gene string, umi string, t string").select("bc", "gene", "umi", F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.json(str(folder / str(i)))
    table = spark.createDataFrame([("AAAA", "AAAA"), ("AAAT", "AAAA"), ("CCCC", None)], "bc string, corr string")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").json(str(folder))
    counts = streams.umi_counts(streams.corrected_stream(stream, table).withColumnRenamed("corr", "cell"))
    run = counts.writeStream.format("memory").queryName("spotweave_counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).start()
    run.processAllAvailable()
    run.stop()
    got = {(r["cell"], r["w"]["start"].hour): r["n"] for r in spark.table("spotweave_counts").collect()}
    assert got == {("AAAA", 0): 2, ("AAAA", 3): 1}


def test_coverage_filter_and_long_results(spark):
    df = spark.createDataFrame([("a", 4), ("b", 5)], "name string, n int")
    assert [r["name"] for r in intervals.at_least(df).collect()] == ["b"]
    assert spatial.reorder_dimensions(spark.createDataFrame([([1.0, 5.0],), ([1.0, 9.0],)], "embedding array<double>")).first()["embedding"] == [5.0, 1.0]
    assert [r["event"] for r in rd.first_rows(spark.createDataFrame([(3,), (1,), (2,)], "event int"), "event", 2).collect()] == [1, 2]
