import random

import pytest
from pyspark.sql import functions as F

from spotweave.operators import barcodes as bc
from spotweave.operators import hmm, intervals, spatial
from spotweave.operators import matrix as mx
from spotweave.operators import reads as rd
from spotweave.operators import tags as tg
from spotweave.operators import umis as um
from spotweave.plans import config


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Barcodes ---------------------------------------------------------------------


@pytest.mark.parametrize("sent", [10**6, 0])
def test_correction(spark, monkeypatch, sent):
    monkeypatch.setattr(bc, "SENT_ENTRIES", sent)
    wl = spark.createDataFrame([("AAAACCCC",), ("AAAACCCG",), ("GGGGTTTT",), ("ACACACAC",), ("ACACACAC",)], "barcode string")
    calls = spark.createDataFrame([("tie", ["AAAACCCT"]), ("one", ["GGGGTTTA"]), ("none", ["CTCTCTCT"]), ("exact", ["GGGGTTTT"]), ("twice", ["ACACACAG"])], "read_id string, bcs array<string>")
    got = bc.correct(calls, [wl])
    by = {r["read_id"]: r["parts"][0].asDict() for r in got.collect()}
    assert (by["tie"]["corr"], by["tie"]["dist"], by["tie"]["margin"], by["tie"]["kept"]) == ("AAAACCCC", 1, 0, None)
    assert (by["one"]["corr"], by["one"]["dist"], by["one"]["margin"], by["one"]["kept"]) == ("GGGGTTTT", 1, 7, "GGGGTTTT")
    assert (by["none"]["corr"], by["none"]["dist"], by["none"]["margin"]) == (None, 8, 0)
    assert (by["exact"]["corr"], by["exact"]["dist"], by["exact"]["margin"]) == ("GGGGTTTT", 0, None)
    assert by["twice"]["margin"] == 0
    assert {r["read_id"] for r in bc.slim(got).collect()} == {"tie", "one", "exact", "twice"}
    assert {r["read_id"] for r in bc.slim(got, True).collect()} == {"one", "exact"}


def test_barcode_of_another_length_is_an_error(spark):
    wl = spark.createDataFrame([("AAAACCCC",)], "barcode string")
    with pytest.raises(Exception, match="as long as"):
        bc.best_matches(spark.createDataFrame([("AAAACCCCG",)], "bc string"), wl).collect()


def test_calls(spark):
    reads = spark.createDataFrame([("a", "TTTTACGTACGTGGGG"), ("b", "ACG")], "read_id string, seq string")
    left = rd.Element("ACGTACGT", 4, 0, "left")
    got = {r["read_id"]: (r["bcs"], r["umis"]) for r in rd.call_barcodes(reads, [left], [rd.Element("ACGTACGT", 4)]).collect()}
    assert got == {"a": (["TTTT"], ["GGGG"]), "b": ([None], [None])}
    assert rd.call_stats(rd.call_barcodes(reads, [left])).first()["no_bc_count"] == 1


# Orientation ----------------------------------------------------------------------

A1, A2 = "CTACACGACGCTCTTCCGATCT", "CCCATGTACTCTGCGTTGATACCACTG"
FLIP = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s[::-1].translate(FLIP)


def test_every_paired_outcome(spark):
    m = "AGTC" * 15
    cases = {
        A1 + m + rc(A2): ("+", "full_len", 22, 82), A1 + m: ("+", "adapter1_single", 22, 82), m + rc(A2): ("+", "adapter2_single", 0, 60),
        A2 + m + rc(A1): ("-", "full_len", 27, 87), m + rc(A1): ("-", "adapter1_single", 82, 82), A2 + m: ("-", "adapter2_single", 0, 0),
        A1 + m + rc(A1): ("=", "adapter1_double", 22, 82), rc(A2) + m + A2: ("=", "adapter2_double", 27, 87), m: ("=", "no_adapters", 0, 60),
    }
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(cases)], "read_id string, seq string")
    got = {r["read_id"]: r for r in rd.adapter_scan(df, [A1], [A2]).collect()}
    for i, (s, want) in enumerate(cases.items()):
        r = got[str(i)]
        assert (r["strand"], r["lab"]) == want[:2], (i, r)
        if want[1] in ("full_len", "adapter1_double", "adapter2_double", "no_adapters"):
            assert (r["start"], r["end"]) == want[2:], (i, r)
        assert r["readlen"] == len(s)


def test_single_ended():
    assert rd.single_ended([A1], []) and rd.single_ended([A1], [rc(A1)]) and not rd.single_ended([A1], [A2])


def test_split_and_trim(spark):
    read = A1 + "ACGTACGTACGTACGT" + "GATTACAGATTA" + "T" * 12 + "GCGCGATCGATCGGATCTAGCGCGATC"
    df = spark.createDataFrame([("a", read, "I" * len(read)), ("b", "ACGT", "IIII")], "read_id string, seq string, qual string")
    got = {r["read_id"]: r for r in rd.split_reads(df, A1, "TTTTTTTT").collect()}
    assert got["b"]["status"] == "no_anchor" and got["a"]["status"] == "written"
    assert rc(got["a"]["r2"]["seq"]) == read[len(got["a"]["r1"]["seq"]) :]
    link = "TCTTCAGCGTTCCCGAGA"
    df = spark.createDataFrame([("exact", "AAAACCCC" + link + "GGGGTT"), ("short", "AAACCCC" + link + "GGGGTT"), ("long", "AAAACCCCC" + link + "GGGGTT"), ("none", "ACGTACGTAC")], "read_id string, seq string")
    got = {r["read_id"]: (r["seq"], r["status"]) for r in rd.internal_trim(df.withColumn("qual", F.col("seq")), [link]).collect()}
    assert got == {"exact": ("AAAACCCCGGGGTT", "exact"), "short": ("NTGGGGTT", "deletion"), "long": ("AAAACCCCGGGGTT", "insertion"), "none": ("N", "missing")}


def test_adapter_trimming(spark):
    df = spark.createDataFrame([("a", "NACGTACGTCTGTCTCTTATACACATCT", "I" * 28), ("q", "ACGTACGT", "IIII####")], "read_id string, seq string, qual string")
    got = {r["read_id"]: r["seq"] for r in rd.trim_adapters(df, ["CTGTCTCTTATACACATCT"]).collect()}
    assert got == {"a": "ACGTACGT", "q": "ACGT"}


# Tags -------------------------------------------------------------------------------


def tagged(spark, values):
    df = spark.createDataFrame([(f"r{i}_BC_UM", v) for i, v in enumerate(values)], "qname string, v string")
    return tg.with_tag(df.withColumn("tags", F.expr(f"cast(map() as {tg.TAGS})")), "CB", F.col("v"))


def test_tag_predicates(spark):
    df = tagged(spark, ["A:B", "-", None, "7"])
    names = lambda d: sorted(r["qname"][:2] for r in d.collect())
    assert names(tg.tag_filled(df, "CB")) == ["r0", "r3"] and names(tg.tag_present(df, "CB")) == ["r0", "r1", "r3"]
    assert names(tg.tag_empty(df, "CB")) == ["r1"] and names(tg.tag_at_least(df, "CB", 7)) == ["r3"] and names(tg.tag_at_most(df, "CB", 7)) == []
    assert [r[0] for r in df.select(tg.value("CB")).collect()] == ["A:B", "-", None, "7"]
    moved = tg.combine(tg.id_to_tags(df), ["CR", "UR"], "XB").select(tg.value("XB")).collect()
    assert {r[0] for r in moved} == {"BCUM"}
    assert tg.drop(df, ["CB"]).where(F.map_contains_key("tags", F.lit("CB"))).count() == 0


def test_attach_keeps_all_and_last_wins(spark):
    table = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "-", 3), ("b", "NA", 1)], "id string, v string, o int")
    al = spark.createDataFrame([("a",), ("a",), ("b",)], "qname string").withColumn("tags", F.expr(f"cast(map() as {tg.TAGS})"))
    out = tg.attach(al, tg.tag_table(table, "id", ["v"], "o"), {"CB": "v"})
    assert rows(out.select("qname", tg.value("CB"))) == [("a", "y"), ("a", "y"), ("b", None)]


def test_version_sort(spark):
    df = spark.createDataFrame([("chr10", 1), ("chr2", 5), ("chrX", 1), ("chr2", 3)], "rname string, pos int")
    assert [tuple(r) for r in tg.coordinate_sort(df).collect()] == [("chr2", 3), ("chr2", 5), ("chr10", 1), ("chrX", 1)]


# UMIs -----------------------------------------------------------------------------------


def test_directional_counts(spark):
    data = [("c", "g", "AAAA")] * 10 + [("c", "g", "AAAT")] * 3 + [("c", "g", "AATT")] * 2 + [("c", "g", "CCCC")] * 2 + [("c", "g", "CCCG")] * 2 + [("d", "g", "AAAA")]
    df = spark.createDataFrame(data, "cell string, gene string, umi string")
    assert rows(um.count_exact(df)) == [("c", "g", 5), ("d", "g", 1)]
    assert rows(um.count_directional(df)) == [("c", "g", 3), ("d", "g", 1)]


# Matrices ---------------------------------------------------------------------------------


def test_coo_and_layers(spark):
    counts = spark.createDataFrame([("g2", "b", 1.0), ("g1", "a", 2.0), ("g1", "a", 3.0), ("g3", "c", 0.0)], "gene string, cell string, n double")
    coo, cells, genes = mx.long_to_coo(counts)
    assert rows(coo) == [(0, 0, 5.0), (1, 1, 1.0)] and rows(cells) == [(0, "a"), (1, "b")] and rows(genes) == [(0, "g1"), (1, "g2")]
    m = mx.place_in_space(mx.from_long(counts), spark.createDataFrame([("a", 1.0, 2.0), ("z", 0.0, 0.0)], "barcode string, x double, y double"))
    assert rows(m.obs) == [("a", 1.0, 2.0)] and rows(m.x) == [("a", "g1", 5.0)]
    assert rows(mx.cell_qc(m.x, spark.createDataFrame([("a",), ("q",)], "cell string"))) == [("a", 5.0, 1), ("q", 0.0, 0)]
    with pytest.raises(ValueError, match="more than once"):
        mx.annotate_genes(genes, spark.createDataFrame([("g1",), ("g1",)], "name string"), "name")
    names = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "o int, name string")
    assert [r["unique_name"] for r in mx.make_unique(names, "name", "o").orderBy("o").collect()] == ["x", "x-1", "y"]


# Intervals -----------------------------------------------------------------------------------


def test_overlaps_against_nested_loops(spark):
    r = random.Random(2)
    iv = [(f"n{i}", "c" + str(i % 2), (s := r.randrange(3000)), s + r.randrange(1, 900), r.choice("+-")) for i in range(120)]
    df = spark.createDataFrame(iv, "name string, chrom string, start long, end long, strand string")
    want = sorted((a[0], b[0]) for a in iv for b in iv[:40] if a[1] == b[1] and a[4] == b[4] and a[2] < b[3] and b[2] < a[3])
    b = spark.createDataFrame(iv[:40], df.schema)
    assert rows(intervals.overlaps(df, b, stranded=True, width=100).selectExpr("l.name", "r.name")) == want
    plan = intervals.overlaps(df, b, width=100)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    hit = {a for a, _ in want}
    assert {r["name"] for r in intervals.coverage(df, b).where("n > 0").collect()} == hit


def test_merge_gap(spark):
    df = spark.createDataFrame([("c", "+", 0, 10), ("c", "+", 15, 20), ("c", "+", 26, 30), ("c", "-", 0, 1)], "chrom string, strand string, start long, end long")
    assert [r[2:4] for r in rows(intervals.merge_intervals(df, 5))] == [(0, 20), (26, 30), (0, 1)]


# Space -----------------------------------------------------------------------------------------


def test_grid_join_and_filter(spark):
    r = random.Random(4)
    pts = [(i, r.random(), r.random()) for i in range(150)]
    df = spark.createDataFrame(pts, "cell long, x double, y double")
    near = lambda some: {i: sum((x - a) ** 2 + (y - b) ** 2 < 0.08**2 for _, a, b in some) for i, x, y in some}
    assert dict(rows(spatial.neighbour_counts(df, 0.08))) == near(pts)
    left = pts
    while len(kept := [p for p in left if near(left)[p[0]] > 3]) < len(left):
        left = kept
    assert {r["cell"] for r in spatial.drop_singlets(df, 0.08, 3, 50).collect()} == {p[0] for p in left}
    square = spatial.in_polygon(df, [(0.2, 0.2), (0.8, 0.2), (0.8, 0.7), (0.2, 0.7)])
    assert {r["cell"] for r in square.where("roi").collect()} == {i for i, x, y in pts if 0.2 < x < 0.8 and 0.2 < y < 0.7}


def test_rotation_keeps_the_centroid(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 2.0, 0.0)], "cell int, x double, y double")
    got = {r["cell"]: (round(r["x"], 9), round(r["y"], 9)) for r in spatial.rotate(df, 90).collect()}
    assert got == {1: (1.0, 1.0), 2: (1.0, -1.0)}


def test_segments_are_sequential(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 2.0, 0.0), (3, 9.0, 0.0)], "cell int, x double, y double")
    got = [r["segment"] for r in spatial.segment_tissues(df, threshold=1.0).orderBy("cell").collect()]
    assert got == ["0", "0", "0", "1"]


def test_hmm_finds_a_dense_run(spark):
    r = random.Random(1)
    reads = [("c", "+", r.randrange(5000, 8000)) for _ in range(3000)] + [("c", "+", r.randrange(20000)) for _ in range(60)]
    got = hmm.transcribed_regions(spark.createDataFrame(reads, "chrom string, strand string, start long")).collect()
    assert any(abs(g["start"] - 5000) <= 200 and abs(g["end"] - 8000) <= 400 for g in got)


# Recipes -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("cell,want", [("8 6", [8, 6]), ("10 10", [10, 10]), ("16", [16]), ("25", [25])])
def test_cells(cell, want):
    assert [int(v) for v in config.cells(cell)] == want


def test_recipe(spark):
    row = dict.fromkeys(config.RECIPE_COLUMNS, "") | {"recipe": "s", "BC_adapter": "TCTT", "BC_length": "8 6", "BC_position": "left right", "BC_offset": "0", "BC_max_ED": "2", "BC_concat": "True", "UMI_adapter": "16", "UMI_length": "12", "UMI_offset": "9"}
    r = config.Recipe.from_row(row)
    assert [(e.length, e.side) for e in r.barcodes] == [(8, "left"), (6, "right")] and r.concat and r.umis[0].anchor == 16
    with pytest.raises(ValueError):
        config.check_recipes([row | {"BC_length": "x"}])
    with pytest.raises(FileNotFoundError):
        config.check_samples([{"sampleID": "a", "recipe": "s", "fastq_R1": "x.fq.gz", "fastq_R2": "y.fq.gz", "BC_map": "m"}], {"s"}, exists=lambda f: False)
    assert config.whitelist_files("seeker_std", True, "ONT") == ["whitelist.txt"] and config.whitelist_files("x_matchLinker", False, "ILMN") == ["whitelist_uniq_1.txt", "whitelist_uniq_2.txt"]


def test_alignment_qc_keeps_one_row_an_alignment(spark):
    from spotweave.operators import tags as tg
    from spotweave.operators.reads import alignment_qc

    rows = [("r1", 0, "AACCCG"), ("r1", 256, "AACCCG"), ("r2", 4, "T"), ("r3", 0, "")]
    df = tg.with_tag(spark.createDataFrame(rows, "qname string, flag int, seq string").withColumn("tags", F.expr(f"cast(map() as {tg.TAGS})")), "CB", F.col("qname"))
    out = sorted(alignment_qc(df, ["CB"]).collect(), key=lambda r: (r["Read_ID"], r["is_secondary"]))
    assert [(r["Read_ID"], r["is_secondary"], r["is_unmapped"], r["Longest_Homopolymer"], r["CB"]) for r in out] == [("r1", False, False, 3, "r1"), ("r1", True, False, 3, "r1"), ("r2", False, True, 1, "r2")]
