"""BAM files read in pieces against one pass over the whole file."""

import gzip
import random
import struct

import pytest

from spotweave.sources import bam, readers, writers

SCHEMA = f"{readers.ALIGNMENT}, tags {readers.TAGS}"


def alignments(n, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        size = r.choice([5, 40, 151, 151, 900])
        seq = "".join(r.choices("ACGTN", k=size))
        rid = r.choice(["c1", "c2", "*"])
        tags = {"CB": ("Z", "".join(r.choices("ACGT", k=16))), "NH": ("i", str(r.randrange(5))), "ZB": ("B", "s,1,-2,3")}
        rows.append((f"read:{i}", r.choice([0, 16, 99]) if rid != "*" else 4, rid, r.randrange(1, 10**6) if rid != "*" else 0, r.randrange(61), f"{size}M" if rid != "*" else "*", "=" if rid != "*" and i % 3 == 0 else "*", i % 3 == 0 and 7 or 0, i - 50, seq, "".join(chr(33 + r.randrange(2, 41)) for _ in seq), tags))
    return rows


def shown(rows):
    return sorted((*map(str, tuple(r)[:-1]), tuple(sorted((k, *v) for k, v in r["tags"].items()))) for r in rows)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("bam") / "out"
    df = spark.createDataFrame(alignments(4000), SCHEMA).repartition(2)
    refs = spark.createDataFrame([("c1", 10**6), ("c2", 2 * 10**6)], "name string, length long")
    writers.bam(df, str(path), refs=refs, rows=100_000)
    return path


@pytest.mark.parametrize("split", [3_000, 40_000, 300_000, 10**9])
def test_pieces_hold_every_alignment_once(spark, folder, split):
    got = readers.bam(spark, str(folder), split_bytes=split)
    want = [tuple(r[:-1]) + ({k: v for k, v in r[-1].items()},) for r in alignments(4000)]
    assert shown(got.collect()) == sorted((*map(str, r[:-1]), tuple(sorted((k, *v) for k, v in r[-1].items()))) for r in want)
    sizes = [f.stat().st_size for f in folder.iterdir() if f.name.startswith("part")]
    assert got.rdd.getNumPartitions() == sum(-(-s // split) for s in sizes)


def test_one_file_is_read_by_several_tasks(spark, folder):
    from pyspark.sql import functions as F

    file = max(folder.glob("part*"), key=lambda f: f.stat().st_size)
    parts = readers.bam(spark, str(file), split_bytes=100_000).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) >= 3 and min(r["count"] for r in parts) > 0


def test_long_alignments_reach_over_pieces(spark, tmp_path):
    r = random.Random(1)
    rows = [(f"long{i}", 0, "c1", 5, 9, "*", "*", 0, 0, "".join(r.choices("ACGT", k=300_000)), "*", {}) for i in range(6)] + alignments(50)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    refs = spark.createDataFrame([("c1", 10**6), ("c2", 10**6)], "name string, length long")
    writers.bam(df, str(tmp_path / "b"), refs=refs, rows=10**6)
    for split in (5_000, 70_000):
        assert sorted(x["qname"] for x in readers.bam(spark, str(tmp_path / "b"), split_bytes=split).select("qname").collect()) == sorted(x[0] for x in rows)


def test_heads_of_blocks():
    whole = gzip.compress(b"x")
    assert bam.block_size(whole) is None and bam.block_size(b"") is None and bam.block_size(writers.BGZF_END) == len(writers.BGZF_END)
    other = b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H", 11) + b"XX" + struct.pack("<HB", 1, 0) + b"BC" + struct.pack("<HH", 2, 99)
    assert bam.block_size(other) == 100


def test_files_that_are_no_bam(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(b"plain text, no blocks")
    (tmp_path / "b.bam").write_bytes(gzip.compress(b"BAD!" + bytes(100)))
    (tmp_path / "c.bam").write_bytes(gzip.compress(b"BAM\1" + struct.pack("<ii", 0, 0) + struct.pack("<i", 400) + bytes(20)))
    (tmp_path / "d.bam").write_bytes(gzip.compress(b"BAM\1" + struct.pack("<ii", 0, 0)))
    for name, said in (("a", "not a BAM file"), ("b", "not a BAM file"), ("c", "cut off")):
        with pytest.raises(Exception, match=said):
            readers.bam(spark, str(tmp_path / f"{name}.bam")).collect()
    assert readers.bam(spark, str(tmp_path / "d.bam")).collect() == []
    with pytest.raises(Exception, match="missing"):
        readers.bam(spark, str(tmp_path / "missing.bam")).collect()
