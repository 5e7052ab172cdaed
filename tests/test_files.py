import gzip
import struct

import pytest
from pyspark.sql import functions as F

from spotweave.sources import readers, writers


def test_fastq_round_trip_over_blocks(spark, tmp_path):
    reads = [(f"r{i}", "ACGT" * (i % 9 + 1), "@" * (4 * (i % 9 + 1))) for i in range(500)]
    text = "".join(f"@{a} extra\n{s}\n+\n{q}\n" for a, s, q in reads)
    (tmp_path / "plain.fq").write_text(text)
    with gzip.open(tmp_path / "packed.fq.gz", "wt") as f:
        f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        for name in ("plain.fq", "packed.fq.gz"):
            got = sorted(readers.fastq(spark, str(tmp_path / name)).select("ord", "read_id", "seq", "qual").collect())
            assert [tuple(r)[1:] for r in got] == reads
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    df = readers.fastq(spark, str(tmp_path / "plain.fq"))
    writers.fastq(df, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in readers.fastq(spark, str(tmp_path / "out")).select("read_id", "seq", "qual").collect()) == sorted(reads)
    with pytest.raises(ValueError):
        readers.fastq_pair(spark, ["a"], [])


def test_sam_round_trip(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nr1\t16\tchr1\t5\t60\t3M2N4M\t*\t0\t0\tACGTACG\tIIIIIII\tCB:Z:A:C\tNH:i:2\n")
    df = readers.sam(spark, str(tmp_path / "a.sam"))
    r = df.first()
    assert r["tags"]["CB"]["value"] == "A:C" and r["tags"]["NH"]["type"] == "i" and r["pos"] == 5
    writers.sam(df, str(tmp_path / "o"))
    assert readers.sam(spark, str(tmp_path / "o")).first() == r


def test_bam(spark, tmp_path):
    name, seq = b"r1\0", "ACGTN"
    codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0]
    packed = bytes((codes[i] << 4) | codes[i + 1] for i in range(0, 6, 2))
    body = struct.pack("<iiBBHHHiiii", 0, 9, len(name), 30, 0, 1, 16, 5, -1, -1, 0) + name + struct.pack("<I", 5 << 4) + packed + bytes([40] * 5) + b"CBZACG\0NHC\x03"
    data = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000) + struct.pack("<i", len(body)) + body
    half = len(data) // 2
    (tmp_path / "a.bam").write_bytes(b"".join(gzip.compress(x) for x in (data[:half], data[half:])))
    r = readers.bam(spark, str(tmp_path / "a.bam")).first()
    assert (r["qname"], r["rname"], r["pos"], r["cigar"], r["seq"], r["qual"]) == ("r1", "chr1", 10, "5M", "ACGTN", "IIIII")
    assert r["tags"]["CB"]["value"] == "ACG" and r["tags"]["NH"]["value"] == "3"


def test_annotation_and_sequences(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('# c\nchr1\tx\tgene\t11\t20\t.\t+\t.\tgene_id "G1"; tag "a"; tag "b"; note "two words";\nchr2\tx\texon\t1\t2\t.\t-\t.\tgene_id "G2";\n')
    df = readers.gtf(spark, str(tmp_path / "a.gtf"), feature="gene")
    assert df.first()["attributes"] == {"gene_id": "G1", "tag": "b", "note": "two words"}
    assert tuple(writers.gtf_to_bed(df).first()) == ("chr1", 10, 20, "G1", ".", "+")
    (tmp_path / "a.fa").write_text(">T1|x|rRNA|\nACG\nTTT\n>T2 cdna gene_biotype:lncRNA\nAC\n")
    fa = readers.fasta_fields(readers.fasta(spark, str(tmp_path / "a.fa")))
    assert sorted((r["id"], r["seq"], r["biotype"]) for r in fa.collect()) == [("T1", "ACGTTT", "rRNA"), ("T2", "AC", "lncRNA")]
    assert readers.rrna_records(fa, ["rRNA"]).count() == 1 and writers.records_to_gtf(fa, "rRNA").count() == 1


def test_matrix_folder(spark, tmp_path):
    from spotweave.operators.matrix import long_to_coo

    counts = spark.createDataFrame([("g1", "a", 2.0), ("g2", "b", 3.0)], "gene string, cell string, n double")
    writers.matrix_market(*long_to_coo(counts), str(tmp_path / "m"))
    m = readers.matrix_folder(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, m.x.collect())) == [("a", "g1", 2.0), ("b", "g2", 3.0)]


def test_small_tables(spark, tmp_path):
    (tmp_path / "w.txt").write_text("ACGT-1\n TTTT \n\n")
    assert sorted(map(tuple, readers.whitelist(spark, str(tmp_path / "w.txt")).collect())) == [("ACGT", 1), ("TTTT", 2)]
    (tmp_path / "e.txt").write_text("\n")
    with pytest.raises(ValueError):
        readers.whitelist(spark, str(tmp_path / "e.txt"))
    (tmp_path / "t.tsv").write_text("#x\na\tb\tc\nd\te\n")
    assert sorted(map(tuple, readers.tsv(spark, str(tmp_path / "t.tsv"), ["id", "last"], [0, -1]).collect())) == [("a", "c"), ("d", "e")]
    (tmp_path / "q.txt").write_text(">>>>>>> Reads\n\nreads aligned  = 1,234 (56.7%)\n>>>>>>> Bias\nx = 2\n")
    assert sorted(map(tuple, readers.qualimap(spark, str(tmp_path / "q.txt")).drop("file").collect())) == [("Bias", "x", "2"), ("Reads", "reads aligned", "1234")]
    (tmp_path / "l.csv").write_text("A,B\ng1,g2\n,g3\n")
    assert sorted(map(tuple, readers.gene_lists(spark, str(tmp_path / "l.csv")).collect())) == [("A", "g1"), ("B", "g2"), ("B", "g3")]
    writers.by_value(spark.createDataFrame([("x", "1")], "lab string, id string"), "lab", "id", str(tmp_path / "v"))
    assert spark.read.text(str(tmp_path / "v")).select(F.col("lab")).first()[0] == "x"


def test_streaming_counts(spark, tmp_path):
    from spotweave.streaming.reads import umi_counts

    src, out = str(tmp_path / "in"), str(tmp_path / "memory")
    data = [("c", "g", "AA", "2024-01-01 00:01:00"), ("c", "g", "AA", "2024-01-01 00:02:00"), ("c", "g", "AT", "2024-01-01 00:03:00"), ("z", "z", "z", "2024-01-02 00:00:00")]
    spark.createDataFrame(data, "cell string, gene string, umi string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    stream = spark.readStream.schema("cell string, gene string, umi string, ts timestamp").parquet(src)
    q = umi_counts(stream).writeStream.format("memory").queryName("umis").outputMode("append").option("checkpointLocation", out).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r["cell"], r["n"]) for r in spark.table("umis").collect()] == [("c", 2)]
