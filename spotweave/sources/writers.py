"""Sinks: text formats through Spark's writers; NULLs become the formats' marks only here."""

from __future__ import annotations

import re
import struct
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fastq(reads: DataFrame, path: str, compression: str = "gzip") -> None:
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual").alias("value")).write.text(path, compression=compression)


def sam_line() -> Column:
    tags = F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat_ws(":", e["key"], e["value"]["type"], e["value"]["value"]))
    fixed = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in fixed], tags)


def references(alignments: DataFrame) -> DataFrame:
    """(name, length) of the sequences aligned to, as long as their alignments reach."""
    covered = F.expr("aggregate(regexp_extract_all(cigar, '(\\\\d+)[MDN=X]', 1), 0L, (a, x) -> a + cast(x as long))")
    rows = alignments.where("rname <> '*'").groupBy(F.col("rname").alias("name")).agg(F.max(F.col("pos") - 1 + covered).alias("length"))
    return rows.select("name", F.greatest("length", F.lit(1)).alias("length"))


def header_lines(refs: list[tuple[str, int]], order: str = "unknown", read_groups: list[str] = (), program: str = "spotweave") -> list[str]:
    """@HD, @SQ, @RG (ids, which name samples too) and @PG lines."""
    lines = [f"@HD\tVN:1.6\tSO:{order}", *(f"@SQ\tSN:{n}\tLN:{k}" for n, k in refs)]
    return [*lines, *(f"@RG\tID:{g}\tSM:{g}" for g in read_groups), f"@PG\tID:{program}\tPN:{program}"]


def _collected(alignments: DataFrame, refs: DataFrame | None) -> list[tuple[str, int]]:
    """References in version order: a dimension of chromosomes or transcripts, one short row each."""
    from spotweave.operators.tags import version_key

    refs = references(alignments) if refs is None else refs
    return [(r["name"], r["length"]) for r in refs.orderBy(version_key("name"), "name").collect()]


def sam(alignments: DataFrame, path: str, by_chromosome: bool = False, header: bool = False, refs: DataFrame | None = None, order: str = "unknown", read_groups: list[str] = ()) -> None:
    """Text SAM; by chromosome, unmapped ones apart.

    With a ``header`` its lines are the first part of the folder, so that the
    parts one after another are one SAM file; ``refs`` (name, length) are
    taken from the alignments unless given.
    """
    rows = alignments.select(sam_line().alias("value"), F.when(F.col("flag").bitwiseAND(4) != 0, "unmapped").otherwise(F.col("rname")).alias("chromosome"))
    if by_chromosome:
        if header:
            raise ValueError("a header goes with one SAM file, not with a folder a chromosome")
        rows.write.partitionBy("chromosome").text(path)
        return
    out = rows.select("value")
    if header:
        lines = header_lines(_collected(alignments, refs), order, read_groups)
        out = alignments.sparkSession.createDataFrame([(x,) for x in lines], "value string").coalesce(1).union(out)
    out.write.text(path)


#: The last block of every BGZF file, and the most bytes that a block holds before it is deflated.  Fixed values of the format.
BGZF_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BGZF_BYTES = 65_280
_BASE_CODES = {b: i for i, b in enumerate("=ACMGRSVTWYHKDBN")}
_OP_CODES = {c: i for i, c in enumerate("MIDNSHP=X")}


def bgzf(data: bytes) -> bytes:
    """``data`` as gzip members of bounded size that say how long they are."""
    out = []
    for at in range(0, len(data), BGZF_BYTES):
        part = data[at : at + BGZF_BYTES]
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(part) + z.flush()
        out.append(struct.pack("<4BI2BH2B2H", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<2I", zlib.crc32(part), len(part)))
    return b"".join(out)


def _bin(begin: int, end: int) -> int:
    """The smallest bin of the index's binning scheme that holds [begin, end)."""
    end -= 1
    for shift, base in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if begin >> shift == end >> shift:
            return base + (begin >> shift)
    return 0


def bam_header(refs: list[tuple[str, int]], text: str) -> bytes:
    data = [b"BAM\1", struct.pack("<i", len(text.encode())), text.encode(), struct.pack("<i", len(refs))]
    for name, length in refs:
        data.append(struct.pack("<i", len(name.encode()) + 1) + name.encode() + b"\0" + struct.pack("<i", length))
    return b"".join(data)


def _bam_tag(name: str, kind: str, value: str) -> bytes:
    head = name.encode() + kind.encode()
    if kind == "A":
        return head + value.encode()[:1]
    if kind == "i":
        n = int(value)
        return name.encode() + (b"i" + struct.pack("<i", n) if -(2**31) <= n < 2**31 else b"I" + struct.pack("<I", n))
    if kind == "f":
        return head + struct.pack("<f", float(value))
    if kind == "B":
        sub, *items = value.split(",")
        form = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}[sub]
        return head + sub.encode() + struct.pack("<i", len(items)) + struct.pack(f"<{len(items)}{form}", *[(float if sub == "f" else int)(x) for x in items])
    return head + value.encode() + b"\0"


def bam_record(row: dict, ids: dict[str, int]) -> bytes:
    """One alignment (the columns of the SAM reader) as a BAM record."""
    ops = [(int(n), c) for n, c in re.findall(r"(\d+)([MIDNSHP=X])", row["cigar"] or "*")]
    span = sum(n for n, c in ops if c in "MDN=X") or 1
    rid = ids.get(row["rname"], -1)
    nid = rid if row["rnext"] == "=" else ids.get(row["rnext"], -1)
    seq = "" if row["seq"] in (None, "*") else row["seq"]
    codes = [_BASE_CODES.get(b.upper(), 15) for b in seq] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True))
    qual = b"\xff" * len(seq) if row["qual"] in (None, "*") or len(row["qual"]) != len(seq) else bytes(ord(c) - 33 for c in row["qual"])
    name = row["qname"].encode() + b"\0"
    pos = row["pos"] - 1
    fixed = struct.pack("<iiBBHHHiiii", rid, pos, len(name), row["mapq"], _bin(max(pos, 0), max(pos, 0) + span), len(ops), row["flag"], len(seq), nid, row["pnext"] - 1, row["tlen"])
    tags = b"".join(_bam_tag(k, t["type"], t["value"]) for k, t in sorted((row["tags"] or {}).items()))
    body = fixed + name + b"".join(struct.pack("<I", n << 4 | _OP_CODES[c]) for n, c in ops) + packed + qual + tags
    return struct.pack("<i", len(body)) + body


def bam(alignments: DataFrame, path: str, refs: DataFrame | None = None, order: str = "unknown", read_groups: list[str] = (), rows: int = 500_000) -> None:
    """A folder of BAM files of at most ``rows`` alignments each, every one with the header, written by Spark's own writer to any store.

    A file is one string of bytes, but for its last byte, which is that of
    the end block and the writer's line separator.  References are a small
    dimension; an alignment to a name that isn't among them is unmapped.
    """
    known = _collected(alignments, refs)
    ids = {n: i for i, (n, _) in enumerate(known)}
    head = bam_header(known, "\n".join(header_lines(known, order, read_groups)) + "\n")
    names = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", "tags"]

    def encode(batches):
        done, held, size, n = [bgzf(head)], [], 0, 0

        def whole():
            return pa.RecordBatch.from_arrays([pa.array([b"".join([*done, bgzf(b"".join(held)), BGZF_END[:-1]])], pa.binary())], ["data"])

        for batch in batches:
            for row in batch.to_pylist():
                row["tags"] = dict(row["tags"] or [])
                record = bam_record(row, ids)
                held.append(record)
                size, n = size + len(record), n + 1
                if size >= 16 * BGZF_BYTES:
                    done.append(bgzf(b"".join(held)))
                    held, size = [], 0
                if n >= rows:
                    yield whole()
                    done, held, size, n = [bgzf(head)], [], 0, 0
        if n:
            yield whole()

    data = alignments.select(*names).mapInArrow(encode, "data binary")
    data.select(F.col("data").cast("string").alias("value")).write.option("lineSep", BGZF_END[-1:].decode()).option("maxRecordsPerFile", 1).text(path)


def tsv(df: DataFrame, path: str, header: bool = False, null: str = "-", compression: str | None = None) -> None:
    """Delimited text; arrays are spread with tabs, NULLs are ``null``."""
    cols = []
    for name, kind in df.dtypes:
        if kind.startswith("array"):
            cols.append(F.array_join(F.col(name).cast("array<string>"), "\t", null).alias(name))
        else:
            cols.append(F.coalesce(F.col(name).cast("string"), F.lit(null)).alias(name))
    if any(kind.startswith("array") for _, kind in df.dtypes):
        df.select(F.concat_ws("\t", *cols).alias("value")).write.text(path, compression=compression or "none")
    else:
        df.select(*cols).write.csv(path, sep="\t", header=header, compression=compression or "none", emptyValue="")


def csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)


def correction_full(corrected: DataFrame, path: str) -> None:
    """Id and four fields a part; an exact match's margin is N, what isn't kept is '-'."""
    part = F.transform("parts", lambda p: F.concat_ws("\t", F.coalesce(p["orig"], F.lit("-")), F.coalesce(p["kept"], F.lit("-")), p["dist"].cast("string"), F.coalesce(p["margin"].cast("string"), F.lit("N"))))
    corrected.select(F.concat_ws("\t", "read_id", F.array_join(part, "\t")).alias("value")).write.text(path)


def matrix_market(coo: DataFrame, cells: DataFrame, genes: DataFrame, folder: str) -> None:
    """matrix.mtx.gz (genes by cells, 1-based), features.tsv.gz and barcodes.tsv.gz; the entries stay in sorted parts."""
    n = coo.count()
    head = coo.sparkSession.createDataFrame([("%%MatrixMarket matrix coordinate real general",), (f"{genes.count()} {cells.count()} {n}",)], "value string").coalesce(1)
    body = coo.orderBy("cell_ix", "gene_ix").select(F.concat_ws(" ", (F.col("gene_ix") + 1).cast("string"), (F.col("cell_ix") + 1).cast("string"), F.col("n").cast("string")).alias("value"))
    head.write.text(f"{folder}/matrix.mtx.gz", compression="gzip")
    body.write.mode("append").text(f"{folder}/matrix.mtx.gz", compression="gzip")
    genes.orderBy("ix").select("name").write.text(f"{folder}/features.tsv.gz", compression="gzip")
    cells.orderBy("ix").select("name").write.text(f"{folder}/barcodes.tsv.gz", compression="gzip")


def matrix_bundle(m, folder: str) -> None:
    """x, obs, var, layers and obsm as parquet."""
    for name, df in {"x": m.x, "obs": m.obs, "var": m.var, **{f"layers/{k}": v for k, v in m.layers.items()}, **{f"obsm/{k}": v for k, v in m.obsm.items()}, **({"raw": m.raw} if m.raw is not None else {})}.items():
        df.write.parquet(f"{folder}/{name}")


def by_value(df: DataFrame, column: str, value: str, path: str) -> None:
    """A folder of text for each value of a column."""
    df.select(F.col(column), F.col(value).cast("string").alias("value")).write.partitionBy(column).text(path)


def ordered_chunks(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.repartitionByRange(n, order).sortWithinPartitions(order)


def bedgraph(track: DataFrame, path: str) -> None:
    track.orderBy("chrom", "start").select("chrom", "start", "end", "value").write.csv(path, sep="\t", header=False)


def bed(intervals: DataFrame, path: str) -> None:
    intervals.select("chrom", "start", "end", "name", "score", "strand").write.csv(path, sep="\t", header=False)


def bed_to_gtf(intervals: DataFrame, source: str = "spotweave", feature: str = "gene") -> DataFrame:
    """0-based BED to 1-based GTF lines."""
    attr = F.concat(F.lit('gene_id "'), "name", F.lit('"; transcript_id "'), "name", F.lit('";'))
    return intervals.select(F.concat_ws("\t", "chrom", F.lit(source), F.lit(feature), (F.col("start") + 1).cast("string"), F.col("end").cast("string"), F.lit("."), "strand", F.lit("."), attr).alias("value"))


def gtf_to_bed(annotation: DataFrame, name: str = "gene_id") -> DataFrame:
    return annotation.select(F.col("seqname").alias("chrom"), (F.col("start").cast("long") - 1).alias("start"), F.col("end").cast("long").alias("end"), F.col("attributes")[name].alias("name"), F.lit(".").alias("score"), "strand")


def records_to_gtf(records: DataFrame, pattern: str) -> DataFrame:
    """One exon a FASTA record whose biotype matches."""
    keep = records.where(F.col("biotype").rlike(pattern)).select(F.col("id").alias("chrom"), F.lit(0).cast("long").alias("start"), F.length("seq").cast("long").alias("end"), F.col("id").alias("name"), F.lit("+").alias("strand"))
    return bed_to_gtf(keep, feature="exon")


def coordinates_export(m, folder: str) -> None:
    """Coordinates, counts and gene names as CSV."""
    csv(m.obsm["spatial"], f"{folder}/coordinates")
    csv(m.x, f"{folder}/counts")
    csv(m.var.select("gene"), f"{folder}/genes")
