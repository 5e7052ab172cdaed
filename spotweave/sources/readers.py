"""Sources: sequence, alignment, annotation, matrix and report files through Spark's own file readers, so any store works."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

READ = "read_id string, seq string, qual string"
ALIGNMENT = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string"
TAGS = "map<string,struct<type:string,value:string>>"


def _lines(spark: SparkSession, paths) -> DataFrame:
    """(file, block, value) of text lines, in file order within a block."""
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def numbered_lines(spark: SparkSession, paths) -> DataFrame:
    """(line, value): lines of all files from 0, in order of file, block and line; blocks are numbered apart and offset."""
    lines = _lines(spark, paths).withColumn("id", F.monotonically_increasing_id())
    sizes = lines.groupBy("file", "block").agg(F.count("*").alias("n"))
    w = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("base", F.coalesce(F.sum("n").over(w), F.lit(0))).drop("n")
    nth = F.row_number().over(Window.partitionBy("file", "block").orderBy("id")) - 1
    return lines.withColumn("nth", nth).join(sizes, ["file", "block"]).select((F.col("base") + F.col("nth")).alias("line"), "value")


def _read_id(header: Column, full: bool) -> Column:
    name = F.regexp_replace(F.replace(header, F.lit("@"), F.lit("")), "\t", "_")
    return name if full else F.substring_index(name, " ", 1)


def fastq(spark: SparkSession, paths, full_header: bool = False, sample: str | None = None) -> DataFrame:
    """Reads of 4-line FASTQ files (plain or compressed), with their file and ordinal.

    A first pass counts the lines of each block; knowing its first line's
    number, a block assembles its own records, a batch of lines at a time, and
    only the few lines of records cut by a block's edge are grouped.
    """
    lines = _lines(spark, paths)
    counts = lines.groupBy("file", "block").agg(F.count("*").alias("n"))
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = {(r["file"], r["block"]): r["first"] for r in counts.withColumn("first", F.coalesce(F.sum("n").over(w), F.lit(0))).collect()}
    shared = spark.sparkContext.broadcast(first)

    def assemble(batches):
        kind = pa.list_(pa.string())

        def rows(key, number, lines, each):
            """Runs of ``each`` lines as rows."""
            n = len(lines) // each
            at = (number + np.arange(n) * each) if each == 1 else number + np.arange(n) * 4
            packed = pa.ListArray.from_arrays(pa.array(np.arange(0, len(lines) + 1, each, dtype=np.int32)), lines)
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array(at // 4), pa.array((at % 4).astype(np.int32)), packed.cast(kind)], ["file", "ord", "part", "lines"])

        key, held, number = None, pa.array([], pa.string()), 0
        for batch in batches:
            files, blocks, values = (batch.column(c) for c in ("file", "block", "value"))
            f, b = files.dictionary_encode().indices.to_numpy(), blocks.to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(f) != 0) | (np.diff(b) != 0)) + 1).tolist(), len(b)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                now = (files[lo].as_py(), int(b[lo]))
                if now != key:
                    if len(held):
                        yield rows(key, number, held, 1)
                    key, held, number = now, pa.array([], pa.string()), shared.value[now]
                own = pa.concat_arrays([held, values.slice(lo, hi - lo).cast(pa.string())])
                head = min(-number % 4, len(own))
                if head:  # the rest of a record that began in another block
                    yield rows(key, number, own.slice(0, head), 1)
                whole = (len(own) - head) // 4 * 4
                if whole:
                    yield rows(key, number + head, pa.concat_arrays([own.slice(head, whole)]), 4)
                number += head + whole
                held = own.slice(head + whole)
        if len(held):
            yield rows(key, number, held, 1)

    parts = lines.mapInArrow(assemble, "file string, ord long, part int, lines array<string>")
    whole = parts.where("size(lines) = 4").select("file", "ord", "lines")
    cut = parts.where("size(lines) = 1").groupBy("file", "ord").agg(F.array_sort(F.collect_list(F.struct("part", F.col("lines")[0].alias("line")))).alias("l"))
    cut = cut.where("size(l) = 4").select("file", "ord", F.transform("l", lambda x: x["line"]).alias("lines"))
    line = F.col("lines")
    out = whole.unionByName(cut).select(_read_id(line[0], full_header).alias("read_id"), line[1].alias("seq"), line[3].alias("qual"), F.col("file").alias("src_file"), "ord")
    return out if sample is None else out.withColumn("sample", F.lit(sample))


def fastq_pair(spark: SparkSession, r1: list[str], r2: list[str]) -> DataFrame:
    """(read_id, r1, r2) of mates; the lists of files must be as long as one another."""
    if len(r1) != len(r2):
        raise ValueError("R1 and R2 need as many files")
    from spotweave.operators.reads import pair_mates

    return pair_mates(fastq(spark, r1), fastq(spark, r2))


def _tag_map(fields: Column) -> Column:
    entry = lambda x: F.struct(F.substring(x, 1, 2).alias("key"), F.struct(F.substring(x, 4, 1).alias("type"), F.substring(x, F.lit(6), F.length(x)).alias("value")).alias("value"))
    return F.map_from_entries(F.filter(F.transform(fields, entry), lambda e: F.length(e["key"]) == 2))


def reads_of(spark: SparkSession, paths: list[str], full_header: bool = False) -> DataFrame:
    """(read_id, seq, qual) of the files of one sample, in any mix of FASTQ, SAM and BAM, by their suffixes.

    Of alignments the primary ones are reads, turned back to the strand that was sequenced; CRAM is an error.
    """
    kinds: dict[str, list[str]] = {}
    for path in paths:
        name = path.rstrip("/").lower()
        kind = next((k for k, ends in (("fastq", (".fq", ".fastq", ".fq.gz", ".fastq.gz")), ("sam", (".sam", ".sam.gz")), ("bam", (".bam",))) if name.endswith(ends)), None)
        if kind is None:
            raise ValueError(f"{path} is no FASTQ, SAM or BAM file")
        kinds.setdefault(kind, []).append(path)
    out = None
    for kind, own in kinds.items():
        if kind == "fastq":
            rows = fastq(spark, own, full_header).select("read_id", "seq", "qual")
        else:
            rows = reads_from_alignments(sam(spark, own) if kind == "sam" else bam(spark, own))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("a sample needs files")
    return out


def reads_from_alignments(alignments: DataFrame) -> DataFrame:
    """(read_id, seq, qual) of primary alignments, as they were sequenced."""
    from spotweave.functions.sequences import revcomp

    reverse = F.col("flag").bitwiseAND(16) != 0
    seq = F.when(F.col("seq") == "*", "").otherwise(F.col("seq"))
    qual = F.when(F.col("qual") == "*", F.repeat(F.lit("B"), F.length(seq))).otherwise(F.col("qual"))
    return alignments.where(F.col("flag").bitwiseAND(0x900) == 0).select(
        F.col("qname").alias("read_id"), F.when(reverse, revcomp(seq)).otherwise(seq).alias("seq"), F.when(reverse, F.reverse(qual)).otherwise(qual).alias("qual")
    )


def sam_references(spark: SparkSession, paths) -> DataFrame:
    """(name, length) of the @SQ lines of text SAM files."""
    field = lambda k: F.regexp_extract("value", rf"\t{k}:([^\t]*)", 1)
    return spark.read.text(paths).where("startswith(value, '@SQ')").select(field("SN").alias("name"), field("LN").cast("long").alias("length")).distinct()


def sam(spark: SparkSession, paths) -> DataFrame:
    """Alignments of text SAM files; tag values keep their colons."""
    p = F.split("value", "\t")
    names = [x.split() for x in ALIGNMENT.split(", ")]
    rows = spark.read.text(paths).where("not startswith(value, '@') and value <> ''").select(p.alias("p"))
    return rows.select(*[F.col("p")[i].cast(t).alias(n) for i, (n, t) in enumerate(names)], _tag_map(F.slice("p", F.lit(12), F.greatest(F.size("p") - 11, F.lit(0)))).alias("tags"))


# Fixed values of the BAM format: bases of 4-bit codes, operations, value formats of tag types.
_BASES = "=ACMGRSVTWYHKDBN"
_OPS = "MIDNSHP=X"
_PAIRS = [_BASES[b >> 4] + _BASES[b & 15] for b in range(256)]
_PRINTED = bytes((b + 33) % 256 for b in range(256))
_KINDS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def bam_references(data, at: int = 0) -> tuple[list[str], int]:
    """The names of the reference sequences and the place of the first alignment, of the head of an inflated BAM file; IndexError where it is cut."""
    if bytes(data[at : at + 4]) != b"BAM\1":
        raise ValueError("not a BAM file")
    whole = len(data)

    def number(p: int) -> int:
        if p + 4 > whole:
            raise IndexError("the header goes on")
        return struct.unpack_from("<i", data, p)[0]

    at += 8 + number(at + 4)
    n, at, names = number(at), at + 4, []
    for _ in range(n):
        size = number(at)
        if at + 8 + size > whole:
            raise IndexError("the header goes on")
        names.append(bytes(data[at + 4 : at + 3 + size]).decode())
        at += 8 + size
    return names, at


def alignment(data, at: int, names: list[str]) -> tuple:
    """The row (with a dict of tags) of the alignment at a place of inflated BAM data."""
    ref = lambda i: names[i] if i >= 0 else "*"
    size = struct.unpack_from("<i", data, at)[0]
    end = at + 4 + size
    rid, pos, l_name, mapq, _, n_cigar, flag, l_seq, nrid, npos, tlen = struct.unpack_from("<iiBBHHHiiii", data, at + 4)
    p = at + 36
    name = data[p : p + l_name - 1].decode()
    p += l_name
    cigar = "".join(f"{v >> 4}{_OPS[v & 15]}" for v in struct.unpack_from(f"<{n_cigar}I", data, p)) or "*"
    p += 4 * n_cigar
    packed = data[p : p + (l_seq + 1) // 2]
    # Two bases a byte, and qualities shifted to print, by tables.
    seq = "".join(map(_PAIRS.__getitem__, packed))[:l_seq] or "*"
    p += (l_seq + 1) // 2
    q = data[p : p + l_seq]
    qual = "*" if not q or q[0] == 255 else q.translate(_PRINTED).decode("latin-1")
    p += l_seq
    tags = {}
    while p < end:
        key, kind = data[p : p + 2].decode(), chr(data[p + 2])
        p += 3
        if kind == "A":
            v, p = chr(data[p]), p + 1
        elif kind in "ZH":
            stop = data.index(0, p)
            v, p = data[p:stop].decode(), stop + 1
        elif kind == "B":
            sub, count = chr(data[p]), struct.unpack_from("<i", data, p + 1)[0]
            form = f"<{count}{_KINDS[sub]}"
            v = ",".join([sub, *map(str, struct.unpack_from(form, data, p + 5))])
            p += 5 + struct.calcsize(form)
        else:
            form = "<" + _KINDS[kind]
            v = str(struct.unpack_from(form, data, p)[0])
            p, kind = p + struct.calcsize(form), "f" if kind == "f" else "i"
        tags[key] = {"type": kind, "value": v}
    nxt = "=" if nrid >= 0 and nrid == rid else ref(nrid)
    return name, flag, ref(rid), pos + 1, mapq, cigar, nxt, npos + 1, tlen, seq, qual, tags


def bam(spark: SparkSession, paths, split_bytes: int | None = None) -> DataFrame:
    """Alignments of BAM files or folders of them, a task for each ``split_bytes`` of a file; see :mod:`spotweave.sources.bam`."""
    from spotweave.sources.bam import read_bam

    out = None
    for path in [paths] if isinstance(paths, str) else paths:
        rows = read_bam(spark, path, split_bytes)
        out = rows if out is None else out.unionByName(rows)
    return out


def tsv(spark: SparkSession, path, columns: list[str], positions: list[int] | None = None) -> DataFrame:
    """Headerless positional TSV with rows of any width; '#' lines are skipped, negative positions count from the end."""
    p = F.split("value", "\t")
    positions = positions if positions is not None else list(range(len(columns)))
    rows = spark.read.text(path).where("not startswith(value, '#')").select(p.alias("p"))
    at = lambda i: F.when(F.size("p") >= (i + 1 if i >= 0 else -i), F.element_at("p", i + 1 if i >= 0 else i))
    return rows.select(*[at(i).alias(c) for c, i in zip(columns, positions, strict=True)])


def sheet(spark: SparkSession, path) -> DataFrame:
    """Headed CSV, all strings, nothing missing but ''."""
    return spark.read.csv(path, header=True, inferSchema=False).fillna("")


def whitelist(spark: SparkSession, path) -> DataFrame:
    """(barcode, line); an empty file is an error."""
    w = Window.partitionBy("file").orderBy("block", "id")
    from spotweave.operators.barcodes import clean_whitelist

    rows = clean_whitelist(_lines(spark, path).withColumn("id", F.monotonically_increasing_id()))
    out = rows.withColumn("line", F.row_number().over(w)).select("barcode", "line")
    if not out.head(1):
        raise ValueError(f"whitelist is empty: {path}")
    return out


def bc_map(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="barcode string, x double, y double")


def gtf(spark: SparkSession, path, feature: str = "all", seqname: str = "all", unwrap: list[str] | None = None) -> DataFrame:
    """Annotation rows with attributes as a map (of repeated keys the last wins); ``unwrap`` makes columns of some."""
    # A filter on what comes out may be tried on lines that the one on '#' leaves out, so a field that isn't there is null.
    p = F.split("value", "\t")
    fields = ["seqname", "source", "feature", "start", "end", "score", "strand", "frame"]
    rows = spark.read.text(path).where("not startswith(value, '#') and value <> ''").select(*[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(fields)], F.get(p, F.lit(8)).alias("a"))
    if feature != "all":
        rows = rows.where(F.col("feature") == feature)
    if seqname != "all":
        rows = rows.where(F.col("seqname") == seqname)
    # The last of repeated keys, without a session setting: keep an entry unless its key comes again.
    pairs = F.transform(F.filter(F.transform(F.split("a", ";"), lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.struct(F.substring_index(x, " ", 1).alias("k"), F.replace(F.trim(F.substring(x, F.instr(x, " ") + 1, F.length(x))), F.lit('"'), F.lit("")).alias("v")))
    rows = rows.withColumn("e", pairs)
    last = F.filter("e", lambda x, i: ~F.exists(F.slice("e", i + 2, F.size("e")), lambda y: y["k"] == x["k"]))
    out = rows.select(*fields, F.map_from_entries(last).alias("attributes"))
    return out if unwrap is None else out.select(*fields, *[F.col("attributes")[k].alias(k) for k in unwrap])


def attribute_keys(annotation: DataFrame) -> list[str]:
    return sorted(r[0] for r in annotation.select(F.explode(F.map_keys("attributes"))).distinct().collect())


def fasta(spark: SparkSession, path) -> DataFrame:
    """(header, seq) of multi-line records; a record begins with '>' at the start of a line, and its header may hold more."""
    rec = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^\\s*>", "").alias("value")).where("trim(value) <> ''")
    p = F.split("value", "\n", 2)
    return rec.select(F.rtrim(p[0]).alias("header"), F.regexp_replace(F.coalesce(F.get(p, F.lit(1)), F.lit("")), r"\s", "").alias("seq"))


def fasta_fields(records: DataFrame) -> DataFrame:
    """GENCODE ('|') or Ensembl (space) headers: id, biotype and the other fields."""
    bar = F.col("header").contains("|")
    fields = F.when(bar, F.split("header", r"\|")).otherwise(F.split("header", " "))
    filled = F.filter(fields, lambda x: x != "")
    biotype = F.when(bar, F.element_at(filled, -1)).otherwise(F.regexp_extract("header", r"gene_biotype:(\S+)", 1))
    return records.withColumns({"id": fields[0], "biotype": biotype})


def record_counts(records: DataFrame | None = None, annotation: DataFrame | None = None) -> DataFrame:
    """(what, n): FASTA records and annotation rows by feature, as build logs report them."""
    out = None
    if records is not None:
        out = records.agg(F.lit("records").alias("what"), F.count("*").alias("n"))
    if annotation is not None:
        rows = annotation.groupBy(F.col("feature").alias("what")).agg(F.count("*").alias("n"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("nothing to count")
    return out


#: Features in the order in which parents come before what they hold.
NESTING = ["gene", "transcript", "mRNA", "exon", "CDS", "start_codon", "stop_codon"]


def sorted_annotation(annotation: DataFrame) -> DataFrame:
    """Annotation rows by sequence and start; of those that begin together the longest first, then parents before children."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in NESTING]), F.col("feature")), F.lit(0))
    return annotation.orderBy("seqname", F.col("start").cast("long"), F.col("end").cast("long").desc(), F.when(rank > 0, rank).otherwise(len(NESTING) + 1), "feature")


def rrna_records(records: DataFrame, keywords: list[str]) -> DataFrame:
    """Records whose header contains a keyword."""
    return records.where(F.exists(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains("header", k)))


def mtx(spark: SparkSession, path) -> DataFrame:
    """(row, col, value), 0-based, of a MatrixMarket file."""
    lines = _lines(spark, path)
    rows = lines.where("not startswith(value, '%') and trim(value) <> ''").withColumn("id", F.monotonically_increasing_id())
    # Entries may be spread over files; the one with the banner has the line of sizes.
    banner = lines.where("startswith(value, '%%MatrixMarket')").select("file").distinct()
    size = rows.where("block = 0").join(F.broadcast(banner), "file").groupBy("file").agg(F.min("id").alias("first"))
    p = F.split(F.trim("value"), r"\s+")
    body = rows.join(F.broadcast(size), "file", "left").where("first is null or id <> first")
    return body.select((p[0].cast("int") - 1).alias("row"), (p[1].cast("int") - 1).alias("col"), p[2].cast("double").alias("value"))


def counts_long(spark: SparkSession, path) -> DataFrame:
    """(gene, cell, n) of a headed TSV, zeros dropped."""
    rows = spark.read.csv(path, sep="\t", header=True)
    return rows.toDF("gene", "cell", "n").withColumn("n", F.col("n").cast("double")).where("n <> 0")


def counts_wide(spark: SparkSession, path, gene: str | None = None) -> DataFrame:
    """(gene, cell, n) of a headed table with a gene column (the first, unless named) and one column a cell, zeros dropped."""
    rows = spark.read.csv(path, sep="\t", header=True)
    gene = gene or rows.columns[0]
    cells = [c for c in rows.columns if c != gene]
    return rows.unpivot([F.col(f"`{gene}`")], [F.col(f"`{c}`") for c in cells], "cell", "n").toDF("gene", "cell", "n").withColumn("n", F.col("n").cast("double")).where("n <> 0")


def listed(spark: SparkSession, folder: str) -> dict[str, bool]:
    """The names in a folder of any store, with whether they are folders; nothing for one that isn't there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName(): f.isDirectory() for f in fs.listStatus(path)} if fs.exists(path) else {}


def matrix_bundle(spark: SparkSession, folder: str):
    """The Matrix that the writer of the same name has written."""
    from spotweave.operators.matrix import Matrix

    read = lambda sub: spark.read.parquet(f"{folder}/{sub}")
    some = lambda sub: {k: read(f"{sub}/{k}") for k, inner in listed(spark, f"{folder}/{sub}").items() if inner}
    return Matrix(read("x"), read("obs"), read("var"), some("layers"), some("obsm"), read("raw") if "raw" in listed(spark, folder) else None)


def spots_folder(spark: SparkSession, folder: str, scale: float = 0.25):
    """A Matrix of the spots of an array, by parts of file names: counts, positions and, where there is one, an annotation.

    Counts are a folder of MatrixMarket files named like raw_feature_bc_matrix
    (an .h5 file is an error), positions a headed CSV in a folder named like
    spatial, of which the last two columns are pixel row and column, here
    scaled as the image is; only spots with a position stay.  The image itself
    isn't read.
    """
    from dataclasses import replace

    from spotweave.operators.matrix import place_in_space

    names = listed(spark, folder)
    one = lambda part, inner, of: next((n for n, is_folder in sorted(of.items()) if part in n and is_folder == inner), None)
    counts, spatial, notes = one("raw_feature_bc_matrix", True, names), one("spatial", True, names), one("annotation", False, names)
    if counts is None:
        raise ValueError(f"{folder} has no folder of MatrixMarket files for raw_feature_bc_matrix; .h5 files aren't read")
    positions = spatial and one("tissue_positions", False, listed(spark, f"{folder}/{spatial}"))
    if not positions:
        raise ValueError(f"{folder} has no tissue_positions")
    at = spark.read.csv(f"{folder}/{spatial}/{positions}", header=True)
    barcode, row, col = at.columns[0], at.columns[-2], at.columns[-1]
    place = lambda c: (F.col(f"`{c}`").cast("double") * scale)
    m = place_in_space(matrix_folder(spark, f"{folder}/{counts}"), at.select(F.col(f"`{barcode}`").alias("barcode"), place(col).alias("x"), place(row).alias("y")))
    if notes:
        note = spark.read.csv(f"{folder}/{notes}", header=True)
        m = replace(m, obs=m.obs.join(note.withColumnRenamed(note.columns[0], "cell"), "cell", "left"))
    return m


def bed(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema="chrom string, start long, end long, name string, score string, strand string")


def gene_lists(spark: SparkSession, path, names: DataFrame | None = None) -> DataFrame:
    """(list, name): each column is a list, blanks skipped, only known names where there are more than one."""
    wide = sheet(spark, path)
    out = wide.unpivot([], wide.columns, "list", "name").where("trim(name) <> ''")
    if names is not None and len(names.head(2)) > 1:
        out = out.join(names.toDF("name"), "name", "left_semi")
    return out.select("list", "name")


def report_lines(lines: DataFrame, order: str, value: str = "value", by: list[str] = ("file",)) -> DataFrame:
    """(*by, section, key, value): section headings carried forward within a report, values cleaned; ``by`` tells reports apart."""
    from spotweave.functions.sequences import report_number

    heading = F.when(F.col(value).startswith(">>>>>>> "), F.trim(F.substring(F.col(value), 9, 1 << 30)))
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    named = lines.withColumn("section", F.last(heading, True).over(w)).where(F.col(value).contains(" = "))
    p = F.split(value, " = ", 2)
    return named.select(*by, "section", F.trim(p[0]).alias("key"), report_number(p[1]).alias("value"))


def qualimap(spark: SparkSession, path) -> DataFrame:
    return report_lines(_lines(spark, path).withColumn("id", F.monotonically_increasing_id()), "id")


def cutadapt_json(spark: SparkSession, paths) -> DataFrame:
    rows = spark.read.schema("read_counts struct<input:long,read1_with_adapter:long,read2_with_adapter:long,output:long>").json(paths, multiLine=True)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("read_counts.input").alias("total_reads"), F.col("read_counts.read1_with_adapter").alias("reads_with_adapters"), F.col("read_counts.read2_with_adapter").alias("reads2_with_adapters"), F.col("read_counts.output").alias("reads_written"))


def matrix_folder(spark: SparkSession, folder: str):
    """A Matrix from matrix.mtx.gz, barcodes.tsv.gz and features.tsv.gz (genes by cells)."""
    from spotweave.operators.matrix import Matrix

    def names(file, key):
        return numbered_lines(spark, f"{folder}/{file}").select(F.col("line").alias("ix"), F.split("value", "\t")[0].alias(key))

    cells, genes = names("barcodes.tsv.gz", "cell"), names("features.tsv.gz", "gene")
    x = mtx(spark, f"{folder}/matrix.mtx.gz")
    x = x.join(genes.withColumnRenamed("ix", "row"), "row").join(cells.withColumnRenamed("ix", "col"), "col").select("cell", "gene", F.col("value").alias("n"))
    return Matrix(x, cells.select("cell"), genes.select("gene"))
