"""BUS files: fixed-width records of barcode, UMI and equivalence class, read in pieces by offset, and what is counted from them.

A file has a header (magic, version, lengths of barcode and UMI, length of a
text, the text) and records of 32 bytes.  Files are cut into runs of records,
so one file is read by many tasks; barcodes and UMIs are two bits a base, most
significant base first.  Reading and writing run in Arrow batches of tasks: the
driver keeps a Python process of its own for each step that it plans of a data
source, which is there for ``spark.read.format("bus")`` alone.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from spotweave.operators.quantify import one_mismatch
from spotweave.sources.scratch import written
from spotweave.sources.stores import file_system, files

#: Fixed layout.
MAGIC, VERSION, HEAD = b"BUS\x00", 1, struct.Struct("<4s4I")
RECORD = np.dtype([("barcode", "<u8"), ("umi", "<u8"), ("ec", "<i4"), ("count", "<u4"), ("flags", "<u4"), ("pad", "<u4")])
BASES = np.frombuffer(b"ACGT", np.uint8)
SCHEMA = "barcode string, umi string, ec int, count long, flags long"
#: Records that a task reads, and those of one batch.
SPLIT, BATCH = 1 << 21, 1 << 15
#: Tasks a core that read small runs, and that write records down for correction.
RUNS = 4


def encode(strings: pa.Array, length: int) -> np.ndarray:
    """Two bits a base of strings of one length over ACGT; anything else is an error."""
    data, n = strings.cast(pa.large_string()), len(strings)
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    at = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + n + 1]
    if data.null_count or (np.diff(at) != length).any():
        raise ValueError(f"a sequence is missing or not {length} bases long")
    code = np.full(256, 255, np.uint8)
    code[BASES] = np.arange(4)
    digits = code[np.frombuffer(data.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]].reshape(n, length)
    if (digits == 255).any():
        raise ValueError("bases other than A, C, G and T can't be written")
    for i in range(length):
        out = out << np.uint64(2) | digits[:, i].astype(np.uint64)
    return out


def decode(codes: np.ndarray, length: int) -> pa.Array:
    shift = (2 * np.arange(length - 1, -1, -1)).astype(np.uint64)
    text = BASES[((codes[:, None] >> shift) & np.uint64(3)).astype(np.uint8)]
    ends = pa.py_buffer(np.arange(0, length * len(codes) + 1, max(length, 1), dtype=np.int32) if length else np.zeros(len(codes) + 1, np.int32))
    return pa.Array.from_buffers(pa.string(), len(codes), [None, ends, pa.py_buffer(np.ascontiguousarray(text))])


@dataclass
class Run(InputPartition):
    """Records of one file, from an offset on."""

    path: str
    offset: int
    records: int
    barcode: int
    umi: int


class BusReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("splitrecords", SPLIT))

    def partitions(self) -> list[Run]:
        system, _ = file_system(self.path)
        out = []
        for f in files(self.path):
            with system.open_input_file(f.path) as file:
                head = file.read(HEAD.size)
                magic, version, barcode, umi, text = HEAD.unpack(head) if len(head) == HEAD.size else (b"", 0, 0, 0, 0)
            first = HEAD.size + text
            if magic != MAGIC or version != VERSION or barcode > 32 or umi > 32 or (f.size - first) % RECORD.itemsize or f.size < first:
                raise ValueError(f"not a BUS file of version {VERSION}, or one cut short: {f.path}")
            n = (f.size - first) // RECORD.itemsize
            out += [Run(f.path, first + at * RECORD.itemsize, min(self.split, n - at), barcode, umi) for at in range(0, n, self.split)]
        return out

    def read(self, run: Run | None) -> Iterator[pa.RecordBatch]:
        if run is None:  # no records anywhere
            return
        system, _ = file_system(self.path)
        with system.open_input_file(run.path) as file:
            file.seek(run.offset)
            for at in range(0, run.records, BATCH):
                r = np.frombuffer(file.read(min(BATCH, run.records - at) * RECORD.itemsize), RECORD)
                columns = [decode(r["barcode"], run.barcode), decode(r["umi"], run.umi), pa.array(r["ec"]), pa.array(r["count"].astype(np.int64)), pa.array(r["flags"].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["barcode", "umi", "ec", "count", "flags"])


@dataclass
class Done(WriterCommitMessage):
    held: str | None


class BusWriter(DataSourceArrowWriter):
    """A file a task, under a hidden name until the whole write is committed, so a task that ran twice leaves one."""

    def __init__(self, options):
        self.path, self.lengths, self.id = options["path"], (int(options["barcodelength"]), int(options["umilength"])), uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Done:
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        held, file = f"{path}/.{self.id}-{uuid.uuid4().hex}.bus", None
        try:
            for batch in batches:
                r = np.zeros(batch.num_rows, RECORD)
                for name, length in zip(("barcode", "umi"), self.lengths, strict=True):
                    r[name] = encode(batch.column(name), length)
                for name in ("ec", "count", "flags"):
                    if batch.column(name).null_count:
                        raise ValueError(f"{name} is missing")
                    r[name] = batch.column(name).to_numpy()
                if file is None:
                    file = system.open_output_stream(held)
                    file.write(HEAD.pack(MAGIC, VERSION, *self.lengths, 0))
                file.write(r.tobytes())
        finally:
            if file is not None:
                file.close()
        return Done(held if file is not None else None)

    def commit(self, messages: list[Done | None]) -> None:
        system, path = file_system(self.path)
        for i, done in enumerate(m for m in messages if m is not None and m.held):
            system.move(done.held, f"{path}/part-{i:05d}.bus")
        self.abort(messages)

    def abort(self, messages: list[Done | None]) -> None:
        """What this write has left under hidden names goes, that of tasks which ran twice as well."""
        system, path = file_system(self.path)
        for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if f.is_file and f.base_name.startswith(f".{self.id}-"):
                system.delete_file(f.path)


class BusSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bus"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BusReader:
        return BusReader(self.options)

    def writer(self, schema, overwrite: bool) -> BusWriter:
        return BusWriter(self.options)


def read_bus(spark: SparkSession, path: str, split_records: int = SPLIT) -> DataFrame:
    """(barcode, umi, ec, count, flags) of a BUS file or a folder of them, a task for each ``split_records``, or for several of them where they are many and small."""
    reader = BusReader({"path": path, "splitrecords": split_records})
    runs = reader.partitions()
    tasks = min(len(runs), max(RUNS * spark.sparkContext.defaultParallelism, sum(r.records for r in runs) // SPLIT))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column(0).to_pylist():
                for run in runs[task::tasks]:
                    yield from reader.read(run)

    return spark.range(0, tasks, 1, max(1, tasks)).mapInArrow(read, SCHEMA)


def write_bus(records: DataFrame, path: str, barcode_length: int, umi_length: int) -> None:
    """Records as a folder of BUS files, one a task that has any."""
    typed = records.select("barcode", "umi", F.col("ec").cast("int"), F.col("count").cast("long"), F.col("flags").cast("long"))
    writer = BusWriter({"path": path, "barcodelength": barcode_length, "umilength": umi_length})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"held": pa.array([writer.write(batches).held], pa.string())})

    try:
        done = typed.mapInArrow(write, "held string").collect()  # a name a task
    except Exception:
        writer.abort([])
        raise
    writer.commit([Done(x.held) for x in done])


# Records -----------------------------------------------------------------------


def corrected(records: DataFrame, whitelist: DataFrame, entry: str = "barcode") -> DataFrame:
    """Records whose barcode is listed, or differs in one base from exactly one entry, which it becomes; others go."""
    listed = written(whitelist.select(F.col(entry).alias("to")).distinct(), "whitelist")
    # Written once, some runs of a file a task: each read of files starts Python for every run, and the driver keeps processes for each that it plans.
    records = written(records.coalesce(RUNS * records.sparkSession.sparkContext.defaultParallelism), "records")
    seen = records.select("barcode").distinct()
    # Sizes are guessed from files, which hold ids in place of barcodes: without hints the whitelist would be sent to all.
    others = seen.join(listed.withColumnRenamed("to", "barcode").hint("merge"), "barcode", "left_anti")
    near = one_mismatch(others, listed, "barcode", "to").groupBy("barcode").agg(F.min("to").alias("to"), F.count("*").alias("n")).where("n = 1").drop("n")
    exact = listed.select(F.col("to").alias("barcode"), "to")
    return records.join(exact.unionByName(near).hint("merge"), "barcode").withColumn("barcode", F.col("to")).drop("to")


def sorted_records(records: DataFrame) -> DataFrame:
    """Records in order of barcode, UMI, class and flags; equal ones are one, with their counts summed."""
    by = ["barcode", "umi", "ec", "flags"]
    return records.groupBy(*by).agg(F.sum("count").alias("count")).orderBy(*by).select("barcode", "umi", "ec", "count", "flags")


def inspected(records: DataFrame, whitelist: DataFrame | None = None) -> DataFrame:
    """(what, n): records, reads, distinct barcodes and UMIs of them, and with a whitelist the reads and barcodes on it."""
    by_barcode = records.groupBy("barcode").agg(F.count("*").alias("records"), F.sum("count").alias("reads"), F.count_distinct("umi").alias("umis"))
    listed = F.lit(None).cast("string")
    if whitelist is not None:
        by_barcode = by_barcode.join(whitelist.select(F.col("barcode"), F.lit("x").alias("on")).distinct(), "barcode", "left")
        listed = F.col("on")
    total = by_barcode.agg(
        F.sum("records").alias("records"), F.sum("reads").alias("reads"), F.count("*").alias("barcodes"), F.sum("umis").alias("umis"),
        F.sum(F.when(listed.isNotNull(), F.col("reads"))).alias("listed_reads"), F.count(listed).alias("listed_barcodes"),
    )
    names = ["records", "reads", "barcodes", "umis"] + (["listed_reads", "listed_barcodes"] if whitelist is not None else [])
    return total.select(F.explode(F.array(*[F.struct(F.lit(n).alias("what"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("n")) for n in names])).alias("x")).select("x.*")


def class_genes(spark: SparkSession, classes: str, transcripts: str, genes: DataFrame) -> DataFrame:
    """(ec, gene): the genes of each equivalence class, from its file (class, transcript numbers), the transcripts' names in order of number, and (transcript, gene)."""
    from spotweave.sources.readers import numbered_lines

    p = F.split("value", "\t")
    members = spark.read.text(classes).where("trim(value) <> ''").select(p[0].cast("int").alias("ec"), F.explode(F.split(p[1], ",")).alias("line")).withColumn("line", F.col("line").cast("long"))
    names = numbered_lines(spark, transcripts).select("line", F.col("value").alias("transcript"))
    return members.join(names, "line").join(genes.select("transcript", "gene"), "transcript").select("ec", "gene").distinct()


def molecule_genes(records: DataFrame, genes: DataFrame) -> DataFrame:
    """(cell, umi, gene): the genes that all classes of a molecule share; one whose classes share none has no row."""
    own = records.select(F.col("barcode").alias("cell"), "umi", "ec").distinct()
    many = own.groupBy("cell", "umi").agg(F.count("*").alias("k"))
    held = own.join(genes.select("ec", "gene").distinct(), "ec").groupBy("cell", "umi", "gene").agg(F.count("*").alias("n"))
    return held.join(many.hint("merge"), ["cell", "umi"]).where("n = k").select("cell", "umi", "gene")


def gene_counts(molecules: DataFrame) -> DataFrame:
    """(cell, gene, n): molecules that fit one gene.  Those that fit several are for :func:`spotweave.operators.quantify.em_counts`."""
    one = molecules.groupBy("cell", "umi").agg(F.min("gene").alias("gene"), F.count("*").alias("k")).where("k = 1")
    return one.groupBy("cell", "gene").agg(F.count("*").alias("n"))
