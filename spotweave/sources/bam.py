"""BAM files read in pieces: a data source whose partitions are ranges of a file's compressed bytes.

A BAM file is a row of compressed blocks that tell their own size.  A task looks
for the first block of its range (a block's head, and another at the place to
which its size points), inflates blocks from there, and reads the alignments that
start in them, into the next range's blocks for what the last one still needs.
Where in its first block an alignment starts is not written anywhere: each place is tried,
and taken if a chain of records from there on has fields that fit each other and
the header.  A file of plain gzip members, without sizes, is one range.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from spotweave.sources.stores import file_system, files

#: Compressed bytes of a range, and rows of a batch.
SPLIT, BATCH = 32 << 20, 5000
#: Records of a chain that vouch for its first one, and inflated bytes that are looked through for it at once.
CHAIN, LOOK = 6, 1 << 18
#: Fixed: a block is this long at most.
BLOCK = 1 << 16


def block_size(head: bytes) -> int | None:
    """The length of the block that begins with ``head``, or None if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return None
    end = 12 + struct.unpack_from("<H", head, 10)[0]
    at = 12
    while at + 4 <= min(end, len(head)):
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


def first_block(file, start: int, size: int) -> int:
    """The place of the first block from ``start`` on, or the file's end."""
    at = start
    while at < size:
        file.seek(at)
        data = file.read(2 * BLOCK + 64)
        found = data.find(b"\x1f\x8b\x08\x04")
        while 0 <= found < BLOCK:
            length = block_size(data[found : found + 512])
            if length is not None:
                after = at + found + length
                if after == size or block_size(data[found + length : found + length + 512]) is not None:
                    return at + found
            found = data.find(b"\x1f\x8b\x08\x04", found + 1)
        at += BLOCK
    return size


def blocks(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, inflated bytes) of the blocks from one on."""
    while at < size:
        file.seek(at)
        data = file.read(BLOCK)
        length = block_size(data[:512])
        if length is None or length > len(data):
            raise ValueError(f"no whole block at byte {at}")
        yield at, zlib.decompressobj(31).decompress(data[:length])
        at += length


def members(file, size: int) -> Iterator[tuple[int, bytes]]:
    """(0, inflated bytes), piece by piece, of a file of plain gzip members."""
    file.seek(0)
    left = b""
    while True:
        left = left or file.read(BLOCK)
        if not left:
            return
        member = zlib.decompressobj(31)
        while not member.eof:
            if not left and not (left := file.read(BLOCK)):
                raise ValueError("a gzip member is cut off")
            yield 0, member.decompress(left)
            left = b""
        left = member.unused_data


def fits(data, at: int, n_refs: int) -> int | None:
    """The end of what may be an alignment at ``at``, past the data maybe; None if its fields can't be."""
    if at + 36 > len(data):
        return len(data)
    size, rid, pos, l_name, _, _, n_cigar, _, l_seq, nrid, npos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if size < 32 or not (-1 <= rid < n_refs and -1 <= nrid < n_refs and pos >= -1 and npos >= -1 and l_name >= 1 and l_seq >= 0):
        return None
    if 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq > size:
        return None
    name = bytes(data[at + 36 : at + 36 + l_name])
    if len(name) == l_name and (name[-1] or any(not 33 <= c <= 126 for c in name[:-1])):
        return None
    ops = bytes(data[at + 36 + l_name : at + 36 + l_name + 4 * n_cigar])
    if any(c & 15 > 8 for c in ops[::4]):
        return None
    return at + 4 + size


def first_record(data, n_refs: int, last: bool) -> int | None:
    """The first place of ``data`` from which a chain of records goes on; None where more data has to be seen.

    A chain is CHAIN records long, or ends with the data if this is the file's ``last``.
    """
    for at in range(len(data)):
        here, links = at, 0
        while links < CHAIN and here < len(data) and (end := fits(data, here, n_refs)) is not None:
            here, links = end, links + 1
        if links == CHAIN and here <= len(data) or last and links and here == len(data):
            return at
        if links and here >= len(data) and not last:
            return None
    return None


@dataclass
class Range(InputPartition):
    """Alignments that start in blocks which begin from ``start`` up to ``end``; ``sized`` is False for a file without block sizes."""

    path: str
    start: int
    end: int
    size: int
    sized: bool


class BamReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT))

    def partitions(self) -> list[Range]:
        system, _ = file_system(self.path)
        out = []
        for f in files(self.path):
            with system.open_input_file(f.path) as file:
                head = file.read(512)
            if head and head[:2] != b"\x1f\x8b":
                raise ValueError(f"not a BAM file: {f.path}")
            if block_size(head) is None:
                out += [Range(f.path, 0, f.size, f.size, False)] if f.size else []
            else:
                out += [Range(f.path, at, min(at + self.split, f.size), f.size, True) for at in range(0, f.size, self.split)]
        return out

    def read(self, run: Range | None) -> Iterator[pa.RecordBatch]:
        if run is None:  # no files
            return
        from spotweave.sources.readers import alignment

        held: list[tuple] = []
        system, _ = file_system(self.path)
        with system.open_input_file(run.path) as file:
            for data, at, names in starts(file, run):
                held.append(alignment(data, at, names))
                if len(held) == BATCH:
                    yield as_batch(held)
                    held = []
        if held:
            yield as_batch(held)


def _head(pieces: Iterator[tuple[int, bytes]]) -> tuple[list[str], bytearray, int, list[tuple[int, int]]]:
    """The reference names of a file's head, the data it came with, the place of the first alignment there, and (place in the data, block) of its pieces."""
    from spotweave.sources.readers import bam_references

    data, edges = bytearray(), []
    for block, piece in pieces:
        edges.append((len(data), block))
        data += piece
        if len(data) >= 4:
            try:
                names, at = bam_references(data)
                return names, data, at, edges
            except IndexError:
                continue
    raise ValueError("not a BAM file, or one cut short in its header")


def starts(file, run: Range) -> Iterator[tuple[bytearray, int, list[str]]]:
    """(data, place, reference names) of each alignment that starts in the range's blocks."""
    names, data, at, edges = _head(blocks(file, 0, run.size) if run.sized else members(file, run.size))
    if run.start:
        begin = first_block(file, run.start, run.size)
        if begin >= run.end:
            return
        pieces, data, edges, at = blocks(file, begin, run.size), bytearray(), [], None
    elif run.sized:
        pieces = blocks(file, edges[-1][1], run.size)
        next(pieces)  # the last block that the header was read from
    else:
        pieces = members(file, run.size)
        seen = 0
        while seen < len(edges):
            next(pieces)
            seen += 1

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            edges.append((len(data), piece[0]))
            data.extend(piece[1])
        return piece is not None

    if at is None:
        last, look = False, LOOK
        while at is None and not last:
            while not last and len(data) < look:
                last = not more()
            at, look = first_record(data, len(names), last), 4 * look
        if at is None:
            return
    while True:
        while len(data) < at + 4 and more():
            pass
        if len(data) <= at:
            return
        # The block that holds this place: the last piece that begins by it.
        while len(edges) > 1 and edges[1][0] <= at:
            edges.pop(0)
        if edges[0][1] >= run.end and run.sized:
            return
        end = at + 4 + struct.unpack_from("<i", data, at)[0] if len(data) >= at + 4 else len(data) + 1
        while len(data) < end and more():
            pass
        if len(data) < end:
            raise ValueError(f"the last alignment of {run.path} is cut off")
        yield data, at, names
        at = end
        if at >= 4 * BLOCK:
            del data[:at]
            edges[:] = [(p - at, b) for p, b in edges]
            at = 0


def _types() -> pa.Schema:
    from spotweave.sources.readers import ALIGNMENT

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "bigint": pa.int64()}
    fields = [pa.field(n, kinds[t]) for n, t in (x.split() for x in ALIGNMENT.split(", "))]
    return pa.schema([*fields, pa.field("tags", pa.map_(pa.string(), pa.struct([("type", pa.string()), ("value", pa.string())])))])


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = _types()
    columns = [list(c) for c in zip(*rows, strict=True)]
    columns[-1] = [list(t.items()) for t in columns[-1]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        from spotweave.sources.readers import ALIGNMENT, TAGS

        return f"{ALIGNMENT}, tags {TAGS}"

    def reader(self, schema) -> BamReader:
        return BamReader(self.options)


def read_bam(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """Alignments of a BAM file or a folder of them, a task for each ``split_bytes`` of compressed data."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("splitBytes", split_bytes or SPLIT).load(path)
