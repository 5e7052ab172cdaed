"""WARC archives written and read through Spark's own file systems, and an external index merge.

Writing: one WARC/1.1 record a page.  Pages with equal payloads (SHA-1) form a
group; its largest page_id is a response, the others are revisits without
payload.  A record is one string, so Spark's text writer, with the blank lines
that end a record as its line separator, writes real gzip WARC files to any
shared store.  Files hold a bounded number of records, fewer where pages are long.

Reading: each archive is inflated as a stream, of one gzip member or of many
(a member a record is usual elsewhere) or of none, parsed by Content-Length,
and its payloads are hashed again.  Archives made elsewhere are read too: only
responses and revisits are captures, names of headers are taken in any case,
digests that are absent are computed, and ids and references of another form
than this module's are null.  The archives that a task reads give runs of up to RUN_ROWS
captures, sorted by (URL key, timestamp, page_id), then archive and offset, and numbered in
that order; sampled splitters cut all runs alike, equal keys among them, and
each range merges its pieces of the runs with a loser tree into globally
ordered capture histories.

Edge cases: null html is an empty payload (equal payloads of 0 bytes are
revisited too, down to ``least_bytes``); a null url becomes '-'; a null
page_id is written as 'none', comes back null, comes after all others and is
no one's response unless its group has no page_id at all; repeated rows of a
page_id share its role as response; extra columns are ignored, but for one
named as ``captured`` (where that is null or no time, as without it); an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.llm.common import bounded, fresh_path, written

#: Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of an archive, at most, and its bytes before compression, about.
FILE_RECORDS, FILE_BYTES = 1000, 64 << 20
#: Captures of a run, about, and those that a range merges in one task; keys sampled to cut ranges by, at least and for each range.
RUN_ROWS, RANGE_ROWS, SAMPLE, PER_RANGE = 20_000, 50_000, 20_000, 8
#: Captures are dated from here, one second a page_id modulo CYCLE, unless a column says when.
FIRST_CAPTURE, CYCLE = 1_700_000_000, 1_000_000_000
NO_PAGE = "none"
#: Bytes inflated at once.
INFLATE = 1 << 20


def base32_sha1(data: F.Column) -> F.Column:
    """Bare upper-case base32 of the SHA-1 of a binary column, natively: 5 hex digits make 4 letters."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, least_bytes: int = 0, captured: str | None = None) -> DataFrame:
    """(record string) of each page."""
    stamp = F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(CYCLE)))
    if captured is not None:
        stamp = F.coalesce(F.expr(f"try_cast(`{captured}` as timestamp)"), stamp)
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit("-")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    )
    base = base.withColumn("digest", base32_sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html"))
    # Groups of one page need no look-up; sums are combined before the shuffle.
    groups = base.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("to"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = bounded(written(groups, "payload-groups"))
    rows = base.join(groups, "digest", "left").withColumn("revisit", F.col("to").isNotNull() & ~F.col("to").eqNullSafe(F.col("page_id")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    body = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    id_ = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit(NO_PAGE)), F.lit(">"))
    head = F.concat(
        F.lit(VERSION + "\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", id_("page_id")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.col("date")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", id_("to")), line("WARC-Profile", F.lit(REVISIT)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(body).cast("string")),
    )
    return rows.select(F.concat(head, F.lit("\r\n"), body).alias("record"))


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, captured: str | None = None) -> None:
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0
    most = int(max(1, min(FILE_RECORDS, FILE_BYTES // (mean + 500))))
    records(pages, least_bytes, captured).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


def inflated(data) -> Iterator[bytes]:
    """The bytes of all members of a gzip file, or of one that isn't compressed, piece by piece."""
    left = memoryview(data)
    if bytes(left[:2]) != b"\x1f\x8b":
        for at in range(0, len(left), INFLATE):
            yield bytes(left[at : at + INFLATE])
        return
    while len(left):
        member, at = zlib.decompressobj(31), 0
        while not member.eof:
            more = member.unconsumed_tail or left[at : at + INFLATE]
            if not len(more):
                raise ValueError("a gzip member is cut off")
            at += 0 if member.unconsumed_tail else len(more)
            yield member.decompress(more, INFLATE)
        left = left[at - len(member.unused_data) :]


def headers(text: str) -> dict[str, str]:
    """Values by names in lower case; a line that begins with a gap goes on with the one before."""
    pairs = [line.partition(":") for line in re.sub(r"\r\n[ \t]+", " ", text).split("\r\n")]
    return {name.strip().lower(): value.strip() for name, sign, value in pairs if sign}


def parse(chunks) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(headers with names in lower case, block, offset) of each record of an uncompressed archive, given whole or in pieces."""
    chunks = iter([chunks] if isinstance(chunks, bytes) else chunks)
    held, at = bytearray(), 0

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(1):
        stop, seen = held.find(b"\r\n\r\n"), 0
        while stop < 0:
            seen = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                raise ValueError(f"the record at {at} has no end of its headers")
            stop = held.find(b"\r\n\r\n", seen)
        first, _, rest = held[:stop].decode(errors="replace").partition("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        head = headers(rest)
        begin = stop + 4
        end = begin + int(head["content-length"])
        if not fill(end + 4) or held[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} isn't ended by a blank line")
        yield head, bytes(held[begin:end]), at
        del held[: end + 4]
        at += end + 4


def url_key(url: str) -> str:
    """The URL with its host reversed, in lower case: com,example)/path?query."""
    try:
        parts = urlsplit(url.lower())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


CAPTURE = "url_key string, stamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, run string, nth long"
NAMES = [x.split()[0] for x in CAPTURE.split(", ")]
KINDS = {"string": pa.string(), "long": pa.int64()}
SCHEMA = pa.schema([(n, KINDS[k]) for n, k in (x.split() for x in CAPTURE.split(", "))])


#: The order of captures, without two alike.
ORDER = ["url_key", "stamp", "page_id", "archive", "offset"]


def order_key(url_key: str, stamp: str, page_id: int | None, archive: str = "", offset: int = 0) -> tuple:
    return url_key, stamp, page_id is None, page_id or 0, archive, offset


def _page(urn: str | None) -> int | None:
    said = re.fullmatch(r"<?urn:page:(-?[0-9]{1,19})>?", urn or "")
    return int(said[1]) if said else None


def capture(head: dict[str, str], block: bytes, archive: str, offset: int) -> tuple | None:
    """The capture that a record describes, None for records of other kinds."""
    kind = head.get("warc-type", "").lower()
    if kind not in ("response", "revisit"):
        return None
    stop = block.find(b"\r\n\r\n")
    # Some responses, as those of name servers, have no headers of their own.
    http = headers(block[:stop].decode(errors="replace")) if stop >= 0 and block.startswith(b"HTTP/") else {}
    cut = stop + 4 if stop >= 0 and block.startswith(b"HTTP/") else 0
    said = head.get("warc-payload-digest", "")
    known = said[5:].upper() if re.fullmatch("(?i)sha1:[A-Z2-7]{32}", said) else None
    page = _page(head.get("warc-record-id"))
    if kind == "response":
        size, to = len(block) - cut, None
        digest = base64.b32encode(hashlib.sha1(memoryview(block)[cut:]).digest()).decode()
        if known is not None and digest != known:
            raise ValueError(f"the payload of the record at {offset} of {archive} doesn't have its digest")
    else:
        digest, to = known, _page(head.get("warc-refers-to"))
        length = http.get("content-length", "")
        size = int(length) if length.isdecimal() else None
    url = head.get("warc-target-uri", "-").removeprefix("<").removesuffix(">")
    return url_key(url), head.get("warc-date", ""), page, size, digest, kind, to, archive, offset


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row a capture; those of the archives that a task reads come in runs sorted by ORDER, ``nth`` of their run.

    Archives are the files that end in .gz or .warc.  Types of records other than response and revisit are passed over; of a
    revisit without HTTP headers the size is null.  A run is named by its first archive.
    """

    def emit(run: list[tuple]) -> Iterator[pa.RecordBatch]:
        name = run[0][7]
        run.sort(key=lambda r: order_key(*r[:3], *r[7:9]))
        for at in range(0, len(run), 5000):
            cols = [*zip(*run[at : at + 5000], strict=True)]
            n = len(cols[0])
            cols += [[name] * n, range(at, at + n)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SCHEMA, strict=True)], schema=SCHEMA)

    def load(batches):
        run: list[tuple] = []
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                archive = name.as_py().rsplit("/", 1)[-1]
                found = (capture(*x[:2], archive, x[2]) for x in parse(inflated(content.as_buffer() if content.is_valid else b"")))
                run += [x for x in found if x is not None]
                if len(run) >= RUN_ROWS:
                    yield from emit(run)
                    run = []
        if run:
            yield from emit(run)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc}").load(path)
    return files.select("path", "content").mapInArrow(load, CAPTURE)


class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, so the next winner replays one path from leaf to root."""

    def __init__(self, runs: list[list]):
        self.runs, self.k = runs, max(1, len(runs))
        self.at = [0] * self.k
        self.tree = [-1] * self.k
        for leaf in range(self.k):
            self._replay(leaf, building=True)

    def _key(self, leaf: int):
        own = self.runs[leaf] if leaf < len(self.runs) else []
        return (0, own[self.at[leaf]], leaf) if self.at[leaf] < len(own) else (1, (), leaf)

    def _replay(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.tree[node] < 0:
                if building:
                    self.tree[node] = winner
                    return
            elif self._key(self.tree[node]) < self._key(winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        while True:
            leaf = self.tree[0]
            if leaf < 0 or leaf >= len(self.runs) or self.at[leaf] >= len(self.runs[leaf]):
                return
            yield self.runs[leaf][self.at[leaf]]
            self.at[leaf] += 1
            self._replay(leaf)


def merged_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``captures`` with ``position``, their place in the global order by (url_key, stamp, page_id), then archive and offset, by merging the runs."""
    spark = captures.sparkSession
    n = captures.count()
    parts = max(1, -(-n // range_rows))
    u = F.pmod(F.xxhash64("archive", "offset"), F.lit(1 << 30)) / float(1 << 30)
    some = captures.where(u < max(SAMPLE, PER_RANGE * parts) / max(n, 1)).select(*ORDER)
    sample = sorted(order_key(*r) for r in some.toLocalIterator())
    cuts = sorted({sample[i * len(sample) // parts] for i in range(1, parts)}) if sample else []
    shared = spark.sparkContext.broadcast(cuts)

    def cut(batches):
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ORDER), strict=True)
            at = [bisect.bisect_right(shared.value, order_key(*k)) for k in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*NAMES, "range"])

    ranged = captures.mapInArrow(cut, CAPTURE + ", range int")
    counts = {r["range"]: r["count"] for r in ranged.groupBy("range").count().collect()}
    start, at = {}, 0
    for r in sorted(counts):
        start[r], at = at, at + counts[r]

    def merge(p: pa.Table) -> pa.Table:
        # A shuffle may mix the pieces of runs; each run's own numbers give its order back.
        p = p.take(pc.sort_indices(p, [("run", "ascending"), ("nth", "ascending")]))
        keys = [order_key(*k) for k in zip(*(p.column(c).to_pylist() for c in ORDER), strict=True)]
        names = p.column("run").to_pylist()
        # Archives of one name in two folders make runs of one name; a run ends where the order does.
        edges = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1] or keys[i] < keys[i - 1]), len(names)] if names else [0]
        runs = [[(keys[i], i) for i in range(a, b)] for a, b in zip(edges, edges[1:], strict=False)]
        out = p.select(NAMES).take(pa.array([i for _, i in LoserTree(runs)], pa.int64()))
        return out.append_column("position", pa.array(np.arange(out.num_rows) + start[p.column("range")[0].as_py()]))

    return ranged.groupBy("range").applyInArrow(merge, CAPTURE + ", position long")


def archive_and_index(pages: DataFrame, path: str | None = None, least_bytes: int = 0, captured: str | None = None) -> DataFrame:
    """Write ``pages`` to archives and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, stamp, position)."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    write_warc(pages, path, least_bytes, captured)
    captures = written(read_warc(spark, path), "captures")
    return merged_index(captures).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "stamp", "position")
