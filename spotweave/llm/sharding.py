"""Sharding by sampled splitters, under the law ``bytes``: shard sizes near equal.

Records are ordered by (60 bits of the text's md5, doc_id), which keeps equal
texts together.  A size-weighted sample of keys gives quantile boundaries;
records are range-partitioned by them, overfull ranges are subdivided by a
sample of their own, and sums within and over ranges give every record's exact
offset in bytes and rows.  The offset decides the shard, so the sample only
decides how the work is spread, never the result.

A group of equal texts goes whole to the shard of its middle if it has at most
an eighth of a shard's bytes, and is cut between records otherwise; so a shard
differs from the mean by an eighth plus one record at most.

Edge cases: a null text has 8 bytes and the checksum of no bytes; an empty
text likewise; repeated rows get places of their own; extra columns are
ignored; an empty table gives no rows; shards may stay empty when there are
fewer records than shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.llm.common import bounded, unused, written

SHARDS = 24
#: Ranges to begin with, and sampled keys; both bound what reaches the driver.
RANGES, SAMPLE = 768, 24_576
#: Bytes of text that a range stands for where there are more, and the most ranges (with 32 sampled keys each).
RANGE_BYTES, MOST_RANGES = 1 << 30, 1 << 15
#: A group is kept whole up to this part of a shard.
WHOLE = 8
LOWEST = -(2**63)


def keys(docs: DataFrame) -> DataFrame:
    """(h, doc_id, size, crc) of each row."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.conv(F.substring(F.md5(data), 1, 15), 16, 10).cast("long").alias("h"),
        F.col("doc_id").cast("long"),
        (F.octet_length(data) + 8).cast("long").alias("size"),
        F.crc32(data).alias("crc"),
    )


def _sample(rows: DataFrame, total: int, want: int) -> list[tuple[int, int]]:
    """Keys drawn with chances in proportion to size, about ``want`` of them; the draw depends on the key alone."""
    u = F.pmod(F.xxhash64("h", "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    got = rows.where(u < F.col("size") * want / max(total, 1)).select("h", F.coalesce("doc_id", F.lit(LOWEST)).alias("d"))
    return sorted((r["h"], r["d"]) for r in got.toLocalIterator())


def quantiles(sample: list[tuple[int, int]], parts: int) -> list[tuple[int, int]]:
    """Splitters at the sample's quantiles; one inside a group goes to the group's start, unless the group fills several parts."""
    cuts = [sample[i * len(sample) // parts] for i in range(1, parts)] if sample else []
    out = set()
    for i, (h, d) in enumerate(cuts):
        inside = sum(0 <= j < len(cuts) and cuts[j][0] == h for j in (i - 1, i + 1))
        out.add((h, d if inside else LOWEST))
    return sorted(out)


def in_ranges(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with the number of splitters at or before each key."""
    shared = rows.sparkSession.sparkContext.broadcast(np.array(splitters, np.int64).reshape(-1, 2))

    def locate(batches):
        hs, ds = shared.value[:, 0], shared.value[:, 1]
        for batch in batches:
            h = batch.column("h").to_numpy()
            d = batch.column("doc_id").fill_null(LOWEST).to_numpy()
            lo, hi = np.searchsorted(hs, h, "left"), np.searchsorted(hs, h, "right")
            place, tied = lo.copy(), np.flatnonzero(hi > lo)
            for a in np.unique(lo[tied]):
                own = tied[lo[tied] == a]
                place[own] = a + np.searchsorted(ds[a : hi[own[0]]], d[own], "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place.astype(np.int32))], [*batch.schema.names, "range"])

    return rows.mapInArrow(locate, "h long, doc_id long, size long, crc long, range int")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``."""
    spark = docs.sparkSession
    rows = written(keys(docs), "keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = min(MOST_RANGES, max(ranges, total // RANGE_BYTES))
    sample = max(sample, 32 * ranges)
    splitters = quantiles(_sample(rows, total, sample), ranges)
    while True:
        ranged = in_ranges(rows, splitters)
        sums = {r["range"]: (r["bytes"], r["n"]) for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
        full = [r for r, (b, n) in sums.items() if b > 3 * total / ranges and n > 100]
        if not full:
            break
        before = len(splitters)
        over = sum(sums[r][0] for r in full)
        more = _sample(ranged.where(F.col("range").isin(full)), over, sample)
        splitters = sorted({*splitters, *quantiles(more, max(2, int(2 * over * ranges / max(total, 1))))})
        if len(splitters) == before:  # what is left are rows equal in text and doc_id
            break
    base, at_byte, at_row = [], 0, 0
    for r in sorted(sums):
        base.append((r, at_byte, at_row))
        at_byte, at_row = at_byte + sums[r][0], at_row + sums[r][1]
    base = F.broadcast(spark.createDataFrame(base, "range int, byte0 long, row0 long"))

    order = Window.partitionBy("range").orderBy("h", "doc_id", "size", "crc")
    placed = (
        ranged.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(order) - 1)
        .join(base, "range")
        .select("h", "doc_id", "size", "crc", (F.col("byte0") + F.col("upto") - F.col("size")).alias("begin"), (F.col("row0") + F.col("nth")).alias("place"))
    )
    placed = written(placed, "placed")
    groups = placed.groupBy("h").agg(F.sum("size").alias("g_bytes"), F.min("begin").alias("g_begin"), F.count("*").alias("g_rows")).where("g_rows > 1")
    groups = written(groups.where(F.col("g_bytes") * (WHOLE * shards) <= total).drop("g_rows"), "groups")
    twice = F.coalesce(2 * F.col("g_begin") + F.col("g_bytes"), 2 * F.col("begin") + F.col("size"))
    sharded = placed.join(bounded(groups), "h", "left").withColumn("shard", F.least(F.lit(shards - 1), F.floor(twice * shards / (2 * total))).cast("int") if total else F.lit(0))
    # Shards are runs of the order, so the first place of each makes the slots.
    first = F.broadcast(written(sharded.groupBy("shard").agg(F.min("place").alias("first")), "first-places"))
    return sharded.join(first, "shard").select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents themselves, partitioned by shard and sorted by slot; rows are matched by doc_id and text.

    ``docs`` may not have columns named shard or slot, which the files get.
    """
    if {"shard", "slot"} & {c.lower() for c in docs.columns}:
        raise ValueError("columns named shard and slot are those of the files")
    plan = shard_by_bytes(docs, shards).select("doc_id", "shard", "slot", "text_crc32")
    crc, nth = unused(docs, "crc"), unused(docs, "nth")
    left = docs.withColumn(crc, F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    left = left.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id", crc).orderBy("doc_id"))).alias("d")
    right = plan.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "text_crc32").orderBy("shard", "slot"))).alias("p")
    on = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col(f"d.{crc}") == F.col("p.text_crc32")) & (F.col(f"d.{nth}") == F.col("p.nth"))
    joined = left.join(right, on).select(*[F.col(f"d.`{c}`") for c in docs.columns], "p.shard", "p.slot")
    joined.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
