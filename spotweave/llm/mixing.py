"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is an exponential variate divided by its quality weight, so
small keys first is weighted sampling without replacement.  A source whose
target is k whole sizes and a rest takes k complete epochs, then documents in
key order while the running sum of words stays nearest the rest.

Keys are spread over buckets, the more the more rows there are; sums for each
(source, bucket) find the one bucket in which a source's rest ends, and only
that bucket is sorted.  So a source with a third of all rows is never sorted
in one task.  The sources themselves, one row each, are ordered in one task.

Edge cases: null or empty text has size 0 and takes 0; a null source is a
source of its own, ordered last; repeated rows are separate documents with
equal keys; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.llm import text as tx
from spotweave.llm.common import bounded, unused, written

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Rows of all sources that a bucket holds, about, and the fewest and most buckets.
BUCKET_ROWS, FEWEST, MOST = 4096, 4096, 1 << 20
#: Rows of the whole table for which a file of the sums, which have a row a source and bucket at most, is written.
PART_ROWS = 1_000_000
#: Characters a word that make a document's quality weight 1; it falls with the distance.
WORD_CHARS = 6.0


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, tid, size, chars) with the number of words and of code points of each whole text; tid is a hash of it."""

    def make(batches):
        for batch in tx.text_slices(batches, "text"):
            data, off = tx.raw(batch.column("text"))
            gap = tx.GAP[data]
            begin = np.ones(len(data), bool)
            begin[1:] = gap[:-1]
            begin[off[:-1][off[:-1] < len(data)]] = True
            words = np.concatenate(([0], np.cumsum(begin & ~gap)))
            chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), batch.column("tid"), pa.array(words[off[1:]] - words[off[:-1]]), pa.array(chars[off[1:]] - chars[off[:-1]])],
                ["doc_id", "source", "tid", "size", "chars"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64("text").alias("tid"), "text").mapInArrow(
        make, "doc_id long, source string, tid long, size long, chars long"
    )


def source_targets(by_source: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight, capped at ``most`` sizes, the excess reshared.

    Filling in the order of cap over weight, a source is capped if its cap is at most its share of what the capped ones before it left.
    """
    every = Window.partitionBy()
    ranked = by_source.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        ranked.withColumn("w", w)
        .withColumn("cap", (most * F.col("source_size")).cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("all", F.sum("source_size").over(every).cast("double"))
        .withColumn("left", F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("capped", F.col("cap") * F.col("left_w") <= F.col("left") * F.col("w"))
    )
    free = F.sum(F.when(~F.col("capped"), F.col("w"))).over(every)
    given = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0))
    share = (F.col("all") - given) * F.col("w") / free
    return filled.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(share).alias("target"))


def unit(*cols, seed: int) -> F.Column:
    """A reproducible uniform variate in (0, 1) from 52 bits of md5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") + 0.5) / float(2**52)


def mix_sources(docs: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS, seed: int = 11) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) for each row of ``docs``."""
    return _mix(docs, weights, most, seed).drop("tid")


def _mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS, seed: int = 11) -> DataFrame:
    quality = 1 / (1 + F.abs(F.col("chars") / F.greatest(F.col("size"), F.lit(1)) - WORD_CHARS) / 4)
    key = -F.log(unit("doc_id", "size", seed=seed)) / F.col("weight")
    rows = (
        sizes(docs)
        .withColumn("weight", F.greatest(quality, F.lit(0.05)))
        .withColumn("key", key)
        .drop("chars", "weight")
    )
    rows = written(rows, "sizes")
    n = rows.count()
    buckets = min(MOST, max(FEWEST, n // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.floor(buckets * (1 - F.exp(-F.col("key") * 0.8))).cast("int"))
    sums = written(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "bucket-sums", n // PART_ROWS + 1)
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    plan = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = written(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets", n // PART_ROWS + 1)
    run = Window.partitionBy("source").orderBy("bucket")
    ends = (
        sums.withColumn("end", F.sum("words").over(run))
        .join(bounded(plan.select(F.col("source").alias("s"), "rest")), F.col("source").eqNullSafe(F.col("s")))
        .where("end >= rest")
        .groupBy("s")
        .agg(F.min(F.struct("bucket", (F.col("end") - F.col("words")).alias("before"))).alias("last"))
    )
    plan = written(
        plan.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").select(
            F.col("source").alias("s"), "source_size", "target", "epochs", "rest", F.coalesce("last.bucket", F.lit(buckets + 1)).alias("last"), F.coalesce("last.before", F.lit(0)).alias("before")
        ),
        "plan",
        n // PART_ROWS + 1,
    )
    told = rows.join(bounded(plan), F.col("source").eqNullSafe(F.col("s")))
    edge = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    inside = told.where("bucket = last").withColumn("at", F.col("before") + F.sum("size").over(edge.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2)
    inside = inside.withColumn("more", F.col("at") <= F.col("rest")).drop("at")
    outside = told.where("bucket <> last").withColumn("more", F.col("bucket") < F.col("last"))
    taken = F.col("size") * (F.col("epochs") + F.when(F.col("more") & (F.col("epochs") < most), 1).otherwise(0))
    return outside.unionByName(inside).select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "tid")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as the mix takes it, with the columns of ``docs``.

    Rows with equal doc_id, source and text are taken equally often, the mean of their times rounded.
    """
    mean = F.round(F.avg(F.col("taken") / F.col("size"))).cast("int")
    times = _mix(docs, **options).where("size > 0").groupBy("doc_id", "source", "tid").agg(mean.alias("times")).where("times > 0")
    a, b = docs.alias("a"), bounded(written(times, "times")).alias("b")
    copy = unused(docs, "copy")
    on = F.col("a.doc_id").cast("long").eqNullSafe(F.col("b.doc_id")) & F.col("a.source").cast("string").eqNullSafe(F.col("b.source")) & (F.xxhash64("a.text") == F.col("b.tid"))
    return a.join(b, on).select("a.*", F.explode(F.sequence(F.lit(1), F.col("b.times"))).alias(copy)).drop(copy)
