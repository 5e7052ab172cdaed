"""Streams of reads: per-read operators run unchanged; counting needs an arrival time and a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corrected_stream(reads: DataFrame, corrections: DataFrame) -> DataFrame:
    """Stream of (…, bc) joined to a static table (bc, corr)."""
    return reads.join(corrections.where("corr is not null").select("bc", "corr"), "bc")


def umi_counts(reads: DataFrame, time: str = "ts", late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Distinct UMIs of (cell, gene) for each window of arrival: repeated UMIs are dropped in state bounded by the watermark."""
    w = F.window(time, window)
    keyed = reads.withWatermark(time, late).withColumn("w", w)
    return keyed.dropDuplicates(["w", "cell", "gene", "umi"]).groupBy("w", "cell", "gene").agg(F.count("*").alias("n"))
