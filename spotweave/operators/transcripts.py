"""Transcripts assembled from annotation rows: exons in order, coding spans, BED12 rows and junctions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(annotation: DataFrame, gene: str = "gene_id", transcript: str = "transcript_id") -> DataFrame:
    """(gene, transcript, chrom, strand, start, end, thick_start, thick_end, exons), 0-based half-open.

    Exons are distinct and in order of position; those that overlap or touch are one.  The thick span reaches over
    CDS and stop codons; without any it is empty and lies at the end.  A name that stands on two chromosomes or strands is two
    transcripts; rows without a transcript take no part.
    """
    a = F.col("attributes")
    rows = annotation.where(F.col("feature").isin("exon", "CDS", "stop_codon")).select(
        a[transcript].alias("transcript"), a[gene].alias("gene"), F.col("seqname").alias("chrom"), "strand", (F.col("start").cast("long") - 1).alias("start"), F.col("end").cast("long").alias("end"), (F.col("feature") == "exon").alias("exon")
    )
    rows = rows.where("transcript is not null and transcript <> '' and end > start")
    found = rows.groupBy("transcript", "chrom", "strand").agg(
        F.min("gene").alias("gene"),
        F.array_sort(F.collect_set(F.when(F.col("exon"), F.struct("start", "end")))).alias("parts"),
        F.min(F.when(~F.col("exon"), F.col("start"))).alias("thick_start"),
        F.max(F.when(~F.col("exon"), F.col("end"))).alias("thick_end"),
    )
    joined = F.expr(
        """aggregate(parts, cast(array() as array<struct<start:bigint,end:bigint>>), (out, e) ->
             if(size(out) > 0 and element_at(out, -1).end >= e.start,
                concat(slice(out, 1, size(out) - 1), array(named_struct('start', element_at(out, -1).start, 'end', greatest(element_at(out, -1).end, e.end)))),
                concat(out, array(e))))"""
    )
    found = found.where("size(parts) > 0").withColumn("exons", joined)
    end = F.element_at("exons", -1)["end"]
    return found.select(
        "gene", "transcript", "chrom", "strand", F.col("exons")[0]["start"].alias("start"), end.alias("end"), F.coalesce("thick_start", end).alias("thick_start"), F.coalesce("thick_end", end).alias("thick_end"), "exons"
    )


def introns(exons: str = "exons"):
    """Array of (start, end) of the gaps between neighbouring exons, as SQL over an array of them in order."""
    return F.expr(f"transform(slice({exons}, 1, size({exons}) - 1), (e, i) -> named_struct('start', e.end, 'end', {exons}[i + 1].start))")


def bed12(transcripts: DataFrame) -> DataFrame:
    """The twelve columns of BED, one row a transcript: blocks with their sizes and their starts from the transcript's own."""
    text = lambda x: F.concat(F.array_join(F.transform("exons", x), ","), F.lit(","))
    return transcripts.select(
        "chrom", "start", "end", F.col("transcript").alias("name"), F.lit(0).alias("score"), "strand", "thick_start", "thick_end", F.lit("0").alias("rgb"), F.size("exons").alias("n_blocks"),
        text(lambda e: (e["end"] - e["start"]).cast("string")).alias("sizes"), text(lambda e: (e["start"] - F.col("start")).cast("string")).alias("starts"),
    )


def junctions(transcripts: DataFrame, distinct: bool = False) -> DataFrame:
    """(chrom, start, end, name, score, strand) of every gap between neighbouring exons; ``distinct`` has each once, scored by its transcripts and named by the least."""
    gaps = transcripts.select("chrom", F.explode(introns()).alias("j"), F.col("transcript").alias("name"), "strand").select("chrom", "j.start", "j.end", "name", "strand")
    if distinct:
        gaps = gaps.groupBy("chrom", "start", "end", "strand").agg(F.min("name").alias("name"), F.count_distinct("name").alias("score"))
        return gaps.select("chrom", "start", "end", "name", "score", "strand")
    return gaps.select("chrom", "start", "end", "name", F.lit(0).cast("long").alias("score"), "strand")
