"""Whole runs as one lazy plan: reads to corrected barcodes to UMI counts to an annotated matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators import barcodes as bc
from spotweave.operators import matrix as mx
from spotweave.operators import reads as rd
from spotweave.operators import tags as tg
from spotweave.operators import umis as um
from spotweave.plans.config import Recipe
from spotweave.sources.scratch import written


def barcodes_of(reads: DataFrame, recipe: Recipe, whitelists: list[DataFrame], enforce_thresholds: bool = False) -> DataFrame:
    """(read_id, cb, umi) of reads whose barcodes were found and corrected."""
    if recipe.internal_adapter:
        reads = rd.internal_trim(reads, [recipe.internal_adapter])
    # Written before any are dropped: the filter would be moved in front of what makes the calls and make them anew.
    calls = written(rd.call_barcodes(reads, recipe.barcodes, recipe.umis), "calls")
    calls = rd.drop_missing_calls(calls).withColumn("umi", F.array_join("umis", ""))
    return bc.slim(bc.correct(calls, whitelists, max_dist=recipe.max_dist, min_margin=recipe.min_margin, concat=recipe.concat, keep=["umi"], stored=True), enforce_thresholds)


def long_reads(reads: DataFrame, recipe: Recipe, adapter2: str, split: str = "TTTTTTTT") -> DataFrame:
    """(read_id, r1, r2) of full-length long reads, turned forward and split at the poly-T."""
    scan = rd.adapter_scan(reads, [recipe.fwd_primer], [adapter2])
    full = tg.only_ids(rd.stranded_reads(reads, scan), rd.full_length(scan))
    return rd.split_reads(full, recipe.fwd_primer, split).where("status = 'written'").select("read_id", "r1", "r2")


def count_reads(barcoded: DataFrame, genes: DataFrame, method: str = "exact") -> DataFrame:
    """(cell, gene, n) from (read_id, cb, umi) and (read_id, gene)."""
    joined = barcoded.join(genes, "read_id").select(F.col("cb").alias("cell"), "gene", "umi")
    return um.count_exact(joined) if method == "exact" else um.count_directional(joined)


def annotated_matrix(counts: DataFrame, bc_map: DataFrame, annotation: DataFrame | None = None) -> mx.Matrix:
    # Cells, genes and their summaries are all made from the counts: written, so that they and the map are made once.
    m = mx.place_in_space(mx.from_long(written(counts, "counts")).keep_raw(), written(bc_map, "map"))
    m = m.subset(cells=mx.nonzero_cells(m.x))
    m.obs = m.obs.join(mx.cell_qc(m.x, m.obs), "cell")
    if annotation is not None:
        m.var = mx.annotate_genes(m.var, annotation)
    return m


def tagged_alignments(alignments: DataFrame, barcoded: DataFrame, assigned: DataFrame) -> DataFrame:
    """Alignments with CB, UR and GN, without those that lack a barcode or gene."""
    table = tg.tag_table(barcoded.withColumn("_o", F.lit(0)), "read_id", ["cb", "umi"], "_o")
    genes = tg.tag_table(assigned.where("targets is not null").withColumn("_o", F.lit(0)), "read_id", ["targets"], "_o")
    out = tg.attach(alignments, table, {"CB": "cb", "UR": "umi"})
    return tg.tag_filled(tg.tag_filled(tg.attach(out, genes, {"GN": "targets"}), "CB"), "GN")
