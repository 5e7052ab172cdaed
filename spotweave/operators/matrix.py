"""Sparse count matrices as coordinate triplets with two dimension tables, never dense."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.sources.scratch import written

def ranked(df: DataFrame, order: list[Column], column: str) -> DataFrame:
    """``df`` in order with its place from 0 as ``column``: sorted ranges are numbered apart and offset, so no task sees all rows.

    The sorted ranges are written once; a range sorted anew after a lost executor could be cut elsewhere.
    """
    cut = written(df.orderBy(*order).withColumn("_p", F.spark_partition_id()), "sorted")
    sizes = cut.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    nth = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return cut.withColumn("_nth", nth).join(F.broadcast(before), "_p").withColumn(column, F.col("_base") + F.col("_nth")).drop("_p", "_nth", "_base")


def dense_index(names: DataFrame, column: str) -> DataFrame:
    """(ix, name) from 0 in order."""
    return ranked(names.select(F.col(column).alias("name")).distinct(), [F.asc("name")], "ix").select(F.col("ix").cast("int").alias("ix"), "name")


@dataclass
class Matrix:
    """Cells by genes: ``x`` (cell, gene, n), ``obs`` (cell, ...), ``var`` (gene, ...), layers like x, obsm by basis; ``raw`` is x before filters."""

    x: DataFrame
    obs: DataFrame
    var: DataFrame
    layers: dict[str, DataFrame] = field(default_factory=dict)
    obsm: dict[str, DataFrame] = field(default_factory=dict)
    raw: DataFrame | None = None

    def keep_raw(self) -> Matrix:
        return replace(self, raw=self.x)

    def subset(self, cells: DataFrame | None = None, genes: DataFrame | None = None) -> Matrix:
        out = self
        for key, names, table in (("cell", cells, "obs"), ("gene", genes, "var")):
            if names is not None:
                names = names.select(key).distinct()
                cut = lambda df, key=key, names=names: df.join(names, key, "left_semi")
                out = replace(out, x=cut(out.x), layers={k: cut(v) for k, v in out.layers.items()}, **{table: cut(getattr(out, table))})
        return out

    def transposed(self) -> Matrix:
        """Cells and genes change places; ``obsm``, which belongs to cells, then goes by genes, and ``raw`` is turned too."""
        turn = lambda df: df.select(F.col("gene").alias("cell"), F.col("cell").alias("gene"), "n")
        swap = lambda df: df.select(*[F.col(f"`{c}`").alias({"cell": "gene", "gene": "cell"}.get(c, c)) for c in df.columns])
        return Matrix(turn(self.x), swap(self.var), swap(self.obs), {k: turn(v) for k, v in self.layers.items()}, {k: swap(v) for k, v in self.obsm.items()}, None if self.raw is None else turn(self.raw))

    def add_layer(self, name: str, layer: DataFrame, how: str = "intersect") -> Matrix:
        """``layer`` (cell, gene, n) aligned by names: keep common cells and genes, or all of both."""
        if how == "intersect":
            out = self.subset(layer, layer)
            layer = layer.join(self.obs.select("cell"), "cell", "left_semi").join(self.var.select("gene"), "gene", "left_semi")
            return replace(out, layers=out.layers | {name: layer})
        obs = self.obs.join(layer.select("cell").distinct(), "cell", "full_outer")
        var = self.var.join(layer.select("gene").distinct(), "gene", "full_outer")
        return replace(self, obs=obs, var=var, layers=self.layers | {name: layer})


def long_to_coo(counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(coo (cell_ix, gene_ix, n), cells (ix, name), genes (ix, name)) from (gene, cell, n): zeros dropped, duplicates summed."""
    some = counts.where("n <> 0")
    cells, genes = dense_index(some, "cell"), dense_index(some, "gene")
    summed = some.groupBy("cell", "gene").agg(F.sum("n").cast("double").alias("n"))
    coo = summed.join(cells.withColumnsRenamed({"ix": "cell_ix", "name": "cell"}), "cell").join(genes.withColumnsRenamed({"ix": "gene_ix", "name": "gene"}), "gene")
    return coo.select("cell_ix", "gene_ix", "n"), cells, genes


def from_long(counts: DataFrame) -> Matrix:
    some = counts.where("n <> 0").groupBy("cell", "gene").agg(F.sum("n").cast("double").alias("n"))
    return Matrix(some, some.select("cell").distinct(), some.select("gene").distinct())


def place_in_space(m: Matrix, bc_map: DataFrame) -> Matrix:
    """Only cells of the spatial map (barcode, x, y), with their coordinates."""
    xy = bc_map.select(F.col("barcode").alias("cell"), "x", "y")
    out = m.subset(cells=xy)
    return replace(out, obs=out.obs.join(xy, "cell"), obsm=out.obsm | {"spatial": xy.join(out.obs, "cell", "left_semi")})


def annotate_genes(genes: DataFrame, annotation: DataFrame, key: str = "gene", missing: str | None = None) -> DataFrame:
    """Left join; a repeated key in the annotation is an error.  ``missing`` fills strings instead of NULL."""
    twice = annotation.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"annotation has {key} more than once: {twice[0][key]}")
    out = genes.join(annotation, key, "left")
    return out if missing is None else out.fillna(missing)


def nonzero_cells(x: DataFrame) -> DataFrame:
    return x.groupBy("cell").agg(F.sum("n").alias("s")).where("s > 0").select("cell")


def cell_qc(x: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """n_counts and n_genes of each cell; cells without entries get zeros."""
    out = x.groupBy("cell").agg(F.sum("n").cast("double").alias("n_counts"), F.count_if(F.col("n") > 0).alias("n_genes"))
    return out if cells is None else cells.select("cell").join(out, "cell", "left").fillna(0)


def matrix_qc(x: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """One row of totals; medians include empty cells."""
    per = cell_qc(x, cells)
    totals = per.agg(F.count("*").alias("n_cells"), F.sum("n_counts").alias("total_counts"), F.avg("n_counts").alias("mean_counts"), F.median("n_counts").alias("median_counts"), F.avg("n_genes").alias("mean_genes"), F.median("n_genes").alias("median_genes"))
    some = x.where("n > 0").agg(F.count("*").alias("n_entries"), F.count_distinct("gene").alias("genes_detected"))
    return totals.join(F.broadcast(some)).join(F.broadcast(genes.agg(F.count("*").alias("n_genes"))))


def knee_ranks(qc: DataFrame) -> DataFrame:
    """``qc`` with ``rank`` by counts and genes, both falling, then name."""
    return ranked(qc, [F.desc("n_counts"), F.desc("n_genes"), F.asc("cell")], "rank").withColumn("rank", F.col("rank") + 1)


def category_share(x: DataFrame, var: DataFrame, category: str, per_cent: bool = False) -> DataFrame:
    """(cell, category, share): part of a cell's counts in each category; 0/0 is 0."""
    joined = x.join(var.select("gene", category), "gene")
    sums = joined.groupBy("cell", category).agg(F.sum("n").alias("s"))
    total = F.sum("s").over(Window.partitionBy("cell"))
    return sums.select("cell", category, F.coalesce(F.try_divide(F.col("s") * (100 if per_cent else 1), total), F.lit(0.0)).alias("share"))


def gene_totals(x: DataFrame) -> DataFrame:
    return x.groupBy("gene").agg(F.sum("n").cast("double").alias("total"))


def top_genes(x: DataFrame, n: int) -> DataFrame:
    return gene_totals(x).orderBy(F.desc("total"), "gene").limit(n)


def names_like(names: DataFrame, column: str, patterns: list[str], exclude: list[str] = (), sort_by: Column | None = None) -> DataFrame:
    """Names that contain a pattern and no exclusion, case-sensitive; sorted if asked."""
    has = lambda ps: F.exists(F.array(*[F.lit(p) for p in ps]), lambda p: F.contains(F.col(column), p))
    out = names.where(has(patterns))
    if exclude:
        out = out.where(~has(exclude))
    return out if sort_by is None else out.orderBy(sort_by, column)


def make_unique(names: DataFrame, column: str, order: str, join: str = "-") -> DataFrame:
    """x, x-1, x-2 ... in order."""
    nth = F.row_number().over(Window.partitionBy(column).orderBy(order)) - 1
    return names.withColumn("unique_name", F.when(nth > 0, F.concat_ws(join, column, nth.cast("string"))).otherwise(F.col(column)))


def rename_features(names: DataFrame, column: str, mapping: DataFrame, order: str) -> DataFrame:
    """New names by (old, new) where there are any, the last of repeated ones, then made unique."""
    last = mapping.groupBy("old").agg(F.max_by("new", order).alias("new"))
    out = names.join(last, names[column] == last["old"], "left").withColumn("renamed", F.coalesce("new", column)).drop("old", "new")
    return make_unique(out, "renamed", column)


def top_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)


def wide(top: DataFrame, group: str, name: str) -> DataFrame:
    """Ranks as rows, groups as columns."""
    return top.groupBy("rank").pivot(group).agg(F.first(name)).orderBy("rank")


def long_top(top: DataFrame, group: str, name: str) -> DataFrame:
    """Ranked results as rows (group, rank, name, and what else was ranked by)."""
    others = [c for c in top.columns if c not in (group, "rank", name)]
    return top.select(group, "rank", name, *others).orderBy(group, "rank")
