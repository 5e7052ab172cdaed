"""Spatial operators on (cell, x, y) and on embeddings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.operators.graphs import components
from spotweave.sources.scratch import shared_folder


def close_pairs(points: DataFrame, distance: float, key: str = "cell") -> DataFrame:
    """(a, b) with a distance below ``distance``, each point with itself too: an equi-join on 3 x 3 grid cells."""
    p = points.select(key, "x", "y").withColumns({"gx": F.floor(F.col("x") / distance), "gy": F.floor(F.col("y") / distance)})
    near = p.withColumn("dx", F.explode(F.array(*map(F.lit, (-1, 0, 1))))).withColumn("dy", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    near = near.select(F.col(key).alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), (F.col("gx") + F.col("dx")).alias("gx"), (F.col("gy") + F.col("dy")).alias("gy"))
    d2 = (F.col("x") - F.col("bx")) ** 2 + (F.col("y") - F.col("by")) ** 2
    return p.join(near, ["gx", "gy"]).where(F.sqrt(d2) < distance).select(F.col(key).alias("a"), "b")


def neighbour_counts(points: DataFrame, distance: float, key: str = "cell") -> DataFrame:
    return close_pairs(points, distance, key).groupBy(F.col("a").alias(key)).agg(F.count("*").alias("n_neighbors"))


def drop_singlets(points: DataFrame, distance: float, more_than: int, rounds: int = 10, key: str = "cell") -> DataFrame:
    """Points with more than so many within ``distance`` (themselves included), again until none goes or after ``rounds``."""
    shared_folder(points.sparkSession)
    now = points.checkpoint()
    n = now.count()
    for _ in range(rounds):
        kept = neighbour_counts(now, distance, key).where(F.col("n_neighbors") > more_than).select(key)
        now = now.join(kept, key, "left_semi").checkpoint()
        left = now.count()
        if left == n:
            break
        n = left
    return now


def segment_tissues(points: DataFrame, threshold: float | None = None, tissues: int | None = None, key: str = "cell", section: str | None = None) -> DataFrame:
    """``points`` with ``segment``: one ordered pass in which each point gives its label to all within the threshold.

    The pass is sequential by definition, so a section (an image) is one
    group; sections are independent.  Without a threshold it is ``tissues``
    times the mean distance from the centroid.
    """
    if threshold is None and tissues is None:
        raise ValueError("give a threshold or the number of tissues")

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(key, kind="stable")
        xy = p[["x", "y"]].to_numpy(float)
        limit = threshold if threshold is not None else tissues * np.sqrt(((xy - xy.mean(0)) ** 2).sum(1)).mean()
        label = np.arange(len(xy))
        for i in range(len(xy)):
            label[np.sqrt(((xy - xy[i]) ** 2).sum(1)) <= limit] = label[i]
        names = {v: str(i) for i, v in enumerate(sorted(set(label.tolist())))}
        return p.assign(segment=[names[v] for v in label.tolist()])

    schema = ", ".join(f"`{n}` {t}" for n, t in points.dtypes) + ", segment string"
    return points.groupBy(*([section] if section else [])).applyInPandas(one, schema)


def tissue_components(points: DataFrame, distance: float, key: str = "cell", section: str | None = None) -> DataFrame:
    """``points`` with ``tissue``: the least key of those that are linked to a point by steps shorter than ``distance``, within its section.

    Neighbours are found on a grid and linked as components of a graph, so no image has to fit a task.
    """
    by = F.lit(0) if section is None else F.col(section)
    named = points.withColumn("_p", F.struct(by.alias("s"), F.col(key).alias("k")))
    pairs = close_pairs(named.select("_p", "x", "y"), distance, "_p").where("a < b and a.s <=> b.s")
    linked = components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return named.join(linked, F.col("_p") == F.col("node"), "left").select(*[F.col(f"`{c}`") for c in points.columns], F.coalesce("component.k", "_p.k").alias("tissue"))


def in_polygon(points: DataFrame, polygon: list[tuple[float, float]], column: str = "roi") -> DataFrame:
    """``points`` with whether they lie inside: crossings of a ray, summed over a constant array of edges."""
    edges = [F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), (*a, *b), strict=True)]) for a, b in zip(polygon, polygon[1:] + polygon[:1], strict=True)]
    x, y = F.col("x"), F.col("y")
    cross = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.when(e["y2"] != e["y1"], e["y2"] - e["y1"]).otherwise(1.0) + e["x1"])
    return points.withColumn(column, F.size(F.filter(F.array(*edges), cross)) % 2 == 1)


def rotate(points: DataFrame, degrees: float) -> DataFrame:
    """Clockwise about the centroid."""
    c, s = float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))
    centre = points.agg(F.avg("x").alias("_cx"), F.avg("y").alias("_cy"))
    dx, dy = F.col("x") - F.col("_cx"), F.col("y") - F.col("_cy")
    return points.join(F.broadcast(centre)).withColumns({"x": F.col("_cx") + dx * c + dy * s, "y": F.col("_cy") - dx * s + dy * c}).drop("_cx", "_cy")


def rescale(points: DataFrame, scale: float | tuple[float, float] = 1.0, to_zero: bool = False) -> DataFrame:
    sx, sy = scale if isinstance(scale, tuple) else (scale, scale)
    out = points.withColumns({"x": F.col("x") * sx, "y": F.col("y") * sy})
    if to_zero:
        low = out.agg(F.min("x").alias("_lx"), F.min("y").alias("_ly"))
        out = out.join(F.broadcast(low)).withColumns({"x": F.col("x") - F.col("_lx"), "y": F.col("y") - F.col("_ly")}).drop("_lx", "_ly")
    return out


def to_frame(points: DataFrame, size: tuple[float, float], target: tuple[float, float]) -> DataFrame:
    """Coordinates of one image in the frame of another."""
    return rescale(points, (target[0] / size[0], target[1] / size[1]))


def dimension_variance(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(dim, variance), population variance."""
    return vectors.select(F.posexplode(column).alias("dim", "v")).groupBy("dim").agg(F.var_pop(F.col("v").cast("double")).alias("variance"))


def dims_for_share(variances: DataFrame, share: float = 0.95) -> DataFrame:
    """Number of leading dimensions whose variances reach ``share`` of the sum."""
    w = Window.orderBy("dim")
    run = variances.withColumn("run", F.sum("variance").over(w)).withColumn("all", F.sum("variance").over(Window.partitionBy()))
    return run.agg((F.count_if(F.col("run") < share * F.col("all")) + 1).alias("n_dims"))


def reorder_dimensions(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Dimensions by falling variance; the order is an array of constants, as long as a vector."""
    order = [r["dim"] for r in dimension_variance(vectors, column).orderBy(F.desc("variance"), "dim").collect()]
    return vectors.withColumn(column, F.transform(F.array(*[F.lit(i) for i in order]), lambda i: F.get(column, i)))
